"""Registered queries against their check SQL, and the shape of important plans."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from onefold.workload import CHECKS, QUERIES

FOLDER = "/root/testdata/sf0.001"
HEAVY = [n for n in QUERIES if n[0] in "cdj" and n.split("_")[0] in {"c7", "c9", "d3", "j1", "j10"}]
MORE = ["j13_upsert_movies", "j17_model_violations", "c12_seed_genres", "c10_genre_names"]
LIGHT = [n for n in CHECKS if n[0] in "bh" and n.split("_")[0] not in {"b8", "b16"}] + MORE


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(LIGHT + HEAVY))
def test_query_equals_its_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, CHECKS[name]) is None


def test_every_query_but_the_unordered_limit_has_sql():
    assert set(QUERIES) - set(CHECKS) == {"e6_any_ten"}
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())


def test_the_entry_imports_without_jars_and_without_the_optional_parts(tmp_path):
    """A copy of the repository without the training-data operators, and no jar folder of Spark in sight."""
    root = Path(entry.__file__).parent
    shutil.copytree(root / "onefold", tmp_path / "onefold", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import pyspark; pyspark.__file__ = '/nowhere/x.py'; import __spark_entry__ as e; print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.stdout.strip() == str(len(QUERIES)), done.stderr


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["a6_parquet_scan"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(l_quantity,45.0)" in plan
    scan = plan[plan.rindex("ReadSchema"):]
    assert "l_comment" not in scan and "l_extendedprice" not in scan
