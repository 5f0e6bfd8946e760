"""Run registered queries on Spark and their check SQL in DuckDB, and compare names, types and rows.

As a script: python tests/compare.py FOLDER [NAME_PART ...]
"""

from __future__ import annotations

import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
conversations""".split()
SAME = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(df, con, sql):
    """None when equal, otherwise what differs."""
    names = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*names).collect())
    result = con.execute(f"SELECT {', '.join(names)} FROM ({sql})")
    types = {d[0]: str(d[1]) for d in result.description}
    want = Counter(result.fetchall())
    kinds = dict(df.dtypes)
    if {n.lower() for n in names} != {n.lower() for n in types}:
        return f"columns {names} / {sorted(types)}"
    odd = {n: (kinds[n], types[n]) for n in names if SAME.get(kinds[n]) != types.get(n, "")}
    if got != want:
        return f"rows {sum(got.values())} / {sum(want.values())}; only spark {list((got - want))[:2]}; only sql {list((want - got))[:2]}"
    return f"types {odd}" if odd else None


def main():
    from pyspark.sql import SparkSession

    from onefold.workload import CHECKS, QUERIES

    folder, parts = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="onefold-compare-"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, failed = duck(folder), 0
    for name in sorted(QUERIES):
        if parts and not any(name.startswith(p) for p in parts):
            continue
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            problem = compare(df, con, CHECKS[name]) if name in CHECKS else f"no sql, {df.count()} rows"
            if name not in CHECKS:
                print(f"{name:28} {time.time() - start:6.1f}s  {problem}", flush=True)
                continue
        except Exception as e:
            problem = f"error {str(e)[:700]}"
        failed += problem is not None
        print(f"{name:28} {time.time() - start:6.1f}s  {problem or 'ok'}"[:1500], flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
