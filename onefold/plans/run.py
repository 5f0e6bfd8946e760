"""The whole run: ingest, unify, report, load."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from onefold.operators.clean import THEME
from onefold.operators.quality import quality_report
from onefold.plans.adapters import collect_partials
from onefold.plans.gold import build_gold, typed
from onefold.plans.model import TABLES, load_statistics, normalise
from onefold.sources.readers import missing_as_empty, read_parquet
from onefold.sources.writers import current_snapshot, publish, write_parquet
from onefold.schema import API_SCHEMA, BULK_SCHEMA, RATINGS_EXTRACT_SCHEMA, SCRAPED_SCHEMA, TEXT_ENRICHMENT_SCHEMA

log = logging.getLogger(__name__)

# Order of ingestion: the text job reads what the bulk file left behind.
INGEST_ORDER = ("tmdb", "imdb", "kaggle", "rotten_tomatoes", "spark")

CLEAN_SCHEMAS = {
    "tmdb": API_SCHEMA,
    "rotten_tomatoes": SCRAPED_SCHEMA,
    "kaggle": BULK_SCHEMA,
    "imdb": RATINGS_EXTRACT_SCHEMA,
    "spark": TEXT_ENRICHMENT_SCHEMA,
}


def ingest(jobs: dict[str, Callable[[], DataFrame]], clean_root: str, sources: list[str] | None = None) -> dict[str, bool]:
    """Run the cleaning job of each source and write its clean table. A source that fails, or that is wanted by
    name and has no job, is reported as False and does not stop the others."""
    wanted = list(INGEST_ORDER) if sources is None else sources
    unknown = [s for s in wanted if s not in INGEST_ORDER]
    if unknown:
        raise ValueError(f"unknown source: {', '.join(unknown)}")
    done = {}
    for name in INGEST_ORDER:
        if name not in wanted or (sources is None and name not in jobs):
            continue
        if name not in jobs:
            log.error("source %s is wanted and has no job", name)
            done[name] = False
            continue
        try:
            write_parquet(jobs[name](), f"{clean_root}/{name}")
            done[name] = True
        except Exception as e:  # a broken source must not take the others with it
            log.error("source %s failed: %s", name, e)
            done[name] = False
    return done


def clean_tables(spark: SparkSession, clean_root: str) -> dict[str, DataFrame]:
    """Every clean table on disk; one that is missing is empty."""
    return {
        name: missing_as_empty(spark, lambda n=name: read_parquet(spark, f"{clean_root}/{n}"), schema)
        for name, schema in CLEAN_SCHEMAS.items()
    }


def run(
    spark: SparkSession,
    jobs: dict[str, Callable[[], DataFrame]],
    root: str,
    sources: list[str] | None = None,
    skip_ingest: bool = False,
    load: bool = True,
    theme: str = THEME,
) -> dict:
    """Ingest `sources`, unify all clean tables on disk (also those of earlier runs), write the unified
    table, report on it, and publish the normalised model. Returns a summary."""
    summary: dict = {"ingest": {}, "gold": None, "load": None}
    clean_root = f"{root}/clean"
    if not skip_ingest:
        summary["ingest"] = ingest(jobs, clean_root, sources)
    unified = build_gold(collect_partials(clean_tables(spark, clean_root)), theme, keep_order=True)
    write_parquet(unified, f"{root}/gold")
    gold = read_parquet(spark, f"{root}/gold")
    summary["gold"] = quality_report(typed(gold)).first().asDict()
    if load:
        publish(spark, normalise(gold, ["first_seq"]), f"{root}/model")
        where = current_snapshot(spark, f"{root}/model")
        tables = {n: read_parquet(spark, f"{where}/{n}") for n in TABLES}
        summary["load"] = {r.table_name: r.rows for r in load_statistics(tables).collect()}
    return summary
