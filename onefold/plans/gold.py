"""The unified, denormalised table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onefold.operators.clean import THEME
from onefold.operators.fuzzy import THRESHOLD, YEAR_TOLERANCE
from onefold.operators.survive import reconcile
from onefold.schema import GOLD_SCHEMA


def with_theme(gold: DataFrame, theme: str = THEME) -> DataFrame:
    """Rows whose genres hold the theme exactly."""
    return gold.filter(F.array_contains("genres", theme))


def typed(unified: DataFrame) -> DataFrame:
    """The fixed schema, so that a column without any value keeps its type."""
    return unified.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in GOLD_SCHEMA])


def build_gold(
    partials: DataFrame,
    theme: str | None = THEME,
    threshold: int = THRESHOLD,
    tolerance: int = YEAR_TOLERANCE,
    keep_order: bool = False,
) -> DataFrame:
    """Reconcile partials and keep the theme. `keep_order` adds `first_seq`, the input position of a row."""
    unified = reconcile(partials, threshold, tolerance)
    table = unified.select(*GOLD_SCHEMA.fieldNames(), *(["first_seq"] if keep_order else []))
    return table if theme is None else with_theme(table, theme)
