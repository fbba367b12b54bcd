"""Small reports: histograms with bars, first errors, counters, previews."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_bars(histogram: DataFrame, percent: str = "percent") -> DataFrame:
    """A bar of one block for every two percent."""
    return histogram.withColumn("bar", F.repeat(F.lit("█"), F.floor(F.col(percent) / 2).cast("int")))


def first_errors(rows: DataFrame, order: str, error: str = "parse_error", n: int = 10) -> DataFrame:
    """The first errors in order; a limit by the report's definition, the count of all is ``error_count``."""
    return rows.filter(F.col(error).isNotNull()).select(order, error).orderBy(order).limit(n)


def error_count(rows: DataFrame, error: str = "parse_error") -> DataFrame:
    return rows.agg(F.count_if(F.col(error).isNotNull()).alias("n_errors"), F.count("*").alias("n_rows"))


def flagged_path(path: str) -> str:
    """The default place of the flagged rows beside an output."""
    return str(Path(path).with_suffix(".flagged.jsonl"))


def checkpoint_path(path: str) -> str:
    """The default place of the done ids beside an output."""
    return str(Path(path).with_suffix(".checkpoint"))


def preview(rows: DataFrame, n: int = 1) -> tuple[str, list]:
    """Schema and first rows of a source."""
    return rows.schema.simpleString(), rows.take(n)
