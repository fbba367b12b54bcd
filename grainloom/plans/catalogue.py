"""All queries of the core, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from grainloom.operators.rowparse import parse_rows
from grainloom.plans import curation
from grainloom.session import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_rows(table(spark, sf_dir, "raw_lines")).filter("status = 'failed'").select("line_id", "reason")


def p3_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_rows(table(spark, sf_dir, "raw_lines")).filter("status = 'loaded'").select("line_id", "index", "source", "messages")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p3_found": p3_found, "p3_loaded": p3_loaded} | curation.queries()


def oracle_sql() -> dict[str, str]:
    return curation.oracle_sql()
