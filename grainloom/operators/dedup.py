"""Keyed deduplication, merging and exclusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainloom.session import checkpoint


def keep_first(rows: DataFrame, key: Column, *order: Column, null_keys: str = "keep") -> DataFrame:
    """The first row of each key in the given order; rows with a null key all stay (``keep``) or share one key (``group``).

    Planned with a partial limit before the shuffle, so a hot key sends one row per task.
    """
    first = F.row_number().over(Window.partitionBy("_key").orderBy(*order)) == 1
    keyed = rows.withColumn("_key", key)
    if null_keys == "group":
        return keyed.withColumn("_first", first).filter("_first").drop("_key", "_first")
    alone = keyed.filter("_key is null").drop("_key")
    return keyed.filter("_key is not null").withColumn("_first", first).filter("_first").drop("_key", "_first").unionByName(alone)


def exclude_by_key(rows: DataFrame, others: DataFrame, key: Column) -> DataFrame:
    """Rows whose key is not among the others'; null keys count as empty; duplicates within rows stay."""
    keys = others.select(F.coalesce(key, F.lit("")).alias("_key")).distinct()
    return rows.withColumn("_key", F.coalesce(key, F.lit(""))).join(keys, "_key", "left_anti").drop("_key")


def merge_longest(rows: DataFrame, problem: Column, solution: Column, order: str) -> DataFrame:
    """One row per problem with the longest solution (earliest on ties); ``first_order`` is the output position.

    One partial aggregate and one shuffle, which carries a text for each problem and task.
    """
    keyed = rows.select(problem.alias("problem"), solution.alias("solution"), F.col(order).alias("ord"))
    best = F.min(F.struct((-F.length("solution")).alias("n"), "ord", "solution")).alias("best")
    merged = keyed.groupBy("problem").agg(F.min("ord").alias("first_order"), best)
    return merged.select("problem", "first_order", "best.ord", "best.solution").withColumnRenamed("ord", "row_order")


def merge_counters(rows: DataFrame, problem: Column, solution: Column, order: str) -> DataFrame:
    """How many rows were new, replaced a shorter solution, or left the kept one."""
    before = Window.partitionBy("p").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.select(F.md5(F.encode(problem, "utf-8")).alias("p"), F.length(solution).alias("n"), F.col(order).alias("ord")).withColumn("longest", F.max("n").over(before))
    new, replaced = F.col("longest").isNull(), F.col("n") > F.col("longest")
    return seen.agg(F.count_if(new).alias("n_new"), F.count_if(replaced).alias("n_replaced"), F.count_if(~new & ~replaced).alias("n_kept"))


def with_ordinal(rows: DataFrame, order: str, name: str = "ordinal") -> DataFrame:
    """A dense 0-based number in the order of a column, without gathering the rows in one task.

    Rows are range-partitioned and numbered within partitions; the partitions' offsets are a table as long
    as there are partitions.
    """
    spread = checkpoint(rows.repartitionByRange(F.col(order)).withColumn("_part", F.spark_partition_id()))
    sizes = spread.groupBy("_part").agg(F.count("*").alias("_n"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(sizes.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead")))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return spread.withColumn("_in", within).join(offsets, "_part").withColumn(name, F.col("_in") + F.col("_ahead")).drop("_part", "_in", "_ahead")
