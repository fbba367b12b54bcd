"""Duplicates hidden by formatting differences (problem 4).

Records are compared by a canonical key. Exact counts, combined in each task before they move, find the
hot keys; their copies are reduced in two levels (key and salt, then key) and the members learn their
representative from a broadcast table whose size is bounded by the threshold. All other keys go through
one shuffle, in groups smaller than the threshold. The representative is the smallest identifier.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainloom.session import checkpoint

#: The marks that do not count, besides white space.
MARKS = ".,;:!?'\"“”‘’…–—"
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def canonical_text(text: Column) -> Column:
    """The text without case, white space and MARKS; a point or comma between two digits stays."""
    points = F.regexp_replace(text, r"[.,](?:(?<!\p{Nd}[.,])|(?!\p{Nd}))", "")
    others = "".join(m for m in MARKS if m not in ".,")
    return F.replace(F.translate(F.lower(F.upper(points)), "ς" + SPACES + others, "σ"), F.lit("ß"), F.lit("ss"))


def canonical_json(text: Column) -> Column:
    """An object with its keys in order and no spaces; what is no JSON stays as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)


def record_key(messages: Column, extra: Column) -> Column:
    """128-bit key of roles and canonical contents in order, and of the other fields; null without messages."""
    parts = F.transform(messages, lambda m: F.struct(m["role"].alias("r"), canonical_text(m["content"]).alias("c")))
    whole = F.to_json(F.struct(parts.alias("m"), canonical_json(extra).alias("e")), {"ignoreNullFields": "false"})
    return F.when(messages.isNotNull(), F.unhex(F.md5(whole.cast("binary"))))


def collapse(keyed: DataFrame, *, key: str = "key", row_id: str = "row_id", hot_least: int = 16, hot_share: float = 1e-5, salts: int = 64) -> DataFrame:
    """Members of each group of equal keys: ``key, row_id, keep_id, n_copies``; null keys take no part.

    A key is hot from ``hot_least`` rows on if it holds ``hot_share`` of all rows: there are at most
    ``1 / hot_share`` hot keys, which bounds what is broadcast, and no other group is larger than a hundred
    thousandth of the rows. A repeated row_id counts as one row.
    """
    rows = checkpoint(keyed.select(F.col(key).alias("key"), F.col(row_id).alias("row_id")).filter("key is not null"))  # keys are small, and dear to compute
    limit = max(hot_least, math.ceil(rows.count() * hot_share))
    hot = F.broadcast(rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") >= limit).select("key"))
    hot_rows = rows.join(hot, "key", "left_semi")
    salted = hot_rows.withColumn("salt", F.pmod(F.xxhash64("row_id"), F.lit(salts)))
    first = salted.groupBy("key", "salt").agg(F.min("row_id").alias("keep_id"), F.count_distinct("row_id").alias("n_copies"))
    keep = first.groupBy("key").agg(F.min("keep_id").alias("keep_id"), F.sum("n_copies").alias("n_copies"))
    hot_members = hot_rows.distinct().join(F.broadcast(keep), "key")
    group = Window.partitionBy("key")
    cold = rows.join(hot, "key", "left_anti").distinct().select("key", "row_id", F.min("row_id").over(group).alias("keep_id"), F.count("*").over(group).alias("n_copies"))
    return cold.unionByName(hot_members.select(cold.columns))


def formatting_duplicates(records: DataFrame, *, row_id: str = "rec_id", messages: str = "messages", extra: str = "extra", **limits: float) -> DataFrame:
    """Groups of records that differ only in formatting: ``row_id, keep_id, n_copies`` for each record.

    Two records are the same if roles, canonical contents and the keys and values of ``extra`` agree (or
    both are null). A record with null messages or a null id takes no part; an empty array of messages, an
    empty or a null content are values like others. ``n_copies`` counts distinct ids; ties do not arise,
    since ids are distinct. Other columns, whatever their names, are ignored.
    """
    keyed = records.filter(F.col(row_id).isNotNull()).select(F.col(row_id).alias("row_id"), record_key(F.col(messages), F.col(extra)).alias("key"))
    return collapse(keyed, **limits).select("row_id", "keep_id", "n_copies")
