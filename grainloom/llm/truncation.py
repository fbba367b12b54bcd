"""Text cut off by field limits (problem 1).

Each content has ten lengths: as code points and in other encodings, with entities or JSON escapes, with
other line ends. A hidden limit of a source is a length, in one of them, that more of its different texts
have than the lengths around it let expect, and of which most break off. A content that stands at a limit
was cut unless its ending proves that it is whole; away from the limits the ending alone decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainloom.llm.endings import judge, with_endings
from grainloom.session import checkpoint

ROLES = ("user", "assistant")
#: The order in which encodings are preferred where several explain the same texts.
ENCODINGS = ("code points", "utf-8", "utf-16", "entities", "entities utf-8", "entities and quotes", "json", "json ascii", "crlf", "crlf utf-8")


def count_of(text: Column, *chars: str) -> Column:
    return sum((F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in chars), F.lit(0))


def encoded_lengths(text: Column) -> Column:
    """Lengths of the text as it may have been stored, in the order of ENCODINGS."""
    n, utf8, lines = F.length(text), F.octet_length(text), count_of(text, "\n")
    units = F.when(utf8 == n, n).otherwise(F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")
    tags = 4 * count_of(text, "&") + 3 * count_of(text, "<", ">")
    quotes = 5 * count_of(text, '"') + 4 * count_of(text, "'")
    escapes = count_of(text, '"', "\\", "\n", "\r", "\t")
    wide = F.when(utf8 == n, 0).otherwise(n - F.length(F.regexp_replace(text, r"[^\x00-\x7f]", "")))
    lengths = (n, utf8, units, n + tags, utf8 + tags, n + tags + quotes, n + escapes, units + escapes + 5 * (wide + units - n), n + lines, utf8 + lines)
    return F.array(*[x.cast("int") for x in lengths])


def contents(records: DataFrame, row_id: str, messages: str, source: str) -> DataFrame:
    each = records.filter(F.col(row_id).isNotNull()).select(F.col(row_id).alias("row_id"), F.col(source).alias("source"), F.posexplode(messages).alias("turn", "m"))
    rows = each.select("row_id", "source", "turn", F.col("m.role").alias("role"), F.col("m.content").alias("text"))
    return rows.filter(F.col("role").isin(*ROLES) & F.col("text").rlike(r"\S"))


def storage_limits(texts: DataFrame, *, reach: int = 25, doubt: float = 0.01) -> DataFrame:
    """Hidden limits: ``source, encoding, field_limit, n_texts``.

    ``texts`` has ``source, sample, lengths, sure``. Copies of a text count once. A length is a limit if so
    many texts have it as chance gives to no length of the source but with probability ``doubt`` (the tail of a
    Poisson variable by Chernoff's bound, its mean from the ``reach`` lengths on either side, for all lengths
    of the source in all encodings), and at least half of them do not surely end. Each text then belongs to
    the limit with most texts (the first of ENCODINGS on ties), and a limit stays if half of its texts do.
    """
    distinct = texts.groupBy("source", "sample", "lengths").agg(F.min("sure").alias("sure"))
    each = distinct.select("source", "sure", F.posexplode("lengths").alias("encoding", "n"))
    counts = each.groupBy("source", "encoding", "n").agg(F.count("*").alias("k"), F.count_if(~F.col("sure")).alias("broken"))
    # windows over lengths, not texts: as many rows as a source has different lengths
    near = F.sum("k").over(Window.partitionBy("source", "encoding").orderBy("n").rangeBetween(-reach, reach)) - F.col("k")
    mean = (near + 1) / (2.0 * reach)
    k, cells = F.col("k"), F.count("*").over(Window.partitionBy("source"))
    peak = (k > mean) & (k * F.log(k / mean) - k + mean >= F.log(cells / F.lit(doubt)))
    peaks = checkpoint(counts.select("source", "encoding", "n", "k", (peak & (2 * F.col("broken") >= k)).alias("peak")).filter("peak").drop("peak"))
    voted = at_limits(distinct, peaks).filter("at is not null").groupBy("source", F.col("at.encoding").alias("encoding"), F.col("at.n").alias("n")).agg(F.count("*").alias("n_texts"), F.max("at.k").alias("k"))
    names = F.element_at(F.array(*map(F.lit, ENCODINGS)), F.col("encoding") + 1)
    return voted.filter("2 * n_texts >= k").select("source", names.alias("encoding"), F.col("n").alias("field_limit"), "n_texts", F.col("encoding").alias("code"))


def at_limits(texts: DataFrame, limits: DataFrame, *, salts: int = 16, most: int = 10_000) -> DataFrame:
    """The texts with ``at``: the limit (``k, first, encoding, n``) of their source that they stand at, of several the one with most texts.

    Up to ``most`` limits are broadcast, so no text moves. Of more, each source's are repeated for ``salts`` salts and
    joined, so that a source of a third of all texts is spread over tasks. ``limits`` is a written table.
    """
    limit = F.struct("k", (-F.col("encoding")).alias("first"), "encoding", "n")
    per_source = limits.groupBy(F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("none")).agg(F.collect_list(limit).alias("limits"))
    keyed = texts.withColumns({"s": F.coalesce("source", F.lit("")), "none": F.col("source").isNull()})
    if limits.count() <= most:
        joined = keyed.join(F.broadcast(per_source), ["s", "none"], "left")
    else:
        salted = per_source.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = keyed.withColumn("salt", F.pmod("sample", F.lit(salts)).cast("int")).join(salted, ["s", "none", "salt"], "left").drop("salt")
    met = F.filter("limits", lambda x: F.get("lengths", x["encoding"]) == x["n"])
    return joined.withColumn("at", F.array_max(met)).drop("s", "none", "limits")


def cut_contents(records: DataFrame, *, row_id: str = "rec_id", messages: str = "messages", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """Contents of users and assistants that were cut off, and the storage limits that cut them.

    The first result has ``row_id, source, turn, role, field_limit, by_limit`` for each cut content:
    ``field_limit`` is null where it stands at no limit, as after a broken transfer, and ``by_limit`` is true
    where only the limit tells. A content is cut if its ending shows it (an open formula, a sign of the cut),
    or is no whole sentence, or if it stands exactly at a limit and closes neither with a stop nor with a
    sure ending that could not go on, as a number could. The second result is that of ``storage_limits``. Null and blank contents and
    null messages are not cut; null sources are a source of their own; an empty table gives empty results;
    repeated rows give repeated rows.
    """
    each = contents(records, row_id, messages, source).withColumn("lengths", encoded_lengths(F.col("text")))
    judged = checkpoint(judge(with_endings(each)))
    limits = checkpoint(storage_limits(judged))
    at = at_limits(judged, limits.select("source", F.col("code").alias("encoding"), F.col("field_limit").alias("n"), F.col("n_texts").alias("k")))
    proven = F.col("stop") | (F.col("sure") & ~F.col("tail").endswith("9"))  # part of a number is a number, too
    by_limit = F.col("at").isNotNull() & ~proven
    rows = at.filter(by_limit | ~F.col("whole"))
    return rows.select("row_id", "source", "turn", "role", F.col("at.n").alias("field_limit"), F.col("whole").alias("by_limit")), limits.drop("code")


def source_shares(records: DataFrame, *, row_id: str = "rec_id", messages: str = "messages", source: str = "source") -> DataFrame:
    """For each source: records, records with a cut content, their share, and how many stand at a limit."""
    cut, _ = cut_contents(records, row_id=row_id, messages=messages, source=source)
    per_record = cut.groupBy("source", "row_id").agg(F.max(F.col("field_limit").isNotNull()).alias("at_limit"))
    bad = per_record.groupBy(F.col("source").alias("s")).agg(F.count("*").alias("n_cut"), F.count_if("at_limit").alias("n_at_limit"))
    all_ = records.filter(F.col(row_id).isNotNull()).groupBy(F.col(source).alias("source")).agg(F.count_distinct(row_id).alias("n_records"))
    joined = all_.join(bad, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "n_records", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_cut", "n_at_limit")])
    return joined.withColumn("share", F.round(F.col("n_cut") / F.col("n_records"), 6))
