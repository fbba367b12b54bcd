"""JSON Lines in and out: scans with a total order, strict parsing, self-repair, sinks."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from grainloom.functions.text import strip
from grainloom.session import checkpoint

#: Line ends of ``str.splitlines`` at which the text source does not split.
_MORE_ENDS = "[\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"
RECORD = "index string, source string, text string, messages array<struct<role:string,content:string>>"


def read_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """``ord, file, line`` of text files, blank lines left out; ``ord`` orders by file, block and line."""
    reader = spark.read.option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(path).select(
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq")).alias("at"),
        F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", _MORE_ENDS)).alias("sub", "line"),
    )
    lines = lines.select(F.struct("at.file", "at.block", "at.seq", "sub").alias("ord"), "file", strip(F.col("line")).alias("line"))
    return lines.filter("line <> ''")


def numbered_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """``file_path, line_no, line`` of all lines, blank ones too; ``line_no`` counts from 1 within its file.

    Lines are numbered within their block of the file; the blocks' offsets are a table as long as there are blocks.
    """
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    at = reader.text(path).select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line"))
    at = checkpoint(at)
    ahead = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = at.groupBy("file_path", "block").agg(F.count("*").alias("n")).select("file_path", "block", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    within = F.row_number().over(Window.partitionBy("file_path", "block").orderBy("seq"))
    return at.withColumn("within", within).join(blocks, ["file_path", "block"]).select("file_path", (F.col("ahead") + F.col("within")).alias("line_no"), "line")


def read_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON Lines of which every line must fit; the action fails on the first that does not."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def training_texts(spark: SparkSession, path: str) -> DataFrame:
    """The texts of a training file."""
    return spark.read.schema("text string").json(path)


PAGE = "url string, problem string, solutions array<string>"


def read_pages(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``ord, file, url, problem, solutions`` of scraped pages; lines that are no object are left out."""
    lines = read_lines(spark, path, glob)
    rows = lines.select("ord", "file", F.from_json("line", PAGE).alias("p")).filter("p is not null")
    return rows.select("ord", "file", "p.url", F.coalesce("p.problem", F.lit("")).alias("problem"), "p.solutions")


def is_clean_json(c: Column) -> Column:
    """The line is exactly one JSON value: it parses alone within brackets and as the value of a key."""
    listed = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    keyed = F.try_parse_json(F.concat(F.lit('{"x":'), c, F.lit("}")))
    return listed.isNotNull() & keyed.isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()


def fix_escapes(c: Column) -> Column:
    """Backslashes that start no legal escape are doubled."""
    return F.regexp_replace(c, r'\G((?:[^\\]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+)\\', r"$1\\\\")


def split_objects(line: str, *, keep_between: bool) -> list[str]:
    """The objects of a line, found by their outer braces with strings and escapes in mind.

    With ``keep_between`` a part starts where the last one ended (what stands between spoils it), else at its brace.
    """
    parts, depth, start, quoted, escaped = [], 0, 0, False, False
    for i, ch in enumerate(line):
        if escaped:
            escaped = False
        elif quoted:
            escaped, quoted = ch == "\\", ch != '"'
        elif ch == '"':
            quoted = True
        elif ch == "{":
            if depth == 0 and not keep_between:
                start = i
            depth += 1
        elif ch == "}" and depth:
            depth -= 1
            if depth == 0:
                parts.append(line[start : i + 1].strip())
                start = i + 1
    return parts


def _loads(text: str) -> str | None:
    try:
        return text if isinstance(json.loads(text), dict) else None
    except (ValueError, RecursionError):
        return None


def rescue(line: str, *, strict_parts: bool) -> list[tuple[str | None, str | None]]:
    """(object, error) for a line that is not clean even with its escapes repaired."""
    if _loads(line):
        return [(line, None)]
    parts = split_objects(line, keep_between=strict_parts)
    if strict_parts and len(parts) < 2:
        return [(None, f"unfixable: {line[:80]}")]
    good = [(p, _loads(p)) for p in parts]
    if strict_parts:
        return [(o, None if o else f"unfixable part: {p[:80]}") for p, o in good]
    kept = [(o, None) for _, o in good if o]
    return kept or [(None, f"unfixable: {line[:80]}")]


def repair_lines(lines: DataFrame, *, line: str = "line", strict_parts: bool = False) -> DataFrame:
    """One row per object found in a line, or per error: the other columns, ``sub_object``, ``raw``, ``parse_error``.

    Clean lines and lines with broken escapes stay in the JVM; only lines still rejected go through Python.
    ``strict_parts`` reports parts that fail and wants two parts or more, else bad parts are dropped.
    """
    fixed = F.when(is_clean_json(F.col(line)), F.col(line)).otherwise(fix_escapes(F.col(line)))
    rows = lines.withColumn("raw", fixed).withColumn("_ok", is_clean_json(F.col("raw")))
    others = [c for c in lines.columns if c != line]
    clean = rows.filter("_ok").select(*others, F.lit(0).alias("sub_object"), "raw", F.lit(None).cast("string").alias("parse_error"))
    n = len(others)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, sub, raw, error = [], [], [], []
            for i, text in enumerate(batch.column(n).to_pylist()):
                for k, (obj, err) in enumerate(rescue(text, strict_parts=strict_parts)):
                    where.append(i), sub.append(k), raw.append(obj), error.append(err)
            take = pa.array(where, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(take) for i in range(n)), pa.array(sub, pa.int32()), pa.array(raw, pa.string()), pa.array(error, pa.string())], [*others, "sub_object", "raw", "parse_error"])

    rejected = rows.filter(F.coalesce(~F.col("_ok"), F.lit(False))).select(*others, "raw")
    made = StructType([StructField(f.name, f.dataType, f.nullable or f.name == "raw") for f in clean.schema.fields])  # an error has no object
    return clean.unionByName(rejected.mapInArrow(scan, made))


def with_record(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds the usual fields of a record; ``raw`` keeps the keys and order of the input."""
    return rows.withColumn("record", F.from_json(raw, RECORD)).select("*", "record.*").drop("record")


def index_key(raw: Column) -> Column:
    """One key per value of ``index``: 1, 1.0 and true are equal, "1" is another; null if absent or null."""
    value = F.try_variant_get(F.try_parse_json(raw), "$.index", "variant")
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", "double")
    flag = F.try_variant_get(value, "$", "boolean").cast("int").cast("double")
    return F.when(kind == "STRING", F.concat(F.lit("s:"), text)).when(kind == "BOOLEAN", F.concat(F.lit("n:"), flag.cast("string"))).when(kind.rlike("BIGINT|DECIMAL|DOUBLE"), F.concat(F.lit("n:"), number.cast("string")))


def write_jsonl(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Each row as one JSON object, nulls written, non-ASCII kept."""
    rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def write_raw(rows: DataFrame, path: str, raw: str = "raw", mode: str = "overwrite") -> None:
    rows.select(F.col(raw).alias("value")).write.mode(mode).text(path)


def write_routes(rows: DataFrame, path: str, route: str = "route", raw: str = "raw") -> None:
    """One pass, one folder per route."""
    rows.select(F.col(raw).alias("value"), F.col(route)).write.mode("overwrite").partitionBy(route).text(path)


def write_report(rows: DataFrame, path: str, order: str) -> None:
    """A small report as one csv file with a header."""
    rows.repartitionByRange(1, order).sortWithinPartitions(order).write.mode("overwrite").csv(path, header=True)


def read_integers(spark: SparkSession, path: str) -> DataFrame:
    """Distinct whole numbers, one a line; other lines are ignored."""
    n = F.expr("try_cast(trim(value) as bigint)")
    return spark.read.option("ignoreMissingFiles", "true").text(path).select(n.alias("index")).filter("index is not null").distinct()


def read_tex(spark: SparkSession, path: str) -> DataFrame:
    """``source, text`` of TeX files below a folder, in the order of their paths; bytes that are no UTF-8 are dropped."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tex").load(path)
    decode = F.pandas_udf(lambda s: s.map(lambda b: b.decode("utf-8", "ignore")), "string")
    return files.orderBy("path").select(F.regexp_extract("path", r"([^/]+)\.tex$", 1).alias("source"), decode("content").alias("text"))


def store_files(files: DataFrame, folder: str) -> DataFrame:
    """Contents (``file_name, content``) as files in a folder that all tasks share: ``file_name, n_bytes`` of what was written.

    A file is written beside its name and then moved there, so a task that runs twice leaves whole files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = os.path.join(folder, f".{os.path.basename(name)}.{uuid.uuid4().hex}")
                with open(part, "wb") as f:
                    sizes.append(f.write(content))
                os.replace(part, os.path.join(folder, os.path.basename(name)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["file_name", "n_bytes"])

    os.makedirs(folder, exist_ok=True)
    return files.select("file_name", "content").mapInArrow(run, "file_name string, n_bytes bigint")
