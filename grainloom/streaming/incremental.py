"""Incremental work: resuming by done ids, streamed transforms, model calls with an injectable client."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType

from grainloom.functions.text import answer_budget
from grainloom.operators.messages import chatml_training, completed, completion, continue_prompt, restructure_prompt, restructured
from grainloom.session import checkpoint
from grainloom.sources.jsonl import read_integers, write_jsonl


def remaining(rows: DataFrame, done: DataFrame, key: str = "index") -> DataFrame:
    """Rows whose id is not among the done ones; rows without an id stay."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


class RateLimited(Exception):
    """Raised by a client whose provider asks it to wait."""


def growing_wait(error: Exception, attempt: int) -> float:
    """After any error 10 seconds, longer each time."""
    return 10.0 * (attempt + 1)


def limited_wait(error: Exception, attempt: int) -> float:
    """After a rate limit 30 seconds, longer each time; 5 after any other error."""
    return 30.0 * (attempt + 1) if isinstance(error, RateLimited) else 5.0


def call_model(
    rows: DataFrame, client: Callable[[str, int], str], *, prompt: str = "prompt", budget: str = "budget", attempts: int = 3, wait: Callable[[Exception, int], float] = growing_wait, parallel: int = 5, sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Adds ``response`` (null after the last failed attempt). The client gets the prompt and a token budget.

    Each task keeps ``parallel`` calls open at a time; ``wait`` says how long to wait after an error.
    """
    schema = StructType([*rows.schema.fields, StructField("response", StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def ask(text: str, tokens: int) -> str | None:
            for attempt in range(attempts):
                try:
                    return client(text, int(tokens))
                except Exception as e:  # noqa: BLE001 - the client's errors are not known here
                    sleep(wait(e, attempt))
            return None

        with ThreadPoolExecutor(parallel) as pool:
            for batch in batches:
                yield batch.assign(response=list(pool.map(ask, batch[prompt], batch[budget])))

    return rows.mapInPandas(run, schema)


def complete_answers(records: DataFrame, client: Callable[[str, int], str], **options: object) -> DataFrame:
    """Partial answers (``index, problem, partial``) completed by the model: ``index, problem, solution``."""
    asked = records.withColumn("prompt", continue_prompt(F.col("problem"), F.col("partial"))).withColumn("budget", answer_budget(F.col("partial")))
    said = call_model(asked, client, **options).filter("response is not null")
    return said.select("index", "problem", completion(F.col("partial"), F.col("response")).alias("solution"))


def stream_templates(spark: SparkSession, source: str, sink: str, checkpoint_dir: str) -> StreamingQuery:
    """Files of records (Parquet with ``messages``) rendered as they arrive; restarts go on where they stopped."""
    schema = "rec_id bigint, messages array<struct<role:string,content:string>>"
    rows = spark.readStream.schema(schema).parquet(source)
    text = rows.select("rec_id", chatml_training(F.col("messages")).alias("text")).filter("text is not null")
    return text.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start(sink)


def stream_first(spark: SparkSession, source: str, schema: str, keys: list[str], sink: str, checkpoint_dir: str) -> StreamingQuery:
    """Keep-first over a stream: the first row that is processed of each key; state grows with the keys."""
    rows = spark.readStream.schema(schema).parquet(source).dropDuplicates(keys)
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start(sink)


def append_results(rows: DataFrame, sink: str, done: DataFrame, key: str = "index") -> None:
    """Append rows whose id is not done yet: repeating an interrupted run repeats no row."""
    remaining(rows, done, key).write.mode("append").parquet(sink)


def generate(
    records: DataFrame, client: Callable[[str, int], str], *, order: str, system: str | None = None, limit: int | None = None, done: DataFrame | None = None, end: str = "", budget: int = 4000, **options: object,
) -> DataFrame:
    """A generation stage over records (``index, messages``): problem and solution are the first two contents.

    With ``system`` the solution is written anew (three messages and the original solution), without it the
    partial solution is completed (two messages). The first ``limit`` records in order (all for 0), without the
    ids in ``done``; failed calls give no row.
    """
    rows = records.orderBy(order).limit(limit) if limit else records
    if done is not None:
        rows = remaining(rows, done)
    first, second = (F.get("messages", F.lit(i))["content"] for i in (0, 1))
    asked = rows.select("index", first.alias("problem"), second.alias("solution"))
    problem, solution, said = F.col("problem"), F.col("solution"), F.col("response")
    if system is not None:
        asked = asked.withColumns({"prompt": restructure_prompt(problem, solution, end=end), "budget": F.lit(budget)})
        record = restructured(system, problem, solution, said, F.col("index"))
    else:
        asked = asked.withColumns({"prompt": continue_prompt(problem, solution), "budget": answer_budget(solution)})
        record = completed(problem, solution, said, F.col("index"))
    return call_model(asked, client, **options).filter("response is not null").select(record.alias("r")).select("r.*")


def append_with_ids(rows: DataFrame, sink: str, ids: str, key: str = "index") -> None:
    """Appends records to ``sink`` and then their ids to ``ids``, one a line; a run that broke off between the two repeats its rows.

    Rows whose id is listed already are left out.
    """
    spark = rows.sparkSession
    done = read_integers(spark, ids) if _exists(spark, ids) else spark.createDataFrame([], "index bigint")
    fresh = checkpoint(remaining(rows, done.withColumnRenamed("index", key), key))  # the model is asked once
    write_jsonl(fresh, sink, mode="append")
    fresh.select(F.col(key).cast("string").alias("value")).write.mode("append").text(ids)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def stream_until(spark: SparkSession, source: str, schema: str, keep: Callable[[DataFrame], DataFrame], sink: str, checkpoint_dir: str, n: int) -> int:
    """Reads files as they come, keeps what ``keep`` leaves of each batch, and stops after the batch that fills ``n`` rows; the rows written."""
    written = 0

    def take(batch: DataFrame, _: int) -> None:
        nonlocal written
        if written >= n:
            return
        rows = keep(batch).limit(n - written).persist()
        rows.write.mode("append").parquet(sink)
        written += rows.count()
        rows.unpersist()

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
    while not query.awaitTermination(1):
        if written >= n:
            query.stop()
    return written


class Progress(StreamingQueryListener):
    """What a long run has done: rows so far, rows a second, and the seconds left of ``total`` rows."""

    def __init__(self, total: int | None = None) -> None:
        self.total, self.rows, self.rate, self.failed = total, 0, 0.0, False

    @property
    def seconds_left(self) -> float | None:
        return max(0, self.total - self.rows) / self.rate if self.total is not None and self.rate else None

    def onQueryStarted(self, event: object) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event: object) -> None:  # noqa: N802
        self.rows += event.progress.numInputRows
        self.rate = event.progress.processedRowsPerSecond or self.rate

    def onQueryIdle(self, event: object) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event: object) -> None:  # noqa: N802
        self.failed = event.exception is not None
