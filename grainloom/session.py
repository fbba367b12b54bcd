"""Session helpers: a local session for tests and benches, table loading, lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A session on this machine; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("grainloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Only where none is named and everything runs on one machine a temporary one is set. A cluster without
    the setting is an error: no folder of one machine serves the others.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(os.path.join(tempfile.gettempdir(), "grainloom-checkpoints"))
    return context._jsc.sc().getCheckpointDir().get()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder.

    The written rows outlive a lost executor; ``spark.cleaner.referenceTracking.cleanCheckpoints`` removes them.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
