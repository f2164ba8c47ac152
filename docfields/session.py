"""Session defaults and the one place where results are cut off from their lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("docfields")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("DOCFIELDS_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Where it is unset, a temporary one is chosen on a local master; on a cluster
    executors would each write to a disk of their own, so that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_folder(spark)}/docfields/{spark.sparkContext.applicationId}"


def once(make: Callable) -> Callable:
    """``make`` gives columns that name what they read and so hold for any frame: made once a session and kept, since each is
    thousands of calls to the JVM, which a stream would repeat at every trigger."""
    kept: dict = {}

    @wraps(make)
    def get(*args):
        key = (SparkSession.active().sparkContext.applicationId, *args)
        if key not in kept:
            kept[key] = make(*args)
        return kept[key]

    return get


def clear_run(spark: SparkSession) -> None:
    """Delete what this application wrote in between; frames that read it are of no use afterwards."""
    jvm, path = spark._jvm, run_folder(spark)
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Unlike ``checkpoint()`` the input is computed a single time, so external calls in it happen once,
    and an executor lost later costs a re-read, not a re-run.
    """
    path = f"{run_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
