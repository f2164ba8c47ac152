"""Queues in the order of time, laid out so that their oldest entries are found in few files (O2).

Entries lie in one folder for each hour they fall due in, in order inside it, with a small table of how many there are in
each hour. The oldest due ones are in the first hours that together hold as many as are asked for; no other folder is
opened.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfields.session import materialise

HOUR = "yyyyMMddHH"


def write_queue(entries: DataFrame, path: str, due: str = "due_at", key: str = "job_id") -> None:
    """``entries`` at a fresh path. A crowded hour is many files; entries without a time are never due and left out."""
    timed = materialise(entries.filter(F.col(due).isNotNull()).withColumn("_hour", F.date_format(due, HOUR)), "queue")
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = timed.repartitionByRange(parts, due, key).sortWithinPartitions("_hour", due, key)
    ordered.write.partitionBy("_hour").parquet(f"{path}/entries")
    timed.groupBy("_hour").agg(F.count(F.lit(1)).alias("n")).coalesce(1).write.parquet(f"{path}/hours")


def hours_of(spark: SparkSession, path: str, now: datetime.datetime, limit: int) -> list[str]:
    """The first hours that hold ``limit`` entries due by ``now``, or all up to that hour. A row an hour is read."""
    last, found, held = now.strftime("%Y%m%d%H"), [], 0
    for row in spark.read.parquet(f"{path}/hours").filter(F.col("_hour") <= last).orderBy("_hour").collect():
        found.append(row["_hour"])
        held += row["n"]
        if held >= limit and row["_hour"] < last:
            break
    return found


def oldest_due(spark: SparkSession, path: str, now: datetime.datetime, limit: int = 50, due: str = "due_at", key: str = "job_id") -> DataFrame:
    """O2: the ``limit`` oldest entries that are due by ``now`` (in the session's time zone), oldest first."""
    hours = hours_of(spark, path, now, limit)
    columns = [c for c in spark.read.parquet(f"{path}/entries").columns if c != "_hour"]
    entries = spark.read.option("basePath", f"{path}/entries").parquet(*[f"{path}/entries/_hour={h}" for h in hours]) if hours else (
        spark.read.parquet(f"{path}/entries").limit(0))
    return entries.filter(F.col(due) <= F.lit(now)).select(*columns).orderBy(due, key).limit(limit)
