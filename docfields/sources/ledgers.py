"""Logs of what tasks did to the outside world, so that nothing is done twice.

Every attempt of a task has a file of its own and flushes each line as it is written, so what a lost task had done is
still there. A later attempt of the same task reads its predecessors' lines; a later run reads the whole log as a table.
Lines that were cut off while being written are skipped.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def as_uri(folder: str) -> str:
    if folder.startswith("/"):
        return f"file://{folder}"
    if folder.startswith("file:/") and not folder.startswith("file://"):
        return f"file://{folder[5:]}"
    return folder.rstrip("/")


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_log(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All complete lines of a log; no rows where there is no log yet."""
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    lines = spark.read.option("recursiveFileLookup", True).text(folder)
    read = F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    return lines.select(read.alias("r")).filter("r IS NOT NULL AND r._bad IS NULL").select("r.*").drop("_bad")


class TaskLog:
    """The log of one attempt of one task of ``run``, opened inside the task."""

    def __init__(self, folder: str, run: str):
        from pyspark import TaskContext

        self.store, path = fs.FileSystem.from_uri(as_uri(folder))
        self.place, self.name = f"{path}/run={run}", f"task-{TaskContext.get().partitionId():06d}-"
        self.out = None

    def earlier(self) -> Iterator[dict]:
        """What earlier attempts of this task have logged."""
        self.store.create_dir(self.place, recursive=True)
        for found in self.store.get_file_info(fs.FileSelector(self.place)):
            if found.base_name.startswith(self.name):
                with self.store.open_input_stream(found.path) as f:
                    for line in f.read().splitlines():
                        try:
                            yield json.loads(line)
                        except ValueError:
                            continue  # cut off

    def write(self, *entries: dict) -> None:
        """Lines that are flushed together."""
        if self.out is None:
            self.out = self.store.open_output_stream(f"{self.place}/{self.name}{uuid.uuid4().hex[:12]}.json")
        self.out.write("".join(f"{json.dumps(e)}\n" for e in entries).encode())
        self.out.flush()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
