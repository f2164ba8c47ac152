"""Continuous stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from docfields.operators.requests import BATCH_SIZE, assign_batches
from docfields.operators.routing import extract_fields, route, rule_payload
from docfields.operators.scans import HOT_ROWS
from docfields.operators.validation import validate


def _append_once(df: DataFrame, path: str, batch_id: int) -> None:
    """A micro-batch has its own folder, so a replayed one replaces its files instead of adding to them."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def stream_extract(
    words: DataFrame, sink: str, checkpoint: str, today: Column, hot_rows: int | None = HOT_ROWS
) -> DataStreamWriter:
    """Words to routed rows (``sink/routed``) and validated rows (``sink/validated``)."""

    def stage(batch: DataFrame, batch_id: int) -> None:
        # A trigger has few files, each one task's to read, so words are dealt out before anything is made of them.
        tasks = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rules = route(extract_fields(batch.repartition(tasks, "doc_id"), hot_rows=hot_rows))
        _append_once(rules.select("doc_id", "vendor", "total", "date", "vendor_conf", "total_conf", "date_conf", "route"),
                     f"{sink}/routed", batch_id)
        # Read back what was written instead of extracting a second time.
        routed = batch.sparkSession.read.parquet(f"{sink}/routed/batch={batch_id}")
        checked = validate(rule_payload(routed.filter("route = 'VALIDATE'")), today)
        _append_once(checked, f"{sink}/validated", batch_id)

    return words.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint)


def stream_batches(
    requests: DataFrame, sink: str, checkpoint: str, size: int = BATCH_SIZE, order: tuple[str, ...] = ("job_id",),
    wait: str | None = "5 seconds",
) -> DataStreamWriter:
    """Requests of every trigger cut into model batches; ``wait`` bounds how long one waits for company."""

    def stage(batch: DataFrame, batch_id: int) -> None:
        _append_once(assign_batches(batch, size, order), sink, batch_id)

    writer = requests.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=wait) if wait else writer.trigger(availableNow=True)


def dedupe_ingest(stream: DataFrame, bound: tuple[str, str]) -> DataFrame:
    """T4: every job once within ``bound`` (time column, delay); keys are forgotten after it, so state does not grow for ever."""
    column, delay = bound
    return stream.withWatermark(column, delay).dropDuplicatesWithinWatermark(["job_id"])


def stream_counters(outcomes: DataFrame) -> DataFrame:
    """T5: live counters, for output mode ``complete``; state is one row per name."""
    return outcomes.groupBy("name").agg(F.sum("n").alias("n"))


def drain(writer: DataStreamWriter, before: Callable[[DataStreamWriter], DataStreamWriter] = lambda w: w) -> None:
    """Run a stream over everything there is, then stop."""
    before(writer).trigger(availableNow=True).start().awaitTermination()
