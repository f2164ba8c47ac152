"""Pacing and circuit state of an external service, from its log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfields.operators.scans import HOT_ROWS, OrderedRows, scan_by_key


def seconds(ts: Column) -> Column:
    """Wall-clock seconds since 1970 with microseconds, exact as a double for present-day times."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz")) / F.lit(1_000_000.0)


def _pace(rows: OrderedRows, step: float) -> DataFrame:
    numbered = rows.number("_n")
    base = F.col("at") - (F.col("_n") - 1) * F.lit(step)
    paced = numbered.running("_base", base, "max").df
    return paced.withColumn("start_at", F.col("_base") + (F.col("_n") - 1) * F.lit(step)).drop("_n", "_base", "chunk")


def pace(
    events: DataFrame, key: str, rpm: float, at: str = "at", tie: str = "event_id", hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """When every call may start at ``rpm`` calls a minute: its arrival, or a step after the call before.

    The recurrence has the closed form max over earlier calls of (arrival - place * step) + own place * step. A single
    service-wide key is the usual case, so the key may own the whole table.
    """
    step = 60.0 / max(rpm, 0.5)
    return scan_by_key(events, [key], [at, tie], lambda r: _pace(r, step), hot_rows)


def _circuit(rows: OrderedRows, threshold: int, open_for: float) -> DataFrame:
    failed = F.col("failed")
    return (
        rows.running("_failures", F.when(failed, 1).otherwise(0), "sum")
        .running("_healed", F.when(~failed, F.col("_failures")), "max")
        .derive("run", F.when(failed, F.col("_failures") - F.coalesce(F.col("_healed"), F.lit(0))).otherwise(0))
        .derive("trips", failed & (F.col("run") % threshold == 0))
        .running("_open", F.when(F.col("trips"), F.col("at") + F.lit(float(open_for))), "max")
        .lag("open_until", F.col("_open"))
        .derive("allowed", F.coalesce(F.col("at") >= F.col("open_until"), F.lit(True)))
        .df.drop("_failures", "_healed", "_open", "chunk")
    )


def circuit(
    events: DataFrame, key: str, threshold: int = 5, open_for: float = 60.0, at: str = "at", tie: str = "event_id",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """For every call whether the circuit lets it through, given the outcomes before it.

    ``threshold`` failures in a row open the circuit for ``open_for`` seconds; opening and success reset the count.
    """
    return scan_by_key(events, [key], [at, tie], lambda r: _circuit(r, threshold, open_for), hot_rows)


def run_counters(log: DataFrame) -> DataFrame:
    """Counters of a run by name."""
    return log.groupBy("name").agg(F.sum("n").alias("n"))
