"""Ordered scans per key that also hold when one key owns a large share of all rows.

Most keys are small: a plain window, one shuffle. A key above ``hot_rows`` would put all its rows into one task, so
its rows are range-partitioned by key and order instead, scanned chunk by chunk, and each chunk is corrected by what
the chunks before it carry over; if there are many such keys, only those larger than a chunk and some more are. Both ways
give the same result; only the plan differs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfields.session import materialise

HOT_ROWS = 1_000_000


class OrderedRows:
    """Rows of a frame in ``order`` within ``keys``; each method adds one column."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str]):
        self.df, self.keys, self.order = df, keys, order

    def _window(self):
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def _with(self, df: DataFrame) -> OrderedRows:
        return OrderedRows(df, self.keys, self.order)

    def derive(self, name: str, value: Column) -> OrderedRows:
        return self._with(self.df.withColumn(name, value))

    def number(self, name: str) -> OrderedRows:
        """Position from 1."""
        return self._with(self.df.withColumn(name, F.row_number().over(self._window()).cast("long")))

    def lag(self, name: str, value: Column) -> OrderedRows:
        return self._with(self.df.withColumn(name, F.lag(value).over(self._window())))

    def running(self, name: str, value: Column, how: str) -> OrderedRows:
        """Running ``sum`` or ``max`` up to and including the row."""
        frame = self._window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        fold = F.sum if how == "sum" else F.max
        return self._with(self.df.withColumn(name, fold(value).over(frame)))


class ChunkedRows(OrderedRows):
    """The same, where the rows of a key lie in consecutive chunks; ``chunk`` numbers them in order."""

    def _window(self):
        return Window.partitionBy(*self.keys, "chunk").orderBy(*self.order)

    def _with(self, df: DataFrame) -> ChunkedRows:
        return ChunkedRows(df, self.keys, self.order)

    def _carry(self, df: DataFrame, summary: Column, fold: str) -> DataFrame:
        """Join to every row what the earlier chunks of its key add up to, as column ``carry``.

        The window here runs over chunks, at most one row per key and range partition.
        """
        earlier = Window.partitionBy(*self.keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        per_chunk = df.groupBy(*self.keys, "chunk").agg(summary.alias("part"))
        folded = {"sum": F.sum("part"), "max": F.max("part"), "last": F.last("part")}[fold].over(earlier)
        carried = per_chunk.select(
            *[F.col(k).alias(f"_{k}") for k in self.keys], F.col("chunk").alias("_chunk"), folded.alias("carry")
        )
        same = F.col("chunk") == F.col("_chunk")
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        return df.join(carried, same, "left").drop("_chunk", *[f"_{k}" for k in self.keys])

    def number(self, name: str) -> OrderedRows:
        local = self.df.withColumn(name, F.row_number().over(self._window()))
        joined = self._carry(local, F.count(F.lit(1)), "sum")
        value = (F.col(name) + F.coalesce(F.col("carry"), F.lit(0))).cast("long")
        return self._with(joined.withColumn(name, value).drop("carry"))

    def lag(self, name: str, value: Column) -> OrderedRows:
        w = self._window()
        local = self.df.select("*", value.alias("_value"), F.row_number().over(w).alias("_at"))
        local = local.withColumn(name, F.lag("_value").over(w))
        last = F.max_by(F.struct("_value"), F.col("_at"))
        joined = self._carry(local, last, "last")
        value = F.when(F.col("_at") == 1, F.col("carry._value")).otherwise(F.col(name))
        return self._with(joined.withColumn(name, value).drop("carry", "_value", "_at"))

    def running(self, name: str, value: Column, how: str) -> OrderedRows:
        frame = self._window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        fold = F.sum if how == "sum" else F.max
        local = self.df.withColumn("_value", value)
        local = local.withColumn(name, fold("_value").over(frame))
        joined = self._carry(local, fold("_value"), how)
        if how == "sum":
            total = F.when(
                F.col(name).isNotNull() | F.col("carry").isNotNull(),
                F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col("carry"), F.lit(0)),
            )
        else:
            total = F.greatest(name, "carry")
        return self._with(joined.withColumn(name, total).drop("carry", "_value"))


def oversized(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame | None:
    """Those of the keys with more than ``hot_rows`` rows that chunks of equal size cut, or None. Counts are combined before
    the shuffle and written once; the tests read what was written."""
    return cut_keys(materialise(df.groupBy(*keys).count().filter(F.col("count") > hot_rows), "hot-keys"), keys, "count")


def cut_keys(counts: DataFrame, keys: list[str], rows: str) -> DataFrame | None:
    """Of large keys, with their number of ``rows``, those that chunks of equal size cut, or None.

    If their rows lay end to end in one chunk for each partition, most keys that are no larger than a chunk would lie whole
    in one. Such a key is no more to a task than a chunk is, so it is scanned like an ordinary one, without a range
    partition. Where a key begins in its chunk is told by its hash, so every key larger than a chunk is cut, and of the
    others about as many as there are chunks.
    """
    total = counts.agg(F.sum(rows)).first()[0]
    if total is None:
        return None
    chunk = -(-total // int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = counts.filter(F.col(rows) > F.pmod(F.xxhash64(*keys), F.lit(chunk))).select(*keys)
    return None if cut.isEmpty() else cut


def split(df: DataFrame, hot: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of keys that are scanned whole and rows of ``hot`` keys."""
    renamed = hot.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(renamed, same, "left_anti"), df.join(renamed, same, "left_semi")


def chunked(df: DataFrame, keys: list[str], order: list[str], parts: int | None = None) -> ChunkedRows:
    """Range-partition by key and order and keep the partition number as ``chunk``.

    Written once as a table: range bounds come from a sample, so a second evaluation could cut elsewhere.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *keys, *order).withColumn("chunk", F.spark_partition_id())
    return ChunkedRows(materialise(ranged, "chunks"), keys, order)


def scan_by_key(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    body: Callable[[OrderedRows], DataFrame],
    hot_rows: int | None = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Apply ``body`` to the ordered rows of every key, whatever the size of the key.

    ``hot`` names the oversized keys where the caller knows them; else they are counted, unless ``hot_rows`` is None
    (keys whose size is bounded by construction).
    """
    if hot is None and hot_rows is not None:
        hot = oversized(df, keys, hot_rows)
    if hot is None:
        return body(OrderedRows(df, keys, order))
    cold_rows, hot_part = split(df, hot, keys)
    cold = body(OrderedRows(cold_rows, keys, order))
    return cold.unionByName(body(chunked(hot_part, keys, order)).select(*cold.columns))


def latest(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """The last row of every key by ``by``; combined before the shuffle, so key size does not matter."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("row")).select(*keys, "row.*")
