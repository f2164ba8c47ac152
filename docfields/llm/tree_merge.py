"""Exact duplicates by a tree of merges over sorted runs of digests, in DataFrame operations only.

Rows are dealt to a few runs. A run has one entry for each digest and lies in a table that is bucketed and sorted by
digest, so runs share their bucket borders. In each round runs meet in pairs (a binomial tree): a full outer sort-merge
join reads both in order, without a shuffle or a sort, and keeps of each digest one entry with the row that stays. A
digest that a third of all rows share is one entry a run from the start.
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from docfields.llm.large_groups import join_groups
from docfields.session import materialise, run_folder

#: Runs that the tree begins with; half as many are left after each round.
RUNS = 8
#: Entries of a bucket, about; a bucket of two runs is merged as two streams, so this bounds sorting, not correctness.
BUCKET = 1_000_000
ORDERED_SCAN = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def normalised(text: Column) -> Column:
    """A to Z in lower case, nothing else changed; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


#: Columns of ``placed``. A table with both is taken to come from there.
PLACE = ("__place_file", "__place_at")


def placed(rows: DataFrame, columns: dict[str, Column] | None = None) -> DataFrame:
    """``columns`` (name to value; all by default) and ``PLACE``, which tells apart rows that are equal in every column.

    The place of a row in its Parquet file where the frame is a plain reading of files; else the frame is written once.
    """
    wanted = ["*"] if columns is None else [v.alias(k) for k, v in columns.items()]
    if set(PLACE) <= set(rows.columns):
        return rows if columns is None else rows.select(*wanted, *PLACE)
    try:
        where = rows.metadataColumn("_metadata")
        return rows.select(*wanted, F.xxhash64(where["file_path"]).alias(PLACE[0]), where["row_index"].alias(PLACE[1]))
    except AnalysisException:
        return materialise(rows.select(*wanted, F.lit(0).cast("long").alias(PLACE[0]), F.monotonically_increasing_id().alias(PLACE[1])), "rows")


@contextmanager
def ordered_scans(spark: SparkSession) -> Iterator[None]:
    """Within it, the order of a bucket that is one file counts as sorted when it is read."""
    before = spark.conf.get(ORDERED_SCAN)
    spark.conf.set(ORDERED_SCAN, "true")
    try:
        yield
    finally:
        spark.conf.set(ORDERED_SCAN, before)


def write_runs(entries: DataFrame, keys: list[str], buckets: int) -> str:
    """Write ``entries`` (``run``, ``keys`` and more), each bucket of a run sorted by ``keys``; the name of the table."""
    name = f"docfields_runs_{uuid.uuid4().hex}"
    (entries.write.partitionBy("run").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", f"{run_folder(entries.sparkSession)}/{name}").saveAsTable(name))
    return name


def merge_pair(left: DataFrame, right: DataFrame, keys: list[str], run: int) -> DataFrame:
    """Both runs as one: where both have a key (digest and length agree), the larger ``keep`` and the rows of both."""
    left, right = left.alias("l").hint("merge"), right.alias("r")
    met = reduce(Column.__and__, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys])
    none = F.lit(0).cast("long")
    return left.join(right, met, "full_outer").select(
        *[F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in keys], F.greatest("l.keep", "r.keep").alias("keep"),
        (F.coalesce("l.group_size", none) + F.coalesce("r.group_size", none)).alias("group_size"), F.lit(run).alias("run"))


def merge_round(table: DataFrame, keys: list[str], runs: int) -> DataFrame:
    """One round: runs ``2i`` and ``2i + 1`` of ``table`` become run ``i``."""
    of = [table.where(F.col("run") == i) for i in range(runs)]
    return reduce(DataFrame.unionAll, [merge_pair(of[2 * i], of[2 * i + 1], keys, i) for i in range(runs // 2)])


def merge_runs(rows: DataFrame, keys: list[str], runs: int = RUNS) -> DataFrame:
    """``keys, keep, group_size``: of each key the largest ``row`` and how many rows there are.

    ``rows`` has ``keys``, none of them null, and ``row`` (a value with an order). ``runs`` is a power of two; a part of
    ``rows`` goes to a run whole. Buckets are as many as shuffle partitions, more for a large table. The tables of all
    but the last round are forgotten at the end.
    """
    spark = rows.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(-(-rows.count() // BUCKET), 50_000))
    leaves = (rows.withColumn("run", F.pmod(F.spark_partition_id(), F.lit(runs)))
              .groupBy(*keys, "run").agg(F.max("row").alias("keep"), F.count(F.lit(1)).alias("group_size")))
    names = [write_runs(leaves.repartition(buckets, *keys), keys, buckets)]
    with ordered_scans(spark):
        while runs > 2:
            names.append(write_runs(merge_round(spark.table(names[-1]), keys, runs), keys, buckets))
            runs //= 2
        root = materialise(merge_round(spark.table(names[-1]), keys, runs).drop("run"), "merged-runs")
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    return root


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each of ``docs``: ``key, keep_id, group_size, kept, text_sha256`` and the row's ``PLACE``.

    Texts are equal when equal after lower-casing A to Z (null: empty); digest and byte length must both agree. The row
    with the largest key stays; null keys are smaller than all others; of rows that share text and key, one stays. Other
    columns are not read. A very long text is digested whole, as one value. An empty table gives no rows.
    """
    norm = normalised(F.col("_text"))
    rows = placed(docs, {"_key": F.col(key), "_text": F.col(text)})
    rows = rows.select("_key", F.unhex(F.sha2(norm.cast("binary"), 256)).alias("_sha256"), F.octet_length(norm).alias("_size"), *PLACE)
    rows = materialise(rows, "digests")
    same, here = ["_sha256", "_size"], F.struct("_key", *PLACE)
    # Texts without a copy need no partner.
    groups = merge_runs(rows.withColumn("row", here), same).where("group_size > 1").withColumn("_rows", F.col("group_size"))
    found = join_groups(rows, groups, same, "_rows", rows.count()).withColumn("keep", F.coalesce("keep", here))
    return found.select(
        F.col("_key").alias(key), F.col("keep._key").alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        here.eqNullSafe(F.col("keep")).alias("kept"), F.lower(F.hex("_sha256")).alias("text_sha256"), *PLACE)


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the copies that ``exact_groups`` would not keep; all columns, in their order."""
    rows = placed(docs)
    dropped = exact_groups(rows, key, text).where(~F.col("kept")).select(*PLACE)
    return rows.join(dropped, list(PLACE), "left_anti").select(*docs.columns)
