"""Word boxes and their snapshot form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfields.operators.words import nonblank
from docfields.schema import SNAPSHOT, WORDS


def read_words(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Word boxes under the fixed schema."""
    return spark.read.schema(WORDS).format(file_format).load(path)


def read_words_stream(spark: SparkSession, path: str, file_format: str = "parquet", files: int | None = None) -> DataFrame:
    """S2 as files arrive; a file holds whole documents."""
    reader = spark.readStream.schema(WORDS).format(file_format)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).load(path)


def collect_snapshot(words: DataFrame, page_words: int = 4096) -> DataFrame:
    """S3: words of a document as a JSON list, in pages of at most ``page_words`` words.

    Pages follow from ``word_id``, so an oversized document is spread over many of them and ordinary ones have a
    single page 0.
    """
    entry = F.struct(
        (F.col("conf") / F.lit(100.0)).alias("conf"), "text", F.array("x", "y", "w", "h").alias("bbox")
    )
    ordered = F.array_sort(F.collect_list(F.struct("word_id", entry.alias("entry"))))
    page = F.floor(F.col("word_id") / page_words).alias("page")
    return nonblank(words).groupBy("doc_id", page).agg(
        F.to_json(F.transform(ordered, lambda e: e["entry"])).alias("snapshot")
    )


def explode_snapshot(snapshots: DataFrame, page_words: int = 4096) -> DataFrame:
    """S3, back to a table of words, for extraction from what was stored.

    ``word_id`` counts in reading order with gaps where blank words were left out; the height of the page is not stored.
    """
    entries = snapshot_entries(snapshots)
    number = {c: F.col(c).cast("int").alias(c) for c in ("x", "y", "w", "h")}
    return entries.select(
        "doc_id", (F.col("page") * page_words + F.col("at")).cast("int").alias("word_id"), "text",
        F.round(F.col("conf") * 100).cast("int").alias("conf"), *number.values(), F.lit(None).cast("int").alias("page_h"),
    )


def snapshot_entries(snapshots: DataFrame) -> DataFrame:
    """S3: one row per stored entry; a missing confidence is 0.0 and a missing text is empty."""
    items = F.from_json("snapshot", SNAPSHOT)
    rows = snapshots.select("doc_id", "page", F.posexplode(items).alias("at", "e"))
    return rows.select(
        "doc_id", "page", "at", F.coalesce("e.conf", F.lit(0.0)).alias("conf"),
        F.coalesce("e.text", F.lit("")).alias("text"),
        *[F.try_element_at("e.bbox", F.lit(i + 1)).alias(c) for i, c in enumerate(("x", "y", "w", "h"))],
    )
