"""From raw documents to packed training sequences, one operator a stage.

Each stage gets the documents that its predecessor kept, as a Parquet table. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docfields.llm import bagminhash, host_rules, packing, tree_merge
from docfields.llm.queries import BPE_50K, crc32
from docfields.session import materialise

#: What a worker encodes at once when packing, and the pieces it remembers: less than alone, since a worker also holds what the
#: stages before have left, and an executor the memory they have touched.
PACK_BYTES, PACK_REMEMBERED = 1 << 19, 250_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the base rules themselves nor come from a rejected host."""
    return host_rules.drop_low_quality(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return tree_merge.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the row with the smallest id."""
    return bagminhash.drop_near_copies(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences of at most 1,024 ids."""
    return packing.pack(docs, public_tokenizers.path(BPE_50K), derive={"ids_crc32": ("long", crc32)}, special=True,
                        batch_bytes=PACK_BYTES, remembered=PACK_REMEMBERED)


STAGES = [("quality rules", quality), ("exact dedup", exact_copies), ("near dedup", near_copies), ("packing", sequences)]

#: SQL can express neither near duplicates by this method nor the tokenizer; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
