"""The operators as queries over the driver's tables, with their SQL where SQL can express them."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfields.llm import (
    bagminhash,
    host_rules,
    kneser_ney,
    open_bins,
    packing,
    prefix_bpe,
    prefix_trie,
    ring,
    token_files,
    tree_merge,
    tree_model,
    warc,
    whitening,
)

BPE_50K, MULTI_50K = "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.tobytes())


def op1_kneser_ney(spark: SparkSession, folder: str, order: int = 2) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2).alias("held_out"))
    model = kneser_ney.fit(docs.where(~F.col("held_out")), order=order)
    return kneser_ney.score(docs, model)


def op1_kneser_ney_trigrams(spark: SparkSession, folder: str) -> DataFrame:
    return op1_kneser_ney(spark, folder, 3)


def op2_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = host_rules.judge(table(spark, folder, "documents").select("doc_id", "source", "text"))
    m = "_measures."
    return judged.select(
        "doc_id", *[m + c for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        ((F.col(m + "n_words") < 50) | (100 * F.col(m + "n_repeat_words") > 50 * F.col(m + "n_words"))).alias("base_failed"),
        F.col("_kept").alias("kept"))


def op3_bagminhash(spark: SparkSession, folder: str) -> DataFrame:
    return bagminhash.near_groups(table(spark, folder, "documents")).drop(*tree_merge.PLACE)


def op4_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(MULTI_50K)
    tokens = prefix_bpe.encode(table(spark, folder, "documents"), path, keep=["doc_id"])

    def digests(batches):
        for batch in batches:
            ids = batch.column("ids")
            values, marks = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            hashes = [hashlib.sha256(values[a:b].astype("<u4")).hexdigest() for a, b in zip(marks[:-1], marks[1:], strict=True)]
            decoded = [hashlib.sha256(b.as_buffer()).hexdigest() for b in batch.column("bytes")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(marks), pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return prefix_bpe.decode(tokens, path).mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    shards = token_files.write(table(spark, folder, "documents"), public_tokenizers.path(BPE_50K), special=True)
    return token_files.read(shards, {"ids_crc32": ("long", crc32)})


def op6_tree_merge(spark: SparkSession, folder: str) -> DataFrame:
    return tree_merge.exact_groups(table(spark, folder, "documents")).drop(*tree_merge.PLACE)


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.read(spark, warc.write(table(spark, folder, "pages")), payload=False)
    return records.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to_key").alias("refers_to"))


def op8_tree_model(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return tree_model.extract(pages, tree_model.fit(pages), keep=["page_id", "url"]).withColumn("n_chars", F.char_length("text").cast("long"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(BPE_50K), derive={"ids_crc32": ("long", crc32)}, special=True)


def op10_ring(spark: SparkSession, folder: str) -> DataFrame:
    dealt = ring.deal(table(spark, folder, "documents"), shards=8)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_lanczos_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    conv = F.col("conv")
    convs, rows = prefix_trie.rebuilt(
        prefix_trie.numbered_turns(table(spark, folder, "conversations")), base=conv - conv % 20, head=F.crc32(conv.cast("string").cast("binary")) % 4)
    return prefix_trie.peel(convs, prefix_trie.prefixes(rows))


def op13_open_bins(spark: SparkSession, folder: str) -> DataFrame:
    return open_bins.pack(table(spark, folder, "documents"), public_tokenizers.path(BPE_50K), derive={"ids_crc32": ("long", crc32)}, special=True)


RULES = {
    "short": "n_words < 50", "repeats": "100 * n_repeat_words > 50 * n_words", "symbols": "n_symbols > n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines", "word_length": "(word_chars < 2 * n_words OR word_chars > 12 * n_words)",
}

_MOMENTS = ", ".join(f"""sum(f_{r}) / sum(n) AS m_{r},
    greatest(sum(n * (f_{r} / n) * (f_{r} / n)) / sum(n) - (sum(f_{r}) / sum(n)) * (sum(f_{r}) / sum(n))
        - (sum(f_{r}) / sum(n)) * (1 - sum(f_{r}) / sum(n)) * count(*) / sum(n),
        (sum(f_{r}) / sum(n)) * (1 - sum(f_{r}) / sum(n)) / 1001, 1e-12) AS v_{r}""" for r in RULES)

SQL = {
    "op2_host_rules": rf"""
WITH split AS (
    SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT k, unnest(parts) AS line FROM split),
dups AS (SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
places AS (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) > 2),
grams AS (SELECT k, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM places),
often AS (SELECT k, i FROM grams QUALIFY count(*) OVER (PARTITION BY k, a, b, c) > 1),
marked AS (SELECT k, count(DISTINCT i + d) AS n_repeat_words FROM often, (SELECT unnest([0, 1, 2]) AS d) GROUP BY k),
measures AS (
    SELECT split.k, doc_id, source, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM split LEFT JOIN dups ON split.k = dups.k LEFT JOIN marked ON split.k = marked.k),
hosts AS (SELECT source, count(*) AS n, {", ".join(f"count(*) FILTER ({c}) AS f_{r}" for r, c in RULES.items())} FROM measures GROUP BY source),
moments AS (SELECT {_MOMENTS} FROM hosts),
verdicts AS (SELECT source, greatest({", ".join(
        f"(f_{r} + m_{r} * greatest(m_{r} * (1 - m_{r}) / v_{r} - 1, 1)) / (n + greatest(m_{r} * (1 - m_{r}) / v_{r} - 1, 1))" for r in RULES)}) > 0.5 AS rejected
    FROM hosts, moments)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({RULES["short"]} OR {RULES["repeats"]}) AS base_failed,
    NOT ({RULES["short"]} OR {RULES["repeats"]}) AND NOT rejected AS kept
FROM measures JOIN verdicts ON measures.source IS NOT DISTINCT FROM verdicts.source""",
    "op6_tree_merge": """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)""",
    "op7_warc": """
WITH t AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS hex FROM pages),
s AS (SELECT page_id, octet_length(payload) AS payload_bytes, min(page_id) OVER (PARTITION BY hex) AS first,
    array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda b:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, i * 5 + 1, 5))::BIGINT >> b) & 31)::INT + 1, 1)), '')), '') AS payload_digest FROM t)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to FROM s""",
    "op12_prefix_trie": r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
    {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(said ORDER BY i) AS turns, conv_id::VARCHAR AS name FROM t GROUP BY conv_id),
bits AS (SELECT *, list_transform(range(8 * length(name)), lambda b: (ascii(substr(name, b // 8 + 1, 1)) >> (b % 8)::INT) & 1) AS b FROM own),
heads AS (SELECT *, (xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, x: xor(a >> 1, 3988292384::BIGINT * (xor(a, x) & 1))), 4294967295::BIGINT) % 4) AS h FROM bits),
built AS (SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
    FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20),
members AS (SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM built),
nodes AS (SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN len(turns) = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM members GROUP BY ALL),
kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
below AS (SELECT path, depth, unnest(range(0, depth + 1)) AS above,
    CASE WHEN depth > 0 THEN (n_convs - 1) * len(regexp_extract_all(path[-1].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved,
    path NOT IN (SELECT path FROM kids) AS leaf FROM nodes),
totals AS (SELECT path[1:above] AS path, sum(saved)::BIGINT AS saved, count(*) FILTER (leaf) AS leaves FROM below GROUP BY ALL)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, coalesce(k.n, 0) AS n_children, t.leaves AS n_leaves, t.saved AS saved_tokens, a.ends_sha256
FROM nodes a JOIN totals t ON a.path = t.path LEFT JOIN kids k ON a.path = k.path LEFT JOIN nodes p ON a.depth > 0 AND p.path = a.path[1:a.depth - 1]""",
}

QUERIES = {f.__name__: f for f in (
    op1_kneser_ney, op1_kneser_ney_trigrams, op2_host_rules, op3_bagminhash, op4_prefix_bpe, op5_token_files, op6_tree_merge, op7_warc,
    op8_tree_model, op9_packing, op10_ring, op11_lanczos_whitening, op12_prefix_trie, op13_open_bins)}
