"""Quality rules judged by host: how often a host's documents fail each rule, shrunk towards what hosts do at large.

The share of failures of a host with few documents says little, so it is drawn to the mean of all hosts by a beta prior
that is fitted to the spread of the hosts' own shares. A host whose shrunken share of a rule is too high loses all its
documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfields.llm.arrays import GOLDEN, U64, Texts, mix, parts, range_hash, unused, windows
from docfields.session import materialise

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
#: A host is rejected if its shrunken share of documents that fail some rule is over this.
MOST_FAILING = 0.5


def rules() -> dict[str, Column]:
    """What makes a document fail, by rule."""
    n = F.col("n_words")
    return {
        "short": n < 50,
        "repeats": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": F.col("n_symbols") > n,
        "dup_lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 12 * n),
    }


def measured(texts: Texts) -> dict[str, np.ndarray]:
    """The measures of every text."""
    words, n = texts.words(), len(texts)
    out = {"n_words": words.counts(), "word_chars": texts.per_text(words.word & ((texts.data & 0xC0) != 0x80)),
           "n_symbols": texts.per_text(SYMBOLS[texts.data])}
    # Lines: from a text's begin or behind a \n up to the next \n or the text's end; those with a word count.
    breaks = np.flatnonzero(texts.data == 10)
    starts = np.unique(np.concatenate([texts.offsets[:-1], breaks + 1]))
    starts = starts[starts < len(texts.data)]
    owner = np.searchsorted(texts.offsets, starts, side="right") - 1
    ends = np.minimum(np.append(breaks, len(texts.data))[np.searchsorted(breaks, starts)], texts.offsets[owner + 1])
    held = np.concatenate([[0], np.cumsum(words.word)])
    full = held[ends] > held[starts]
    starts, ends, owner = starts[full], ends[full], owner[full]
    salt = mix(np.arange(1, n + 1, dtype=U64) * GOLDEN)
    line = mix(range_hash()(texts.data, starts, ends) ^ salt[owner])
    _, first = np.unique(line, return_index=True)
    out["n_lines"] = np.bincount(owner, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(owner[first], minlength=n)
    # Words in windows of three that the text has twice or more.
    window, at = windows(words.hashes(), words.first, 3)
    text_of = words.text_of()
    _, which, times = np.unique(mix(window ^ salt[text_of[at]]), return_inverse=True, return_counts=True)
    marked = np.zeros(len(words) + 2, dtype=bool)
    often = at[times[which] > 1] if len(at) else at
    for k in range(3):
        marked[often + k] = True
    out["n_repeat_words"] = np.bincount(text_of[marked[: len(words)]], minlength=n)
    return out


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` and a struct ``_measures`` of the text; a null text counts as empty."""
    names = list(docs.columns)
    inner = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])
    schema = T.StructType([*docs.schema.fields, T.StructField("_measures", inner)])

    def run(batches):
        for batch in batches:
            for part, texts in parts(batch, text):
                found = measured(texts)
                struct = pa.StructArray.from_arrays([pa.array(found[m], pa.int64()) for m in MEASURES], names=list(MEASURES))
                yield pa.RecordBatch.from_arrays([*part.columns, struct], names=[*names, "_measures"])

    return docs.mapInArrow(run, schema)


def prior(hosts: DataFrame, failures: str, documents: str = "n_docs") -> tuple[Column, Column]:
    """``alpha, beta`` of the beta distribution fitted by moments to the hosts' shares, as aggregates of ``hosts``."""
    n, share = F.col(documents), F.col(failures) / F.col(documents)
    mean = F.sum(failures) / F.sum(n)
    # The spread of the shares, less what chance alone gives hosts of this size.
    second = F.sum(n * share * share) / F.sum(n) - mean * mean
    chance = mean * (1 - mean) * F.count(F.lit(1)) / F.sum(n)
    spread = F.greatest(second - chance, mean * (1 - mean) / 1001, F.lit(1e-12))
    strength = F.greatest(mean * (1 - mean) / spread - 1, F.lit(1.0))
    return mean * strength, (1 - mean) * strength


def host_verdicts(measures: DataFrame, host: str = "source") -> DataFrame:
    """One row for each host: ``host``, ``n_docs``, each rule's failures ``f_...`` and shrunken share ``r_...``, ``rejected``.

    ``measures`` has ``host`` and the measures of each document. Documents without a host (null) are a host of their own.
    """
    names = list(rules())
    hosts = measures.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(rule.cast("long")).alias(f"f_{name}") for name, rule in rules().items()])
    hosts = materialise(hosts, "hosts")
    fitted = hosts.agg(*[c.alias(f"{x}_{name}") for name in names for x, c in zip("ab", prior(hosts, f"f_{name}"), strict=True)]).first()
    shares = {name: (F.col(f"f_{name}") + F.lit(fitted[f"a_{name}"] or 0.0)) / (F.col("n_docs") + F.lit((fitted[f"a_{name}"] or 0.0) + (fitted[f"b_{name}"] or 0.0))) for name in names}
    judged = hosts.select("*", *[c.alias(f"r_{name}") for name, c in shares.items()])
    return materialise(judged.withColumn("rejected", F.greatest(*[F.col(f"r_{name}") for name in names]) > MOST_FAILING), "host-verdicts")


def judge(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with ``_measures`` (struct) and ``_kept``: neither the document itself nor its host fails.

    Every row stays, repeated ones too; null or empty texts have no words and fail. Very long texts are measured whole, in
    arrays of some 15 times their size. A column of ``docs`` with one of these two names gives way to the new one. Two passes over the texts: one for the hosts' shares, one that carries the documents past their verdict, so
    that texts are shuffled only where hosts are too many to be sent along.
    """
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ("_measures", "_kept")])
    mine, bad_name = (unused(x, docs.columns) for x in ("_host", "_bad"))
    narrow = docs.select(F.col(host).alias("_host"), F.col(text).alias("_text"))
    verdicts = host_verdicts(measure(narrow, "_text").select("_host", "_measures.*"), "_host")
    bad = verdicts.where("rejected").select(F.col("host").alias(mine), F.lit(True).alias(bad_name))
    full = measure(docs, text)
    joined = full.join(bad, full[host].eqNullSafe(bad[mine]), "left")
    n = F.col("_measures.n_words")
    failed = (n < 50) | (100 * F.col("_measures.n_repeat_words") > 50 * n)
    return joined.select(*[full[c] for c in docs.columns], "_measures", (~failed & F.col(bad_name).isNull()).alias("_kept"))


def drop_low_quality(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``docs`` without rejected rows; all columns, in their order."""
    clash = [c for c in docs.columns if c.lower() in ("_measures", "_kept")]
    if clash:  # they stay in the result, so they are carried past the verdict under other names
        other = {c: unused(f"_own{c}", docs.columns) for c in clash}
        return drop_low_quality(docs.withColumnsRenamed(other), host, text).withColumnsRenamed({v: k for k, v in other.items()})
    return judge(docs, host, text).where("_kept").select(*docs.columns)
