"""Near duplicates by BagMinHash signatures of word shingles, banded, and verified by exact multiset overlap.

Each distinct shingle of a text, with its count as weight, owns Poisson processes of points in time: one for the weight
levels up to 1, one for those from 1 to 2, from 2 to 4 and so on, with rates as long as those ranges. A point is dealt
to one of ``SIZE`` components; in a range that the weight covers in part only, repeated halving gives the point a level,
and points above the weight do not count. The first point of each component is the signature, so that two texts agree in
a component with a probability that equals their weighted Jaccard similarity. Points are made in the order of time and
only while they can still come first somewhere.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfields.llm.arrays import GOLDEN, U64, Texts, mix, new_seed, parts, windows
from docfields.llm.components import components
from docfields.llm.large_groups import join_groups
from docfields.llm.tree_merge import PLACE, placed
from docfields.session import materialise

SHINGLE, SIMILARITY = 5, 0.8
#: Components of a signature, and how many of them make a band. At similarity 0.8 all 32 bands miss 5 times in 10^8.
SIZE, ROWS = 128, 4
BANDS = SIZE // ROWS
#: Pairs whose signatures agree in fewer components are not verified: five standard deviations below SIMILARITY.
LEAST_AGREEING = int(SIZE * (SIMILARITY - 5 * (SIMILARITY * (1 - SIMILARITY) / SIZE) ** 0.5))
#: Members of a bucket that one task compares with as many others.
BLOCK = 4_096


def shingles(texts: Texts, size: int = SHINGLE, seed: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash (by ``seed``) and count of every distinct shingle; a text of fewer words has one shingle, of all its words."""
    words = texts.words()
    hashes, text_of, counts = words.hashes(seed=seed), words.text_of(), words.counts()
    value, at = windows(hashes, words.first, size)
    owner = text_of[at]
    short = np.flatnonzero((counts > 0) & (counts < size))
    h = counts[short].astype(U64)
    for k in range(size - 1):
        more = counts[short] > k
        h[more] = mix(h[more] * GOLDEN + hashes[words.first[short[more]] + k])
    value, owner = np.concatenate([value, h]), np.concatenate([owner, short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return owner[first], value[first], np.diff(np.append(first, len(value)))


def signatures(owner: np.ndarray, value: np.ndarray, count: np.ndarray, texts: int, size: int = SIZE) -> np.ndarray:
    """A row of ``size`` hashes (32 bits) for each text; zeros for texts without shingles."""
    # One process for each shingle and range of levels: [0, 1), [1, 2), [2, 4), ...
    ranges = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1
    row = np.repeat(np.arange(len(owner)), ranges)
    k = np.arange(len(row)) - np.repeat(np.cumsum(ranges) - ranges, ranges)
    low = np.where(k > 0, 1 << np.maximum(k - 1, 0), 0)
    width = np.maximum(low, 1)
    covered = np.minimum(count[row] - low, width)
    seed = mix(value[row] + GOLDEN * (k + 1).astype(U64))
    doc, time = owner[row], np.zeros(len(row))
    first = np.full(texts * size, np.inf)
    out = np.zeros(texts * size, dtype=np.uint32)
    step = 0
    while len(doc):
        step += 1
        point = mix(seed + U64(step * int(GOLDEN) & (1 << 64) - 1))
        time = time - np.log(((point >> U64(11)).astype(np.float64) + 0.5) / 2.0**53) / width
        drawn = mix(point)
        place = doc * size + (drawn % U64(size)).astype(np.int64)
        level = ((drawn >> U64(20)) & (width - 1).astype(U64)).astype(np.int64)
        counts = (level < covered) & (time < first[place])
        at, when = place[counts], time[counts]
        np.minimum.at(first, at, when)
        won = first[at] == when
        out[at[won]] = (mix(point[counts][won]) >> U64(32)).astype(np.uint32)
        latest = first.reshape(texts, size).max(axis=1)
        on = time < latest[doc]
        doc, time, seed, width, covered = doc[on], time[on], seed[on], width[on], covered[on]
    return out.reshape(texts, size)


def bands(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row; the band's number is part of it."""
    wide = signature.astype(U64).reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U64) * GOLDEN, wide.shape[:2])
    for r in range(ROWS):
        key = mix(key + wide[:, :, r] * U64(0xD6E8FEB86659FD93) + U64(r))
    return key.view(np.int64)


def _sign(batches, seed: int):
    for batch in batches:
        for part, texts in parts(batch, "_text"):
            owner, value, count = shingles(texts, seed=seed)
            n = len(texts)
            total = np.bincount(owner, weights=count, minlength=n).astype(np.int64)
            signature = signatures(owner, value, count, n)
            keys = bands(signature)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.where(total > 0, BANDS, 0))]), pa.int32()), pa.array(keys[total > 0].ravel()))
            short = (signature & 0xFF).astype(np.uint8)
            digests = [hashlib.sha256(texts.bytes(i)).digest()[:16] for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [part.column("_key"), *[part.column(c) for c in PLACE], pa.array(digests, pa.binary()), pa.array(total),
                 lists, pa.array([r.tobytes() for r in short], pa.binary())],
                names=["_key", *PLACE, "digest", "n", "bands", "short"])


def _agreeing(batches):
    """Pairs whose sizes and signatures leave the similarity possible."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, SIZE) for c in ("short_a", "short_b"))
        n, m = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
        good = ((a == b).sum(axis=1) >= LEAST_AGREEING) & (np.minimum(n, m) >= SIMILARITY * np.maximum(n, m))
        yield batch.filter(pa.array(good)).select(["a", "b"])


def _verify(batches):
    """Pairs of texts whose shingles, as multisets, overlap enough. The hash here is this worker's own, not the one that
    the pairs were found by."""
    for batch in batches:
        for part, left in parts(batch, "text_a"):
            right = Texts(part.column("text_b"))
            own, value, count = shingles(left)
            other, value_b, count_b = shingles(right)
            size = np.bincount(own, weights=count, minlength=len(left)) + np.bincount(other, weights=count_b, minlength=len(left))
            order = np.lexsort((np.concatenate([value, value_b]), np.concatenate([own, other])))
            v, o, c = (np.concatenate(x)[order] for x in ((value, value_b), (own, other), (count, count_b)))
            same = np.flatnonzero((v[1:] == v[:-1]) & (o[1:] == o[:-1]))
            common = np.bincount(o[same], weights=np.minimum(c[same], c[same + 1]), minlength=len(left))
            good = (common >= SIMILARITY * (size - common)) & (size > 0)
            yield part.filter(pa.array(good)).select(["a", "b"])


def _elements(batches, seed: int):
    """The distinct shingles of every text and their counts, as bytes."""
    for batch in batches:
        for part, texts in parts(batch, "_text"):
            owner, value, count = shingles(texts, seed=seed)
            marks = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
            cut = list(zip(marks[:-1], marks[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([value[a:b].tobytes() for a, b in cut], pa.binary()),
                 pa.array([count[a:b].astype(np.uint32).tobytes() for a, b in cut], pa.binary())], names=["id", "values", "counts"])


def bucket_links(table: pa.Table) -> pa.Table:
    """Links between members of one bucket that are in different components so far; enough to join all that belong together.

    Rows: ``id, label, n, short, values, counts`` and ``side`` (0, 1: members of two blocks that are compared with each
    other only; null: all with all).
    """
    ids, label = table.column("id").to_numpy(), table.column("label").to_numpy().copy()
    sizes, sides = table.column("n").to_numpy(), table.column("side").fill_null(-1).to_numpy()
    short = np.frombuffer(b"".join(table.column("short").to_pylist()), dtype=np.uint8).reshape(-1, SIZE)
    values = [np.frombuffer(x, dtype=U64) for x in table.column("values").to_pylist()]
    counts = [np.frombuffer(x, dtype=np.uint32).astype(np.int64) for x in table.column("counts").to_pylist()]
    lengths = np.array([len(v) for v in values])
    known, code = np.unique(np.concatenate(values), return_inverse=True)
    weight, begin = np.concatenate(counts), np.cumsum(lengths) - lengths
    mine = np.zeros(len(known), dtype=np.int64)
    left, right = [], []
    for i in range(len(ids) - 1):
        rest = np.arange(i + 1, len(ids))
        rest = rest[(label[rest] != label[i]) & ((sides[rest] < 0) | (sides[rest] != sides[i]))
                    & (np.minimum(sizes[rest], sizes[i]) >= SIMILARITY * np.maximum(sizes[rest], sizes[i]))]
        if not len(rest):
            continue
        agree = (short[rest] == short[i]).sum(axis=1)
        rest = rest[agree >= LEAST_AGREEING]
        if not len(rest):
            continue
        own = slice(begin[i], begin[i] + lengths[i])
        mine[code[own]] = weight[own]
        take = np.repeat(begin[rest] - (np.cumsum(lengths[rest]) - lengths[rest]), lengths[rest]) + np.arange(lengths[rest].sum())
        common = np.add.reduceat(np.minimum(mine[code[take]], weight[take]), np.cumsum(lengths[rest]) - lengths[rest])
        mine[code[own]] = 0
        for j in rest[common >= SIMILARITY * (sizes[rest] + sizes[i] - common)].tolist():
            if label[j] != label[i]:
                left.append(ids[i])
                right.append(ids[j])
                label[label == label[j]] = label[i]
    return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


def _links(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified links between ``classes`` (id, n, bands, short), enough to connect every pair that is similar and shares a band."""
    keys = materialise(classes.select("id", F.explode("bands").alias("bucket")), "bands")
    shared = keys.groupBy("bucket").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialise(keys.join(shared, "bucket"), "buckets")
    # First every member of a bucket with the bucket's smallest.
    pairs = members.where("a != id").select("a", F.col("id").alias("b")).distinct()
    marks = classes.select("id", "n", "short")
    for side in "ab":
        pairs = pairs.join(marks.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("short").alias(f"short_{side}")), side)
    pairs = materialise(pairs.mapInArrow(_agreeing, "a long, b long"), "pairs")
    for side in "ab":
        pairs = pairs.join(texts.select(F.col("id").alias(side), F.col("_text").alias(f"text_{side}")), side)
    links = materialise(pairs.mapInArrow(_verify, "a long, b long"), "links")
    # Then the buckets whose members are not all connected: members of different components with each other.
    label = components(links)
    members = members.join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
    several = members.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("k")).where("x != y")
    open_members = materialise(members.select("bucket", "id", "label").join(several.select("bucket", "k"), "bucket"), "open-buckets")
    # A bucket over BLOCK members is cut to blocks, and every two blocks are compared on their own.
    blocks = F.ceil(F.col("k") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    others = F.when(blocks > 1, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(F.lit(0)))
    cut = open_members.withColumn("own", own).withColumn("other", F.explode(others)).select(
        "bucket", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "id", "label",
        F.when(F.col("own") == F.col("other"), F.lit(None)).otherwise((F.col("own") > F.col("other")).cast("int")).alias("side"))
    elements = texts.join(open_members.select("id").distinct(), "id", "left_semi").mapInArrow(partial(_elements, seed=new_seed()), "id long, values binary, counts binary")
    full = cut.join(marks, "id").join(elements, "id")
    more = full.groupBy("bucket", "p", "q").applyInArrow(bucket_links, "a long, b long")
    return links.union(materialise(more, "more-links"))


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each of ``docs``: ``key, class_id, group_size, kept`` and the row's ``PLACE``.

    Two texts are linked if their multisets of five-word shingles overlap by 0.8 or more (weighted Jaccard), or if they
    are the same; a class is what links connect, ``class_id`` its smallest key. Words are runs without white space, as
    they are written. A text without words (null, empty) is linked to the same text only. The row with the smallest key
    stays (null keys come last); of rows with the same key and text, one. Other columns are not read. An empty table
    gives no rows.
    """
    rows = placed(docs, {"_key": F.col(key), "_text": F.col(text)})
    signed = materialise(rows.mapInArrow(
        partial(_sign, seed=new_seed()), f"_key {docs.schema[key].dataType.simpleString()}, {PLACE[0]} long, {PLACE[1]} long, digest binary, n long, bands array<long>, short binary"), "signatures")
    # Equal texts are one class from the start, stood for by its first row.
    here = F.struct(F.col("_key").isNull().alias("no_key"), F.col("_key").alias("key"), F.col(PLACE[0]).alias("file"), F.col(PLACE[1]).alias("at"))
    first = signed.groupBy("digest").agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("copies"))
    first = materialise(first.withColumn("id", F.monotonically_increasing_id()), "texts")
    of_first = [F.col("first.file").alias(PLACE[0]), F.col("first.at").alias(PLACE[1])]
    classes = materialise(signed.where("n > 0").select(*PLACE, "n", "bands", "short").join(first.select("id", *of_first), list(PLACE)).drop(*PLACE), "classes")
    texts = rows.select("_text", *PLACE).join(first.select("id", *of_first), list(PLACE)).select("id", "_text")
    label = components(_links(classes, texts))
    # What a class keeps is found among its texts; a text is told of it, then the text's rows.
    labelled = materialise(first.join(label, "id", "left").select("digest", "first", "copies", F.coalesce("label", "id").alias("label")), "labelled")
    n_texts, n_rows = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("copies"), F.lit(0))).first()
    best = labelled.groupBy("label").agg(F.min("first").alias("best"), F.sum("copies").alias("group_size"), F.count(F.lit(1)).alias("_texts")).where("_texts > 1")
    told = join_groups(labelled, best, ["label"], "_texts", n_texts).select(
        "digest", "copies", F.coalesce("best", "first").alias("best"), F.coalesce("group_size", "copies").alias("group_size"))
    full = join_groups(signed.select("_key", "digest", *PLACE), materialise(told, "told"), ["digest"], "copies", n_rows)
    return full.select(
        F.col("_key").alias(key), F.col("best.key").alias("class_id"), "group_size", here.eqNullSafe(F.col("best")).alias("kept"), *PLACE)


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every class of ``near_groups``; all columns, in their order."""
    rows = placed(docs)
    dropped = near_groups(rows, key, text).where(~F.col("kept")).select(*PLACE)
    return rows.join(dropped, list(PLACE), "left_anti").select(*docs.columns)
