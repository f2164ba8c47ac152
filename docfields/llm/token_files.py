"""Token ids in raw payload files, with a minimal perfect hash from document key to place.

A shard is two files. ``.ids`` has the ids of its documents, one after the other, 16 bits each where the vocabulary
allows it, else 32. ``.idx`` has a header and arrays: document keys and id offsets in file order, then the hash: bit
levels with ranks, and for every slot the fingerprint of its key, the first document with that key and how many follow.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docfields.llm.arrays import GOLDEN, U64, mix, parts
from docfields.llm.files import attempt_name, create, mapped, new_folder, opened
from docfields.llm.pieces import LIBRARY_BATCH, library_encoder
from docfields.session import materialise

MAGIC = b"idshard1"


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys.

    Each level hashes the keys left to a bit array twice their number; keys alone on their bit stay there, the rest go
    on. A key's slot is the rank of its bit. Keys that have none after the last level (hardly ever) lie in a sorted list.
    """

    LEVELS = 48

    def __init__(self, words: np.ndarray, ranks: np.ndarray, sizes: np.ndarray, rest: np.ndarray):
        self.words, self.ranks, self.sizes, self.rest = words, ranks, sizes, rest

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, words, sizes = np.asarray(keys, dtype=U64), [], []
        for level in range(cls.LEVELS):
            if not len(left):
                break
            size = -(-2 * len(left) // 64) * 64
            at = cls._place(left, level, size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone[at]]
        words = np.concatenate(words) if words else np.zeros(0, dtype=U64)
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        return cls(words, ranks, np.array(sizes, dtype=np.int64), np.sort(left))

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(keys + GOLDEN * U64(level + 1)) % U64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key; -1 for some keys that were not there, any slot for the others."""
        keys = np.asarray(keys, dtype=U64)
        out = np.full(len(keys), -1, dtype=np.int64)
        todo, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(todo):
                return out
            at = base + self._place(keys[todo], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(U64)
            hit = (word >> bit) & U64(1) == 1
            below = np.bitwise_count(word & ((U64(1) << bit) - U64(1)))
            out[todo[hit]] = (self.ranks[at >> 6] + below)[hit]
            todo, base = todo[~hit], base + size
        if len(todo) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            found = self.rest[at] == keys[todo]
            out[todo[found]] = self.ranks[-1] + at[found]
        return out


def hashed(keys: np.ndarray) -> np.ndarray:
    """A one-to-one scramble, so that different keys never share a hash."""
    return mix(np.asarray(keys).astype(np.int64).view(U64))


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ U64(0x5851F42D4C957F2D)) >> U64(32)).astype(np.uint32)


def write_index(uri: str, keys: np.ndarray, n_null: int, offsets: np.ndarray, width: int) -> None:
    """``keys`` in ascending order; the first ``n_null`` stand for null and are not in the hash."""
    own = keys[n_null:]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, dtype=np.int64)
    runs = np.diff(np.append(first, len(own)))
    hashes = hashed(own[first])
    table = PerfectHash.build(hashes)
    slots = table.slots(hashes)
    prints = np.zeros(len(first), dtype=np.uint32)
    rows, counts = np.zeros(len(first), dtype=np.int64), np.zeros(len(first), dtype=np.int64)
    prints[slots], rows[slots], counts[slots] = fingerprints(hashes), first + n_null, runs
    arrays = {"keys": keys.astype(np.int64), "offsets": offsets.astype(np.int64), "words": table.words,
              "ranks": table.ranks, "sizes": table.sizes, "rest": table.rest, "prints": prints, "rows": rows, "counts": counts}
    head = json.dumps({"width": width, "nulls": n_null, "arrays": [[k, v.dtype.str, len(v)] for k, v in arrays.items()]}).encode()
    with create(uri) as f:
        f.write(MAGIC + len(head).to_bytes(8, "little") + head.ljust(-(-len(head) // 8) * 8))
        for v in arrays.values():
            f.write(v.tobytes().ljust(-(-v.nbytes // 8) * 8, b"\0"))


class Shard:
    """A shard opened for keyed access: one probe per level, one fingerprint, then the payload's place."""

    def __init__(self, ids: str, index: str):
        with opened(index) as f:
            if f.read(8) != MAGIC:
                raise ValueError(f"{index} is not an index of token ids")
            size = int.from_bytes(f.read(8), "little")
            head = json.loads(f.read(size))
        at = 16 + -(-size // 8) * 8
        self.nulls, a = head["nulls"], {}
        for name, kind, count in head["arrays"]:
            a[name] = mapped(index, np.dtype(kind), count, at)
            at += -(-count * np.dtype(kind).itemsize // 8) * 8
        self.keys, self.offsets = a["keys"], a["offsets"]
        self.prints, self.rows, self.counts = a["prints"], a["rows"], a["counts"]
        self.hash = PerfectHash(a["words"], a["ranks"], a["sizes"], a["rest"])
        self.ids = mapped(ids, f"<u{head['width']}", int(self.offsets[-1]))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every key its first document and how many have it; -1 and 0 where the fingerprint denies it."""
        hashes = hashed(keys)
        slots = self.hash.slots(hashes)
        row, count = np.full(len(hashes), -1, dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        held = np.flatnonzero(slots >= 0)
        held = held[self.prints[slots[held]] == fingerprints(hashes[held])]
        row[held], count[held] = self.rows[slots[held]], self.counts[slots[held]]
        return row, count

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of every document with ``key``."""
        row, count = self.find(np.array([key]))
        return [self.ids[self.offsets[r] : self.offsets[r + 1]] for r in range(row[0], row[0] + count[0])]


def write(docs: DataFrame, vocabulary: str, end_id: int = 0, key: str = "doc_id", text: str = "text",
          folder: str | None = None, special: bool = False) -> DataFrame:
    """Encode ``text``, add ``end_id``, and write shards in ascending order of ``key`` (a whole number).

    Returns the written shards: ``shard, ids, index, n_docs, n_tokens, first_key, last_key, first_token``. Null text
    counts as empty; rows with a null key come first and are found by no key; rows of equal keys keep the order of a
    hash of their text and are all found. ``special``: see ``library_encoder``. An empty table gives no shards.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-ids")
    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text))
    order = [F.col(key).asc_nulls_first(), F.xxhash64(F.coalesce(F.col(text), F.lit("")))]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        from pyspark import TaskContext

        encoder = library_encoder(vocabulary, special)
        width = np.dtype(encoder.dtype).itemsize
        name = f"{folder}/{attempt_name('shard', '')}"
        keys, sizes, nulls, out = [], [], 0, None
        for batch in batches:
            for part, texts in parts(batch, text, LIBRARY_BATCH):
                out = out or create(f"{name}.ids")
                flat, counts = encoder.ids(texts)
                ends = np.cumsum(counts)
                out.write(np.insert(flat, ends, end_id).astype(f"<u{width}").tobytes())
                column = part.column(key)
                nulls += column.null_count
                keys.append(column.fill_null(0).to_numpy(zero_copy_only=False))
                sizes.append(counts + 1)
        if out:
            out.close()
            keys, offsets = np.concatenate(keys), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            write_index(f"{name}.idx", keys, nulls, offsets, width)
            row = {"shard": TaskContext.get().partitionId(), "ids": f"{name}.ids", "index": f"{name}.idx", "n_docs": len(keys),
                   "n_tokens": int(offsets[-1]), "first_key": int(keys[nulls]) if nulls < len(keys) else None,
                   "last_key": int(keys[-1]) if nulls < len(keys) else None}
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("shard", pa.int32()), ("ids", pa.string()), ("index", pa.string()), ("n_docs", pa.int64()),
                ("n_tokens", pa.int64()), ("first_key", pa.int64()), ("last_key", pa.int64())]))

    written = materialise(ranged.mapInArrow(
        run, "shard int, ids string, index string, n_docs long, n_tokens long, first_key long, last_key long"), "token-shards")
    # One row for each shard, not for each document.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


Derived = dict[str, tuple[str, Callable[[np.ndarray], object]]]
#: Documents of one batch that a reader returns.
READ_ROWS = 2_000


def read(shards: DataFrame, derive: Derived | None = None) -> DataFrame:
    """Every document of the shards: ``doc_id, start, n_tokens`` and ``ids``, or what ``derive`` makes of them.

    ``derive`` maps a column to its Spark type and a function of the ids as unsigned 32-bit integers. Each key is looked
    up in its shard's hash, and a document that the hash does not give raises an error.
    """
    derive = derive or {"ids": ("array<long>", lambda ids: ids.tolist())}
    schema = ", ".join(["doc_id long, start long, n_tokens long", *[f"{k} {kind}" for k, (kind, _) in derive.items()]])

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                shard = Shard(r["ids"], r["index"])
                for at in range(0, r["n_docs"], READ_ROWS):
                    keys = np.asarray(shard.keys[at : at + READ_ROWS])
                    rows = np.arange(at, at + len(keys))
                    null = rows < shard.nulls
                    first, count = shard.find(keys)
                    if not (null | (first <= rows) & (rows < first + count)).all():
                        raise ValueError(f"{r['index']} does not find its own keys")
                    marks = np.asarray(shard.offsets[at : at + len(keys) + 1])
                    flat = np.asarray(shard.ids[marks[0] : marks[-1]]).astype("<u4")
                    cut = (marks - marks[0]).tolist()
                    columns = {"doc_id": pa.array(keys, pa.int64(), mask=null), "start": pa.array(r["first_token"] + marks[:-1], pa.int64()),
                               "n_tokens": pa.array(np.diff(marks), pa.int64())}
                    for name, (_, f) in derive.items():
                        columns[name] = pa.array([f(flat[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)])
                    yield pa.RecordBatch.from_pydict(columns)

    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartition(n, "shard").mapInArrow(run, schema)


def fetch(keys: DataFrame, shards: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents of ``keys``, as ``key, ids``: each key goes to the shards whose range holds it and is looked up there.

    Keys meet shards by the cells of a grid with about as many cells as shards, so no key is compared with all shards.
    """
    wanted = keys.select(F.col(key).cast("long").alias("_key")).where(F.col("_key").isNotNull())
    ranged = shards.select("ids", "index", "first_key", "last_key").where("first_key IS NOT NULL AND last_key IS NOT NULL")
    low, high, n = ranged.agg(F.min("first_key"), F.max("last_key"), F.count(F.lit(1))).first()
    low, width = low or 0, ((high or 0) - (low or 0)) // max(n, 1) + 1
    cell = lambda c: F.floor((F.col(c).cast("double") - F.lit(float(low))) / F.lit(float(width)))
    celled = ranged.withColumn("_cell", F.explode(F.sequence(cell("first_key"), cell("last_key"))))
    inside = wanted.where(F.col("_key").between(F.lit(low), F.lit(high))).withColumn("_cell", cell("_key"))
    placed = inside.join(celled, "_cell").where(F.col("_key").between(F.col("first_key"), F.col("last_key"))).select("_key", "ids", "index")
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        name, shard = "", None
        for batch in batches:
            for r in batch.to_pylist():
                if r["index"] != name:
                    name, shard = r["index"], Shard(r["ids"], r["index"])
                found = [x.tolist() for x in shard.get(r["_key"])]
                if found:
                    yield pa.RecordBatch.from_pydict({key: pa.array([r["_key"]] * len(found), pa.int64()), "ids": pa.array(found, pa.list_(pa.int64()))})

    return placed.repartition(n, "index").sortWithinPartitions("index").mapInArrow(run, f"{key} long, ids array<long>")
