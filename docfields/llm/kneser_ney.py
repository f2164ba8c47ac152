"""An interpolated modified Kneser-Ney model of order 2 or 3, counted in Spark and kept as sorted hash arrays in shared files.

Words are known by a 64-bit hash whose seed is drawn for each model. The hashes of the training words, sorted and cut into ranges, are the vocabulary; a
word's id is its place. Bigrams are sorted pairs of ids, cut into shards by their first word; the bigrams of a very
frequent first word are dealt over shards by their second. Scoring tasks map these files and look up the distinct
words and pairs of a part of the texts in order.

At order 3 trigrams are counted, in shards by a hash of their first two words and prefix-coded: a context once, then its
followers. Pairs then count the words they follow, but pairs that begin a text their occurrences.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfields.llm.arrays import U64, Texts, gather, group_sums, mix, new_seed, parts, unused
from docfields.llm.files import create, mapped, new_folder
from docfields.session import materialise

END = mix(np.array([0x454E44], dtype=U64))
#: Distinct entries that a counting task holds before it passes them on.
HELD = 1_500_000
STATS = (("follows", "<i8"), ("total", "<i8"), ("once", "<i8"), ("twice", "<i8"), ("more", "<i8"))


def tokens(texts: Texts, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (by ``seed``) of the words of every text, A to Z in lower case, each text followed by its end; and where texts begin."""
    words = texts.words()
    first = words.first + np.arange(len(texts) + 1)
    return np.insert(words.hashes(True, seed), words.first[1:], END[0]), first


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    return keys[first], np.add.reduceat(counts, first, dtype=counts.dtype) if len(first) else counts


class Counter:
    """Counts of 64-bit keys in sorted arrays."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray) -> None:
        keys, counts = np.unique(keys, return_counts=True)
        self.parts.append((keys, counts.astype(np.uint32)))
        self.held += len(keys)
        if self.held > HELD:
            self.parts = [self.all()]
            self.held = len(self.parts[0][0])

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.uint32)
        keys, counts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts = []
        return summed(keys, counts)

    def full(self) -> bool:
        return self.held > HELD // 2

    def clear(self) -> None:
        self.parts, self.held = [], 0


def summed_triples(pairs: np.ndarray, third: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct triples (a pair's key and a word) in order, with the sums of their counts."""
    order = np.lexsort((third, pairs))
    pairs, third, counts = pairs[order], third[order], counts[order]
    new = np.ones(len(pairs), dtype=bool)
    new[1:] = (pairs[1:] != pairs[:-1]) | (third[1:] != third[:-1])
    first = np.flatnonzero(new)
    return pairs[first], third[first], np.add.reduceat(counts, first, dtype=counts.dtype) if len(first) else counts


class TripleCounter(Counter):
    """Counts of triples in sorted arrays."""

    def add(self, pairs: np.ndarray, third: np.ndarray) -> None:
        self.parts.append(summed_triples(pairs, third.astype(np.uint32), np.ones(len(pairs), dtype=np.uint32)))
        self.held += len(self.parts[-1][0])

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.uint32)
        columns = [np.concatenate(x) for x in zip(*self.parts, strict=True)]
        self.parts = []
        return summed_triples(*columns)


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return ((hashes >> U64(32)) * U64(ranges) >> U64(32)).astype(np.int64)


@dataclass
class Model:
    """Where the files of a model are, and its few constants. What grows with the corpus is in the files only."""

    ranges: int
    words: list = field(default_factory=list)  # (file, entries) of each range of hashes
    pairs: list = field(default_factory=list)  # of each shard of pairs
    stats: list = field(default_factory=list)  # of each range of ids
    base: np.ndarray | None = None  # first id of each range
    tokens: int = 0
    frequent: np.ndarray | None = None  # ids of first words whose pairs are dealt over shards
    pair_discount: tuple = (0.5, 1.0, 1.5)
    word_discount: tuple = (0.5, 1.0, 1.5)
    bigrams: int = 0
    kinds: tuple = (0, 0, 0)  # words that follow one, two, three or more others
    order: int = 2
    seed: int = 0  # of the words' hashes
    triples: list = field(default_factory=list)  # (file, contexts, entries) of each shard of triples
    triple_discount: tuple = (0.5, 1.0, 1.5)

    @property
    def size(self) -> int:
        return int(self.base[-1])

    def shard_of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        own = first * self.ranges // (self.size + 1)
        return np.where(np.isin(first, self.frequent), (own + second) % self.ranges, own)


class Mapped:
    """A model's files on a worker: each is mapped once, on first use, and the least used of more than ``KEPT`` let go."""

    KEPT = 256

    def __init__(self, model: Model):
        self.m = model
        self.kept: OrderedDict[str, list[np.ndarray]] = OrderedDict()

    def _arrays(self, file: str, layout: Sequence[tuple[str, int]]) -> list[np.ndarray]:
        if not file:
            return [np.zeros(0, dtype=kind) for kind, _ in layout]
        if file in self.kept:
            self.kept.move_to_end(file)
            return self.kept[file]
        raw, at, out = mapped(file, np.uint8, sum(n * np.dtype(kind).itemsize for kind, n in layout)), 0, []
        for kind, n in layout:
            end = at + n * np.dtype(kind).itemsize
            out.append(np.asarray(raw[at:end]).view(kind))
            at = end
        self.kept[file] = out
        if len(self.kept) > self.KEPT:
            self.kept.popitem(last=False)
        return out

    def words(self, r: int) -> list[np.ndarray]:
        file, n = self.m.words[r]
        return self._arrays(file, (("<u8", n), ("<i8", n)))

    def pairs(self, r: int) -> list[np.ndarray]:
        file, n = self.m.pairs[r]
        return self._arrays(file, (("<u8", n), ("<i4", n)))

    def stats(self, r: int) -> dict[str, np.ndarray]:
        file, n = self.m.stats[r]
        return dict(zip([name for name, _ in STATS], self._arrays(file, [(kind, n) for _, kind in STATS]), strict=True))

    def triples(self, r: int) -> list[np.ndarray]:
        file, n, entries = self.m.triples[r]
        return self._arrays(file, triple_layout(n, entries))

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id (-1: unknown) and count of sorted distinct hashes."""
        ids, counts = np.full(len(hashes), -1, dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        cut = np.searchsorted(range_of(hashes, self.m.ranges), np.arange(self.m.ranges + 1))
        for r in np.flatnonzero(np.diff(cut)):
            known, count = self.words(r)
            if not len(known):
                continue
            some = hashes[cut[r] : cut[r + 1]]
            at = np.minimum(np.searchsorted(known, some), len(known) - 1)
            hit = np.flatnonzero(known[at] == some)
            ids[cut[r] + hit], counts[cut[r] + hit] = self.m.base[r] + at[hit], count[at[hit]]
        return ids, counts

    def text_ids(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and counts of all tokens, and where texts begin."""
        flat, first = tokens(texts, self.m.seed)
        distinct, which = np.unique(flat, return_inverse=True)
        ids, counts = self.ids(distinct)
        return ids[which], counts[which], first

    def stat(self, ids: np.ndarray, names: list[str]) -> list[np.ndarray]:
        """Statistics of sorted distinct ids."""
        out = [np.zeros(len(ids), dtype=np.int64) for _ in names]
        cut = np.searchsorted(ids, [stat_range(r, self.m)[0] for r in range(self.m.ranges)] + [self.m.size + 1])
        for r in np.flatnonzero(np.diff(cut)):
            at = ids[cut[r] : cut[r + 1]] - stat_range(int(r), self.m)[0]
            held = self.stats(r)
            for o, name in zip(out, names, strict=True):
                if len(held[name]):  # else nothing was counted there
                    o[cut[r] : cut[r + 1]] = held[name][at]
        return out

    def pair_counts(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Counts of distinct pairs, in order."""
        out = np.zeros(len(first), dtype=np.int64)
        shard = self.m.shard_of(first, second)
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(self.m.ranges + 1))
        keys = pair_keys(first, second)[order]
        for r in np.flatnonzero(np.diff(cut)):
            known, count = self.pairs(r)
            if not len(known):
                continue
            some = keys[cut[r] : cut[r + 1]]
            at = np.minimum(np.searchsorted(known, some), len(known) - 1)
            out[order[cut[r] : cut[r + 1]]] = np.where(known[at] == some, count[at], 0)
        return out

    def words_probability(self, ids: np.ndarray) -> np.ndarray:
        """Of sorted distinct ids (-1: unknown), by how many words each follows."""
        m = self.m
        out = np.full(len(ids), 1.0)
        if m.bigrams:
            out[:] = sum(d * k for d, k in zip(m.word_discount, m.kinds, strict=True)) / m.bigrams
        out /= m.size + 1
        known = ids >= 0
        follows, = self.stat(ids[known], ["follows"])
        out[known] += (follows - discount(follows, m.word_discount)) / max(1, m.bigrams)
        return out

    def log_probability(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 of each token's probability after the token before it in its text."""
        m = self.m
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[first[:-1]] = m.size
        distinct, which = np.unique(ids, return_inverse=True)
        low = self.words_probability(distinct)[which]
        # Distinct pairs only; unknown words have no counts.
        pairs, at, back = np.unique(pair_keys(before + 1, ids + 1), return_index=True, return_inverse=True)
        v, w = before[at], ids[at]
        seen = (v >= 0) & (w >= 0)
        count = np.zeros(len(pairs), dtype=np.int64)
        count[seen] = self.pair_counts(v[seen], w[seen])
        context, where = np.unique(v, return_inverse=True)
        known = context >= 0
        total, *kinds = (np.zeros(len(context), dtype=np.int64) for _ in range(4))
        total[known], kinds[0][known], kinds[1][known], kinds[2][known] = self.stat(context[known], ["total", "once", "twice", "more"])
        spare = sum(d * k for d, k in zip(m.pair_discount, kinds, strict=True))
        own = (count - discount(count, m.pair_discount)) / np.maximum(total[where], 1)
        left = np.where(total > 0, spare / np.maximum(total, 1), 1.0)[where]
        found = own[back] + left[back] * low
        if m.order == 3:
            earlier = np.empty_like(ids)
            earlier[1:] = before[:-1]
            earlier[first[:-1]] = -1
            found = self.after_two(earlier, before, ids, found)
        return np.log10(found)

    def after_two(self, earlier: np.ndarray, before: np.ndarray, ids: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Probability after the two words before; ``low`` where those were not seen (-1: unknown or none)."""
        m, out = self.m, low.copy()
        at = np.flatnonzero((earlier >= 0) & (before >= 0))
        contexts, which = np.unique(pair_keys(earlier[at], before[at]), return_inverse=True)
        shard = range_of(mix(contexts), m.ranges)
        order = np.argsort(which, kind="stable")  # tokens by context
        cut = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(contexts)))])
        for r in np.unique(shard):
            known, total, once, twice, more, marks, third, counts = self.triples(r)
            if not len(known):
                continue
            some = np.flatnonzero(shard == r)
            place = np.minimum(np.searchsorted(known, contexts[some]), len(known) - 1)
            hit = known[place] == contexts[some]
            some, place = some[hit], place[hit]
            lengths = cut[some + 1] - cut[some]
            token, of = at[gather(order, cut[some], lengths)], np.repeat(place, lengths)
            word, low_end, high = ids[token], np.asarray(marks[of]), np.asarray(marks[of + 1])
            end = high.copy()
            while (open_ := low_end < high).any():
                middle = (low_end + high) >> 1
                less = open_ & (third[np.minimum(middle, len(third) - 1)] < word)
                low_end, high = np.where(less, middle + 1, low_end), np.where(open_ & ~less, middle, high)
            spot = np.minimum(low_end, len(third) - 1)
            count = np.where((low_end < end) & (third[spot] == word), counts[spot], 0)
            spare = sum(d * k[of] for d, k in zip(m.triple_discount, (once, twice, more), strict=True))
            out[token] = (count - discount(count, m.triple_discount) + spare * low[token]) / total[of]
        return out


def discount(counts: np.ndarray, by: tuple) -> np.ndarray:
    return np.array([0.0, *by])[np.minimum(counts, 3)]


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts from how many entries have counts 1 to 4; fixed ones where those leave them undefined."""
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, 0.0), k) for k, d in enumerate(found, 1))


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return first.astype(U64) << U64(32) | second.astype(U64)


def triple_layout(contexts: int, entries: int) -> tuple[tuple[str, int], ...]:
    """Arrays of a file of triples: contexts, their statistics and where their entries begin; followers and counts."""
    return (("<u8", contexts), ("<i8", contexts), *[("<i4", contexts)] * 3, ("<i8", contexts + 1 if contexts else 0), ("<u4", entries), ("<i4", entries))


def stat_range(r: int, model: Model) -> tuple[int, int]:
    """The ids whose statistics are in file ``r``: those with ``id * ranges // (size + 1) == r``."""
    n = model.size + 1
    return -(-r * n // model.ranges), -(-(r + 1) * n // model.ranges)


_mapped: dict[str, Mapped] = {}


def opened(model: Model) -> Mapped:
    key = next((f for f, *_ in model.stats + model.words if f), "")  # while counting, the words alone
    if key not in _mapped:
        _mapped.clear()
        _mapped[key] = Mapped(model)
    return _mapped[key]


def _blocks(part: np.ndarray, *columns: np.ndarray):
    """Rows ``part, data`` with the columns' values of each part, one column after the other."""
    order = np.argsort(part, kind="stable")
    parts_, first = np.unique(part[order], return_index=True)
    cut = np.append(first, len(part))
    data = [b"".join(c[order[a:b]].tobytes() for c in columns) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return pa.array(parts_, pa.int32()), pa.array(data, pa.binary())


def _unpacked(blocks: list[bytes], *kinds: str) -> list[np.ndarray]:
    width = sum(np.dtype(k).itemsize for k in kinds)
    out: list[list[np.ndarray]] = [[] for _ in kinds]
    for b in blocks:
        n, at = len(b) // width, 0
        for o, k in zip(out, kinds, strict=True):
            o.append(np.frombuffer(b, dtype=k, count=n, offset=at))
            at += n * np.dtype(k).itemsize
    return [np.concatenate(o) for o in out]


def _write(folder: str, name: str, *arrays: np.ndarray) -> str:
    uri = f"{folder}/{name}-{uuid.uuid4().hex[:12]}"
    with create(uri) as f:
        for a in arrays:
            f.write(np.ascontiguousarray(a).tobytes())
    return uri


WRITTEN = "part int, file string, n long, total long, kinds array<long>, data binary, target int"
_SCHEMA = pa.schema([("part", pa.int32()), ("file", pa.string()), ("n", pa.int64()), ("total", pa.int64()),
                     ("kinds", pa.list_(pa.int64())), ("data", pa.binary()), ("target", pa.int32())])


def count_words(docs: DataFrame, text: str, ranges: int, folder: str, seed: int) -> DataFrame:
    def count(batches):
        held = Counter()

        def passed_on():
            keys, counts = held.all()
            part, data = _blocks(range_of(keys, ranges), keys, counts.astype("<u4"))
            held.clear()
            return pa.RecordBatch.from_arrays([part, data], names=["part", "data"])

        for batch in batches:
            for _, texts in parts(batch, text):
                held.add(tokens(texts, seed)[0])
                if held.full():
                    yield passed_on()
        yield passed_on()

    def merge(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        keys, counts = _unpacked(table.column("data").to_pylist(), "<u8", "<u4")
        keys, counts = summed(keys, counts.astype(np.int64))
        often = np.flatnonzero(counts > counts.sum() // 64)  # candidates for frequent words: at most 64 of a range
        data = keys[often].tobytes() + counts[often].tobytes()
        return pa.Table.from_pylist([{"part": part, "file": _write(folder, f"words-{part}", keys, counts), "n": len(keys),
                                      "total": int(counts.sum()), "data": data}], schema=_SCHEMA)

    return materialise(docs.select(text).mapInArrow(count, "part int, data binary").groupBy("part").applyInArrow(merge, WRITTEN), "kn-words")


def count_triples(docs: DataFrame, text: str, model: Model, folder: str) -> DataFrame:
    """Files of triples, and with ``target`` set what they make of pairs, by the shard of the pair."""
    none = model.size + 1  # before the begin of a text

    def count(batches):
        held, words = TripleCounter(), opened(model)

        def passed_on():
            pairs, third, counts = held.all()
            part, data = _blocks(range_of(mix(pairs), model.ranges), pairs, third.astype("<u4"), counts.astype("<u4"))
            held.clear()
            return pa.RecordBatch.from_arrays([part, data], names=["part", "data"])

        for batch in batches:
            for _, texts in parts(batch, text):
                ids, _, first = words.text_ids(texts)
                before, earlier = np.empty_like(ids), np.empty_like(ids)
                before[1:] = ids[:-1]
                before[first[:-1]] = model.size
                earlier[1:] = before[:-1]
                earlier[first[:-1]] = none
                held.add(pair_keys(earlier, before), ids)
                if held.full():
                    yield passed_on()
        yield passed_on()

    def merge(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        pairs, third, counts = _unpacked(table.column("data").to_pylist(), "<u8", "<u4", "<u4")
        pairs, third, counts = summed_triples(pairs, third, counts.astype(np.int64))
        starts = pairs >> U64(32) == U64(none)
        keys, weight = summed((pairs << U64(32)) | third.astype(U64), np.where(starts, counts, 1))
        first, second = (keys >> U64(32)).astype(np.int64), (keys & U64(0xFFFFFFFF)).astype(np.int64)
        target, data = _blocks(model.shard_of(first, second), first.astype("<u4"), second.astype("<u4"), weight.astype("<u4"))
        rows = [{"part": part, "data": d, "target": t} for t, d in zip(target.to_pylist(), data.to_pylist(), strict=True)]
        pairs, third, counts = pairs[~starts], third[~starts], counts[~starts]
        if len(pairs):
            begin = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
            stats = [np.add.reduceat(x.astype(np.int64), begin) for x in (counts, counts == 1, counts == 2, counts > 2)]
            columns = [pairs[begin], *stats, np.append(begin, len(pairs)), third, np.minimum(counts, 2**31 - 1)]
            layout = triple_layout(len(begin), len(pairs))
            file = _write(folder, f"triples-{part}", *[c.astype(kind) for c, (kind, _) in zip(columns, layout, strict=True)])
            rows.append({"part": part, "file": file, "n": len(begin), "total": len(pairs), "kinds": [int((counts == k).sum()) for k in (1, 2, 3, 4)]})
        return pa.Table.from_pylist(rows, schema=_SCHEMA)

    return materialise(docs.select(text).mapInArrow(count, "part int, data binary").groupBy("part").applyInArrow(merge, WRITTEN), "kn-triples")


def count_pairs(docs: DataFrame, text: str, model: Model, folder: str, triples: DataFrame | None = None) -> DataFrame:
    def count(batches):
        held, words = Counter(), opened(model)

        def passed_on():
            keys, counts = held.all()
            first, second = (keys >> U64(32)).astype(np.int64), (keys & U64(0xFFFFFFFF)).astype(np.int64)
            part, data = _blocks(model.shard_of(first, second), first.astype("<u4"), second.astype("<u4"), counts.astype("<u4"))
            held.clear()
            return pa.RecordBatch.from_arrays([part, data], names=["part", "data"])

        for batch in batches:
            for _, texts in parts(batch, text):
                ids, _, first = words.text_ids(texts)
                before = np.empty_like(ids)
                before[1:] = ids[:-1]
                before[first[:-1]] = model.size
                held.add(pair_keys(before, ids))
                if held.full():
                    yield passed_on()
        yield passed_on()

    def merge(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        first, second, counts = _unpacked(table.column("data").to_pylist(), "<u4", "<u4", "<u4")
        keys, counts = summed(pair_keys(first, second), counts.astype(np.int64))
        first, second = (keys >> U64(32)).astype(np.int64), (keys & U64(0xFFFFFFFF)).astype(np.int64)
        rows = [{"part": part, "file": _write(folder, f"pairs-{part}", keys, np.minimum(counts, 2**31 - 1).astype("<i4")), "n": len(keys),
                 "total": int(counts.sum()), "kinds": [int((counts == k).sum()) for k in (1, 2, 3, 4)]}]
        # What this shard knows of its first words as contexts, and of its second words as followers.
        begin = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        context = [first[begin].astype("<u4"), *[np.add.reduceat(x, begin).astype("<u4") for x in (counts, counts == 1, counts == 2, counts > 2)]]
        word, follows = np.unique(second, return_counts=True)
        for kind, columns in (("context", context), ("follows", [word.astype("<u4"), follows.astype("<u4")])):
            target, data = _blocks(columns[0].astype(np.int64) * model.ranges // (model.size + 1), *columns)
            rows += [{"part": part, "file": kind, "data": d, "target": t} for t, d in zip(target.to_pylist(), data.to_pylist(), strict=True)]
        return pa.Table.from_pylist(rows, schema=_SCHEMA)

    counted = docs.select(text).mapInArrow(count, "part int, data binary") if triples is None else (
        triples.where("target is not null").select(F.col("target").alias("part"), "data"))
    return materialise(counted.groupBy("part").applyInArrow(merge, WRITTEN), "kn-pairs")


def write_stats(pairs: DataFrame, model: Model, folder: str) -> DataFrame:
    def merge(table: pa.Table) -> pa.Table:
        part = table.column("target")[0].as_py()
        low, high = stat_range(part, model)
        follows, *context = (np.zeros(high - low, dtype=np.int64) for _ in range(5))
        rows = table.to_pylist()
        if own := [r["data"] for r in rows if r["file"] == "follows"]:
            word, n = _unpacked(own, "<u4", "<u4")
            np.add.at(follows, word.astype(np.int64) - low, n.astype(np.int64))
        if own := [r["data"] for r in rows if r["file"] == "context"]:
            word, *values = _unpacked(own, *["<u4"] * 5)
            for c, v in zip(context, values, strict=True):
                np.add.at(c, word.astype(np.int64) - low, v.astype(np.int64))
        kinds = [int((follows == k).sum()) for k in (1, 2, 3, 4)] + [int((follows > 2).sum())]
        return pa.Table.from_pylist([{"part": part, "file": _write(folder, f"stats-{part}", follows, *context), "n": high - low,
                                      "kinds": kinds}], schema=_SCHEMA)

    return materialise(pairs.where("target is not null").groupBy("target").applyInArrow(merge, WRITTEN), "kn-stats")


def fit(docs: DataFrame, text: str = "text", order: int = 2) -> Model:
    """A model of all ``docs``; null texts count as empty. Passes that count, merge and write, one more at order 3; files
    stay in the shared folder.

    Ranges and shards are as many as shuffle partitions. Every entry is counted; none is pruned.
    """
    if order not in (2, 3):
        raise ValueError(f"order is 2 or 3, not {order}")
    spark = docs.sparkSession
    folder = new_folder(spark, "kneser-ney")
    model = Model(int(spark.conf.get("spark.sql.shuffle.partitions")), order=order, seed=new_seed())
    none = ("", 0)
    found = count_words(docs, text, model.ranges, folder, model.seed).collect()  # one row for each range
    by = {r["part"]: r for r in found}
    model.words = [(by[k]["file"], by[k]["n"]) if k in by else none for k in range(model.ranges)]
    model.base = np.concatenate([[0], np.cumsum([n for _, n in model.words])])
    model.tokens = sum(r["total"] for r in found)
    words = Mapped(model)
    often = [model.size]
    for r in found:
        keys, counts = _unpacked([r["data"]], "<u8", "<i8")
        often += words.ids(keys)[0][counts > model.tokens // (4 * model.ranges)].tolist()
    model.frequent = np.array(sorted(often), dtype=np.int64)
    triples = None
    if order == 3:
        triples = count_triples(docs, text, model, folder)
        found = triples.where("target is null").select("part", "file", "n", "total", "kinds").collect()  # one row for each shard
        by = {r["part"]: r for r in found}
        model.triple_discount = discounts(*[sum(r["kinds"][k] for r in found) for k in range(4)])
        seen = [(by[k]["file"], by[k]["n"], by[k]["total"]) if k in by else ("", 0, 0) for k in range(model.ranges)]
    pairs = count_pairs(docs, text, model, folder, triples)
    found = pairs.where("target is null").select("part", "file", "n", "kinds").collect()  # one row for each shard
    by = {r["part"]: r for r in found}
    model.pairs = [(by[k]["file"], by[k]["n"]) if k in by else none for k in range(model.ranges)]
    model.bigrams = sum(r["n"] for r in found)
    model.pair_discount = discounts(*[sum(r["kinds"][k] for r in found) for k in range(4)])
    found = write_stats(pairs, model, folder).collect()  # one row for each range
    by = {r["part"]: r for r in found}
    model.stats = [(by[k]["file"], by[k]["n"]) if k in by else none for k in range(model.ranges)]
    kinds = [sum(r["kinds"][k] for r in found) for k in range(5)]
    model.word_discount, model.kinds = discounts(*kinds[:4]), (kinds[0], kinds[1], kinds[4])
    if order == 3:
        model.triples = seen
    return model


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all but ``text`` by default) and ``n_tokens, n_known, train_tokens, base_score, score, perplexity``.

    ``base_score`` adds log10((c + 1) / (N + V + 1)) of each token. Every row is scored, repeated ones too; a null or
    empty text is its end alone; a very long one is scored whole, in arrays of some 15 times its size. With an empty
    training table every word is as likely as unknown. A column of ``docs`` with the name of a new one gives way to it.
    """
    kinds = (("n_tokens", T.LongType()), ("n_known", T.LongType()), ("train_tokens", T.LongType()), ("base_score", T.DoubleType()),
             ("score", T.DoubleType()), ("perplexity", T.DoubleType()))
    made = {k for k, _ in kinds}
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in made and (keep is not None or c != text)]
    inner = unused("_text", names)
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(k, t) for k, t in kinds])

    def run(batches):
        files = opened(model)
        for batch in batches:
            for part, texts in parts(batch, inner):
                ids, counts, first = files.text_ids(texts)
                n = np.diff(first)
                base = group_sums(np.log10((counts + 1) / (model.tokens + model.size + 1)), first)
                total = group_sums(files.log_probability(ids, first), first)
                columns = [n, group_sums((counts > 0).astype(np.int64), first), np.full(len(n), model.tokens), base, total, 10 ** (-total / n)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], *map(pa.array, columns)], names=schema.names)

    return docs.select(*names, F.col(text).alias(inner)).mapInArrow(run, schema)
