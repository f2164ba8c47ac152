"""Texts of an Arrow batch as flat numpy arrays: words, hashes, windows and ragged gathers, without per-word Python."""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; the temporaries are some 60 times that. A longer text is handled alone and whole.
BATCH_BYTES = 1 << 20

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit integers that spreads every input bit."""
    x = np.asarray(x, dtype=U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


_MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=U64)


def leading(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: int = 0) -> np.ndarray:
    """Up to eight bytes of each range from its byte ``at`` on, as one number; zeros behind its end."""
    return eights(data, starts + at) & _MASKS[np.minimum(lengths - at, 8)]


def eights(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number; zeros behind the end of ``data``."""
    if not len(at):
        return np.zeros(0, dtype=U64)
    if int(at.max()) + 8 > len(data):
        data = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    return np.ndarray((len(data) - 7,), "V8", np.ascontiguousarray(data), strides=(1,))[at].view("<u8")


class RangeHash:
    """64-bit hashes of ranges of bytes; equal contents give equal hashes wherever they lie.

    Ranges of up to 8 bytes are mixed without loss. Longer ones are polynomials of their 32-bit limbs modulo two primes
    near 2^31 at points drawn from ``seed``, those beyond ``LONG`` bytes a BLAKE2 digest with the seed as key. With a seed
    that is drawn anew for each run no two texts can be chosen to collide. Only equal seeds give comparable hashes.
    """

    PRIMES = (2**31 - 1, 2**31 - 19)
    LONG = 96

    def __init__(self, seed: int):
        drawn = np.random.default_rng(seed)
        self.key = seed.to_bytes(16, "little")
        self.salt = U64(drawn.integers(1 << 63, dtype=U64))
        self.points = [U64(drawn.integers(1 << 16, p - 1)) for p in self.PRIMES]
        self.begins = [U64(drawn.integers(1, p)) for p in self.PRIMES]

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each ``data[start:end]``."""
        sizes = ends - starts
        out = mix(leading(data, starts, sizes) ^ self.salt)
        rows = np.flatnonzero((sizes > 8) & (sizes <= self.LONG))
        rows = rows[np.argsort(-sizes[rows], kind="stable")]  # longest first, so that those with a further limb lead
        if len(rows):
            at, size = starts[rows], sizes[rows]
            found = [np.full(len(rows), b, dtype=U64) for b in self.begins]
            more = np.searchsorted(-size, -np.arange(0, self.LONG, 8), side="left")  # how many are longer than 0, 8, 16, ...
            for k, n in enumerate(more.tolist()):
                if not n:
                    break
                word = eights(data, at[:n] + 8 * k) & _MASKS[np.minimum(size[:n] - 8 * k, 8)]
                for limb in (word & U64(0xFFFFFFFF), word >> U64(32)):
                    for h, p, point in zip(found, self.PRIMES, self.points, strict=True):
                        h[:n] = (h[:n] * point + limb) % U64(p)
            out[rows] = mix(found[0] << U64(32) | found[1])
        for i in np.flatnonzero(sizes > self.LONG).tolist():
            digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, key=self.key).digest()
            out[i] = U64(int.from_bytes(digest, "little"))
        return mix(out + sizes.astype(U64) * GOLDEN)


_hashes: dict[int, RangeHash] = {}
_own: list[RangeHash] = []


def new_seed() -> int:
    """A seed for the hashes of one run, which the driver draws and tasks get with their work."""
    return secrets.randbits(63)


def range_hash(seed: int | None = None) -> RangeHash:
    """The hash of ``seed``, or one of this process alone, which nothing else can be compared with."""
    if seed is None:
        if not _own:
            _own.append(RangeHash(secrets.randbits(128)))
        return _own[0]
    if seed not in _hashes:
        if len(_hashes) > 2:
            _hashes.clear()
        _hashes[seed] = RangeHash(seed)
    return _hashes[seed]


def unused(name: str, columns: Iterable[str]) -> str:
    """``name``, with underscores before it until no column has it, whatever its case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class Texts:
    """Some whole texts as UTF-8 bytes ``data`` with ``offsets`` (one more than texts)."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column, "") if column.null_count else column
        column = column.cast(pa.large_string())
        _, offsets, data = column.buffers()
        marks = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        self.data = raw[marks[0] : marks[-1]]
        self.offsets = marks - marks[0]

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of ``flags`` (one for each byte) in every text."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return np.diff(total[self.offsets])

    def words(self) -> Words:
        return Words(self)


class Words:
    """Words (runs without the white space 0x20 and 0x09 to 0x0D) of ``texts``: byte ``starts`` and ``ends``.

    ``first`` has the index of every text's first word, and one more entry.
    """

    def __init__(self, texts: Texts):
        self.texts = texts
        self.word = ~_SPACE[texts.data]
        n = len(texts.data)
        begins = np.zeros(n + 1, dtype=bool)
        begins[texts.offsets] = True
        before = np.ones(n, dtype=bool)
        before[1:] = ~self.word[:-1]
        after = np.ones(n, dtype=bool)
        after[:-1] = ~self.word[1:]
        self.starts = np.flatnonzero(self.word & (before | begins[:n]))
        self.ends = np.flatnonzero(self.word & (after | begins[1:])) + 1
        self.first = np.searchsorted(self.starts, texts.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.texts)), self.counts())

    def hashes(self, lower: bool = False, seed: int | None = None) -> np.ndarray:
        """Hash of every word by ``range_hash(seed)``, A to Z as a to z if ``lower``."""
        return range_hash(seed)(_LOWER[self.texts.data] if lower else self.texts.data, self.starts, self.ends)


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words inside one text, and the index of its first word."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    value = np.zeros(n - size + 1, dtype=U64)
    for k in range(size):
        value = mix(value + hashes[k : n - size + 1 + k] * GOLDEN + U64(k + 1))
    inside = np.ones(n - size + 1, dtype=bool)
    cuts = first[1:-1]
    for k in range(1, size):
        at = cuts - k
        inside[at[(at >= 0) & (at < len(inside))]] = False
    at = np.flatnonzero(inside)
    return value[at], at


def parts(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Consecutive slices of ``batch`` with at most ``limit`` bytes of text each, or a single longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        part = batch.slice(at, to - at)
        yield part, Texts(part.column(column))
        at = to


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[start:start+length]`` of every row, one after the other."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    ends = np.cumsum(lengths)
    step = np.repeat(starts - (ends - lengths), lengths)
    return values[step + np.arange(total)]


def group_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[i]:first[i+1]]``, in order and per group, so other rows of the batch do not matter."""
    out = np.zeros(len(first) - 1, dtype=values.dtype)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.add.reduceat(values, first[full])
    return out
