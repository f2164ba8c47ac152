"""Texts cut into the pieces of a byte-level tokenizer's pattern, each distinct piece encoded once.

The merges of such a tokenizer never cross a piece, so the ids of a text are those of its pieces. Pieces are found with
whole-array operations over code points; a worker keeps the ids of the pieces it has met. Added tokens of a tokenizer
(``<|endoftext|>``) are cut out of a text first, as the library does, and are pieces of their own.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Sequence

import numpy as np

from docfields.llm.arrays import U64, Texts, gather, leading, range_hash

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: Unicode's White_Space, and the endings that the pattern keeps apart.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Letters and numbers that Unicode 16 added, first and last. Both tokenizer libraries know them, Python from
#: some release on only.
LATER_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0))
LATER_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA))

#: Distinct pieces that a worker remembers; beyond, it starts anew.
REMEMBERED = 600_000
#: The same for the tokenizers library, which keeps less beside it, and the bytes of text that are best cut at once for it.
LIBRARY_REMEMBERED, LIBRARY_BATCH = 1_000_000, 1 << 21

#: Bytes of one text that are cut to pieces at once, and the white space that a longer one is parted at.
LONGEST, WHITE_BYTES = 1 << 22, [0x20, *range(0x09, 0x0E)]

_tables: list[np.ndarray] = []


def classes() -> np.ndarray:
    """The class of every code point; made once per worker."""
    if not _tables:
        names = [unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)]
        table = np.full(len(names), OTHER, dtype=np.uint8)
        table[[i for i, x in enumerate(names) if x == "L"]] = LETTER
        table[[i for i, x in enumerate(names) if x == "N"]] = NUMBER
        table[list(WHITE_SPACE)] = SPACE
        for kind, ranges in ((LETTER, LATER_LETTERS), (NUMBER, LATER_NUMBERS)):
            for low, high in ranges:
                table[low : high + 1] = kind
        _tables.append(table)
    return _tables[0]


def piece_starts(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the pieces of ``points`` begin; ``begins`` marks the first code point of every text."""
    n = len(points)
    if not n:
        return np.zeros(0, dtype=np.int64)
    kind = classes()[points]
    space = kind == SPACE
    last = np.ones(n, dtype=bool)  # last of its text
    last[:-1] = begins[1:n]
    same = np.zeros(n, dtype=bool)
    same[1:] = kind[1:] == kind[:-1]
    start = ~same | begins[:n]
    # The last white space before anything else is split off its run; a plain space joins what follows.
    parting = np.zeros(n, dtype=bool)
    parting[:-1] = space[:-1] & ~space[1:] & ~last[:-1]
    start |= parting
    joins = parting & (points == 0x20)
    start[1:] &= ~joins[:-1]
    # A quote that begins a piece may begin one of the endings, whatever follows it.
    for at in np.flatnonzero(start & (points == 0x27)):
        tail = "".join(map(chr, points[at + 1 : at + 3]))
        for ending in ENDINGS:
            stop = at + 1 + len(ending)
            if tail.startswith(ending) and not begins[at + 1 : stop].any():
                start[at + 1 : stop] = False
                if stop < n and not begins[stop]:
                    # After the ending comes a piece of its own, unless a space has already begun one.
                    start[stop] = True
                break
    return np.flatnonzero(start)


class PieceEncoder:
    """``ids(texts)`` through ``encode``, which gives the ids of each piece of a list.

    Pieces are found by a hash of this worker alone, and every find is compared byte by byte; a piece that only shares its
    hash with another is encoded on its own. ``added`` are strings that are pieces wherever they stand; of several at one
    place the longest counts. ``flat`` may give all ids of many pieces in a row and how many each has.
    """

    def __init__(self, encode: Callable[[list[str]], Sequence[Sequence[int]]], dtype=np.uint32, remembered: int = REMEMBERED,
                 added: Sequence[str] = (), flat: Callable[[list[str]], tuple[np.ndarray, np.ndarray]] | None = None):
        self.encode, self.dtype, self.remembered = encode, dtype, remembered
        self.flat = flat or (lambda pieces: flattened(encode(pieces), dtype))
        self.added = sorted(filter(None, added), key=len, reverse=True)
        self.pattern = re.compile("|".join(map(re.escape, self.added)))
        self.spaced = any(c.isspace() for a in self.added for c in a)
        self.clear()

    def clear(self) -> None:
        self.hashes, self.slots = np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
        self.store, self.used = np.zeros(1 << 16, dtype=self.dtype), 0
        self.start, self.length = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.bytes, self.filled = np.zeros(1 << 16, dtype=np.uint8), 0  # of the pieces themselves
        self.byte_start, self.byte_length = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.hashes, hashes)
        return at, at < len(self.hashes) if not len(self.hashes) else (
            self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        """Ids and bytes of new pieces; ``hashes`` are in order."""
        starts, lengths = [], []
        raw = [p.encode() for p in pieces]
        sizes, flat = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)), np.frombuffer(b"".join(raw), dtype=np.uint8)
        while self.filled + len(flat) > len(self.bytes):
            self.bytes = np.concatenate([self.bytes, np.zeros_like(self.bytes)])
        self.bytes[self.filled : self.filled + len(flat)] = flat
        self.byte_start = np.concatenate([self.byte_start, self.filled + np.cumsum(sizes) - sizes])
        self.byte_length = np.concatenate([self.byte_length, sizes])
        self.filled += len(flat)
        for at in range(0, len(pieces), 20_000):
            ids, size = self.flat(pieces[at : at + 20_000])
            new = len(ids)
            while self.used + new > len(self.store):
                self.store = np.concatenate([self.store, np.zeros_like(self.store)])
            self.store[self.used : self.used + new] = ids
            starts.append(self.used + np.cumsum(size) - size)
            lengths.append(size)
            self.used += new
        slots = len(self.start) + np.arange(len(pieces))
        self.start, self.length = np.concatenate([self.start, *starts]), np.concatenate([self.length, *lengths])
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.slots = np.insert(self.hashes, at, hashes), np.insert(self.slots, at, slots)

    def _spans(self, string: str, offsets: np.ndarray) -> np.ndarray:
        """Begin and end of every added token; none runs over the end of a text."""
        if not any(a in string for a in self.added):
            return np.zeros((0, 2), dtype=np.int64)
        marks = offsets.tolist()
        found = [m.span() for a, b in zip(marks[:-1], marks[1:], strict=True) for m in self.pattern.finditer(string, a, b)]
        return np.array(found, dtype=np.int64).reshape(-1, 2)

    def ids(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts``, and how many each text has. A very long text is taken in parts, cut where white space begins."""
        if len(texts) != 1 or len(texts.data) <= LONGEST or self.spaced:
            return self._ids(texts.data, texts.offsets)
        found, at = [], 0
        while at < len(texts.data):
            to = next_break(texts.data, at + LONGEST)
            found.append(self._ids(texts.data[at:to], np.array([0, to - at]))[0])
            at = to
        ids = np.concatenate(found)
        return ids, np.array([len(ids)])

    def _ids(self, data: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        string = data.tobytes().decode("utf-8")
        points = np.frombuffer(string.encode("utf-32-le"), dtype=np.uint32)
        leading = np.flatnonzero((data & 0xC0) != 0x80)
        offsets = np.searchsorted(leading, marks)
        begins = np.zeros(len(points) + 1, dtype=bool)
        begins[offsets] = True
        spans = self._spans(string, offsets)
        begins[spans] = True
        starts = piece_starts(points, begins)
        if len(spans):
            own = np.searchsorted(spans[:, 0], starts) - 1  # the last span that begins before
            starts = starts[(own < 0) | (starts >= spans[own, 1])]
        ends = np.append(starts[1:], len(points))
        low = leading[starts] if len(starts) else starts
        sizes = np.diff(np.append(low, len(data)))
        hashes, first, which = np.unique(range_hash()(data, low, low + sizes), return_index=True, return_inverse=True)
        odd = ~equal_ranges(data, low, data, low[first][which], sizes, sizes[first][which])
        at, known = self._find(hashes)
        if not known.all():
            if len(self.hashes) and len(self.hashes) + np.count_nonzero(~known) > self.remembered:
                self.clear()
                known[:] = False
            new = first[~known]
            self._learn(hashes[~known], [string[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            at, known = self._find(hashes)
        slots = self.slots[at] if len(at) else at
        odd |= ~equal_ranges(data, low[first], self.bytes, self.byte_start[slots], sizes[first], self.byte_length[slots])[which]
        slots = slots[which]
        lengths = self.length[slots]
        store, source = self.store, self.start[slots]
        if odd.any():  # a piece that is not the one that has its hash
            alone = np.flatnonzero(odd)
            lists = self.encode([string[a:b] for a, b in zip(starts[alone].tolist(), ends[alone].tolist(), strict=True)])
            lengths[alone] = [len(x) for x in lists]
            source[alone] = self.used + np.cumsum(lengths[alone]) - lengths[alone]
            store = np.concatenate([store[: self.used], np.array([i for x in lists for i in x], dtype=self.dtype)])
        counts = np.zeros(len(marks) - 1, dtype=np.int64)
        if len(starts):
            total = np.concatenate([[0], np.cumsum(lengths)])
            counts = np.diff(total[np.searchsorted(starts, offsets)])
        return gather(store, source, lengths), counts


def flattened(lists: Sequence[Sequence[int]], dtype) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids as one array and their lengths."""
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter((i for ids in lists for i in ids), dtype=dtype, count=int(sizes.sum())), sizes


def by_lines(encode: Callable[[list[str]], Sequence[Sequence[int]]], dtype, added: Sequence[str]) -> Callable | None:
    """``flat`` of a :class:`PieceEncoder` that encodes many pieces as the lines of one text, which takes one call instead of
    one each; None where a line break does not have one id of its own.

    A piece is white space or has none but a space before it. One of the second kind is a piece on a line of its own too:
    none runs over a break, and only white space hangs on what follows it. The first kind and added tokens are encoded
    alone, and so are all pieces should the ids not have a break for each line.
    """
    ends = encode(["\n"])[0]
    if len(ends) != 1 or any(c.isspace() for a in added for c in a):
        return None
    whole = frozenset(added)

    def flat(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        fit = [not p.isspace() and p not in whole for p in pieces]
        lines = pieces if all(fit) else [p for p, f in zip(pieces, fit, strict=True) if f]
        ids = np.array(encode(["\n".join(lines)])[0], dtype=dtype) if lines else np.zeros(0, dtype=dtype)
        breaks = np.flatnonzero(ids == ends[0])
        if not lines or len(breaks) != len(lines) - 1:
            return flattened(encode(pieces), dtype)
        sizes = np.diff(np.concatenate([[-1], breaks, [len(ids)]])) - 1
        ids = np.delete(ids, breaks)
        if len(lines) == len(pieces):
            return ids, sizes
        rest = np.flatnonzero(~np.array(fit))
        rest_ids, rest_sizes = flattened(encode([pieces[i] for i in rest.tolist()]), dtype)
        starts, lengths = np.zeros(len(pieces), dtype=np.int64), np.zeros(len(pieces), dtype=np.int64)
        for at, size, base in ((np.flatnonzero(fit), sizes, 0), (rest, rest_sizes, len(ids))):
            starts[at], lengths[at] = base + np.cumsum(size) - size, size
        return gather(np.concatenate([ids, rest_ids]), starts, lengths), lengths

    return flat


def equal_ranges(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether ``a[at:at + size_a]`` and ``b[bt:bt + size_b]`` have the same bytes, row by row."""
    same = (size_a == size_b) & (leading(a, at, size_a) == leading(b, bt, size_b))
    rows = np.flatnonzero(same & (size_a > 8))
    if len(rows):
        rows = rows[leading(a, at[rows], size_a[rows], 8) != leading(b, bt[rows], size_b[rows], 8)]
        same[rows] = False
        rows = np.flatnonzero(same & (size_a > 16) & ((at != bt) | (a is not b)))
    for some in np.array_split(rows, max(1, int(size_a[rows].sum()) >> 20)):
        size = size_a[some]
        bad = gather(a, at[some], size) != gather(b, bt[some], size)
        if bad.any():
            same[some[np.repeat(np.arange(len(some)), size)[bad]]] = False
    return same


def next_break(data: np.ndarray, at: int) -> int:
    """Where white space next begins at ``at`` or later (else the end): no piece runs over such a place."""
    step = 1 << 16
    for low in range(max(at, 1), len(data), step):
        space = np.isin(data[low - 1 : low + step], WHITE_BYTES)
        for found in (low + np.flatnonzero(space[1:] & ~space[:-1])).tolist():
            if not data[max(0, found - 4) : found].tobytes().decode("utf-8", "ignore")[-1:].isspace():
                return found
    return len(data)


_encoders: dict[str, PieceEncoder] = {}  # by vocabulary and kind


def library_encoder(path: str, special: bool = False, remembered: int = LIBRARY_REMEMBERED) -> PieceEncoder:
    """Pieces through the tokenizers library; one per worker and vocabulary, with ``remembered`` pieces at most.

    With ``special`` the vocabulary's special tokens have their ids in a text, as the library has it by default; without,
    they are plain text there.
    """
    name = f"{path}:{special}"
    if name not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = not special
        added = [t for t in tokenizer.get_added_tokens_decoder().values() if special or not t.special]
        if any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError(f"{path} has added tokens that depend on what stands beside them")
        small = tokenizer.get_vocab_size() <= 1 << 16

        def encode(pieces: list[str]) -> list[list[int]]:
            return [e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

        kind, whole = np.uint16 if small else np.uint32, [t.content for t in added]
        lines = by_lines(encode, kind, whole) if tokenizer.normalizer is None else None
        _encoders[name] = PieceEncoder(encode, kind, added=whole, flat=lines)
    _encoders[name].remembered = remembered
    return _encoders[name]
