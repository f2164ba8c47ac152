"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece's bytes exactly one token can come last in the prefix's encoding. ``last[i]`` stores it;
following it backwards from the end gives the encoding. Appending bytes only adds entries, and an edit leaves the
entries before it as they are.
"""

from __future__ import annotations

import base64

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docfields.llm.arrays import parts
from docfields.llm.pieces import PieceEncoder

NEVER = 1 << 62


class Merges:
    """The ranks of a byte-level vocabulary, and which pairs of tokens can stand side by side in an encoding."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.sizes = [len(b) for b in self.bytes]
        self.longest = max(map(len, ranks))
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.pair: dict[tuple[int, int], int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            halves = self._merged(token, rank)
            self.parts[rank] = halves
            if halves:
                self.pair[halves] = rank
        self.finder = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if len(token) == 1 or self.parts[rank]:
                self.finder.add_word(token.decode("latin-1"), (rank, len(token)))
        self.finder.make_automaton()
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.beside: dict[int, bool] = {}

    def _merged(self, token: bytes, limit: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a byte, or where merging does not lead to it."""
        if len(token) == 1:
            return None
        now = [self.ranks[token[i : i + 1]] for i in range(len(token))]
        while len(now) > 2:
            best, at = min((self.ranks.get(self.bytes[a] + self.bytes[b], NEVER), i) for i, (a, b) in enumerate(zip(now, now[1:])))
            if best >= limit:
                return None
            now[at : at + 2] = [best]
        return now[0], now[1]

    def _edge(self, token: int, side: int, cache: dict) -> list[tuple[int, int]]:
        """Tokens that lie at one end of ``token`` while it is merged, from the byte on, each with the rank that ends it."""
        if token not in cache:
            chain, ends = [token], [NEVER]
            while self.parts[chain[-1]]:
                ends.append(chain[-1])
                chain.append(self.parts[chain[-1]][side])
            cache[token] = list(zip(chain, ends, strict=True))[::-1]
        return cache[token]

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether encoding the bytes of ``a`` and ``b`` together gives just these two tokens.

        At every time one token lies on each side of the border. They merge if their pair's rank comes before either is
        merged away; at equal ranks the pair further left merges first.
        """
        key = a << 32 | b
        known = self.beside.get(key)
        if known is None:
            known = self.beside[key] = self._apart(self._edge(a, 1, self.right), self._edge(b, 0, self.left))
        return known

    def _apart(self, left: list[tuple[int, int]], right: list[tuple[int, int]]) -> bool:
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            rank = self.pair.get((x, y))
            if rank is not None and rank < x_ends and rank <= y_ends:
                return False
            if x_ends == y_ends == NEVER:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1


class PrefixTable:
    """``last[i]``: the last token of the encoding of the first ``i`` bytes of ``piece``."""

    def __init__(self, merges: Merges, piece: bytes = b""):
        self.merges, self.piece, self.last = merges, b"", [-1]
        self.append(piece)

    def append(self, more: bytes) -> PrefixTable:
        """Bytes put behind; earlier entries stay."""
        merges, last, old = self.merges, self.last, len(self.piece)
        beside, stay_apart = merges.beside, merges.stay_apart
        self.piece += more
        from_byte = max(0, old - merges.longest + 1)
        done = old
        # All tokens that end at a byte, byte after byte; one of them is accepted at each.
        for at, (token, size) in merges.finder.iter(self.piece[from_byte:].decode("latin-1")):
            end = from_byte + at + 1
            if end <= done:
                continue
            start = end - size
            if start:
                before = last[start]
                fits = beside.get(before << 32 | token)
                if not (stay_apart(before, token) if fits is None else fits):
                    continue
            last.append(token)
            done = end
        return self

    def edit(self, start: int, end: int, by: bytes) -> PrefixTable:
        """Bytes ``start`` to ``end`` replaced; entries up to ``start`` are kept, and so are those behind the edit from where
        as many in a row as the longest token has bytes come out as before: a later entry depends on no others."""
        old, whole, longest = self.last, self.piece, self.merges.longest
        shift = start + len(by) - end  # from places in the old piece to places in the new one
        self.piece, self.last = whole[:start], old[: start + 1]
        self.append(by)
        at, step = end, 2 * longest
        while at < len(whole):
            to = min(len(whole), at + step)
            self.append(whole[at:to])
            if to - end >= longest and self.last[to + shift - longest + 1 :] == old[to - longest + 1 : to + 1]:
                self.piece += whole[to:]
                self.last += old[to + 1 :]
                break
            at, step = to, 2 * step
        return self

    def ids(self) -> list[int]:
        whole = self.merges.ranks.get(self.piece)
        if whole is not None:
            return [whole]
        out, at, last, sizes = [], len(self.piece), self.last, self.merges.sizes
        while at:
            token = last[at]
            out.append(token)
            at -= sizes[token]
        return out[::-1]


_loaded: dict[str, tuple[Merges, PieceEncoder]] = {}
#: Pairs of tokens whose answer a worker remembers.
REMEMBERED_PAIRS = 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def load(path: str) -> tuple[Merges, PieceEncoder]:
    """Merges and piece encoder of a file of ranks; once per worker."""
    if path not in _loaded:
        merges = Merges(read_ranks(path))

        def encode(pieces: list[str]) -> list[list[int]]:
            if len(merges.beside) > REMEMBERED_PAIRS:
                merges.beside.clear()
            whole = merges.ranks.get
            out = []
            for piece in pieces:
                raw = piece.encode("utf-8")
                one = whole(raw)
                out.append([one] if one is not None else PrefixTable(merges, raw).ids())
            return out

        _loaded[path] = merges, PieceEncoder(encode)
    return _loaded[path]


#: Rows that a decoding task holds decoded at a time.
DECODED_ROWS = 500
_bytes: dict[str, list[bytes]] = {}


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every token; all that decoding needs."""
    if path not in _bytes:
        ranks = read_ranks(path)
        _bytes[path] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            _bytes[path][rank] = token
    return _bytes[path]


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the token ids of ``text`` as ``array<int>`` in column ``ids``, replaced if it exists.

    ``keep`` lists the columns to keep (all by default). ``vocabulary`` is a file of ranks that every worker can open.
    A null or empty text has no ids; repeated rows stay; an empty table gives an empty table.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c != ids]
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches):
        encoder = load(vocabulary)[1]
        for batch in batches:
            for part, texts in parts(batch, text):
                flat, counts = encoder.ids(texts)
                marks = np.concatenate([[0], np.cumsum(counts)])
                column = pa.ListArray.from_arrays(pa.array(marks, pa.int32()), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], column], names=[*names, ids])

    return docs.select(*dict.fromkeys([*names, text])).mapInArrow(run, schema)


def decode(tokens: DataFrame, vocabulary: str, ids: str = "ids", data: str = "bytes") -> DataFrame:
    """``tokens`` with the bytes of ``ids`` in column ``data``, replaced if it exists; null ids give no bytes."""
    names = [c for c in tokens.columns if c != data]
    schema = T.StructType([tokens.schema[c] for c in names] + [T.StructField(data, T.BinaryType())])

    def run(batches):
        pieces = token_bytes(vocabulary)
        for part in (batch.slice(at, DECODED_ROWS) for batch in batches for at in range(0, batch.num_rows, DECODED_ROWS)):
            column = part.column(ids)
            values, marks = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            valid = column.is_valid().to_numpy(zero_copy_only=False)
            out = [b"".join(map(pieces.__getitem__, values[a:b].tolist())) if ok else b""
                   for a, b, ok in zip(marks[:-1], marks[1:], valid, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in names], pa.array(out, pa.binary())], names=[*names, data])

    return tokens.select(*names).mapInArrow(run, schema)
