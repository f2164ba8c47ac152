"""Packing by bounded-space online best-fit: each piece goes at once to the open bin that it leaves with the least room.

Pieces come in the order of the table. A task keeps a fixed number of open bins; a bitset keyed by free space gives the
smallest room that a piece fits by one shift. When a piece fits nowhere and all bins are taken, the fullest is closed.
Nothing waits, so a task holds the bins' numbers only, never their tokens, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfields.llm.arrays import parts
from docfields.llm.pieces import LIBRARY_BATCH, library_encoder

#: Open bins of a task.
OPEN_BINS = 8_192

Derived = dict[str, tuple[str, Callable[[np.ndarray], object]]]


class OpenBins:
    """Bins of ``size`` with at most ``most`` of them open; ``room`` has a bit for each free space that an open bin has."""

    def __init__(self, size: int, most: int = OPEN_BINS):
        if size < 1 or most < 1:
            raise ValueError("a bin needs room, and one bin must be open")
        self.size, self.most = size, most
        self.room, self.bins = 0, [[] for _ in range(size + 1)]
        self.opened, self.made = 0, 0

    def _take(self, free: int) -> int:
        stack = self.bins[free]
        found = stack.pop()
        if not stack:
            self.room ^= 1 << free
        self.opened -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """Bin and place in it for the next piece."""
        fits = self.room >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            found = self._take(free)
        else:
            free, found = self.size, self.made
            self.made += 1
        left = free - length
        if left:
            if self.opened == self.most:  # the fullest closes
                self._take((self.room & -self.room).bit_length() - 1)
            if not self.bins[left]:
                self.room |= 1 << left
            self.bins[left].append(found)
            self.opened += 1
        return found, self.size - free


def cut(totals: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, number, start and length of every piece of rows of ``totals`` ids: the first piece is what is over."""
    number = -(-totals // length)
    row = np.repeat(np.arange(len(totals)), number)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
    first = totals - (number - 1) * length
    start = np.where(piece > 0, first[row] + (piece - 1) * length, 0)
    return row, piece, start, np.where(piece > 0, length, first[row])


def pack(docs: DataFrame, vocabulary: str, length: int = 2048, open_bins: int = OPEN_BINS, end_id: int = 0,
         key: str = "doc_id", text: str = "text", derive: Derived | None = None, special: bool = False) -> DataFrame:
    """One row for each piece: ``key, piece, start, length, sequence_id, offset`` and ``ids``, or what ``derive`` makes
    of the ids (column to Spark type and function of unsigned 32-bit ids).

    A document's ids are those of ``text`` and then ``end_id``; null text counts as empty, so every row has an id. A
    document of at most ``length`` ids is one piece; a longer one is cut to pieces of ``length``, of which the first has
    what is over. A very long text is encoded in parts and its pieces placed one by one. Rows are packed as they are,
    with repeated and null keys, in the table's order. Other columns are not read. An empty table gives no rows.
    Sequence ids are unique, not consecutive. ``special``: see ``library_encoder``.
    """
    derive = derive or {"ids": ("array<long>", lambda ids: ids.tolist())}
    kind = docs.schema[key].dataType.simpleString()
    schema = ", ".join([f"`{key}` {kind}", "piece int, start long, length long, sequence_id long, offset long",
                        *[f"{k} {kind}" for k, (kind, _) in derive.items()]])

    def run(batches):
        from pyspark import TaskContext

        encoder = library_encoder(vocabulary, special)
        bins, base = OpenBins(length, open_bins), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part, texts in parts(batch, "_text", LIBRARY_BATCH):
                flat, counts = encoder.ids(texts)
                ids = np.insert(flat, np.cumsum(counts), end_id).astype("<u4", copy=False)
                totals = counts + 1
                row, piece, start, size = cut(totals, length)
                at = (np.cumsum(totals) - totals)[row] + start
                placed = np.array([bins.place(n) for n in size.tolist()], dtype=np.int64).reshape(-1, 2)
                columns = [part.column("_key").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                           pa.array(size, pa.int64()), pa.array(base + placed[:, 0]), pa.array(placed[:, 1])]
                made = [pa.array([f(ids[a : a + n]) for a, n in zip(at.tolist(), size.tolist(), strict=True)]) for _, f in derive.values()]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *made], names=[key, "piece", "start", "length", "sequence_id", "offset", *derive])

    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(run, schema)
