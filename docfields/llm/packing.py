"""Vector bin packing of token sequences under limits on tokens, segments and loss-bearing tokens.

Every task packs its own rows, a window of them at a time: nothing is shuffled, and a window leaves at most one
sequence that is not full. A document longer than a sequence is cut; its whole sequences stand alone and its rest is
packed. The open sequence takes the item whose vector has the largest dot product with what room it has left; when
nothing fits, the largest item is cut to fill it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfields.llm.arrays import parts
from docfields.llm.pieces import LIBRARY_BATCH, LIBRARY_REMEMBERED, library_encoder

#: Documents whose rests are packed together.
WINDOW = 50_000

Derived = dict[str, tuple[str, Callable[[np.ndarray], object]]]


class Items:
    """Pieces that wait, by (tokens, loss tokens); pieces of one kind are taken last in, first out."""

    def __init__(self) -> None:
        self.kind: dict[tuple[int, int], int] = {}
        self.waiting: list[list[tuple]] = []
        self.vectors = np.zeros((64, 3))
        self.filled = np.zeros(64, dtype=bool)

    def put(self, tokens: int, loss: int, piece: tuple) -> None:
        k = self.kind.get((tokens, loss))
        if k is None:
            k = self.kind[tokens, loss] = len(self.waiting)
            self.waiting.append([])
            if k == len(self.filled):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
                self.filled = np.concatenate([self.filled, np.zeros_like(self.filled)])
            self.vectors[k] = tokens, 1, loss
        self.waiting[k].append(piece)
        self.filled[k] = True

    def take(self, k: int) -> tuple:
        piece = self.waiting[k].pop()
        self.filled[k] = bool(self.waiting[k])
        return piece

    def best(self, room: np.ndarray, limit: np.ndarray) -> int | None:
        fits = self.filled & (self.vectors <= room).all(axis=1)
        if not fits.any():
            return None
        return int(np.argmax(np.where(fits, self.vectors @ (room / limit**2), -1.0)))

    def largest(self) -> int | None:
        return int(np.argmax(np.where(self.filled, self.vectors[:, 0], -1.0))) if self.filled.any() else None


def pack_items(pieces: list[tuple], limit: tuple[int, int, int]) -> list[list[tuple]]:
    """Sequences of pieces ``(row, start, end, loss_from)``; a piece may be cut, no id is lost or repeated.

    ``limit``: tokens, segments and loss-bearing tokens of a sequence. A piece's ids from place ``loss_from`` of its
    document on bear loss.
    """
    most = np.array(limit, dtype=float)
    items, out = Items(), []
    loss = lambda p: max(0, p[2] - max(p[1], p[3]))
    for p in pieces:
        items.put(p[2] - p[1], loss(p), p)
    room, now = most.copy(), []
    while items.filled.any():
        k = items.best(room, most)
        if k is not None:
            p = items.take(k)
        else:
            p = None
            if room[0] >= 1 and room[1] >= 1:
                k = items.largest()
                row, start, end, loss_from = items.waiting[k][-1]
                cut = min(end - 1, start + int(room[0]), max(start, loss_from) + int(room[2]))
                if cut > start:
                    items.take(k)
                    p, rest = (row, start, cut, loss_from), (row, cut, end, loss_from)
                    items.put(end - cut, loss(rest), rest)
            if p is None:
                out.append(now)
                room, now = most.copy(), []
                continue
        now.append(p)
        room -= (p[2] - p[1], 1, loss(p))
        if not room[0] or not room[1]:
            out.append(now)
            room, now = most.copy(), []
    return [*out, now] if now else out


def pack(docs: DataFrame, vocabulary: str, length: int = 1024, max_segments: int = 1024, max_loss: int | None = None,
         end_id: int = 0, key: str = "doc_id", text: str = "text", loss_from: str | None = None,
         derive: Derived | None = None, special: bool = False, batch_bytes: int = LIBRARY_BATCH,
         remembered: int = LIBRARY_REMEMBERED) -> DataFrame:
    """One row for each piece: ``key, start, length, doc_tokens, sequence_id, offset`` and ``ids``, or what ``derive``
    makes of the ids (column to Spark type and function of unsigned 32-bit ids).

    A document's ids are those of ``text`` and then ``end_id``; null text counts as empty, so every row has an id. Rows
    are packed as they are, with repeated and null keys. ``loss_from`` names a column with the number of leading ids
    that bear no loss (a prompt; null: none); ``max_loss`` is ``length`` by default. ``special``: see ``library_encoder``.
    ``batch_bytes`` of text are encoded at once and ``remembered`` distinct pieces kept by a worker: smaller ones take less
    memory and more time, for the same rows. Other columns are not read. An empty table gives no rows. Sequence ids are
    unique, not consecutive.
    """
    derive = derive or {"ids": ("array<long>", lambda ids: ids.tolist())}
    limit = (length, max_segments, max_loss or length)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(
        F.col(key).alias("_key"), F.col(text).alias("_text"),
        F.coalesce(F.col(loss_from).cast("long") if loss_from else F.lit(0), F.lit(0)).cast("long").alias("_from"))
    schema = ", ".join([f"{key} {kind}", "start long, length long, doc_tokens long, sequence_id long, offset long",
                        *[f"{k} {kind}" for k, (kind, _) in derive.items()]])

    def run(batches):
        from pyspark import TaskContext

        encoder = library_encoder(vocabulary, special, remembered)
        sequence = TaskContext.get().partitionId() << 32

        def rows_of(sequences, keys, ids, base, totals):
            nonlocal sequence
            found = []
            for pieces in sequences:
                at = 0
                for row, start, end, _ in pieces:
                    found.append((row, start, end, sequence, at))
                    at += end - start
                sequence += 1
            index = [f[0] for f in found]
            columns = {key: keys.take(pa.array(index, pa.int64()))}
            for name, values in (("start", [f[1] for f in found]), ("length", [f[2] - f[1] for f in found]),
                                 ("doc_tokens", [totals[r] for r in index]), ("sequence_id", [f[3] for f in found]),
                                 ("offset", [f[4] for f in found])):
                columns[name] = pa.array(values, pa.int64())
            for name, (_, f) in derive.items():
                columns[name] = pa.array([f(ids[r][a - base[r] : b - base[r]].astype("<u4")) for r, a, b, _, _ in found])
            return pa.RecordBatch.from_pydict(columns)

        keys, rests, kept, bases, totals = [], [], [], [], []  # of the window's rests
        for batch in batches:
            for part, texts in parts(batch, "_text", batch_bytes):
                flat, counts = encoder.ids(texts)
                flat = np.insert(flat, np.cumsum(counts), end_id)
                marks = np.concatenate([[0], np.cumsum(counts + 1)]).tolist()
                column, whole, ids = part.column("_key"), [], []
                for i, loss in enumerate(part.column("_from").to_pylist()):
                    ids.append(flat[marks[i] : marks[i + 1]])
                    start, end = 0, len(ids[i])
                    while start < end:
                        cut = min(end, start + length, max(start, loss) + limit[2])
                        if cut - start == length:
                            whole.append([(i, start, cut, loss)])
                        else:
                            rests.append((len(kept), start, cut, loss))
                            keys.append(column.slice(i, 1))
                            kept.append(ids[i][start:cut].copy())
                            bases.append(start)
                            totals.append(end)
                        start = cut
                if whole:
                    yield rows_of(whole, column, ids, [0] * len(ids), [len(x) for x in ids])
                if len(rests) >= WINDOW:
                    yield rows_of(pack_items(rests, limit), pa.concat_arrays(keys), kept, bases, totals)
                    keys, rests, kept, bases, totals = [], [], [], [], []
        if rests:
            yield rows_of(pack_items(rests, limit), pa.concat_arrays(keys), kept, bases, totals)

    return rows.mapInArrow(run, schema)
