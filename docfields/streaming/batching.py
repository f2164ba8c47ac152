"""Model batches that fill up over triggers (T2) and documents that come together over files (T1). Both need the RocksDB state store."""

from __future__ import annotations

import io
import re
import time
from collections.abc import Iterator
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.query import StreamingQuery

from docfields.operators.requests import BATCH_SIZE


def _plain(value: object) -> object:
    """A value of a frame as state takes it."""
    if isinstance(value, (list, np.ndarray)):
        return list(value)
    if value is None or pd.isna(value):
        return None
    return value.item() if isinstance(value, np.generic) else value


class Filling(StatefulProcessor):
    """The requests of one lane that do not fill a batch yet: fewer than ``size`` of them, and a timer.

    Every arrival moves the deadline to ``wait_ms`` from then, as a worker waits anew after each job it has got; what is
    still short then goes out short.
    """

    def __init__(self, columns: T.StructType, size: int, wait_ms: int):
        self.columns, self.size, self.wait_ms = columns, size, wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.made = handle.getValueState("made", "n long")
        self.held = handle.getListState("held", self.columns)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = self.columns.names
        made, = self.made.get() or (0,)
        held = pd.DataFrame(list(self.held.get()), columns=names) if self.held.exists() else pd.DataFrame(columns=names)
        for frame in rows:
            frame = frame[names]
            if len(held):
                frame = pd.concat([held.astype(frame.dtypes.to_dict(), errors="ignore"), frame], ignore_index=True)
            full = len(frame) // self.size * self.size
            if full:
                yield self._batches(key[0], made, frame.iloc[:full])
            made += full // self.size
            held = frame.iloc[full:]
        self.made.update((made,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(held):
            self.held.put([tuple(map(_plain, row)) for row in held.itertuples(index=False, name=None)])
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)
        elif self.held.exists():
            self.held.clear()

    def _batches(self, lane: int, made: int, frame: pd.DataFrame) -> pd.DataFrame:
        at = np.arange(len(frame))
        return frame.assign(batch=[f"{lane}-{made + i // self.size}" for i in at], slot=(at % self.size).astype("int32"))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        made, = self.made.get() or (0,)
        if self.held.exists():
            short = pd.DataFrame(list(self.held.get()), columns=self.columns.names)
            self.held.clear()
            self.made.update((made + 1,))
            yield self._batches(key[0], made, short)

    def close(self) -> None:
        pass


def fill_batches(requests: DataFrame, size: int = BATCH_SIZE, wait_ms: int = 5_000, lanes: int = 1) -> DataFrame:
    """Streamed requests with the ``batch`` and ``slot`` of their model call, in append mode.

    What does not fill a batch is carried over to the next trigger, until nothing has come for ``wait_ms``. Requests are
    dealt to ``lanes`` by a hash of their job, so that many tasks share the work; each lane holds fewer than ``size`` of
    them and sends at most one short batch when requests cease.
    """
    columns = requests.schema
    spread = requests.withColumn("_lane", F.pmod(F.xxhash64("job_id"), F.lit(lanes)))
    out = T.StructType([*columns.fields, T.StructField("batch", T.StringType()), T.StructField("slot", T.IntegerType())])
    return spread.groupBy("_lane").transformWithStateInPandas(
        statefulProcessor=Filling(columns, size, wait_ms), outputStructType=out, outputMode="Append", timeMode="ProcessingTime")


# A lane is kept in so many parts; a task opens one at a time.
LANE_PARTS = 32
PAGE_WORDS = 50_000


class Assembly(StatefulProcessor):
    """The words of the open documents of one part of a lane, as pages in the form they came in, and an index: for each document
    how many words there are, how many there should be, and when the last came.

    The pages are opened only when the index says that a document may be whole. A word that comes twice counts once.
    """

    INDEX = ["there", "expected", "at"]

    def __init__(self, columns: T.StructType, key: str, word: str, expected: str, wait_ms: int):
        self.columns, self.key, self.word, self.expected, self.wait_ms = columns, key, word, expected, wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.pages = handle.getListState("pages", "page binary")
        self.index = handle.getValueState("index", "page binary")

    def _opened(self) -> pd.DataFrame:
        held = self.index.get()
        return pd.DataFrame(columns=[self.key, *self.INDEX]).set_index(self.key) if held is None else _unpacked(bytes(held[0])).set_index(self.key)

    def _kept(self, index: pd.DataFrame) -> None:
        """Remember the index, and wake up when the oldest of its documents has waited long enough."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(index):
            self.index.update((_packed(index.reset_index()),))
            self.handle.registerTimer(int(index["at"].min()) + self.wait_ms)
        elif self.index.exists():
            self.index.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        index, now, come = self._opened(), timerValues.getCurrentProcessingTimeInMs(), []
        for frame in rows:
            frame = frame[self.columns.names]
            # In this order neighbours are much alike, so a page shrinks to a fraction.
            self.pages.appendValue((_packed(frame.sort_values([self.key, self.word])),))
            come.append(frame.groupby(self.key)[self.expected].agg(there="size", expected="max").assign(at=now))
        # Once for all frames: to look through the index for each of them would cost the square of their number.
        index = pd.concat([index, *come] if len(index) else come).groupby(level=0).agg({"there": "sum", "expected": "last", "at": "max"}).astype("int64")
        index.index.name = self.key
        may = index.index[index["there"] >= index["expected"]]
        if len(may):
            yield from self._let_go(index, may, True)
        else:
            self._kept(index)

    def _let_go(self, index: pd.DataFrame, names: pd.Index, whole: bool) -> Iterator[pd.DataFrame]:
        """The documents ``names``, if ``whole`` only those that have all their words; the other pages are written anew."""
        words = pa.concat_tables([_table(bytes(page)) for page, in self.pages.get()], promote_options="permissive")
        ids = words.select([self.key, self.word]).to_pandas()
        first = ~ids.duplicated()
        there = ids[first].groupby(self.key).size()
        index = index.assign(there=there.reindex(index.index).astype("int64"))
        if whole:
            names = names[index.loc[names, "there"] >= index.loc[names, "expected"]]
        out = ids[self.key].isin(names)
        for page in words.filter(pa.array(first & out)).to_batches(max_chunksize=PAGE_WORDS):
            yield page.to_pandas()[self.columns.names].assign(complete=whole)
        self.pages.clear()
        for page in words.filter(pa.array(first & ~out)).to_batches(max_chunksize=PAGE_WORDS):
            self.pages.appendValue((_packed(page.to_pandas()),))
        self._kept(index.drop(names))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        index = self._opened()
        due = index.index[index["at"] + self.wait_ms <= timerValues.getCurrentProcessingTimeInMs()] if len(index) else index.index
        if len(due):
            yield from self._let_go(index, due, False)
        else:
            self._kept(index)

    def close(self) -> None:
        pass


def _packed(frame: pd.DataFrame) -> bytes:
    """A frame as bytes, column by column, each compressed."""
    table = pa.Table.from_pandas(frame, preserve_index=False).replace_schema_metadata()
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return out.getvalue()


def _table(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _unpacked(data: bytes) -> pd.DataFrame:
    return _table(data).to_pandas()


def assemble_documents(
    words: DataFrame, expected: str = "n_words", key: str = "doc_id", word: str = "word_id", wait_ms: int = 60_000, lanes: int = 64,
) -> DataFrame:
    """Streamed words of documents that are whole, whatever files and triggers they were dealt over; append mode.

    Column ``expected`` of every word says how many words its document has. Words of a document of which nothing has come
    for ``wait_ms`` are let go with ``complete`` false; so are words that come after their document. Documents are dealt to
    ``lanes`` by a hash and in each to ``LANE_PARTS`` parts; a task holds the open documents of one part at a time.
    """
    columns = words.schema
    out = T.StructType([*columns.fields, T.StructField("complete", T.BooleanType())])
    return words.withColumn("_lane", F.pmod(F.xxhash64(key), F.lit(lanes * LANE_PARTS))).groupBy("_lane").transformWithStateInPandas(
        statefulProcessor=Assembly(columns, key, word, expected, wait_ms), outputStructType=out, outputMode="Append", timeMode="ProcessingTime")


def settle(query: StreamingQuery, files: int, wait_ms: int = 0, seconds: float = 1_200) -> None:
    """Let a query over ``files`` files take them all and every timer of ``wait_ms`` run out, then stop it.

    A query with processing-time timers has no end of its own: it goes on looking for timers. ``seconds`` bounds the time
    without a trigger that took something.
    """
    last, limit = None, time.monotonic() + seconds
    try:
        while time.monotonic() < limit and query.isActive:
            for progress in query.recentProgress:
                at = datetime.fromisoformat(progress["timestamp"])
                if progress["numInputRows"]:
                    if last is None or at > last:
                        limit = time.monotonic() + seconds
                        last = at
                elif re.findall(r"logOffset\D+(\d+)", str(progress["sources"][0]["endOffset"])) == [str(files - 1)] and (
                        last is None or at - last >= timedelta(milliseconds=wait_ms)):
                    return
            time.sleep(0.2)
        if error := query.exception():
            raise error
        raise TimeoutError(f"the stream took nothing for {seconds} seconds and did not come to rest")
    finally:
        query.stop()
