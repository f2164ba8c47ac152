"""Keyed state: job tracker and circuit (T3, T6). Both need the RocksDB state store.

Of the rows that a job has in a micro-batch the tracker keeps only the few that can still matter, so their number does not
count. The circuit puts the rows of a key in order before it uses them; the source's rate options (such as
``maxFilesPerTrigger``) bound them. For a log already at rest the batch form in ``operators.health`` has no such bound.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from docfields.functions.retries import next_strategy_of

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

TRACKED = (
    "job_id string, event string, status string, failures int, strategy string, due_ms long, error string, "
    "history string"
)
# How long a tracked job is remembered after its last change: 30 days.
KEPT_MS = 30 * 24 * 3_600_000
CIRCUIT = "key string, event_id long, at double, allowed boolean, open_until double"


class JobTracker(StatefulProcessor):
    """Failures of one job: counts them, picks the next strategy, arms a timer for the retry and closes the job.

    State is a counter, a flag and the strategy per job, plus its short history, which goes out with a job sent to
    review; finished jobs keep the final status only. What has not changed for ``ttl_ms`` is forgotten, so that state
    does not grow with all jobs that ever were.
    """

    def __init__(self, max_failures: int, delay_ms: Callable[[int], int], ttl_ms: int | None = None):
        self.max_failures, self.delay_ms, self.ttl_ms = max_failures, delay_ms, ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.current = handle.getValueState("current", "failures int, strategy string, status string", self.ttl_ms)
        self.history = handle.getListState("history", "stage string, error string, strategy string", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        failures, strategy, status = self.current.get() or (0, None, "OPEN")
        out = []
        # Each outcome that is used closes the job or is a failure, so this many of the first decide.
        for row in self._first(rows, self.max_failures - failures).itertuples(index=False):
            if status in ("SUCCESS", "NEEDS_REVIEW"):
                continue
            due = None
            if row.ok:
                status, error = "SUCCESS", None
            else:
                failures, error = failures + 1, row.error
                self.history.appendValue((row.stage, row.error, strategy))
                if failures >= self.max_failures:
                    status = "NEEDS_REVIEW"
                else:
                    status, strategy = "RETRY_SCHEDULED", next_strategy_of(
                        row.stage, row.strategy or (strategy if row.stage == "validation" else None))
                    due = timerValues.getCurrentProcessingTimeInMs() + self.delay_ms(failures - 1)
                    self.handle.registerTimer(due)
            history = self._told() if status == "NEEDS_REVIEW" else None
            out.append((key[0], "outcome", status, failures, strategy, due, error, history))
        self.current.update((failures, strategy, status))
        if status in ("SUCCESS", "NEEDS_REVIEW") and self.history.exists():
            self.history.clear()
        yield _tracked(out)

    @staticmethod
    def _first(rows: Iterator[pd.DataFrame], most: int) -> pd.DataFrame:
        """The ``most`` rows with the smallest ``seq``; frames are taken as they come and never put together."""
        kept = None
        for frame in rows:
            frame = frame if kept is None else pd.concat([kept, frame])
            kept = frame.sort_values("seq", kind="stable").head(max(most, 0))
        return kept

    def _told(self) -> str:
        """The failures so far, for the reviewer; never more than ``max_failures`` of them."""
        return ";".join(":".join(part or "" for part in entry) for entry in self.history.get())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        failures, strategy, status = self.current.get() or (0, None, "OPEN")
        if status != "RETRY_SCHEDULED":
            yield _tracked([])
            return
        self.current.update((failures, strategy, "LLM_PENDING"))
        due = expiredTimerInfo.getExpiryTimeInMs()
        yield _tracked([(key[0], "due", "LLM_PENDING", failures, strategy, due, None, None)])

    def close(self) -> None:
        pass


class OrderedTracker(JobTracker):
    """The same for outcomes that are numbered 1, 2, 3 ... for each job and may come in any order, over any triggers.

    What comes before its predecessors waits in a map by number; a pointer tells which number is next. A closed job
    keeps neither.
    """

    def init(self, handle) -> None:
        super().init(handle)
        self.next = handle.getValueState("next", "seq long", self.ttl_ms)
        self.waiting = handle.getMapState("waiting", "seq long", "stage string, ok boolean, error string, strategy string", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fields = ["stage", "ok", "error", "strategy"]
        for frame in rows:
            at, = self.next.get() or (1,)
            status = (self.current.get() or (0, None, "OPEN"))[2]
            if status in ("SUCCESS", "NEEDS_REVIEW"):
                break
            ready = []
            for row in frame.sort_values("seq").itertuples(index=False):
                if row.seq == at:
                    ready.append(row)
                    at += 1
                    while self.waiting.containsKey((at,)):
                        ready.append(pd.Series(dict(zip(fields, self.waiting.getValue((at,)), strict=True)) | {"seq": at}))
                        self.waiting.removeKey((at,))
                        at += 1
                elif row.seq > at:
                    self.waiting.updateValue((int(row.seq),), (row.stage, bool(row.ok), row.error, row.strategy))
            self.next.update((at,))
            if ready:
                yield from super().handleInputRows(key, iter([pd.DataFrame([[r.seq, *[getattr(r, f) for f in fields]] for r in ready], columns=["seq", *fields])]), timerValues)
        if (self.current.get() or (0, None, "OPEN"))[2] in ("SUCCESS", "NEEDS_REVIEW") and self.waiting.exists():
            self.waiting.clear()

    def close(self) -> None:
        pass


def _tracked(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["job_id", "event", "status", "failures", "strategy", "due_ms", "error", "history"])
    return frame.astype({"failures": "int32", "due_ms": "Int64"})


def track_jobs(
    outcomes: DataFrame, max_failures: int = 2, base_ms: int = 5000, cap_ms: int = 900_000, ttl_ms: int = KEPT_MS, numbered: bool = False
) -> DataFrame:
    """job_id, seq, stage, ok, error, strategy in; one row per outcome and one per retry that falls due out.

    A job that nothing has happened to for ``ttl_ms`` (longer than any retry waits) starts anew. Outcomes are taken in the
    order of ``seq`` within a micro-batch; if they are ``numbered`` from 1 without gaps, in that order over all of them.
    Each of the first ``max_failures`` of a job closes it or is a failure, so later numbers never count and do not wait.
    """
    if numbered:
        outcomes = outcomes.filter(F.col("seq") <= max_failures)
    tracker = (OrderedTracker if numbered else JobTracker)(max_failures, lambda k: min(cap_ms, base_ms * 2 ** k), ttl_ms)
    return outcomes.groupBy("job_id").transformWithStateInPandas(
        statefulProcessor=tracker, outputStructType=TRACKED, outputMode="Update", timeMode="ProcessingTime"
    )


class Circuit(StatefulProcessor):
    """Circuit state of one service: failures in a row and the time it stays open until."""

    def __init__(self, threshold: int, open_for: float):
        self.threshold, self.open_for = threshold, open_for

    def init(self, handle) -> None:
        self.state = handle.getValueState("circuit", "failures int, open_until double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        failures, open_until = self.state.get() or (0, None)
        out = []
        for row in pd.concat(list(rows)).sort_values(["at", "event_id"]).itertuples(index=False):
            out.append((key[0], row.event_id, row.at, open_until is None or row.at >= open_until, open_until))
            failures = failures + 1 if row.failed else 0
            if failures >= self.threshold:
                opened = row.at + self.open_for
                failures, open_until = 0, opened if open_until is None else max(open_until, opened)
        self.state.update((failures, open_until))
        yield pd.DataFrame(out, columns=["key", "event_id", "at", "allowed", "open_until"]).astype(
            {"open_until": "float64"}
        )

    def close(self) -> None:
        pass


def stream_circuit(events: DataFrame, threshold: int = 5, open_for: float = 60.0) -> DataFrame:
    """Key, event_id, at, failed in; whether each call was allowed out. Events of a key arrive in time order."""
    return events.groupBy("key").transformWithStateInPandas(
        statefulProcessor=Circuit(threshold, open_for), outputStructType=CIRCUIT, outputMode="Update", timeMode="None"
    )
