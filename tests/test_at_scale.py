"""What larger tables and longer runs brought to light: few keys are cut, words stay where they are, state stays small."""

import datetime

import numpy as np
import pandas as pd
from oracle import compare, connect
from pyspark.sql import functions as F

from conftest import SMALL
from docfields import fixtures
from docfields.catalog import all_queries
from docfields.operators.scans import oversized, split
from docfields.operators.totals import extract_total
from docfields.streaming import batching, processors


def test_of_many_large_keys_only_few_are_cut(spark):
    few = spark.range(10_000).select((F.col("id") % 500).alias("key"), "id")
    cut = {r.key for r in oversized(few, ["key"], 5).collect()}
    assert len(cut) < 25
    one = few.unionByName(spark.range(9_000).select(F.lit(-1).cast("long").alias("key"), "id"))
    hot = oversized(one, ["key"], 5)
    assert -1 in {r.key for r in hot.collect()}
    whole, cut_rows = split(one, hot, ["key"])
    assert whole.count() + cut_rows.count() == 19_000 and whole.groupBy("key").count().agg(F.max("count")).first()[0] <= 19_000 / 4
    assert oversized(few, ["key"], 20) is None


def test_words_are_dealt_before_they_are_made(spark):
    for words in (fixtures.receipt_words(spark, SMALL), fixtures.contested_totals(spark, SMALL)):
        plan = extract_total(words, hot_rows=None)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(doc_id" not in plan and "hashpartitioning(l_orderkey" in plan


def test_amounts_do_not_make_a_quota_error(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    rows = [(e, at, 429, "error", v, "{}") for e, v in enumerate([429.0, 1429.1, 0.5, 429.0, 4.29, 429.99, 42.9, 3.0, 1.0, 2.0, 5.0, 142.94])]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "events"))
    (part,) = (tmp_path / "events").glob("*.parquet")
    part.rename(tmp_path / "events.parquet")
    query = all_queries()["quota_errors"]
    assert compare(query.run(spark, str(tmp_path)), query.sql, connect(str(tmp_path))) is None


def test_outcomes_that_never_count_are_not_kept(spark, tmp_path):
    schema = "job_id string, seq long, stage string, ok boolean, error string, strategy string"
    late = [(f"job {k}", seq, "llm", False, "e", None) for k in range(20) for seq in range(3, 8)]
    spark.createDataFrame([*late, ("job 0", 2, "llm", False, "e", None)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    tracked = processors.track_jobs(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), 2, numbered=True)
    query = (tracked.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "state"))
             .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(str(tmp_path / "out"))).trigger(once=True).start())
    query.awaitTermination()
    assert sum(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]) <= 3


class Slow:
    """A query that takes a file every 0.4 seconds and comes to rest after eight."""

    isActive = True

    def __init__(self):
        self.begun = datetime.datetime.now()

    @property
    def recentProgress(self):
        past = (datetime.datetime.now() - self.begun).total_seconds()
        taken = [self._progress(0.4 * n, n, 5) for n in range(8) if 0.4 * (n + 1) <= past]
        return taken + ([self._progress(3.3, 7, 0)] if past > 3.4 else [])

    def _progress(self, at, file, rows):
        return {"timestamp": (self.begun + datetime.timedelta(seconds=at)).isoformat(), "numInputRows": rows,
                "sources": [{"endOffset": f'{{"logOffset":{file}}}'}]}

    def exception(self):
        return None

    def stop(self):
        self.isActive = False


def test_a_stream_that_goes_on_is_not_late():
    query = Slow()
    batching.settle(query, 8, seconds=1.5)
    assert not query.isActive


class Held:
    """State of one key in memory."""

    def __init__(self):
        self.values = []

    def get(self):
        return iter(self.values)

    def appendValue(self, value):
        self.values.append(value)

    def clear(self):
        self.values = []


class Index(Held):
    def get(self):
        return self.values[-1] if self.values else None

    def update(self, value):
        self.values = [value]

    def exists(self):
        return bool(self.values)


class Handle:
    def __init__(self):
        self.timers = []

    def getListState(self, *_):
        return Held()

    def getValueState(self, *_):
        return Index()

    def listTimers(self):
        return self.timers

    def deleteTimer(self, at):
        self.timers.remove(at)

    def registerTimer(self, at):
        self.timers.append(at)

    def getCurrentProcessingTimeInMs(self):
        return 1000


def test_documents_go_out_in_pages(spark):
    columns = spark.range(0).selectExpr("id as doc_id", "id as word_id", "'' as text", "id as n_words").schema
    task = batching.Assembly(columns, "doc_id", "word_id", "n_words", 60_000)
    handle = Handle()
    task.init(handle)
    frames = [pd.DataFrame({"doc_id": np.arange(2_000) % 2, "word_id": np.arange(2_000) // 2 + 1_000 * n, "text": "x", "n_words": 70_000}) for n in range(70)]
    assert not list(task.handleInputRows((0,), iter(frames[:30]), handle))
    out = list(task.handleInputRows((0,), iter(frames[29:]), handle))
    assert max(map(len, out)) <= 50_000 and sum(map(len, out)) == 140_000
    assert not pd.concat(out).duplicated(["doc_id", "word_id"]).any() and not task.pages.values and not handle.timers
