"""Queries that run a stream over the given tables to its end and return what it produced."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docfields import fixtures
from docfields.catalog import Catalog
from docfields.catalog import sql as S
from docfields.catalog.events import CIRCUIT, calls
from docfields.catalog.extraction import TODAY, today
from docfields.operators.routing import extract_fields, route
from docfields.session import materialise, shared_folder
from docfields.sources.words import read_words_stream
from docfields.streaming import batching, processors, stages

QUERIES = Catalog()


def _folder(s: SparkSession, name: str) -> str:
    return f"{shared_folder(s)}/docfields/{name}-{uuid.uuid4().hex}"


def _landed(df: DataFrame, name: str) -> str:
    """The input of a stream as files, whole keys per file."""
    path = _folder(df.sparkSession, name)
    df.write.parquet(path)
    return path


def _collected(s: SparkSession, stream: DataFrame, mode: str, once: bool = False, files: int = 0, wait_ms: int = 0) -> DataFrame:
    """Drain a stream into one table per micro-batch and read what it wrote.

    ``once`` takes everything in one batch and stops there: with timers pending, a drain would wait for them. ``files``
    lets a stream with timers take so many files, one a trigger, and its timers of ``wait_ms`` run out.
    """
    out, state = _folder(s, "out"), _folder(s, "state")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", state)
    if once:
        writer.trigger(once=True).start().awaitTermination()
    elif files:
        batching.settle(writer.start(), files, wait_ms)
    else:
        stages.drain(writer)
    return s.read.option("basePath", out).parquet(f"{out}/batch=*")


def extracted(s, d, part: str) -> DataFrame:
    path = _landed(fixtures.receipt_words(s, d).repartition("doc_id"), "words")
    sink, state = _folder(s, "sink"), _folder(s, "state")
    stages.drain(stages.stream_extract(read_words_stream(s, path, files=4), sink, state, today()))
    return s.read.parquet(f"{sink}/{part}")


QUERIES.add("streamed_receipts", "T1 S2", lambda s, d: extracted(s, d, "routed").drop("batch"),
            f"WITH {S.FIELDS} SELECT doc_id, vendor, total, date, vendor_conf, total_conf, date_conf, route FROM routed")
QUERIES.add("streamed_validation", "T1", lambda s, d: extracted(s, d, "validated").select("job_id", "ok", F.array_join("errors", ",").alias("errors")),
            f"""WITH {S.FIELDS}, {S.validated("rule_payloads", TODAY)} SELECT job_id, ok, errors FROM validated WHERE route = 'VALIDATE'""")


def stream_batches(s, d) -> DataFrame:
    """How many batches of each size streamed requests make; all of them arrive in one trigger."""
    path = _landed(fixtures.requests(s, d), "requests")
    sink, state = _folder(s, "sink"), _folder(s, "state")
    source = s.readStream.schema(fixtures.requests(s, d).schema).parquet(path)
    stages.stream_batches(source, sink, state, wait=None).start().awaitTermination()
    # The folder of a micro-batch is only its place; ``batch`` in the rows is the model call.
    out = s.read.parquet(f"{sink}/batch=*").withColumn("at", F.input_file_name())
    sizes = out.groupBy(F.regexp_extract("at", r"/batch=(\d+)/", 1), "batch").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("n").agg(F.count(F.lit(1)).alias("batches"))


QUERIES.add("streamed_batches", "T2", stream_batches, """SELECT n, count(*) AS batches
    FROM (SELECT count(*) AS n FROM (SELECT row_number() OVER () - 1 AS r FROM orders) GROUP BY r // 3) GROUP BY n""")


def filled_sizes(s, d) -> DataFrame:
    calls = _filled_calls(s, d, 1).groupBy("call").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("slot").alias("slots"))
    return calls.groupBy("n", "slots").agg(F.count(F.lit(1)).alias("batches"))


def _dealt(s, rows: DataFrame, name: str, at_once: int = 1) -> tuple[DataFrame, int]:
    """``rows`` (dealt over partitions) as a stream of ``at_once`` files a trigger, and the number of triggers."""
    path = _landed(rows, name)
    files = len(s.read.parquet(path).inputFiles())
    return s.readStream.schema(rows.schema).option("maxFilesPerTrigger", at_once).parquet(path), -(-files // at_once)


def _filled_calls(s, d, lanes: int) -> DataFrame:
    """Calls made of requests that arrive in five files of odd sizes, a file a trigger."""
    _with_rocksdb(s)
    source, files = _dealt(s, fixtures.requests(s, d).filter("job_id % 7 <> 0").repartition(5, "job_id"), "requests")
    calls = batching.fill_batches(source, wait_ms=2_000, lanes=lanes).withColumnRenamed("batch", "call")
    return _collected(s, calls, "append", files=files, wait_ms=2_000)


QUERIES.add("streamed_full_batches", "T2", filled_sizes, """SELECT n, n AS slots, count(*) AS batches
    FROM (SELECT count(*) AS n FROM (SELECT row_number() OVER () - 1 AS r FROM orders WHERE o_orderkey % 7 <> 0) GROUP BY r // 3) GROUP BY n""")


def filled_in_lanes(s, d) -> DataFrame:
    """The same in four lanes: every job has one place, and no more than one batch of a lane is short."""
    calls = _filled_calls(s, d, 4).withColumn("lane", F.substring_index("call", "-", 1))
    sized = calls.groupBy("lane", "call").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("job_id").cast("long")).alias("total"))
    lanes = sized.groupBy("lane").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.count_if(F.col("n") < 3).alias("short"))
    return lanes.agg(F.count(F.lit(1)).alias("lanes"), F.sum("n").alias("jobs"), F.sum("total").alias("total"), (F.max("short") <= 1).alias("full"))


QUERIES.add("streamed_batches_in_lanes", "T2", filled_in_lanes,
            "SELECT 4 AS lanes, count(*) AS jobs, CAST(sum(o_orderkey) AS bigint) AS total, true AS \"full\" FROM orders WHERE o_orderkey % 7 <> 0")


def assembled(s, d) -> DataFrame:
    """Receipts whose words are dealt over 16 files, four a trigger, extracted once all their words are there."""
    _with_rocksdb(s)
    words = fixtures.receipt_words(s, d)
    counted_words = words.join(words.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_words")), "doc_id")
    source, files = _dealt(s, counted_words.repartition(16, "word_id", "doc_id"), "dealt-words", 4)
    whole = _collected(s, batching.assemble_documents(source, wait_ms=3_600_000, lanes=8), "append", files=files)
    rules = route(extract_fields(whole.filter("complete").select(*words.columns)))
    return rules.select("doc_id", "vendor", "total", "date", "vendor_conf", "total_conf", "date_conf", "route")


QUERIES.add("assembled_receipts", "T1", assembled,
            f"WITH {S.FIELDS} SELECT doc_id, vendor, total, date, vendor_conf, total_conf, date_conf, route FROM routed")


def deduplicated(s, d) -> DataFrame:
    """Job keys arriving in several files and batches, every one let through once while it is remembered."""
    jobs = fixtures.attempts(s, d).select("job_id", F.lit("2024-01-01").cast("timestamp").alias("arrived"))
    path = _landed(jobs.repartition(4), "arrivals")
    source = s.readStream.schema("job_id string, arrived timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    return _collected(s, stages.dedupe_ingest(source, ("arrived", "1 hour")), "append").select("job_id")


QUERIES.add("streamed_ingest", "T4", deduplicated,
            "SELECT DISTINCT CAST(user_id AS string) AS job_id FROM events WHERE event_type = 'error'")


def counted(s, d) -> DataFrame:
    log = fixtures.outcomes(s, d).select("name", "n")
    source = s.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(_landed(log.repartition(3), "log"))
    states = _collected(s, stages.stream_counters(source), "complete")
    return states.groupBy("name").agg(F.max_by("n", "batch").alias("n"))


QUERIES.add("streamed_counters", "T5 A11", counted, "SELECT event_type AS name, count(*) AS n FROM events GROUP BY event_type")


def _with_rocksdb(s: SparkSession) -> None:
    s.conf.set("spark.sql.streaming.stateStore.providerClass", processors.ROCKSDB)


def circuits(s, d) -> DataFrame:
    _with_rocksdb(s)
    log = calls(s, d).select(F.col("key").cast("string").alias("key"), "event_id", "at", "failed")
    source = s.readStream.schema(log.schema).parquet(_landed(log, "calls"))
    return _collected(s, processors.stream_circuit(source, 2, 86400.0), "update").select("event_id", "allowed")


QUERIES.add("streamed_circuit", "T6", circuits,
            f"SELECT event_id, allowed FROM ({CIRCUIT.format(by='key', n=2, open='86400e0')})")


def tracked(s, d, numbered: bool = False) -> DataFrame:
    """Final state of every job after its outcomes: the first two failures decide, unless a success comes before.

    ``numbered``: outcomes are numbered by job and come latest first, in five parts of up to four files, four files a trigger.
    """
    _with_rocksdb(s)
    e = F.col("event_id")
    outcomes = fixtures.table(s, d, "events").select(
        F.col("user_id").cast("string").alias("job_id"), e.alias("seq"), F.lit("validation").alias("stage"),
        (F.col("event_type") != "error").alias("ok"), F.concat(F.lit("error "), e).alias("error"),
        F.lit(None).cast("string").alias("strategy"))
    if numbered:
        latest_first = Window.partitionBy("job_id").orderBy("seq")
        outcomes = materialise(outcomes.withColumn("seq", F.row_number().over(latest_first).cast("long")), "numbered-outcomes")
        path = _folder(s, "outcomes")
        for part in range(5):
            outcomes.filter((F.col("seq") - 1) % 5 == 4 - part).repartition(4).write.mode("append").parquet(path)
        source = s.readStream.schema(outcomes.schema).option("maxFilesPerTrigger", 4).parquet(path)
        stream = processors.track_jobs(source, 2, base_ms=3_600_000, cap_ms=3_600_000, numbered=True)
        files = -(-len(s.read.parquet(path).inputFiles()) // 4)
        rows = _collected(s, stream, "update", files=files).filter("event = 'outcome'")
    else:
        source = s.readStream.schema(outcomes.schema).parquet(_landed(outcomes, "outcomes"))
        stream = processors.track_jobs(source, 2, base_ms=3_600_000, cap_ms=3_600_000)
        rows = _collected(s, stream, "update", once=True).filter("event = 'outcome'")
    final = F.max_by(F.struct("status", "strategy"), F.struct("failures", F.col("status") == "SUCCESS"))
    return rows.groupBy("job_id").agg(F.max("failures").alias("failures"), final.alias("f")).select("job_id", "failures", "f.status", "f.strategy")


TRACKED = """
WITH e AS (SELECT CAST(user_id AS string) AS job_id, event_type = 'error' AS failed,
             row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
f AS (SELECT job_id, count(*) FILTER (n = 1 AND failed) AS first, count(*) FILTER (n = 2 AND failed) AS second, count(*) AS n FROM e GROUP BY job_id)
SELECT job_id, CAST(CASE WHEN first = 0 THEN 0 WHEN n > 1 AND second = 1 THEN 2 ELSE 1 END AS int) AS failures,
       CASE WHEN first = 0 THEN 'SUCCESS' WHEN n = 1 THEN 'RETRY_SCHEDULED' WHEN second = 1 THEN 'NEEDS_REVIEW' ELSE 'SUCCESS' END AS status,
       CASE WHEN first = 1 THEN 'after_validation_fail' END AS strategy FROM f"""
QUERIES.add("tracked_jobs", "T3 F23 F25", tracked, TRACKED)
QUERIES.add("tracked_jobs_in_any_order", "T3", lambda s, d: tracked(s, d, True), TRACKED)
