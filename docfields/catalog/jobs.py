"""Queries on the job table, retries, reports and delivery."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfields import fixtures
from docfields.catalog import Catalog
from docfields.catalog import sql as S
from docfields.catalog.extraction import TODAY, routed, today
from docfields.functions import retries
from docfields.operators import delivery, reports, routing, validation
from docfields.operators import jobs as J
from docfields.plans.rounds import run_rounds
from docfields.session import run_folder
from docfields.sources import exports, images, queues
from docfields.sources.tables import KeyedTable

QUERIES = Catalog()

jobs = fixtures.jobs
SQL = f"WITH {S.JOBS}"
EXPORT = (
    "job_id, image_path AS file, vendor, invoice_date AS date, total_amount AS total, confidence, source, status, "
    "retry_count, last_error"
)
BUCKET = """CASE status WHEN 'SUCCESS' THEN 'valid_invoices' WHEN 'NEEDS_REVIEW' THEN 'needs_human_review'
  WHEN 'DLQ' THEN 'legacy_dlq' ELSE 'non_terminal' END"""
NOW = "2024-06-01 00:00:00"


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def key() -> Column:
    return F.col("job_id").cast("long")


def stamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def job_rows(s, d) -> DataFrame:
    return jobs(s, d).withColumn("updated_at", stamp(F.col("updated_at")))


JOB_ROWS = """SELECT * EXCLUDE (k) REPLACE (strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at) FROM jobs"""

QUERIES.add("job_table", "S9", job_rows, f"{SQL} {JOB_ROWS}")


def some_ids(s, d) -> DataFrame:
    """Keys as a caller might ask for them: repeated, and some that no job has."""
    o = F.col("o_orderkey")
    ids = fixtures.table(s, d, "orders").filter(o % 4 == 0).select(F.explode(F.array(o, o, o + 3, -o - 1)).alias("k"))
    return ids.select(F.col("k").cast("string").alias("job_id"))


IDS = """ids AS (SELECT CAST(unnest([o_orderkey, o_orderkey, o_orderkey + 3, -o_orderkey - 1]) AS string) AS job_id
                 FROM orders WHERE o_orderkey % 4 = 0)"""

QUERIES.add("jobs_by_id_list", "S9 J2", lambda s, d: J.jobs_for(jobs(s, d), some_ids(s, d)).select("job_id", "status"),
            f"{SQL}, {IDS} SELECT job_id, status FROM jobs SEMI JOIN ids USING (job_id)")
QUERIES.add("job_lookup", "J1", lambda s, d: J.job_for(jobs(s, d), some_ids(s, d)).select("job_id", "status", "retry_count"),
            f"{SQL}, {IDS} SELECT job_id, status, retry_count FROM ids JOIN jobs USING (job_id)")
QUERIES.add("job_completion", "A14 U2", lambda s, d: J.completion(some_ids(s, d), jobs(s, d)),
            f"""{SQL}, {IDS} SELECT job_id, CASE WHEN status = 'SUCCESS' THEN 'success'
            WHEN status IN ('NEEDS_REVIEW', 'DLQ') THEN 'needs_review' ELSE 'pending' END AS outcome
            FROM (SELECT DISTINCT job_id FROM ids) LEFT JOIN jobs USING (job_id)""")
QUERIES.add("job_completion_counts", "A14", lambda s, d: J.completion_counts(some_ids(s, d), jobs(s, d)),
            f"""{SQL}, {IDS} SELECT CASE WHEN status = 'SUCCESS' THEN 'success'
            WHEN status IN ('NEEDS_REVIEW', 'DLQ') THEN 'needs_review' ELSE 'pending' END AS outcome, count(*) AS jobs
            FROM (SELECT DISTINCT job_id FROM ids) LEFT JOIN jobs USING (job_id) GROUP BY outcome""")
QUERIES.add("pending_jobs", "U4 P14", lambda s, d: J.pending_jobs(some_ids(s, d), jobs(s, d)),
            f"""{SQL}, {IDS} SELECT DISTINCT job_id FROM ids
            ANTI JOIN (SELECT job_id FROM jobs WHERE status IN ('SUCCESS', 'NEEDS_REVIEW', 'DLQ')) USING (job_id)""")
QUERIES.add("terminal_flags", "P14",
            lambda s, d: jobs(s, d).select("job_id", J.is_terminal(F.col("status")).alias("terminal"),
                                           J.skips_validation(F.col("status")).alias("skips")),
            f"{SQL} SELECT job_id, status IN ('SUCCESS', 'NEEDS_REVIEW', 'DLQ') AS terminal, status = 'SUCCESS' AS skips FROM jobs")
QUERIES.add("startable_jobs", "P14", lambda s, d: jobs(s, d).select("job_id", J.may_start(F.col("status")).alias("may_start")),
            f"{SQL} SELECT job_id, status NOT IN ('SUCCESS', 'NEEDS_REVIEW', 'DLQ', 'PROCESSING') AS may_start FROM jobs")
QUERIES.add("newest_review_jobs", "O1",
            lambda s, d: J.jobs_by_status(jobs(s, d), "NEEDS_REVIEW").select("job_id", stamp(F.col("updated_at")).alias("updated_at")),
            f"""{SQL} SELECT job_id, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at FROM jobs
            WHERE status = 'NEEDS_REVIEW' ORDER BY jobs.updated_at DESC, job_id LIMIT 100""")


def snapshots(s, d) -> DataFrame:
    k = F.col("o_orderkey")
    snapshot = F.when(k % 4 == 0, "[]").when(k % 4 == 1, None).when(k % 4 == 2, " [ ]").otherwise(F.concat(F.lit("[{\"text\": \""), k, F.lit("\"}]")))
    return fixtures.table(s, d, "orders").select(k.cast("string").alias("job_id"), snapshot.alias("ocr_snapshot"))


QUERIES.add("processable_jobs", "P19", lambda s, d: J.processable(snapshots(s, d)),
            """SELECT CAST(o_orderkey AS string) AS job_id, '[{"text": "' || o_orderkey || '"}]' AS ocr_snapshot
            FROM orders WHERE o_orderkey % 4 = 3""")


def ingested(s, d) -> DataFrame:
    """Every order's image is listed twice; two thirds of them are known already, under their derived key."""
    known = jobs(s, d).filter(key() % 3 != 0).select(
        F.sha2("image_path", 256).alias("job_id"),
        F.when(key() % 5 == 0, "PENDING").otherwise(F.col("status")).alias("status"))
    files = jobs(s, d).select(F.explode(F.array("image_path", "image_path")).alias("path"))
    return J.ingest(known, files)


INGESTED = """actions AS (SELECT sha256(image_path) AS job_id, image_path AS path,
  CASE WHEN k % 3 = 0 THEN 'new' WHEN k % 5 = 0 THEN 'requeue' ELSE 'skip' END AS action, 2 AS max_retries FROM jobs)"""
QUERIES.add("ingest_actions", "J3 F33 T4", ingested, f"{SQL}, {INGESTED} SELECT * FROM actions")
QUERIES.add("new_jobs", "J3", lambda s, d: J.new_jobs(ingested(s, d)),
            f"{SQL}, {INGESTED} SELECT job_id, path AS image_path, 'PENDING' AS status, 0 AS retry_count, max_retries FROM actions WHERE action = 'new'")


def changed(s, d) -> DataFrame:
    changes = jobs(s, d).filter(key() % 2 == 0).select(
        F.when(key() % 4 == 0, F.concat(F.lit("-"), "job_id")).otherwise(F.col("job_id")).alias("job_id"),
        F.lit("VALIDATING").alias("status"), F.lit(None).cast("string").alias("vendor"))
    return J.upsert(job_rows(s, d), changes, now=now())


QUERIES.add("updated_jobs", "J7", changed,
            f"""{SQL} SELECT * EXCLUDE (k) REPLACE (CASE WHEN k % 4 = 2 THEN '{NOW}' ELSE strftime(updated_at, '%Y-%m-%d %H:%M:%S') END AS updated_at,
            CASE WHEN k % 4 = 2 THEN 'VALIDATING' ELSE status END AS status, CASE WHEN k % 4 = 2 THEN NULL ELSE vendor END AS vendor) FROM jobs""")


def corrections(s, d) -> DataFrame:
    """Line items as corrections of their order; several per job, in the order of their number."""
    n = F.col("l_linenumber")
    rows = fixtures.table(s, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_extendedprice").alias("price"))
    return rows.select(
        n.alias("id"), F.col("l_orderkey").cast("string").alias("job_id"),
        F.when(n % 2 == 0, F.concat(F.lit("corrected "), n)).alias("vendor"), F.lit("2001-02-03").alias("invoice_date"),
        F.col("price").alias("total_amount"), F.lit(None).cast("string").alias("reviewer_note"))


QUERIES.add("corrected_jobs", "J8 W6", lambda s, d: J.apply_corrections(job_rows(s, d), corrections(s, d), now()),
            f"""{SQL}, c AS (SELECT l_orderkey AS ck, l_linenumber AS n, max(l_extendedprice) AS price FROM lineitem
              GROUP BY l_orderkey, l_linenumber QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) = 1)
            SELECT job_id, image_path, CASE WHEN ck IS NULL THEN vendor WHEN n % 2 = 0 THEN 'corrected ' || n END AS vendor,
              CASE WHEN ck IS NULL THEN invoice_date ELSE '2001-02-03' END AS invoice_date,
              CASE WHEN ck IS NULL THEN total_amount ELSE price END AS total_amount, confidence,
              CASE WHEN ck IS NULL THEN source ELSE 'HUMAN' END AS source, CASE WHEN ck IS NULL THEN status ELSE 'SUCCESS' END AS status,
              retry_count, max_retries, last_error, has_ocr_snapshot,
              CASE WHEN ck IS NULL THEN strftime(updated_at, '%Y-%m-%d %H:%M:%S') ELSE '{NOW}' END AS updated_at
            FROM jobs LEFT JOIN c ON ck = k""")


def review_source(s, d) -> DataFrame:
    """Job rows with the long texts a review record cuts: a document per job as raw response and snapshot."""
    docs = fixtures.table(s, d, "documents").select(F.col("doc_id").cast("string").alias("job_id"), "text")
    return jobs(s, d).join(docs, "job_id", "left").select(
        "*", F.lit("llm").alias("failure_class"), F.lit("strict_json").alias("attempt_strategy"),
        F.col("text").alias("ocr_snapshot"), F.lit(None).cast("string").alias("extraction_payload"),
        F.col("text").alias("llm_last_raw"), F.lit("[]").alias("retry_history"))


def review(s, d) -> DataFrame:
    records = J.review_records(review_source(s, d), F.lit("llm"), F.col("last_error"), now())
    return records.select(
        "job_id", "image_path", "status", "stage_failed", "reason", "retry_count", "failure_class", "llm_last_raw",
        F.coalesce(F.get_json_object("ocr_snapshot", "$.preview"), "ocr_snapshot").alias("shown"),
        stamp(F.col("recorded_at")).alias("recorded_at"))


QUERIES.add("review_records", "P16 P18 F19", review,
            f"""{SQL} SELECT job_id, image_path, 'NEEDS_REVIEW' AS status, 'llm' AS stage_failed, last_error AS reason, retry_count,
            'llm' AS failure_class, substr(text, 1, 4000) AS llm_last_raw,
            CASE WHEN length(text) > 12000 THEN substr(text, 1, 6000) || '...' ELSE text END AS shown, '{NOW}' AS recorded_at
            FROM jobs LEFT JOIN documents ON k = doc_id""")


def review_queue(s, d) -> DataFrame:
    queue = jobs(s, d).filter("status = 'NEEDS_REVIEW'").select("job_id", F.lit("old").alias("reason"), F.lit(0).alias("recorded_at"))
    new = corrections(s, d).select("job_id", F.concat(F.lit("line "), "id").alias("reason"), F.col("id").alias("recorded_at"))
    return J.upsert_review(queue, new)


QUERIES.add("review_queue", "S6", review_queue,
            f"""{SQL}, n AS (SELECT CAST(l_orderkey AS string) AS job_id, max(l_linenumber) AS recorded_at FROM lineitem GROUP BY ALL)
            SELECT job_id, 'line ' || recorded_at AS reason, recorded_at FROM n
            UNION ALL SELECT job_id, 'old', 0 FROM jobs ANTI JOIN n USING (job_id) WHERE status = 'NEEDS_REVIEW'""")


def validated_jobs(s, d) -> DataFrame:
    checked = validation.validate(routing.rule_payload(routed(s, d)), today())
    return J.apply_success(job_rows(s, d), checked.withColumn("source", F.when(key() % 2 == 0, F.col("source"))), now())


QUERIES.add("accepted_jobs", "P17", validated_jobs,
            f"""WITH {S.FIELDS}, {S.JOBS}, {S.validated("rule_payloads", TODAY)}
            SELECT j.job_id, image_path, CASE WHEN ok THEN trim(v.vendor) ELSE j.vendor END AS vendor,
              CASE WHEN ok THEN strftime(parsed, '%Y-%m-%d') ELSE invoice_date END AS invoice_date,
              CASE WHEN ok THEN round(total, 2) ELSE total_amount END AS total_amount,
              CASE WHEN ok THEN v.confidence ELSE j.confidence END AS confidence,
              CASE WHEN ok THEN CASE WHEN k % 2 = 0 THEN 'OCR_RULE' ELSE 'UNKNOWN' END ELSE j.source END AS source,
              CASE WHEN ok THEN 'SUCCESS' ELSE status END AS status, retry_count, max_retries,
              CASE WHEN ok THEN NULL ELSE last_error END AS last_error, has_ocr_snapshot,
              CASE WHEN ok THEN '{NOW}' ELSE strftime(updated_at, '%Y-%m-%d %H:%M:%S') END AS updated_at
            FROM jobs j LEFT JOIN validated v USING (job_id)""")

# Attempts and retries

ATTEMPTS = """attempts AS (SELECT CAST(user_id AS string) AS job_id, ts,
  CASE event_id % 3 WHEN 0 THEN 'ocr' WHEN 1 THEN 'llm' ELSE 'validation' END AS stage, 'error ' || event_id AS error,
  CASE event_id % 4 WHEN 0 THEN 'default' WHEN 1 THEN 'strict_json' WHEN 2 THEN 'after_validation_fail' ELSE 'ocr_retry' END AS strategy
  FROM events WHERE event_type = 'error'),
numbered AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ts, error) AS attempt_no,
  lag(strategy) OVER (PARTITION BY job_id ORDER BY ts, error) AS previous_strategy FROM attempts)"""


def next_tried(c: str, p: str) -> str:
    return f"""CASE {c} WHEN 'llm' THEN CASE WHEN coalesce({p}, '') IN ('', 'default') THEN 'strict_json' ELSE 'ocr_retry' END
      WHEN 'validation' THEN CASE WHEN coalesce({p}, '') IN ('', 'default') THEN 'after_validation_fail'
        WHEN {p} = 'after_validation_fail' THEN 'strict_json' ELSE 'ocr_retry' END
      ELSE 'strict_json' END"""


def sequence(s, d, hot_rows: int = 1_000_000) -> DataFrame:
    return J.attempt_sequence(fixtures.attempts(s, d), hot_rows=hot_rows).drop("ts")


QUERIES.add("attempt_sequence", "W9", sequence, f"WITH {ATTEMPTS} SELECT * EXCLUDE (ts) FROM numbered")
QUERIES.add("attempt_sequence_oversized", "W9", lambda s, d: sequence(s, d, 10), f"WITH {ATTEMPTS} SELECT * EXCLUDE (ts) FROM numbered")
QUERIES.add("attempt_rollup", "A15", lambda s, d: J.attempt_rollup(fixtures.attempts(s, d)),
            f"""WITH {ATTEMPTS} SELECT job_id, count(*) OVER (PARTITION BY job_id) AS retry_count, stage AS last_stage,
            error AS last_error, strategy AS last_strategy FROM numbered
            QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY attempt_no DESC) = 1""")


def history(s, d) -> DataFrame:
    pages = J.attempt_history(fixtures.attempts(s, d), page=10)
    return pages.select("job_id", "page", F.array_join(F.transform("history", lambda e: F.concat_ws(":", e["stage"], e["error"], e["strategy"])), ";").alias("history"))


QUERIES.add("attempt_history", "A15", history,
            f"""WITH {ATTEMPTS} SELECT job_id, (attempt_no - 1) // 10 AS page,
            string_agg(concat_ws(':', stage, error, strategy), ';' ORDER BY attempt_no) AS history FROM numbered GROUP BY ALL""")


def retry_rules(s, d) -> DataFrame:
    k = F.col("attempt_no") - 1
    return sequence(s, d).select(
        "job_id", "attempt_no", retries.next_strategy(F.col("stage"), F.col("previous_strategy")).alias("next"),
        retries.base_delay(k).alias("delay"), retries.retry_outcome(F.col("attempt_no"), F.lit(2)).alias("outcome"),
        (retries.jitter(F.col("job_id"), k) < 1.5).alias("spread"))


QUERIES.add("retry_rules", "F23 F24 F25", retry_rules,
            f"""WITH {ATTEMPTS} SELECT job_id, attempt_no, {next_tried("stage", "previous_strategy")} AS next,
            least(900e0, 5e0 * pow(2e0, attempt_no - 1)) AS delay,
            CASE WHEN attempt_no >= 2 THEN 'NEEDS_REVIEW' ELSE 'RETRY_SCHEDULED' END AS outcome, true AS spread FROM numbered""")


def retry_queue(s, d) -> DataFrame:
    """Scheduled retries: the same envelope several times over, due at the event's time."""
    e = F.col("event_id")
    return fixtures.table(s, d, "events").select(
        F.col("user_id").cast("string").alias("job_id"), F.when(e % 3 == 0, "ocr").otherwise("llm").alias("target_stage"),
        F.col("event_type").alias("failure_class"), F.col("ts").alias("due_at"), e.alias("seq"))


ENVELOPES = """retries AS (SELECT CAST(user_id AS string) AS job_id, CASE WHEN event_id % 3 = 0 THEN 'ocr' ELSE 'llm' END AS target_stage,
  event_type AS failure_class, arg_max(ts, event_id) AS due_at FROM events GROUP BY ALL)"""
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
QUERIES.add("retry_envelopes", "U6", lambda s, d: J.dedupe_retries(retry_queue(s, d)).withColumn("due_at", F.date_format("due_at", MICROS)),
            f"WITH {ENVELOPES} SELECT * REPLACE (strftime(due_at, '%Y-%m-%d %H:%M:%S.%f') AS due_at) FROM retries")
QUERIES.add("due_retries", "O2",
            lambda s, d: J.due_retries(J.dedupe_retries(retry_queue(s, d)), F.lit("2024-01-15").cast("timestamp"))
            .withColumn("due_at", F.date_format("due_at", MICROS)),
            f"""WITH {ENVELOPES} SELECT * REPLACE (strftime(due_at, '%Y-%m-%d %H:%M:%S.%f') AS due_at) FROM
            (SELECT * FROM retries WHERE due_at <= TIMESTAMP '2024-01-15' ORDER BY due_at, job_id LIMIT 50)""")


def oldest_retries(s, d) -> DataFrame:
    """The same from a queue that lies in the order of time."""
    path = f"{run_folder(s)}/due-{uuid.uuid4().hex}"
    queues.write_queue(J.dedupe_retries(retry_queue(s, d)), path)
    return queues.oldest_due(s, path, datetime.datetime(2024, 1, 15)).withColumn("due_at", F.date_format("due_at", MICROS))


QUERIES.add("oldest_due_retries", "O1 O2", oldest_retries,
            f"""WITH {ENVELOPES} SELECT * REPLACE (strftime(due_at, '%Y-%m-%d %H:%M:%S.%f') AS due_at) FROM
            (SELECT * FROM retries WHERE due_at <= TIMESTAMP '2024-01-15' ORDER BY due_at, job_id LIMIT 50)""")


def advanced(s, d) -> DataFrame:
    """One round of outcomes over all jobs: a seventh passes, the rest fail in one of the stages."""
    k = key()
    base = job_rows(s, d).withColumns({"failure_class": F.lit(None).cast("string"), "attempt_strategy": F.when(k % 5 == 0, "strict_json").when(k % 5 == 1, "after_validation_fail").otherwise("default")})
    stage = F.when(k % 3 == 0, "ocr").when(k % 3 == 1, "llm").otherwise("validation")
    outcomes = jobs(s, d).filter(k % 11 != 0).select(
        "job_id", stage.alias("stage"), (k % 7 == 0).alias("ok"),
        F.when(k % 3 == 0, "unreadable").when(k % 6 == 1, "empty_parse").when(k % 3 == 1, "timeout").otherwise("date_missing").alias("error"),
        F.when(k % 2 == 0, "strict_json").alias("strategy"), F.lit("V").alias("vendor"), F.lit("1999-01-01").alias("invoice_date"),
        F.lit(9.5).alias("total_amount"), F.lit(0.85).alias("confidence"), F.lit("LLM").alias("source"),
        (k % 13 == 0).alias("corrupted"))
    out = J.advance_jobs(base, outcomes, now())
    wait = (F.unix_micros("due_at") - F.unix_micros(now())) / 1_000_000
    expected = retries.base_delay(F.col("retry_count") - 1)
    return out.withColumn("due_at", (wait >= expected) & (wait < expected + 1.5)).drop("has_ocr_snapshot", "image_path")


QUERIES.add("advanced_jobs", "C7 F23 F24 F25", advanced, f"""{SQL}, f AS (
  SELECT *, CASE k % 3 WHEN 0 THEN 'ocr' WHEN 1 THEN 'llm' ELSE 'validation' END AS stage,
    CASE WHEN k % 3 = 0 THEN 'unreadable' WHEN k % 6 = 1 THEN 'empty_parse' WHEN k % 3 = 1 THEN 'timeout' ELSE 'date_missing' END AS error,
    CASE WHEN k % 2 = 0 THEN 'strict_json' END AS tried,
    CASE k % 5 WHEN 0 THEN 'strict_json' WHEN 1 THEN 'after_validation_fail' ELSE 'default' END AS kept, k % 3 = 0 AND k % 13 = 0 AS broken,
    k % 11 <> 0 AND status <> 'SUCCESS' AND NOT (k % 3 = 0 AND status IN ('NEEDS_REVIEW', 'DLQ')) AS live FROM jobs),
  g AS (SELECT *, live AND k % 7 = 0 AS pass, live AND k % 7 <> 0 AS fail, retry_count + CASE WHEN live AND k % 7 <> 0 AND NOT broken THEN 1 ELSE 0 END AS n FROM f)
  SELECT job_id, CASE WHEN pass THEN 'V' ELSE vendor END AS vendor, CASE WHEN pass THEN '1999-01-01' ELSE invoice_date END AS invoice_date,
    CASE WHEN pass THEN 9.5e0 ELSE total_amount END AS total_amount, CASE WHEN pass THEN 0.85e0 ELSE confidence END AS confidence,
    CASE WHEN pass THEN 'LLM' ELSE source END AS source,
    CASE WHEN pass THEN 'SUCCESS' WHEN fail AND (n >= 2 OR broken) THEN 'NEEDS_REVIEW' WHEN fail THEN 'RETRY_SCHEDULED' ELSE status END AS status,
    n AS retry_count, max_retries,
    CASE WHEN pass THEN NULL WHEN fail AND broken THEN error WHEN fail AND n >= 2 THEN CASE stage WHEN 'validation' THEN 'validation_failed_after_retry:' || error
           WHEN 'ocr' THEN 'ocr_failed_after_retry:' || error ELSE CASE WHEN error = 'empty_parse' THEN 'llm_parse_failed_after_retry'
           ELSE 'llm_exception_after_retry:' || error END END
         WHEN fail THEN CASE WHEN stage = 'validation' THEN 'validation:' || error WHEN error = 'empty_parse' THEN last_error ELSE error END
         ELSE last_error END AS last_error,
    CASE WHEN fail AND broken THEN 'ocr_corrupted' WHEN fail AND (n >= 2 OR stage = 'validation') THEN stage END AS failure_class,
    CASE WHEN live THEN coalesce(tried, kept) ELSE kept END AS attempt_strategy,
    CASE WHEN fail AND n < 2 AND stage <> 'ocr' THEN {next_tried("stage", "CASE stage WHEN 'validation' THEN coalesce(tried, kept) ELSE tried END")} END AS next_strategy,
    CASE WHEN fail AND n < 2 AND NOT broken THEN true END AS due_at,
    CASE WHEN live THEN '{NOW}' ELSE strftime(updated_at, '%Y-%m-%d %H:%M:%S') END AS updated_at FROM g""")

# Reports and delivery

QUERIES.add("exported_rows", "P12 P13 S4", lambda s, d: reports.export_buckets(jobs(s, d)), f"{SQL} SELECT {EXPORT}, {BUCKET} AS bucket FROM jobs")
QUERIES.add("source_histogram", "A6", lambda s, d: reports.source_histogram(jobs(s, d)),
            f"{SQL} SELECT coalesce(nullif(source, ''), 'unset') AS source, count(*) AS jobs FROM jobs GROUP BY 1")
OBSERVED = """count(*) FILTER (has_ocr_snapshot) AS jobs_with_ocr_snapshot,
  count(*) FILTER (status = 'SUCCESS' AND source = 'OCR_RULE') AS {rules},
  count(*) FILTER (source IN ('OCR_LLM', 'LLM')) AS {model}"""
QUERIES.add("observability", "A7", lambda s, d: reports.observability(jobs(s, d), F.col("has_ocr_snapshot")),
            f"{SQL} SELECT {OBSERVED.format(rules='terminal_success_with_rule_extraction_only', model='jobs_with_llm_sourced_extraction')} FROM jobs")
QUERIES.add("export_summary", "A8", lambda s, d: reports.summary(jobs(s, d)),
            f"""{SQL}, b AS (SELECT {BUCKET} AS bucket FROM jobs) SELECT count(*) FILTER (bucket = 'valid_invoices') AS success_count,
            count(*) FILTER (bucket = 'needs_human_review') AS needs_human_review_count, count(*) FILTER (bucket = 'legacy_dlq') AS legacy_dlq_count,
            count(*) FILTER (bucket = 'non_terminal') AS non_terminal_count, count(*) AS total_jobs_in_export FROM b""")
QUERIES.add("failure_modes", "A9 U1 O4", lambda s, d: reports.failure_modes(jobs(s, d)),
            f"""{SQL} SELECT coalesce(nullif(substr(trim(last_error), 1, 120), ''), '(no last_error)') AS error, count(*) AS jobs FROM jobs
            WHERE status <> 'SUCCESS' GROUP BY 1 ORDER BY jobs DESC, error LIMIT 25""")
QUERIES.add("run_evaluation", "A10 C8", lambda s, d: reports.evaluation(jobs(s, d), F.col("has_ocr_snapshot")),
            f"""{SQL}, b AS (SELECT *, {BUCKET} AS bucket FROM jobs) SELECT count(*) AS receipt_count,
            count(*) FILTER (bucket = 'valid_invoices') AS success, count(*) FILTER (bucket = 'needs_human_review') AS needs_human_review,
            count(*) FILTER (bucket = 'legacy_dlq') AS legacy_dlq, count(*) FILTER (bucket = 'non_terminal') AS non_terminal_stuck,
            count(*) FILTER (bucket <> 'valid_invoices') AS failed_or_incomplete, {OBSERVED.format(rules='rule_only_success', model='llm_sourced')} FROM b""")


def reread(s, d) -> DataFrame:
    """The export written by bucket and the accepted bucket read back for delivery."""
    path = f"{run_folder(s)}/export-{uuid.uuid4().hex}"
    exports.write_buckets(jobs(s, d), path)
    return exports.load_valid(exports.read_bucket(s, path, "valid_invoices"))


QUERIES.add("reread_export", "S4 S7", reread, f"{SQL} SELECT {EXPORT} FROM jobs WHERE status = 'SUCCESS'")


def from_csv(s, d) -> DataFrame:
    path = f"{run_folder(s)}/csv-{uuid.uuid4().hex}"
    quoted = F.when(F.col("last_error").isNotNull(), F.concat(F.lit(' "say", '), "last_error", F.lit("\n ")))
    exports.write_csv(jobs(s, d).withColumn("last_error", quoted), path)
    return exports.read_csv(s, path)


QUERIES.add("csv_export", "S5", from_csv,
            f"""{SQL} SELECT {EXPORT.replace("last_error", "' \"say\", ' || last_error || chr(10) || ' ' AS last_error")} FROM jobs""")


def written_summary(s, d) -> DataFrame:
    path = f"{run_folder(s)}/summary-{uuid.uuid4().hex}"
    exports.write_summary(jobs(s, d), F.col("has_ocr_snapshot"), path, fixtures.outcomes(s, d).groupBy("name").agg(F.sum("n").alias("n")))
    report = s.read.schema(REPORT).json(path)
    paired = lambda c, k: F.array_join(F.transform(c, lambda e: F.concat_ws("=", e[k], e["n" if c == "metrics" else "jobs"])), "; ").alias(c)
    return report.select("outcomes.*", *[f"summary.{c}" for c in ("success_count", "needs_human_review_count", "legacy_dlq_count", "non_terminal_count", "total_jobs_in_export")],
                         "observability.terminal_success_with_rule_extraction_only", "observability.jobs_with_llm_sourced_extraction",
                         paired("source_histogram", "source"), paired("metrics", "name"), paired("failure_modes", "error"))


REPORT = """outcomes struct<receipt_count:long,success:long,needs_human_review:long,legacy_dlq:long,non_terminal_stuck:long,failed_or_incomplete:long,
  jobs_with_ocr_snapshot:long,rule_only_success:long,llm_sourced:long>,
  summary struct<success_count:long,needs_human_review_count:long,legacy_dlq_count:long,non_terminal_count:long,total_jobs_in_export:long>,
  observability struct<jobs_with_ocr_snapshot:long,terminal_success_with_rule_extraction_only:long,jobs_with_llm_sourced_extraction:long>,
  source_histogram array<struct<source:string,jobs:long>>, metrics array<struct<name:string,n:long>>, failure_modes array<struct<error:string,jobs:long>>"""
QUERIES.add("summary_file", "S10 C8 A6 A7 A8 A9", written_summary,
            f"""{SQL}, b AS (SELECT *, {BUCKET} AS bucket FROM jobs),
            h AS (SELECT coalesce(nullif(source, ''), 'unset') AS source, count(*) AS n FROM jobs GROUP BY 1),
            m AS (SELECT event_type AS name, count(*) AS n FROM events GROUP BY 1
                  UNION ALL SELECT 'ocr_success', count(*) FROM jobs WHERE status = 'SUCCESS' AND source = 'OCR_RULE'),
            e AS (SELECT coalesce(nullif(substr(trim(last_error), 1, 120), ''), '(no last_error)') AS error, count(*) AS n FROM jobs
                  WHERE status <> 'SUCCESS' GROUP BY 1 ORDER BY n DESC, error LIMIT 25)
            SELECT count(*) AS receipt_count,
            count(*) FILTER (bucket = 'valid_invoices') AS success, count(*) FILTER (bucket = 'needs_human_review') AS needs_human_review,
            count(*) FILTER (bucket = 'legacy_dlq') AS legacy_dlq, count(*) FILTER (bucket = 'non_terminal') AS non_terminal_stuck,
            count(*) FILTER (bucket <> 'valid_invoices') AS failed_or_incomplete, {OBSERVED.format(rules='rule_only_success', model='llm_sourced')},
            success AS success_count, needs_human_review AS needs_human_review_count, legacy_dlq AS legacy_dlq_count,
            non_terminal_stuck AS non_terminal_count, receipt_count AS total_jobs_in_export,
            rule_only_success AS terminal_success_with_rule_extraction_only, llm_sourced AS jobs_with_llm_sourced_extraction,
            (SELECT string_agg(source || '=' || n, '; ' ORDER BY source) FROM h) AS source_histogram,
            (SELECT string_agg(name || '=' || n, '; ' ORDER BY name) FROM m) AS metrics,
            (SELECT string_agg(error || '=' || n, '; ' ORDER BY n DESC, error) FROM e) AS failure_modes FROM b""")


def whole_export(s, d) -> DataFrame:
    """The export as it is handed over: each row from its bucket, with the line of the CSV file and the report beside it."""
    path = f"{run_folder(s)}/handed-over-{uuid.uuid4().hex}"
    metrics = fixtures.outcomes(s, d).groupBy("name").agg(F.sum("n").alias("n"))
    exports.write_export(jobs(s, d), F.col("has_ocr_snapshot"), metrics, path, now())
    rows = s.read.schema(f"{exports.EXPORT_ROW}, bucket string").json(f"{path}/buckets")
    listed = exports.read_csv(s, f"{path}/csv").select("job_id", F.col("total").alias("csv_total"))
    report = s.read.schema(f"{REPORT}, exported_at timestamp").json(f"{path}/report").first()
    return rows.join(listed, "job_id").select("job_id", "bucket", "total", "csv_total", F.lit(report.summary.total_jobs_in_export).alias("jobs"),
                                              F.lit(report.outcomes.success).alias("success"), stamp(F.lit(report.exported_at)).alias("exported_at"))


QUERIES.add("whole_export", "C8 S4 S5 S10", whole_export, f"""{SQL} SELECT job_id, {BUCKET} AS bucket, total_amount AS total, total_amount AS csv_total,
    count(*) OVER () AS jobs, count(*) FILTER (status = 'SUCCESS') OVER () AS success, '{NOW}' AS exported_at FROM jobs""")


def listed_images(s, d) -> DataFrame:
    """Pages written one to a file under image names, listed back; other files beside them are left out."""
    path = f"{run_folder(s)}/images-{uuid.uuid4().hex}"
    pages = fixtures.table(s, d, "pages").select("page_id", "url")
    for rest, (mode, suffix) in enumerate((("overwrite", "jpg"), ("append", "png"), ("append", "csv"))):
        part = pages.filter(F.col("page_id") % 3 == rest)
        part.write.mode(mode).option("maxRecordsPerFile", 1).option("extension", suffix).csv(path)
    suffix = F.substring_index("path", ".", -1)
    return images.image_files(s, path).groupBy(suffix.alias("suffix")).agg(F.count(F.lit(1)).alias("files"))


QUERIES.add("image_listing", "S1 O3", listed_images,
            """SELECT CASE page_id % 3 WHEN 0 THEN 'jpg' ELSE 'png' END AS suffix, count(*) AS files FROM pages
            WHERE page_id % 3 < 2 GROUP BY 1""")


def mixed_case(s, d) -> DataFrame:
    status = F.when(key() % 3 == 0, F.lower(F.concat(F.lit(" "), "status"))).when(key() % 3 == 1, None).otherwise(F.col("status"))
    return exports.load_valid(jobs(s, d).withColumn("status", status)).select("job_id", "status")


QUERIES.add("deliverable_rows", "S7", mixed_case,
            f"""{SQL} SELECT job_id, CASE k % 3 WHEN 0 THEN lower(' ' || status) WHEN 1 THEN NULL ELSE status END AS status FROM jobs
            WHERE k % 3 = 1 OR status = 'SUCCESS'""")


def form(s, d) -> DataFrame:
    return delivery.form_rows(reports.export_row(jobs(s, d)), "dmy")


FORM = """SELECT job_id, coalesce(vendor, '') AS vendor, coalesce(strftime(CAST(invoice_date AS date), '%d/%m/%Y'), '') AS date,
  coalesce(CAST(total_amount AS string), '') AS total FROM jobs"""
QUERIES.add("form_rows", "P15 F5 F16 C9", form, f"{SQL} {FORM}")


def post(row: dict) -> bool:
    """A form stand-in: unreachable for every third job, and rejecting every fifth."""
    number = int(row["job_id"])
    if number % 3 == 0:
        raise ConnectionError("down")
    return number % 5 != 0


def delivered(s, d) -> DataFrame:
    return delivery.deliver(form(s, d), post, sleep=lambda _: None)


DELIVERED = """o AS (SELECT job_id, k % 3 <> 0 AND k % 5 <> 0 AS ok, CASE WHEN k % 3 = 0 OR k % 5 = 0 THEN 3 ELSE 1 END AS attempts FROM jobs)"""
QUERIES.add("delivery_outcomes", "S8 X3", delivered, f"{SQL}, {DELIVERED} SELECT * FROM o")
QUERIES.add("delivery_report", "A12 C9", lambda s, d: delivery.delivery_report(delivered(s, d)),
            f"""{SQL}, {DELIVERED} SELECT count(*) AS attempted, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed,
            count(*) = 0 AS skipped_no_valid FROM o""")


def delivered_twice(s, d) -> DataFrame:
    """Half of the rows delivered, then all of them by the same ledger: the first half's successes are not posted again."""
    rows, ledger = form(s, d), f"{run_folder(s)}/deliveries-{uuid.uuid4().hex}"
    delivery.deliver(rows.filter(key() % 2 == 0), post, sleep=lambda _: None, ledger=ledger)
    return delivery.deliver(rows, post, sleep=lambda _: None, ledger=ledger)


QUERIES.add("ledgered_deliveries", "S8 X3 C9", delivered_twice, f"""{SQL}, {DELIVERED}
    SELECT job_id, ok, CASE WHEN ok THEN 'delivered' ELSE 'failed' END AS state, NOT (ok AND CAST(job_id AS bigint) % 2 = 0) AS posted,
           CASE WHEN NOT ok AND CAST(job_id AS bigint) % 2 = 0 THEN 2 * attempts ELSE attempts END AS attempts FROM o""")


def changed_in_place(s, d) -> DataFrame:
    """The job table kept in buckets: corrections of some jobs, then new jobs, each a version that rewrites few buckets."""
    table = KeyedTable(s, f"{run_folder(s)}/jobs-{uuid.uuid4().hex}")
    table.create(jobs(s, d), "job_id", 16)
    changes = jobs(s, d).filter(key() % 11 == 0).select("job_id", F.lit("SUCCESS").alias("status"), F.lit("HUMAN").alias("source"),
                                                        F.lit(None).cast("string").alias("last_error"))
    table.change(changes, lambda rows, new: J.upsert(rows, new, now=now()))
    more = jobs(s, d).filter(key() % 13 == 0).withColumn("job_id", F.concat(F.lit("n"), "job_id"))
    table.change(more, lambda rows, new: rows.unionByName(new))
    return table.read().withColumn("updated_at", stamp(F.col("updated_at")))


QUERIES.add("jobs_changed_in_place", "J7 J8 S6", changed_in_place, f"""{SQL}
    SELECT * EXCLUDE (k) REPLACE (CASE WHEN k % 11 = 0 THEN 'SUCCESS' ELSE status END AS status, CASE WHEN k % 11 = 0 THEN 'HUMAN' ELSE source END AS source,
        CASE WHEN k % 11 <> 0 THEN last_error END AS last_error, CASE WHEN k % 11 = 0 THEN '{NOW}' ELSE strftime(updated_at, '%Y-%m-%d %H:%M:%S') END AS updated_at) FROM jobs
    UNION ALL SELECT * EXCLUDE (k) REPLACE ('n' || job_id AS job_id, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at) FROM jobs WHERE k % 13 = 0""")


def finished(s, d) -> DataFrame:
    """A whole bounded run with a model that answers every second job and only in later, stricter rounds."""
    from docfields.catalog.requests import stubborn

    run = run_rounds(fixtures.receipt_words(s, d), stubborn, today(), now=now(), sleep=lambda _: None)
    return run.jobs.select("job_id", "status", "vendor", "total_amount", "source", "retry_count")


def finished_parts(s, d):
    from docfields.catalog.requests import stubborn

    return run_rounds(fixtures.receipt_words(s, d), stubborn, today(), now=now(), sleep=lambda _: None)


ROUNDS = f"""WITH {S.FIELDS}, {S.validated("rule_payloads", TODAY)}, j AS (
  SELECT CAST(job_id AS bigint) AS k, route = 'VALIDATE' AS trusted, route = 'VALIDATE' AND ok AS ruled, errors FROM validated),
first AS (SELECT *, NOT trusted AS asked, NOT ruled AS open FROM j)"""
# Round 1 asks the weak documents and gets nothing; round 2 asks all that failed once, strictly: even jobs are answered.
QUERIES.add("finished_run_counters", "C10 A11", lambda s, d: finished_parts(s, d).counters, f"""{ROUNDS},
  n AS (SELECT count(*) FILTER (asked) AS a, count(*) FILTER (open) AS o, count(*) FILTER (open AND k % 2 = 1) AS odd,
        count(*) FILTER (NOT open) AS ruled FROM first)
  SELECT 'llm_fallback_routed' AS name, a AS n FROM n UNION ALL SELECT 'llm_batch_calls', (a + 2) // 3 + (o + 2) // 3 FROM n
  UNION ALL SELECT 'llm_single_calls', a + odd FROM n UNION ALL SELECT 'llm_invocations', (a + 2) // 3 + (o + 2) // 3 + a + odd FROM n
  UNION ALL SELECT 'retry_scheduled', o FROM n UNION ALL SELECT 'success_total', ruled + o - odd FROM n UNION ALL SELECT 'dlq_entries', odd FROM n""")
QUERIES.add("finished_run_reviews", "C10 P16 P18",
            lambda s, d: finished_parts(s, d).reviews.select("job_id", "status", "stage_failed", "reason", "retry_count", "llm_last_raw",
                                                              F.size(F.from_json("retry_history", "array<struct<n:int,stage:string>>")).alias("failures")),
            f"""{ROUNDS} SELECT CAST(k AS string) AS job_id, 'NEEDS_REVIEW' AS status, 'llm' AS stage_failed,
            'llm_parse_failed_after_retry' AS reason, 2 AS retry_count, 'no' AS llm_last_raw, 2 AS failures FROM first WHERE open AND k % 2 = 1""")
QUERIES.add("finished_run", "C10 C4 C5 C6 C7 X1", finished, f"""WITH {S.FIELDS}, {S.validated("rule_payloads", TODAY)}
  SELECT job_id, CASE WHEN ruled OR CAST(job_id AS bigint) % 2 = 0 THEN 'SUCCESS' ELSE 'NEEDS_REVIEW' END AS status,
         CASE WHEN ruled THEN trim(vendor) WHEN CAST(job_id AS bigint) % 2 = 0 THEN 'Store ' || job_id END AS vendor,
         CASE WHEN ruled THEN round(total, 2) WHEN CAST(job_id AS bigint) % 2 = 0 THEN 7.5e0 END AS total_amount,
         CASE WHEN ruled THEN 'OCR_RULE' WHEN CAST(job_id AS bigint) % 2 = 0 THEN 'LLM' END AS source,
         CASE WHEN ruled THEN 0 WHEN CAST(job_id AS bigint) % 2 = 1 THEN 2 ELSE 1 END AS retry_count
  FROM (SELECT *, route = 'VALIDATE' AND ok AS ruled FROM validated)""")
