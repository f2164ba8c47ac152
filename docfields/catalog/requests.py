"""Queries on model requests and responses."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfields import fixtures
from docfields.catalog import Catalog
from docfields.catalog import sql as S
from docfields.operators import requests as R
from docfields.operators import routing
from docfields.session import run_folder

QUERIES = Catalog()

requests = fixtures.requests


def parsed(s, d) -> DataFrame:
    return R.parse_batch(fixtures.responses(s, d), "batch_id")


def batched(s, d) -> DataFrame:
    """Requests in calls of three, in the order of their number."""
    numbered = requests(s, d).withColumn("k", F.col("job_id").cast("long"))
    return R.assign_batches(numbered, 3, ("k",))


BATCHED = f"""WITH {S.RESPONSES}, batched AS (
  SELECT *, CAST((row_number() OVER (ORDER BY k) - 1) % 3 AS int) AS slot,
         concat_ws('-', 0, (row_number() OVER (ORDER BY k) - 1) // 3) AS batch FROM requests)"""
RANKED = """CASE max(CASE strategy WHEN 'ocr_retry' THEN 3 WHEN 'after_validation_fail' THEN 2 WHEN 'strict_json' THEN 1 ELSE 0 END)
  WHEN 3 THEN 'ocr_retry' WHEN 2 THEN 'after_validation_fail' WHEN 1 THEN 'strict_json' ELSE 'default' END"""

QUERIES.add("model_responses", "S2", fixtures.responses, f"WITH {S.RESPONSES} SELECT * FROM responses")
QUERIES.add("request_batches", "W5 T2", lambda s, d: batched(s, d).select("job_id", "batch", "slot"),
            f"{BATCHED} SELECT job_id, batch, slot FROM batched")


def bucketed(s, d) -> DataFrame:
    numbered = requests(s, d).withColumn("k", F.col("job_id").cast("long"))
    return R.assign_batches(numbered, 3, ("k",), F.col("k") % 8).select("job_id", "batch", "slot")


QUERIES.add(
    "request_batches_by_bucket", "W5", bucketed,
    f"""WITH {S.RESPONSES} SELECT job_id, CAST((row_number() OVER (PARTITION BY k % 8 ORDER BY k) - 1) % 3 AS int) AS slot,
         concat_ws('-', k % 8, (row_number() OVER (PARTITION BY k % 8 ORDER BY k) - 1) // 3) AS batch FROM requests""",
)
QUERIES.add(
    "request_batch_sizes", "W5",
    lambda s, d: R.assign_batches(requests(s, d)).groupBy("batch").agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("batches")),
    """SELECT n, count(*) AS batches FROM (SELECT count(*) AS n FROM (SELECT row_number() OVER () - 1 AS r FROM orders) GROUP BY r // 3) GROUP BY n""",
)


def strict_order(s, d) -> DataFrame:
    numbered = requests(s, d).withColumn("k", F.col("job_id").cast("long"))
    rows = R.assign_batches(numbered, 3, ("arrival", "k"), F.lit(0), hot_rows=1000)
    return rows.select("job_id", "batch", "slot")


QUERIES.add(
    "request_batches_in_arrival_order", "W5", strict_order,
    f"""WITH {S.RESPONSES}, n AS (SELECT job_id, row_number() OVER (ORDER BY arrival, k) - 1 AS r FROM requests)
    SELECT job_id, concat_ws('-', 0, r // 3) AS batch, CAST(r % 3 AS int) AS slot FROM n""",
)
QUERIES.add("merged_strategies", "A13 U3", lambda s, d: R.merge_strategy(batched(s, d)),
            f"{BATCHED} SELECT batch, {RANKED} AS strategy FROM batched GROUP BY batch")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _notes(notes: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {_quoted(note)}" for name, note in notes.items())
    return f"CASE strategy {cases} ELSE {_quoted(notes['default'])} END"


QUERIES.add(
    "batch_prompts", "F29 A13", lambda s, d: R.batch_prompt(batched(s, d).withColumn("text", F.concat("job_id", F.lit(" words")))),
    f"""{BATCHED}, g AS (SELECT batch, {RANKED} AS strategy, string_agg('### Invoice ' || (slot + 1) || chr(10) || 'job_id: ' || job_id
        || chr(10) || 'file: ' || file || chr(10) || 'text:' || chr(10) || job_id || ' words' || chr(10), chr(10) ORDER BY slot) AS body
        FROM batched GROUP BY batch)
    SELECT batch, strategy, {_quoted(R.BATCH_HEAD)} || chr(10) || {_notes(R.BATCH_NOTES)} || chr(10) || body AS prompt FROM g""",
)
QUERIES.add(
    "single_prompts", "F28",
    lambda s, d: requests(s, d).select("job_id", R.prompt(F.col("file"), F.col("strategy")).alias("prompt")),
    f"""WITH {S.RESPONSES} SELECT job_id, {_notes(R.SINGLE_NOTES)} || {_quoted(chr(10) + R.SINGLE_SHAPE + chr(10) + chr(10))}
        || 'Receipt text:' || chr(10) || file AS prompt FROM requests""",
)
QUERIES.add("parsed_responses", "F31 F17 F18 W6", parsed, f"WITH {S.RESPONSES} SELECT * FROM parsed")
QUERIES.add(
    "answered_requests", "J4", lambda s, d: R.match_responses(requests(s, d).select("batch_id", "job_id"), parsed(s, d), "batch_id"),
    f"WITH {S.RESPONSES} SELECT p.* FROM requests r JOIN parsed p USING (batch_id, job_id)",
)
QUERIES.add(
    "unanswered_requests", "J5",
    lambda s, d: R.missing_jobs(requests(s, d), parsed(s, d), "batch_id").select("batch_id", "job_id", "strategy"),
    f"WITH {S.RESPONSES} SELECT batch_id, job_id, strategy FROM requests ANTI JOIN parsed USING (batch_id, job_id)",
)


def single_responses(s, d) -> DataFrame:
    """One raw response per order, some prose, some numbers that cannot be read, some without any object."""
    k, amount = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    total = (F.when(k % 5 == 0, amount).when(k % 5 == 1, F.concat(F.lit('"RM '), amount, F.lit('"')))
             .when(k % 5 == 2, '""').when(k % 5 == 3, '"n/a"').otherwise("null"))
    body = F.concat(F.lit('{"vendor": "V '), k, F.lit('", "total": '), total, F.lit(', "date": null}'))
    response = F.when(k % 7 == 0, "nothing found").when(k % 7 == 1, F.concat(F.lit("Sure: "), body, F.lit(" Done."))).otherwise(body)
    return fixtures.table(s, d, "orders").select(k.cast("string").alias("job_id"), response.alias("response"))


QUERIES.add(
    "single_answers", "F30 F17 F18",
    lambda s, d: single_responses(s, d).select("job_id", R.parse_single(F.col("response")).alias("p")).select(
        "job_id", F.col("p").isNotNull().alias("parsed"), "p.vendor", "p.total"),
    """WITH a AS (SELECT o_orderkey AS k, o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 3 AS ok, o_totalprice FROM orders)
    SELECT CAST(k AS string) AS job_id, ok AS parsed, CASE WHEN ok THEN 'V ' || k END AS vendor,
           CASE WHEN ok AND k % 5 < 2 THEN CAST(CAST(o_totalprice AS decimal(12,2)) AS double) END AS total FROM a""",
)


def combined(s, d) -> DataFrame:
    """Batch answers, and single answers for what the batches left open."""
    wanted = requests(s, d).select("batch_id", "job_id", "strategy")
    read = parsed(s, d)
    first = R.match_responses(wanted, read, "batch_id").select("job_id", "vendor", "total", F.lit(True).alias("parsed"))
    missing = R.missing_jobs(wanted, read, "batch_id")
    second = R.apply_single(missing, single_responses(s, d)).select("job_id", "vendor", "total", "parsed")
    return R.all_parsed(first, second)


QUERIES.add(
    "combined_answers", "U5 J4 J5 C5", combined,
    f"""WITH {S.RESPONSES}, a AS (SELECT o_orderkey AS k, o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 3 AS ok, o_totalprice FROM orders)
    SELECT job_id, vendor, total, true AS parsed FROM requests JOIN parsed USING (batch_id, job_id)
    UNION ALL
    SELECT r.job_id, CASE WHEN ok THEN 'V ' || a.k END, CASE WHEN ok AND a.k % 5 < 2 THEN CAST(CAST(o_totalprice AS decimal(12,2)) AS double) END, ok
    FROM requests r JOIN a ON a.k = r.k ANTI JOIN parsed p ON p.batch_id = r.batch_id AND p.job_id = r.job_id""",
)
QUERIES.add(
    "model_payloads", "P9", lambda s, d: routing.llm_payload(parsed(s, d)),
    f"""WITH {S.RESPONSES} SELECT job_id, vendor, total, date, 0.85e0 AS vendor_conf, 0.85e0 AS total_conf, 0.85e0 AS date_conf,
        0.85e0 AS confidence, 'LLM' AS source, true AS llm_used FROM parsed""",
)


def merged(s, d) -> DataFrame:
    rules = requests(s, d).select(
        "job_id", F.col("file").alias("vendor"), F.lit(1.5).alias("total"), F.lit("01/01/1999").alias("date"))
    model = parsed(s, d).withColumn("total", F.when(F.col("job_id").cast("long") % 8 == 0, 0.0).otherwise(F.col("total")))
    return routing.merge_fields(rules, model)


QUERIES.add(
    "merged_fields", "P10", merged,
    f"""WITH {S.RESPONSES} SELECT r.job_id, coalesce(nullif(p.vendor, ''), r.file) AS vendor,
       coalesce(CASE WHEN r.k % 8 = 0 THEN NULL ELSE nullif(p.total, 0) END, 1.5e0) AS total,
       coalesce(nullif(p.date, ''), '01/01/1999') AS date
    FROM requests r LEFT JOIN parsed p USING (job_id)""",
)


def echo(prompt: str) -> str:
    """A model stand-in: answers every job of a batch but those divisible by 5, then those one by one."""
    if "### Invoice" in prompt:
        ids = [i for i in re.findall(r"job_id: (\S+)", prompt) if int(i) % 5]
        return json.dumps({"results": [{"job_id": i, "vendor": f"B {i}", "total": f"RM {i}.25", "date": None} for i in ids]})
    number = re.search(r"images/(\d+)\.jpg", prompt).group(1)
    return "not today" if int(number) % 10 == 0 else f'Here: {{"vendor": "S {number}", "total": {number}.5, "date": null}}'


def asked(s, d) -> DataFrame:
    answers = R.ask_model(requests(s, d).withColumn("text", F.col("file")).drop("batch_id"), echo)
    return answers.select("job_id", "vendor", "total", "parsed", "calls")


QUERIES.add(
    "model_answers", "X1 C5", asked,
    f"""WITH {S.RESPONSES} SELECT job_id, CASE WHEN k % 5 <> 0 THEN 'B ' || k WHEN k % 10 <> 0 THEN 'S ' || k END AS vendor,
       CASE WHEN k % 5 <> 0 THEN k + 0.25e0 WHEN k % 10 <> 0 THEN k + 0.5e0 END AS total, k % 10 <> 0 AS parsed,
       CASE WHEN k % 5 <> 0 THEN 'batch' ELSE 'single' END AS calls FROM requests""",
)


def asked_twice(s, d) -> DataFrame:
    """Half of the prompts asked, then all of them by the same ledger: how many answers it has, and how many by the second."""
    prompts = requests(s, d).select("job_id", R.prompt(F.col("file"), F.col("strategy")).alias("prompt"))
    ledger = f"{run_folder(s)}/answers-{uuid.uuid4().hex}"
    R.call_model(prompts.filter(F.col("job_id").cast("long") % 2 == 0), echo, "job_id", ledger=ledger)
    first = R.read_log(s, ledger, R.ANSWERED).count()
    answers = R.call_model(prompts, echo, "job_id", ledger=ledger)
    logged = R.read_log(s, ledger, R.ANSWERED).agg(F.count(F.lit(1)).alias("calls"), F.countDistinct("hash").alias("prompts"))
    return answers.agg(F.count(F.lit(1)).alias("answers"), F.count_if(F.col("response") == "not today").alias("refused")).join(
        logged.select("*", (F.col("calls") - first).alias("calls_of_second_run")))


QUERIES.add("ledgered_calls", "X1 C5", asked_twice, """SELECT count(*) AS answers, count(*) FILTER (o_orderkey % 10 = 0) AS refused, count(*) AS calls,
    count(*) AS prompts, count(*) FILTER (o_orderkey % 2 = 1) AS calls_of_second_run FROM orders""")


def stubborn(prompt: str) -> str:
    """A model stand-in that fails until asked more strictly, and never answers an odd-numbered job."""
    if "### Invoice" not in prompt or not any(note and note in prompt for note in R.BATCH_NOTES.values()):
        return "no"
    ids = [i for i in re.findall(r"job_id: (\S+)", prompt) if int(i) % 2 == 0]
    return json.dumps({"results": [{"job_id": i, "vendor": f"Store {i}", "total": 7.5, "date": "1997-05-04"} for i in ids]})
