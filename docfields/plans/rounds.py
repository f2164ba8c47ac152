"""A bounded run from words to finished jobs."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfields.functions.text import NEGATIVE_PHRASES
from docfields.operators.jobs import advance_jobs, review_records
from docfields.operators.requests import ask_and_count, counted
from docfields.operators.routing import extract_fields, llm_payload, route, rule_payload
from docfields.operators.scans import HOT_ROWS
from docfields.operators.validation import validate
from docfields.session import materialise
from docfields.sources.ledgers import exists

OUTCOME = ("job_id", "stage", "ok", "error", "strategy", "vendor", "invoice_date", "total_amount", "confidence", "source", "raw")


@dataclass
class Run:
    """Finished jobs, every failed attempt, a record for each job sent to review, and what was counted on the way."""

    jobs: DataFrame
    attempts: DataFrame
    reviews: DataFrame
    counters: DataFrame


def starting_jobs(rules: DataFrame, max_failures: int, now: Column) -> DataFrame:
    """A job for each document that the rules saw."""
    text = F.lit(None).cast("string")
    return rules.select(
        F.col("doc_id").cast("string").alias("job_id"), F.col("doc_id").cast("string").alias("image_path"),
        text.alias("vendor"), text.alias("invoice_date"),
        F.lit(None).cast("double").alias("total_amount"), F.lit(None).cast("double").alias("confidence"),
        text.alias("source"), F.lit("OCR_DONE").alias("status"), F.lit(0).alias("retry_count"),
        F.lit(max_failures).alias("max_retries"), text.alias("failure_class"), text.alias("attempt_strategy"),
        text.alias("last_error"), text.alias("llm_last_raw"), now.alias("updated_at"), text.alias("next_strategy"),
        F.lit(None).cast("timestamp").alias("due_at"),
    )


def validation_outcomes(payloads: DataFrame, strategies: DataFrame, today: Column) -> DataFrame:
    """Validated payloads as outcomes; ``strategies`` (job_id, strategy, raw) says what each was obtained with."""
    checked = validate(payloads, today).join(strategies, "job_id", "left")
    return checked.select(
        "job_id", F.lit("validation").alias("stage"), "ok", F.array_join("errors", ",").alias("error"), "strategy",
        F.col("norm_vendor").alias("vendor"), F.date_format("norm_date", "yyyy-MM-dd").alias("invoice_date"),
        F.col("norm_total").alias("total_amount"), "confidence", "source", "raw",
    )


def model_outcomes(answers: DataFrame, today: Column) -> DataFrame:
    """Outcomes of one round of model answers: unreadable ones fail in stage ``llm``, the rest are validated."""
    unreadable = answers.filter(~F.col("parsed")).select(
        "job_id", F.lit("llm").alias("stage"), F.lit(False).alias("ok"), F.lit("empty_parse").alias("error"), "strategy",
        F.lit(None).cast("string").alias("vendor"), F.lit(None).cast("string").alias("invoice_date"),
        F.lit(None).cast("double").alias("total_amount"), F.lit(None).cast("double").alias("confidence"),
        F.lit(None).cast("string").alias("source"), F.col("response").alias("raw"),
    )
    read = answers.filter("parsed")
    tried = read.select("job_id", "strategy", F.col("response").alias("raw"))
    return unreadable.unionByName(validation_outcomes(llm_payload(read), tried, today))


def review_of(jobs: DataFrame, attempts: DataFrame, now: Column) -> DataFrame:
    """P16 for jobs that have just reached review, with their failures as JSON (at most ``max_retries`` of them)."""
    entry = F.struct("n", "stage", "error", "strategy")
    told = attempts.groupBy("job_id").agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("retry_history"))
    none = F.lit(None).cast("string")
    rows = jobs.filter("status = 'NEEDS_REVIEW'").join(told, "job_id", "left").withColumns(
        {"ocr_snapshot": none, "extraction_payload": none})
    return review_records(rows, F.col("failure_class"), F.col("last_error"), now)


def run_rounds(
    words: DataFrame, call: Callable[[str], str], today: Column, max_failures: int = 2, now: Column | None = None,
    phrases=NEGATIVE_PHRASES, hot_rows: int | None = HOT_ROWS, sleep: Callable[[float], None] = time.sleep,
    rpm: float | None = None, state: str | None = None,
) -> Run:
    """Extract, route, ask the model where needed, validate, and retry what failed.

    At most ``max_failures`` rounds follow the first, because each open job fails once in every one of them. Words are
    read once, for the rules and the texts of routed documents. Every round is written out, so its plan starts
    from a table and the model is never asked twice for the same round; only open jobs go on to the next.

    ``state`` is a folder of this run alone. A run that was stopped goes on from there: tables that are complete (their
    writer leaves a mark) are read, a round whose last table is complete is not run again, and the model's answers of the
    round that was under way come from a ledger. Both runs need the same words, ``today`` and ``now``.
    """
    spark = words.sparkSession
    now = F.current_timestamp() if now is None else now
    ledger = None if state is None else f"{state}/answers"

    def complete(name: str) -> bool:
        return state is not None and exists(spark, f"{state}/{name}/_SUCCESS")

    def keep(make: Callable[[], DataFrame], name: str) -> DataFrame:
        if state is None:
            return materialise(make(), name)
        if not complete(name):
            make().write.mode("overwrite").parquet(f"{state}/{name}")
        return spark.read.parquet(f"{state}/{name}")

    rules = keep(lambda: route(extract_fields(words, phrases, hot_rows, texts=True)), "rules")
    trusted, weak = rules.filter("route = 'VALIDATE'"), rules.filter("route = 'LLM'")
    texts = weak.select(F.col("doc_id").cast("string").alias("job_id"), "text")
    untried = spark.createDataFrame([], "job_id string, strategy string, raw string")
    outcomes = validation_outcomes(rule_payload(trusted), untried, today)
    todo = weak.select(F.col("doc_id").cast("string").alias("job_id"), F.lit("default").alias("strategy"))
    jobs, finished, failures, calls = starting_jobs(rules, max_failures, now), [], [], []
    for n in range(max_failures + 1):
        before, known, took = jobs, outcomes, None
        if not complete(f"round-{n}-calls"):
            asked = todo.join(texts, "job_id", "left").withColumns({"text": F.coalesce("text", F.lit("")), "file": F.col("job_id")})
            answers, took = ask_and_count(asked, call, sleep=sleep, rpm=rpm, ledger=ledger)
            known = known.unionByName(model_outcomes(answers, today))
        outcomes = keep(lambda: known.select(*OUTCOME), f"round-{n}-outcomes")  # noqa: B023
        jobs = keep(lambda: advance_jobs(before, outcomes, now), f"round-{n}-jobs")  # noqa: B023
        took = keep(lambda: took, f"round-{n}-calls")  # noqa: B023
        finished.append(jobs.filter("status <> 'RETRY_SCHEDULED'"))
        failures.append(outcomes.filter(~F.col("ok")).select("job_id", "stage", "error", "strategy", now.alias("ts"), F.lit(n).alias("n")))
        jobs = jobs.filter("status = 'RETRY_SCHEDULED'")
        calls += [took, counted("retry_scheduled", jobs)]
        todo = jobs.select("job_id", F.col("next_strategy").alias("strategy"))
        if todo.isEmpty():
            break
        outcomes = outcomes.limit(0)
    done = reduce(DataFrame.unionByName, [*finished, jobs])
    attempts = reduce(DataFrame.unionByName, failures)
    reviews = keep(lambda: review_of(done, attempts, now), "reviews")
    status = {"success_total": "SUCCESS", "dlq_entries": "NEEDS_REVIEW"}
    counts = reduce(DataFrame.union, [
        *calls, counted("llm_fallback_routed", weak), *[counted(k, done.filter(F.col("status") == v)) for k, v in status.items()]])
    every = counts.union(counts.filter("name in ('llm_batch_calls', 'llm_single_calls')").select(F.lit("llm_invocations").alias("name"), "n"))
    return Run(done, attempts.drop("n"), reviews, every.groupBy("name").agg(F.sum("n").alias("n")))
