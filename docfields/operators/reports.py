"""Exports and run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfields.functions.text import strip
from docfields.session import materialise

BUCKETS = ("valid_invoices", "needs_human_review", "legacy_dlq", "non_terminal")


def bucket(status: Column) -> Column:
    """The export bucket of a job."""
    return (
        F.when(status == "SUCCESS", BUCKETS[0]).when(status == "NEEDS_REVIEW", BUCKETS[1])
        .when(status == "DLQ", BUCKETS[2]).otherwise(BUCKETS[3])
    )


def export_row(jobs: DataFrame, *extra: Column) -> DataFrame:
    """The ten exported columns."""
    return jobs.select(
        "job_id", F.col("image_path").alias("file"), "vendor", F.col("invoice_date").alias("date"),
        F.col("total_amount").alias("total"), "confidence", "source", "status", "retry_count", "last_error", *extra,
    )


def export_buckets(jobs: DataFrame) -> DataFrame:
    """Every exported row with its bucket."""
    return export_row(jobs, bucket(F.col("status")).alias("bucket"))


def source_histogram(jobs: DataFrame) -> DataFrame:
    """Jobs by source, null and empty as ``unset``."""
    name = F.coalesce(F.nullif(F.col("source"), F.lit("")), F.lit("unset"))
    return jobs.groupBy(name.alias("source")).agg(F.count(F.lit(1)).alias("jobs"))


def observability(jobs: DataFrame, has_snapshot: Column) -> DataFrame:
    """How many jobs were recognised, accepted by rules alone, and filled by the model."""
    return jobs.agg(
        F.count_if(has_snapshot).alias("jobs_with_ocr_snapshot"),
        F.count_if((F.col("status") == "SUCCESS") & (F.col("source") == "OCR_RULE"))
        .alias("terminal_success_with_rule_extraction_only"),
        F.count_if(F.col("source").isin("OCR_LLM", "LLM")).alias("jobs_with_llm_sourced_extraction"),
    )


def summary(jobs: DataFrame) -> DataFrame:
    """Jobs per bucket and in all."""
    b = bucket(F.col("status"))
    names = ("success_count", "needs_human_review_count", "legacy_dlq_count", "non_terminal_count")
    return jobs.agg(
        *[F.count_if(b == kind).alias(name) for kind, name in zip(BUCKETS, names)],
        F.count(F.lit(1)).alias("total_jobs_in_export"),
    )


def failure(last_error: Column) -> Column:
    """What a job's last error is counted as."""
    return F.coalesce(F.nullif(F.substring(strip(last_error), 1, 120), F.lit("")), F.lit("(no last_error)"))


def failure_modes(jobs: DataFrame, top: int = 25) -> DataFrame:
    """The most frequent errors among jobs that did not succeed (U1: three buckets in one filter)."""
    error = failure(F.col("last_error"))
    failed = jobs.filter(bucket(F.col("status")) != BUCKETS[0])
    return (
        failed.groupBy(error.alias("error")).agg(F.count(F.lit(1)).alias("jobs"))
        .orderBy(F.desc("jobs"), "error").limit(top)
    )


def evaluation(jobs: DataFrame, has_snapshot: Column) -> DataFrame:
    """A10: outcome counts of a run in one row, from one pass."""
    b = bucket(F.col("status"))
    n = {kind: F.count_if(b == kind) for kind in BUCKETS}
    open_or_failed = n[BUCKETS[1]] + n[BUCKETS[2]] + n[BUCKETS[3]]
    return jobs.agg(
        F.count(F.lit(1)).alias("receipt_count"), n[BUCKETS[0]].alias("success"),
        n[BUCKETS[1]].alias("needs_human_review"), n[BUCKETS[2]].alias("legacy_dlq"),
        n[BUCKETS[3]].alias("non_terminal_stuck"), open_or_failed.alias("failed_or_incomplete"),
        F.count_if(has_snapshot).alias("jobs_with_ocr_snapshot"),
        F.count_if((F.col("status") == "SUCCESS") & (F.col("source") == "OCR_RULE")).alias("rule_only_success"),
        F.count_if(F.col("source").isin("OCR_LLM", "LLM")).alias("llm_sourced"),
    )


def run_profile(jobs: DataFrame, has_snapshot: Column) -> DataFrame:
    """How many jobs there are of each bucket, source, error (null for accepted jobs) and snapshot or none, from one pass.

    Everything a report says is a sum over these rows, of which there are about as many as distinct errors.
    """
    b = bucket(F.col("status"))
    source = F.coalesce(F.nullif(F.col("source"), F.lit("")), F.lit("unset"))
    return jobs.groupBy(
        b.alias("bucket"), source.alias("source"), F.when(b != BUCKETS[0], failure(F.col("last_error"))).alias("error"),
        F.coalesce(has_snapshot, F.lit(False)).alias("has_snapshot"),
    ).agg(F.count(F.lit(1)).alias("n"))


def report_of(profile: DataFrame, metrics: DataFrame, top: int = 25) -> DataFrame:
    """Everything an export says beside its rows, in one row: ``outcomes``, ``summary``, ``observability``,
    ``source_histogram``, ``metrics`` (name, n; ``ocr_success`` is what the rules alone got accepted) and
    ``failure_modes``.

    ``profile`` is that of :func:`run_profile`, as a table. The histogram has one entry for each of the known sources, and
    the other lists are bounded by ``top`` and by the names that are counted.
    """
    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")

    b, true = F.col("bucket"), F.lit(True)
    success, review, legacy, stuck = (total(b == kind) for kind in BUCKETS)
    snapshots = total(F.col("has_snapshot"))
    rules, model = total((b == BUCKETS[0]) & (F.col("source") == "OCR_RULE")), total(F.col("source").isin("OCR_LLM", "LLM"))
    names = ("success_count", "needs_human_review_count", "legacy_dlq_count", "non_terminal_count")
    counts = profile.agg(
        F.struct(total(true).alias("receipt_count"), success.alias("success"), review.alias("needs_human_review"), legacy.alias("legacy_dlq"),
                 stuck.alias("non_terminal_stuck"), total(b != BUCKETS[0]).alias("failed_or_incomplete"), snapshots.alias("jobs_with_ocr_snapshot"),
                 rules.alias("rule_only_success"), model.alias("llm_sourced")).alias("outcomes"),
        F.struct(*[c.alias(name) for c, name in zip((success, review, legacy, stuck), names)], total(true).alias("total_jobs_in_export")).alias("summary"),
        F.struct(snapshots.alias("jobs_with_ocr_snapshot"), rules.alias("terminal_success_with_rule_extraction_only"),
                 model.alias("jobs_with_llm_sourced_extraction")).alias("observability"))

    def listed(rows: DataFrame, *columns: str, by: tuple[str, ...] = ()) -> Column:
        """The rows as an array in the order of ``by`` and ``columns``."""
        found = F.array_sort(F.collect_list(F.struct(*by, *columns)))
        return rows.agg(F.transform(found, lambda e: F.struct(*[e[c].alias(c) for c in columns]))).scalar()

    sources = profile.groupBy("source").agg(F.sum("n").alias("jobs"))
    modes = profile.filter("error IS NOT NULL").groupBy("error").agg(F.sum("n").alias("jobs")).orderBy(F.desc("jobs"), "error").limit(top)
    told = metrics.select("name", F.col("n").cast("long").alias("n")).filter("name <> 'ocr_success'").union(profile.agg(rules).select(F.lit("ocr_success"), "*"))
    ranked = modes.withColumn("rank", -F.col("jobs"))
    return counts.select(
        "*", listed(sources, "source", "jobs").alias("source_histogram"), listed(told, "name", "n").alias("metrics"),
        listed(ranked, "error", "jobs", by=("rank",)).alias("failure_modes"))


def run_report(jobs: DataFrame, has_snapshot: Column, metrics: DataFrame, top: int = 25) -> DataFrame:
    """:func:`report_of` the profile of ``jobs``, which are read once."""
    return report_of(materialise(run_profile(jobs, has_snapshot), "profile"), metrics, top)
