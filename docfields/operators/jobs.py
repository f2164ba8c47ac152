"""The job table and its changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfields.functions.retries import backoff, next_strategy, retry_outcome
from docfields.functions.text import clip, job_id, truncate_json
from docfields.operators.scans import HOT_ROWS, OrderedRows, latest, scan_by_key
from docfields.schema import TERMINAL

REVIEW_RAW_LIMIT = 4000


def is_terminal(status: Column) -> Column:
    """Nothing more happens to the job by itself."""
    return status.isin(*TERMINAL)


def skips_validation(status: Column) -> Column:
    """A job already accepted is not validated again."""
    return status == "SUCCESS"


def has_items(json_list: Column) -> Column:
    """An empty JSON list or object counts as missing, like null."""
    return F.coalesce(~F.regexp_replace(json_list, r"\s+", "").isin("", "[]", "{}", "null"), F.lit(False))


def processable(jobs: DataFrame, column: str = "ocr_snapshot") -> DataFrame:
    """Jobs that have what the next stage reads."""
    return jobs.filter(has_items(F.col(column)))


def job_for(jobs: DataFrame, keys: DataFrame) -> DataFrame:
    """Keys with their job; unknown keys drop out."""
    return keys.join(jobs, "job_id")


def jobs_for(jobs: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The whole table, or the jobs named in ``ids``; a short list is broadcast by size, a long one is not."""
    return jobs if ids is None else jobs.join(ids.select("job_id"), "job_id", "left_semi")


def ingest(jobs: DataFrame, files: DataFrame, max_retries: int = 2) -> DataFrame:
    """What ingesting ``files`` (path) does, file by file: ``new``, ``requeue`` (still pending) or ``skip``."""
    keyed = files.select("path", job_id(F.col("path")).alias("job_id")).dropDuplicates(["job_id"])
    known = jobs.select("job_id", "status")
    action = F.when(F.col("status").isNull(), "new").when(F.col("status") == "PENDING", "requeue").otherwise("skip")
    return keyed.join(known, "job_id", "left").select(
        "job_id", "path", action.alias("action"), F.lit(max_retries).alias("max_retries")
    )


def new_jobs(actions: DataFrame) -> DataFrame:
    """Rows to append to the job table after :func:`ingest`."""
    return actions.filter("action = 'new'").select(
        "job_id", F.col("path").alias("image_path"), F.lit("PENDING").alias("status"), F.lit(0).alias("retry_count"),
        "max_retries",
    )


def may_start(status: Column) -> Column:
    """Recognition skips jobs that are finished and those that another task is working on."""
    return ~is_terminal(status) & (status != "PROCESSING")


def upsert(existing: DataFrame, changes: DataFrame, key: str = "job_id", now: Column | None = None) -> DataFrame:
    """Overwrite the changed columns of known keys, nulls included; unknown keys change nothing.

    ``changes`` has one row per key; :func:`latest` makes it so where it may not. ``updated_at`` of changed rows moves
    to ``now`` (by default the time of the run).
    """
    changed = [c for c in changes.columns if c != key]
    incoming = changes.select(key, F.struct(*changed).alias("_new"))
    joined = existing.join(incoming, key, "left")
    hit = F.col("_new").isNotNull()
    values = {c: F.col(f"_new.{c}") for c in changed}
    if "updated_at" in existing.columns and "updated_at" not in values:
        moved = F.current_timestamp() if now is None else now
        values["updated_at"] = moved.cast(existing.schema["updated_at"].dataType)
    return joined.select(
        *[F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in existing.columns]
    )


def upsert_review(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The review queue with ``new`` records merged in; the latest record of a job wins."""
    kept = existing.join(new.select("job_id"), "job_id", "left_anti")
    return kept.unionByName(latest(new, ["job_id"], ["recorded_at"]).select(*existing.columns))


def apply_corrections(jobs: DataFrame, corrections: DataFrame, now: Column | None = None) -> DataFrame:
    """The latest human correction of a job overwrites its values, nulls too, and closes it."""
    last = latest(corrections.select("job_id", "id", "vendor", "invoice_date", "total_amount"), ["job_id"], ["id"])
    changes = last.select(
        "job_id", "vendor", "invoice_date", "total_amount", F.lit("SUCCESS").alias("status"),
        F.lit("HUMAN").alias("source"),
    )
    return upsert(jobs, changes, now=now)


def jobs_by_status(jobs: DataFrame, status: str, limit: int = 100) -> DataFrame:
    """O1: jobs in a state, newest first."""
    return jobs.filter(F.col("status") == status).orderBy(F.desc("updated_at"), "job_id").limit(limit)


def due_retries(retries: DataFrame, now: Column, limit: int = 50) -> DataFrame:
    """O2: retries that are due, oldest first."""
    return retries.filter(F.col("due_at") <= now).orderBy("due_at", "job_id").limit(limit)


def dedupe_retries(retries: DataFrame) -> DataFrame:
    """Identical envelopes are one, due when the last of them says."""
    envelope = [c for c in retries.columns if c not in ("due_at", "seq")]
    return retries.groupBy(*envelope).agg(F.max_by("due_at", "seq").alias("due_at"))


def completion(ids: DataFrame, jobs: DataFrame) -> DataFrame:
    """Every asked-for job (U2: once) as ``success``, ``needs_review`` (dead letters too) or ``pending``
    (U4: not terminal, or not known at all)."""
    status = F.col("status")
    outcome = (
        F.when(status == "SUCCESS", "success").when(status.isin("NEEDS_REVIEW", "DLQ"), "needs_review")
        .otherwise("pending")
    )
    asked = ids.select("job_id").dropDuplicates(["job_id"])
    return asked.join(jobs.select("job_id", "status"), "job_id", "left").select("job_id", outcome.alias("outcome"))


def pending_jobs(ids: DataFrame, jobs: DataFrame) -> DataFrame:
    """U4: asked-for jobs that are not terminal."""
    done = jobs.filter(is_terminal(F.col("status"))).select("job_id")
    return ids.select("job_id").dropDuplicates(["job_id"]).join(done, "job_id", "left_anti")


def completion_counts(ids: DataFrame, jobs: DataFrame) -> DataFrame:
    return completion(ids, jobs).groupBy("outcome").agg(F.count(F.lit(1)).alias("jobs"))


def attempt_sequence(attempts: DataFrame, order: tuple[str, ...] = ("ts", "error"), hot_rows: int | None = HOT_ROWS):
    """Attempts numbered per job, each with the strategy of the one before."""
    def number(rows: OrderedRows) -> DataFrame:
        return rows.number("attempt_no").lag("previous_strategy", F.col("strategy")).df.drop("chunk")

    return scan_by_key(attempts, ["job_id"], list(order), number, hot_rows)


def attempt_rollup(attempts: DataFrame, order: tuple[str, ...] = ("ts", "error")) -> DataFrame:
    """Failure count and last failure of every job; folds before the shuffle."""
    last = F.max_by(F.struct("stage", "error", "strategy"), F.struct(*order))
    return attempts.groupBy("job_id").agg(F.count(F.lit(1)).alias("retry_count"), last.alias("l")).select(
        "job_id", "retry_count", F.col("l.stage").alias("last_stage"), F.col("l.error").alias("last_error"),
        F.col("l.strategy").alias("last_strategy"),
    )


def attempt_history(attempts: DataFrame, page: int = 1000, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """A15, nested: the history of every job as an ordered array, in pages of at most ``page`` attempts so that no
    array grows with the job. Nearly every job has page 0 only."""
    numbered = attempt_sequence(attempts, hot_rows=hot_rows)
    entry = F.struct("attempt_no", "stage", "error", "strategy")
    return numbered.groupBy("job_id", F.floor((F.col("attempt_no") - 1) / page).alias("page")).agg(
        F.transform(
            F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["stage"], e["error"], e["strategy"])
        ).alias("history")
    )


def review_records(jobs: DataFrame, stage: Column, reason: Column, now: Column) -> DataFrame:
    """What a reviewer sees of a job, long texts cut."""
    return jobs.select(
        "job_id", "image_path", F.lit("NEEDS_REVIEW").alias("status"), stage.alias("stage_failed"),
        reason.alias("reason"), "last_error", "retry_count", "max_retries", "failure_class", "attempt_strategy",
        truncate_json(F.col("ocr_snapshot")).alias("ocr_snapshot"),
        truncate_json(F.col("extraction_payload")).alias("extraction_payload"),
        clip(F.col("llm_last_raw"), REVIEW_RAW_LIMIT).alias("llm_last_raw"), "retry_history", now.alias("recorded_at"),
    )


def apply_success(jobs: DataFrame, validated: DataFrame, now: Column | None = None) -> DataFrame:
    """Accepted values onto their jobs; source and confidence get their defaults, the last error is cleared."""
    changes = validated.filter("ok").select(
        "job_id", F.lit("SUCCESS").alias("status"), F.col("norm_vendor").alias("vendor"),
        F.date_format("norm_date", "yyyy-MM-dd").alias("invoice_date"), F.col("norm_total").alias("total_amount"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        F.coalesce(F.nullif(F.col("source"), F.lit("")), F.lit("UNKNOWN")).alias("source"),
        F.lit(None).cast("string").alias("last_error"),
    )
    return upsert(jobs, changes, now=now)


def advance_jobs(jobs: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """Jobs after one round of outcomes, with ``next_strategy`` and ``due_at`` where a retry is scheduled.

    ``outcomes``: job_id, stage (ocr, llm or validation), ok, error, strategy (the one just tried), and the accepted
    vendor, invoice_date, total_amount, confidence, source; where given, also ``corrupted`` (an image that cannot be
    read) and ``raw`` (what the model said, already clipped). Accepted jobs stay as they are, and recognition changes no
    finished job. Every failure counts once against ``max_retries``, whatever its stage, but a corrupted image goes to
    review at once.
    """
    fields = [c for c in outcomes.columns if c != "job_id"]
    joined = jobs.join(outcomes.select("job_id", F.struct(*fields).alias("o")), "job_id", "left")
    late = F.coalesce(F.col("o.stage") == "ocr", F.lit(False)) & is_terminal(F.col("status"))
    live = F.col("o").isNotNull() & ~skips_validation(F.col("status")) & ~late  # never null: status is always set
    passed, failed = live & F.col("o.ok"), live & ~F.col("o.ok")
    stage, error = F.col("o.stage"), F.col("o.error")
    corrupted = F.coalesce(F.col("o.corrupted"), F.lit(False)) & (stage == "ocr") if "corrupted" in fields else F.lit(False)
    failures = F.coalesce(F.col("retry_count"), F.lit(0)) + F.when(failed & ~corrupted, 1).otherwise(0)
    outcome = F.when(corrupted, "NEEDS_REVIEW").otherwise(retry_outcome(failures, F.col("max_retries")))
    review = failed & (outcome == "NEEDS_REVIEW")
    retry = failed & (outcome == "RETRY_SCHEDULED")
    reason = F.when(corrupted, error).when(stage == "validation", F.concat(F.lit("validation_failed_after_retry:"), error)).when(
        stage == "ocr", F.concat(F.lit("ocr_failed_after_retry:"), error)
    ).when(error == "empty_parse", F.lit("llm_parse_failed_after_retry")).otherwise(
        F.concat(F.lit("llm_exception_after_retry:"), error)
    )
    retry_error = F.when(stage == "validation", F.concat(F.lit("validation:"), error)).when(
        error == "empty_parse", F.col("last_error")
    ).otherwise(error)
    # A validation failure goes by the strategy its values were obtained with, which the job remembers.
    tried = F.col("o.strategy")
    following = next_strategy(stage, F.when(stage == "validation", F.coalesce(tried, F.col("attempt_strategy"))).otherwise(tried))
    changed = {
        "status": F.when(passed, "SUCCESS").when(failed, outcome).otherwise(F.col("status")),
        "retry_count": failures.cast("int"),
        "last_error": F.when(passed, F.lit(None)).when(review, reason).when(retry, retry_error).otherwise(
            F.col("last_error")),
        "failure_class": F.when(failed & corrupted, "ocr_corrupted").when(review | (retry & (stage == "validation")), stage)
        .otherwise(F.col("failure_class")),
        "attempt_strategy": F.when(live, F.coalesce(F.col("o.strategy"), F.col("attempt_strategy"))).otherwise(
            F.col("attempt_strategy")),
        **{c: F.when(passed, F.col(f"o.{c}")).otherwise(F.col(c))
           for c in ("vendor", "invoice_date", "total_amount", "confidence", "source")},
    }
    if "updated_at" in jobs.columns:
        changed["updated_at"] = F.when(live, now.cast(jobs.schema["updated_at"].dataType)).otherwise(F.col("updated_at"))
    if "llm_last_raw" in jobs.columns and "raw" in fields:
        changed["llm_last_raw"] = F.when(live, F.coalesce("o.raw", "llm_last_raw")).otherwise(F.col("llm_last_raw"))
    retried = F.when(stage == "ocr", F.lit(None)).otherwise(following)
    due = F.timestamp_micros((F.unix_micros(now) + backoff(F.col("job_id"), failures - 1) * 1_000_000).cast("long"))
    # A retry scheduled earlier stays scheduled until its job has an outcome.
    kept = {c: F.when(~live, F.col(c)) if c in jobs.columns else F.lit(None) for c in ("next_strategy", "due_at")}
    # Extraction is re-run by the rules only after a recognition failure; every other retry goes to the model.
    return joined.select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in jobs.columns if c not in ("next_strategy", "due_at")],
        F.when(retry, retried).otherwise(kept["next_strategy"]).alias("next_strategy"),
        F.when(retry, due).otherwise(kept["due_at"]).alias("due_at"),
    )
