"""Delivery of accepted records to a form."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfields.functions.dates import format_form_date
from docfields.functions.text import num_text, strip
from docfields.session import materialise
from docfields.sources.ledgers import TaskLog, read_log


def form_rows(valid: DataFrame, date_format: str = "iso") -> DataFrame:
    """Accepted rows as the texts the form takes; null becomes empty. A row without a ``date`` has its ``invoice_date``."""
    empty = F.lit("")
    date = F.nullif(F.col("date"), empty) if "date" in valid.columns else F.lit(None).cast("string")
    if "invoice_date" in valid.columns:
        date = F.coalesce(date, F.col("invoice_date"))
    return valid.select(
        "job_id", F.coalesce(strip(F.col("vendor")), empty).alias("vendor"),
        format_form_date(date, date_format).alias("date"),
        F.coalesce(num_text(F.col("total")), empty).alias("total"),
    )


def deliver(
    rows: DataFrame, post: Callable[[dict], bool], max_retries: int = 3, base_delay: float = 1.0,
    sleep: Callable[[float], None] = time.sleep, pause: float = 0.2, parallel: int = 8, ledger: str | None = None,
    post_doubtful: bool = False,
) -> DataFrame:
    """Post every row, waiting twice as long after each failure; outcomes are written once.

    At most ``parallel`` tasks post, each with a ``pause`` after every row. Without a ledger a task that is re-run posts
    its rows again, so ``post`` should be idempotent on ``job_id``.

    ``ledger`` is a folder in which a row is logged before it is posted and again with its outcome. What it has as
    delivered is not posted again, neither by a task that is re-run nor by a later delivery; what failed is tried anew.
    A row that was being posted when its task was lost is in doubt: it is not posted unless ``post_doubtful``. The
    result then has one row for each job of ``rows``, with ``state`` (``delivered``, ``failed`` or ``in_doubt``),
    ``attempts`` of all deliveries and ``posted``, whether this one posted it. Rows of one job are posted once.
    """
    names = rows.columns

    def attempt(row: dict) -> tuple[bool, int]:
        for n in range(1, max_retries + 1):
            try:
                if post(row):
                    return True, n
            except Exception:  # noqa: BLE001 - a failed post is an outcome, not a failed task
                pass
            sleep(base_delay * 2 ** (n - 1))
        return False, max_retries

    def paced(row: dict) -> tuple[bool, int]:
        outcome = attempt(row)
        sleep(pause)
        return outcome

    if ledger is not None:
        return _deliver_by_ledger(rows, paced, parallel, ledger, post_doubtful)

    def run(batches):
        for batch in batches:
            done = [paced(dict(zip(names, values))) for values in batch[names].itertuples(index=False, name=None)]
            yield pd.DataFrame({
                "job_id": batch["job_id"], "ok": [ok for ok, _ in done], "attempts": [n for _, n in done],
            })

    return materialise(rows.repartition(parallel, "job_id").mapInPandas(run, "job_id string, ok boolean, attempts int"), "delivered")


LOGGED = "job_id string, seq long, at double, ok boolean, attempts int"
DELIVERED = "job_id string, ok boolean, attempts int, state string, posted boolean"


def delivery_states(spark: SparkSession, ledger: str) -> DataFrame:
    """One row for each job that a ledger knows: its ``state`` and all ``attempts`` so far.

    A job once delivered stays so; else its last line counts. A line without an outcome was logged before a post that
    nothing is known of.
    """
    log = read_log(spark, ledger, LOGGED)
    last = F.max_by("ok", F.struct("at", "seq"))
    return log.groupBy("job_id").agg(
        F.coalesce(F.bool_or("ok"), F.lit(False)).alias("done"), last.alias("last"), F.coalesce(F.sum("attempts"), F.lit(0)).cast("int").alias("attempts"),
    ).select("job_id", "attempts", F.when(F.col("done"), "delivered").when(F.col("last").isNull(), "in_doubt").otherwise("failed").alias("state"))


def _deliver_by_ledger(
    rows: DataFrame, paced: Callable[[dict], tuple[bool, int]], parallel: int, ledger: str, post_doubtful: bool,
) -> DataFrame:
    names, this = rows.columns, uuid.uuid4().hex
    told = materialise(delivery_states(rows.sparkSession, ledger), "delivery-states")
    done = told.filter("state = 'delivered'" if post_doubtful else "state IN ('delivered', 'in_doubt')")
    once = rows.dropDuplicates(["job_id"])

    def run(batches):
        log, seq = TaskLog(ledger, this), 0
        begun: dict[str, tuple[bool, int] | None] = {}
        for e in log.earlier():
            begun[e["job_id"]] = None if e["ok"] is None else (e["ok"], e["attempts"])

        def entry(job: str, ok: bool | None, attempts: int) -> dict:
            nonlocal seq
            seq += 1
            return {"job_id": job, "seq": seq, "at": time.time(), "ok": ok, "attempts": attempts}

        for batch in batches:
            found, ended = [], []  # an outcome is written with the next row's beginning, before that is posted
            for row in batch[names].itertuples(index=False, name=None):
                row = dict(zip(names, row))
                job = row["job_id"]
                outcome = begun.get(job)
                if job in begun and outcome is None and not post_doubtful:
                    found.append((job, False, 0, "in_doubt", True))
                    continue
                if outcome is None:
                    log.write(*ended, entry(job, None, 0))
                    outcome = paced(row)
                    ended = [entry(job, *outcome)]
                found.append((job, *outcome, "delivered" if outcome[0] else "failed", True))
            if ended:
                log.write(*ended)
            yield pd.DataFrame(found, columns=["job_id", "ok", "attempts", "state", "posted"])
        log.close()

    todo = once.join(done.select("job_id"), "job_id", "left_anti").select(*names)
    made = materialise(todo.repartition(parallel, "job_id").mapInPandas(run, DELIVERED), "delivered")
    before = told.select("job_id", F.col("attempts").alias("tried"), F.col("state").alias("was"))
    posted = made.join(before, "job_id", "left").select(
        "job_id", "ok", (F.col("attempts") + F.coalesce("tried", F.lit(0))).alias("attempts"), "state", "posted")
    left = once.select("job_id").join(told.join(done.select("job_id"), "job_id"), "job_id").select(
        "job_id", (F.col("state") == "delivered").alias("ok"), "attempts", "state", F.lit(False).alias("posted"))
    return materialise(posted.unionByName(left), "deliveries")


def delivery_report(outcomes: DataFrame) -> DataFrame:
    """What became of a delivery, in one row."""
    n = F.count(F.lit(1))
    return outcomes.agg(
        n.alias("attempted"), F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"),
        (n == 0).alias("skipped_no_valid"),
    )
