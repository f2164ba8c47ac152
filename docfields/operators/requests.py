"""Model requests and responses.

A request is ``job_id, file, text, strategy``; the model itself is the caller's. It is reached either as a table of
responses or as ``call(prompt) -> text`` run inside tasks.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfields.functions.retries import strategy_name, strategy_rank
from docfields.functions.text import QUOTA_MARKS, QUOTA_PAIR, RETRY_DEFAULT, RETRY_HINTS, RETRY_MARGIN, clip, json_span, money, strip
from docfields.operators.scans import HOT_ROWS, OrderedRows, chunked, scan_by_key
from docfields.session import materialise
from docfields.sources.ledgers import TaskLog, read_log

BATCH_SIZE = 3
# How much of a raw response a job keeps.
BATCH_RAW_LIMIT, SINGLE_RAW_LIMIT = 12000, 8000

SINGLE_NOTES = {
    "default": (
        "Read the receipt text below and give the name of the vendor, the amount to pay and the invoice date "
        "(YYYY-MM-DD). Leave addresses, phone numbers, stamps and handwriting aside, repair obvious recognition "
        "errors, and use \"\" for an unknown vendor and null for an unknown amount or date."
    ),
    "strict_json": (
        "Give one JSON object and nothing around it. The vendor is not only digits, the total is positive or null, "
        "the date is YYYY-MM-DD or null and not in the future."
    ),
    "after_validation_fail": (
        "An earlier answer was rejected. Read again with care: the vendor is a company name of at least two "
        "characters, the total a positive number, the date YYYY-MM-DD and not later than today."
    ),
    "ocr_retry": (
        "The text may be badly recognised. Infer vendor, total and date and undo common confusions such as O and 0 "
        "or l and 1."
    ),
}
SINGLE_SHAPE = 'Answer with {"vendor": "...", "total": number or null, "date": "YYYY-MM-DD" or null} only.'
BATCH_NOTES = {
    "default": "",
    "strict_json": "JSON only, no prose.",
    "after_validation_fail": "Earlier answers were rejected: vendor of two characters or more, positive total, past ISO date.",
    "ocr_retry": "The texts may be badly recognised; undo confusions such as O and 0.",
}
BATCH_HEAD = (
    "Give vendor name, amount to pay and invoice date of every invoice below, each on its own.\n"
    'Answer with {"results": [{"job_id": "...", "vendor": "...", "total": number or null, "date": "YYYY-MM-DD" or '
    "null}]} only: one object per invoice, in the given order, each job_id copied exactly. Use \"\" for an unknown "
    "vendor and null for an unknown total or date."
)


def _note(strategy: Column, notes: dict[str, str]) -> Column:
    text = F.lit(notes["default"])
    for name, note in notes.items():
        text = F.when(strategy == name, F.lit(note)).otherwise(text)
    return text


def prompt(text: Column, strategy: Column) -> Column:
    """prompt for one document; an unknown strategy gets the default wording."""
    return F.concat(_note(strategy, SINGLE_NOTES), F.lit("\n" + SINGLE_SHAPE + "\n\nReceipt text:\n"), text)


def _number_batches(rows: OrderedRows, size: int) -> DataFrame:
    numbered = rows.number("_n").df
    slot = (F.col("_n") - 1) % size
    return (
        numbered.withColumn("slot", slot.cast("int"))
        .withColumn("batch", F.concat_ws("-", F.col("bucket"), F.floor((F.col("_n") - 1) / size)))
        .drop("_n", "chunk")
    )


def assign_batches(
    requests: DataFrame,
    size: int = BATCH_SIZE,
    order: tuple[str, ...] = ("job_id",),
    bucket: Column | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Up to ``size`` requests per call in ``order``, as columns ``batch`` and ``slot``.

    Every batch but the last is full, at every table size and with any number of partitions: requests are
    range-partitioned by ``order``, numbered in their chunk, and moved on by what earlier chunks hold. With ``bucket``
    the batches are cut inside each bucket instead.
    """
    number = lambda rows: _number_batches(rows, size)
    if bucket is None:
        return number(chunked(requests.withColumn("bucket", F.lit(0)), ["bucket"], list(order))).drop("bucket")
    return scan_by_key(requests.withColumn("bucket", bucket), ["bucket"], list(order), number, hot_rows).drop("bucket")


def merge_strategy(requests: DataFrame, batch: str = "batch") -> DataFrame:
    """The strictest strategy of every batch; unknown names count as default."""
    rank = F.max(strategy_rank(F.col("strategy")))
    return requests.groupBy(batch).agg(strategy_name(rank).alias("strategy"))


def batch_prompt(requests: DataFrame) -> DataFrame:
    """one prompt per batch: numbered blocks in slot order under the strictest strategy's note."""
    block = F.concat(
        F.lit("### Invoice "), (F.col("slot") + 1).cast("string"), F.lit("\njob_id: "), F.col("job_id"),
        F.lit("\nfile: "), F.col("file"), F.lit("\ntext:\n"), F.col("text"), F.lit("\n"),
    )
    blocks = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slot", block.alias("b")))), lambda s: s["b"]), "\n")
    rank = F.max(strategy_rank(F.col("strategy")))
    grouped = requests.groupBy("batch").agg(blocks.alias("body"), strategy_name(rank).alias("strategy"))
    note = _note(F.col("strategy"), BATCH_NOTES)
    return grouped.select("batch", "strategy", F.concat_ws("\n", F.lit(BATCH_HEAD), note, F.col("body")).alias("prompt"))


TOLD = ("job_id", "vendor", "total", "date")


def _told(v: Column) -> Column:
    """The fields of one variant as texts."""
    return F.struct(*[F.try_variant_get(v, f"$.{name}", "string").alias(name) for name in TOLD])


def _told_again(text: Column) -> Column:
    """The same of JSON text, for objects with a repeated key; null where it is no object."""
    read = F.from_json(text, ", ".join(f"{name} string" for name in [*TOLD, "_bad"]), {"columnNameOfCorruptRecord": "_bad"})
    return F.when(read.isNotNull() & read["_bad"].isNull(), F.struct(*[read[name].alias(name) for name in TOLD]))


def parse_single(c: Column) -> Column:
    """``struct(vendor, total, date)`` from a single response, null without an object or with a bad total."""
    span = json_span(c)
    v = F.try_parse_json(span)
    # An object that repeats a key is no variant; read by name, its last value counts.
    told = F.coalesce(F.when(v.isNotNull(), _told(v)), _told_again(span))
    bad_total = (F.coalesce(told["total"], F.lit("")) != "") & money(told["total"]).isNull()
    parsed = F.struct(told["vendor"].alias("vendor"), money(told["total"]).alias("total"), told["date"].alias("date"))
    return F.when(told.isNotNull() & ~bad_total, parsed)


def parse_batch(responses: DataFrame, key: str = "batch") -> DataFrame:
    """rows of all batch responses. Elements that are no objects or name no job are skipped, a bad total
    becomes null, and the last of several rows for a job in one response wins (W6, folded before the shuffle)."""
    span = json_span(F.col("response"))
    v = F.try_parse_json(span)
    items = F.transform(F.try_variant_get(v, "$.results", "array<variant>"), _told)
    # A key repeated anywhere keeps the text from being a variant; its elements are then read one by one.
    again = F.transform(F.from_json(span, "results array<string>")["results"], _told_again)
    rows = responses.select(key, F.posexplode(F.when(v.isNotNull(), items).otherwise(again)).alias("at", "v"))
    named = rows.select(
        key, "at", F.col("v.job_id").alias("raw_id"), F.col("v.vendor").alias("vendor"), F.col("v.total").alias("total_text"),
        F.col("v.date").alias("date"),
    ).filter(F.coalesce(F.col("raw_id"), F.lit("")) != "")
    last = F.max_by(F.struct("vendor", "total_text", "date"), F.col("at"))
    return named.groupBy(key, strip(F.col("raw_id")).alias("job_id")).agg(last.alias("r")).select(
        key, "job_id", F.col("r.vendor").alias("vendor"), money(F.col("r.total_text")).alias("total"),
        F.col("r.date").alias("date"),
    )


def match_responses(requests: DataFrame, parsed: DataFrame, key: str = "batch") -> DataFrame:
    """Requests with the values their own batch's response holds for them; ids nobody asked for drop out."""
    return requests.join(parsed, [key, "job_id"])


def missing_jobs(requests: DataFrame, parsed: DataFrame, key: str = "batch") -> DataFrame:
    """Requests their batch's response does not answer, all of them when it could not be read."""
    return requests.join(parsed.select(key, "job_id"), [key, "job_id"], "left_anti")


def all_parsed(batch: DataFrame, single: DataFrame) -> DataFrame:
    """Answers of batches and of the single calls that made up for missing ones."""
    return batch.unionByName(single)


def apply_single(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Single responses (``job_id, response``) by request; ``parsed`` is false where nothing usable came back."""
    read = responses.select("job_id", "response", parse_single(F.col("response")).alias("p"))
    return requests.join(read, "job_id", "left").select(
        "job_id", "strategy", "p.vendor", "p.total", "p.date", F.col("p").isNotNull().alias("parsed"), "response"
    )


def is_rate_limited(error: str) -> bool:
    """F26 for an exception inside a task."""
    s = error.lower()
    return any(mark in s for mark in QUOTA_MARKS) or all(mark in s for mark in QUOTA_PAIR)


def seconds_hinted(error: str) -> float:
    """F27 for an exception inside a task."""
    hint = next(filter(None, (re.search(p, error) for p in RETRY_HINTS)), None)
    return float(hint.group(1)) + RETRY_MARGIN if hint else RETRY_DEFAULT


def call_model(
    prompts: DataFrame, call: Callable[[str], str], key: str = "batch", tries: int = 12,
    sleep: Callable[[float], None] = time.sleep, parallel: int | None = None, rpm: float | None = None,
    ledger: str | None = None,
) -> DataFrame:
    """One call per row, spread over ``parallel`` tasks; the answers are written once, so using them twice does
    not call twice. A call that fails for good answers with the empty text, and a quota error waits as told first.

    ``rpm`` is the service's limit of calls a minute, retries too. Tasks cannot see each other, so each of ``parallel``
    (1 if not given) keeps to its share of it.

    ``ledger`` is a folder in which every answer is logged as it comes (see :mod:`docfields.sources.ledgers`), under the
    SHA-256 of its prompt. Prompts that it knows are not asked again, neither by a task that is re-run nor by a later run;
    equal prompts are asked once. Only a call that was under way when its task was lost is made again, and one that
    failed for good is not logged. Speculative execution must be off.
    """
    if rpm is not None:
        parallel = parallel or 1
    pause = 60.0 * parallel / rpm if rpm else 0.0

    def ask(text: str) -> str:
        for left in range(tries - 1, -1, -1):
            if pause:
                now = time.monotonic()
                if (early := allowed[0] - now) > 0:
                    sleep(early)
                allowed[0] = max(now, allowed[0]) + pause
            try:
                return (call(text) or "").strip()
            except Exception as e:  # noqa: BLE001 - whatever the caller's client raises
                if not (left and is_rate_limited(str(e))):
                    return ""
                sleep(seconds_hinted(str(e)))
        return ""

    allowed = [0.0]
    if ledger is not None:
        return _call_by_ledger(prompts, ask, key, parallel, ledger)

    def run(batches):
        for rows in batches:
            yield pd.DataFrame({key: rows[key], "response": [ask(text) for text in rows["prompt"]]})

    spread = prompts.select(key, "prompt")
    spread = spread.repartition(parallel, key) if parallel else spread.repartition(key)
    schema = f"{key} {prompts.schema[key].dataType.simpleString()}, response string"
    return materialise(spread.mapInPandas(run, schema), "answers")


ANSWERED = "hash string, response string"


def _call_by_ledger(prompts: DataFrame, ask: Callable[[str], str], key: str, parallel: int | None, ledger: str) -> DataFrame:
    hashed = prompts.select(key, "prompt", F.sha2("prompt", 256).alias("hash"))
    spark, attempt = prompts.sparkSession, uuid.uuid4().hex
    known = read_log(spark, ledger, ANSWERED).dropDuplicates(["hash"])
    new = hashed.groupBy("hash").agg(F.min("prompt").alias("prompt")).join(known.select("hash"), "hash", "left_anti")

    def run(batches):
        log = TaskLog(ledger, attempt)
        told = {e["hash"]: e["response"] for e in log.earlier()}
        for rows in batches:
            out = []
            for h, text in zip(rows["hash"], rows["prompt"], strict=True):
                response = told.get(h)
                if response is None:
                    response = ask(text)
                    if response:
                        log.write({"hash": h, "response": response})
                out.append(response)
            yield pd.DataFrame({"hash": rows["hash"], "response": out})
        log.close()

    spread = new.repartition(parallel, "hash") if parallel else new.repartition("hash")
    made = materialise(spread.mapInPandas(run, ANSWERED), "new-answers")
    told = known.unionByName(made)
    return materialise(hashed.join(told, "hash").select(key, "response"), "answers")


def counted(name: str, rows: DataFrame) -> DataFrame:
    return rows.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))


def ask_model(*args, **options) -> DataFrame:
    """The rows of :func:`ask_and_count`."""
    return ask_and_count(*args, **options)[0]


def ask_and_count(
    requests: DataFrame, call: Callable[[str], str], size: int = BATCH_SIZE, order: tuple[str, ...] = ("job_id",),
    sleep: Callable[[float], None] = time.sleep, parallel: int | None = None, rpm: float | None = None,
    ledger: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Batch calls, then single calls for what they left open; and how many calls that took (name, n).

    One row per request: vendor, total, date, ``parsed``, the merged strategy it was tried with, the raw response as the
    job keeps it (clipped), and ``calls``, ``batch`` or ``single``. ``ledger``: see :func:`call_model`; an answer from there
    counts like a call.
    """
    batched = materialise(assign_batches(requests, size, order), "batches")
    prompts = batch_prompt(batched)
    answers = call_model(prompts, call, "batch", sleep=sleep, parallel=parallel, rpm=rpm, ledger=ledger)
    parsed = parse_batch(answers)
    merged = merge_strategy(batched).withColumnRenamed("strategy", "merged")
    answered = (
        match_responses(batched, parsed).join(merged, "batch").join(answers, "batch")
        .select("job_id", F.col("merged").alias("strategy"), "vendor", "total", "date", F.lit(True).alias("parsed"),
                clip(F.col("response"), BATCH_RAW_LIMIT).alias("response"), F.lit("batch").alias("calls"))
    )
    missing = materialise(missing_jobs(batched, parsed).select("job_id", "text", "strategy"), "missing")
    singles = missing.select("job_id", prompt(F.col("text"), F.col("strategy")).alias("prompt"))
    single_answers = call_model(singles, call, "job_id", sleep=sleep, parallel=parallel, rpm=rpm, ledger=ledger)
    recovered = apply_single(missing, single_answers).withColumn("calls", F.lit("single")).withColumn(
        "response", clip(F.col("response"), SINGLE_RAW_LIMIT))
    calls = counted("llm_batch_calls", answers).union(counted("llm_single_calls", single_answers))
    return all_parsed(answered, recovered), calls
