"""Operators against plain loops on random small tables, with and without oversized keys."""

import random

import pytest
from pyspark.sql import functions as F

from docfields.operators import health, jobs as J, requests as R
from docfields.operators.routing import extract_fields
from docfields.operators.scans import OrderedRows, chunked, latest, scan_by_key
from docfields.operators.totals import extract_total
from docfields.operators.vendors import extract_vendor
from docfields.operators.words import group_lines, group_rows
from docfields.schema import WORDS


def random_words(seed, docs=40, hot=400):
    """Documents of random boxes; document 0 holds about a third of all words, some at the very same place."""
    rng = random.Random(seed)
    texts = ["TOTAL", "Grand", "total", "RM12.50", "7.25", "cash", "AMOUNT", "due", "99", "Shop", "ACME", "SDN", "BHD", "Tax", "12/03/2018"]
    rows = []
    for doc in range(docs):
        for i in range(hot if doc == 0 else rng.randint(1, 25)):
            y = rng.choice([40, rng.randint(0, 900)])
            rows.append((doc, i, rng.choice(texts), rng.choice([-1, 5, 10, 60, 95]), rng.choice([10, rng.randint(0, 600)]), y,
                         rng.randint(5, 90), rng.choice([10, 20, 21]), 980))
    return rows


@pytest.fixture(scope="module", params=[1, 2])
def words(request, spark):
    return random_words(request.param), spark.createDataFrame(random_words(request.param), WORDS).repartition(5)


def rows_by_loop(rows, gap=14):
    out = {}
    for doc in {r[0] for r in rows}:
        mine = sorted([r for r in rows if r[0] == doc], key=lambda r: (r[5] + r[7] // 2, r[1]))
        row, before = 0, None
        for r in mine:
            cy = r[5] + r[7] // 2
            row += before is not None and cy - before > gap
            out[doc, r[1]], before = row, cy
    return out


@pytest.mark.parametrize("hot_rows", [None, 1000, 30])
def test_rows_match_a_loop(words, hot_rows):
    rows, df = words
    found = {(r.doc_id, r.word_id): r.row_ix for r in group_rows(df, hot_rows=hot_rows).collect()}
    assert found == rows_by_loop(rows)


@pytest.mark.parametrize("hot_rows", [None, 30])
def test_lines_match_a_loop(words, hot_rows):
    rows, df = words
    expected = {}
    for doc in {r[0] for r in rows}:
        line, before = 0, None
        for r in sorted([r for r in rows if r[0] == doc], key=lambda r: r[1]):
            line += before is not None and abs(r[5] - before) >= 15
            expected[doc, r[1]], before = line, r[5]
    assert {(r.doc_id, r.word_id): r.line_ix for r in group_lines(df, hot_rows=hot_rows).collect()} == expected


def test_oversized_documents_give_the_same_fields(words):
    _, df = words
    for extract in (extract_total, extract_vendor, extract_fields):
        plain, split = extract(df, hot_rows=None), extract(df, hot_rows=30)
        assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0
    assert extract_fields(df).count() == 40


def random_calls(seed, n=600):
    rng = random.Random(seed)
    at, rows = 0.0, []
    for i in range(n):
        at += rng.choice([0.0, 0.5, 3.0, 50.0])
        rows.append((i, rng.choice(["hot", "hot", "a", "b"]), at, rng.random() < 0.7))
    return rows


CALLS = "event_id long, key string, at double, failed boolean"


@pytest.mark.parametrize("hot_rows", [None, 100])
def test_pacing_matches_a_loop(spark, hot_rows):
    rows, free, expected = random_calls(3), {}, {}
    for i, key, at, _ in rows:
        expected[i] = max(at, free.get(key, 0.0))
        free[key] = expected[i] + 5.0
    found = health.pace(spark.createDataFrame(rows, CALLS), "key", 12, hot_rows=hot_rows)
    assert {r.event_id: r.start_at for r in found.collect()} == pytest.approx(expected)


@pytest.mark.parametrize("hot_rows", [None, 100])
def test_circuit_matches_a_loop(spark, hot_rows):
    rows, state, expected = random_calls(4), {}, {}
    for i, key, at, failed in rows:
        failures, until = state.get(key, (0, 0.0))
        expected[i] = at >= until
        failures = failures + 1 if failed else 0
        if failures >= 3:
            failures, until = 0, max(until, at + 60)
        state[key] = failures, until
    found = health.circuit(spark.createDataFrame(rows, CALLS), "key", 3, 60, hot_rows=hot_rows)
    assert {r.event_id: r.allowed for r in found.collect()} == expected


def test_chunked_scan_carries_over_chunks_and_null_keys(spark):
    rows = [(None if i % 3 else "k", i, None if i % 7 == 0 else i % 11) for i in range(200)]
    df = spark.createDataFrame(rows, "key string, at int, v int")

    def body(scan: OrderedRows):
        return (scan.number("n").lag("before", F.col("v")).running("total", F.col("v"), "sum")
                .running("top", F.col("v"), "max").df.drop("chunk"))

    plain = body(OrderedRows(df, ["key"], ["at"]))
    for other in (body(chunked(df, ["key"], ["at"], 9)), scan_by_key(df, ["key"], ["at"], body, 100)):
        assert dict(other.dtypes) == dict(plain.dtypes)
        assert plain.exceptAll(other.select(plain.columns)).count() == 0 and other.count() == 200


def test_latest_row_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("a", 2, "z"), ("b", 1, "y")], "k string, t int, v string")
    assert {tuple(r) for r in latest(df, ["k"], ["t"]).collect()} == {("a", 3, None), ("b", 1, "y")}


def test_two_failures_end_in_review(spark):
    jobs = spark.createDataFrame(
        [("a", "OCR_DONE", 0), ("b", "RETRY_SCHEDULED", 1), ("c", "SUCCESS", 0)], "job_id string, status string, retry_count int"
    ).select("*", F.lit(2).alias("max_retries"), *[F.lit(None).cast("string").alias(c) for c in (
        "last_error", "failure_class", "attempt_strategy", "vendor", "invoice_date", "source")],
        *[F.lit(None).cast("double").alias(c) for c in ("total_amount", "confidence")])
    failed = jobs.select("job_id", F.lit("validation").alias("stage"), F.lit(False).alias("ok"), F.lit("date_missing").alias("error"),
                         F.lit(None).cast("string").alias("strategy"), "vendor", "invoice_date", "total_amount", "confidence", "source")
    after = {r.job_id: r for r in J.advance_jobs(jobs, failed, F.current_timestamp()).collect()}
    assert (after["a"].status, after["a"].next_strategy, after["a"].last_error) == (
        "RETRY_SCHEDULED", "after_validation_fail", "validation:date_missing")
    assert (after["b"].status, after["b"].last_error) == ("NEEDS_REVIEW", "validation_failed_after_retry:date_missing")
    assert after["c"].status == "SUCCESS" and after["c"].retry_count == 0


def test_batches_hold_every_request_once(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("job_id"))
    sizes = R.assign_batches(df).groupBy("batch").agg(F.count("*").alias("n"), F.max("slot").alias("s")).collect()
    assert sum(r.n for r in sizes) == 1000 and all(r.n <= 3 and r.s == r.n - 1 for r in sizes)


def test_model_calls_happen_once_and_wait_for_quota(spark, tmp_path):
    log = str(tmp_path / "calls")

    def call(prompt):
        with open(log, "a") as f:
            f.write(prompt + "\n")
        if prompt == "limited" and open(log).read().count("limited") < 2:
            raise RuntimeError("429: retry in 2s")
        if prompt == "broken":
            raise ValueError("no")
        return f" {prompt}! "

    prompts = spark.createDataFrame([("1", "fine"), ("2", "limited"), ("3", "broken")], "batch string, prompt string")
    answers = R.call_model(prompts, call, sleep=lambda seconds: None)
    for _ in range(3):
        assert {tuple(r) for r in answers.collect()} == {("1", "fine!"), ("2", "limited!"), ("3", "")}
    assert sorted(open(log).read().split()) == ["broken", "fine", "limited", "limited"]


def test_history_comes_in_bounded_pages(spark):
    rows = [("a", i, "llm", f"e{i:03}", None) for i in range(25)] + [("b", 0, "ocr", "x", "default")]
    attempts = spark.createDataFrame(rows, "job_id string, ts int, stage string, error string, strategy string")
    pages = J.attempt_history(attempts, page=10, hot_rows=20).collect()
    assert sorted((r.job_id, r.page, len(r.history)) for r in pages) == [("a", 0, 10), ("a", 1, 10), ("a", 2, 5), ("b", 0, 1)]
    assert [e.error for r in sorted(pages, key=lambda r: r.page) if r.job_id == "a" for e in r.history] == [f"e{i:03}" for i in range(25)]


def test_extraction_plan_has_one_shuffle_and_no_python(spark):
    words = spark.createDataFrame([], WORDS)
    plan = extract_total(words, hot_rows=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1 and "Python" not in plan


@pytest.mark.parametrize("partitions", [8, 200])
def test_batches_are_full_with_any_number_of_partitions(spark, partitions):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for n in (12, 13):
            df = spark.range(n).select(F.col("id").cast("string").alias("job_id"))
            sizes = [r.n for r in R.assign_batches(df).groupBy("batch").agg(F.count("*").alias("n")).collect()]
            assert sorted(sizes) == [1] * (n % 3) + [3] * 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_repeated_keys_in_responses_keep_the_last(spark):
    texts = ['{"results": [{"job_id": "1", "vendor": "A", "vendor": "B", "total": 2.5}, {"job_id": "2", "total": "RM 3"}, 7]}', "{}", "no", None]
    df = spark.createDataFrame(list(enumerate(texts)), "batch int, response string")
    assert {tuple(r) for r in R.parse_batch(df).collect()} == {(0, "1", "B", 2.5, None), (0, "2", None, 3.0, None)}
    singles = ['{"vendor": "A", "vendor": "B", "total": 1}', '{"vendor": "C"}', "none", '{"total": "x", "total": "y"}', None]
    rows = spark.createDataFrame([(s,) for s in singles], "r string").select(R.parse_single(F.col("r")).alias("p")).collect()
    assert [r.p and (r.p.vendor, r.p.total) for r in rows] == [("B", 1.0), ("C", None), None, None, None]


def test_calls_keep_to_the_rate(spark, tmp_path):
    log = str(tmp_path / "calls")

    def call(text):
        import time

        with open(log, "a") as f:
            f.write(f"{time.monotonic()}\n")
        return text

    prompts = spark.createDataFrame([(str(i), "p") for i in range(4)], "batch string, prompt string")
    assert R.call_model(prompts, call, rpm=300).count() == 4
    at = sorted(float(x) for x in open(log))
    assert all(b - a > 0.18 for a, b in zip(at, at[1:]))
