"""What must not happen twice, tables changed in place, runs that go on where they stopped, and state over triggers."""

import os
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from docfields.functions.text import num_text
from docfields.operators import delivery, jobs, requests
from docfields.plans import rounds
from docfields.session import run_folder
from docfields.sources.tables import Conflict, KeyedTable
from docfields.streaming import processors


@pytest.fixture
def folder(spark):
    return f"{run_folder(spark)}/test-{uuid.uuid4().hex}"


def stub(tmp_path, stop_at=None):
    """A service that keeps a line for each call and kills its worker before the call of ``stop_at``."""
    log = str(tmp_path / "calls")

    def call(what):
        text = what if isinstance(what, str) else what["job_id"]
        if text == stop_at and not os.path.exists(f"{log}-stopped"):
            open(f"{log}-stopped", "w").close()
            os._exit(1)
        with open(log, "a") as f:
            f.write(f"{text}\n")
        return f"answer to {text}"

    return call, lambda: open(log).read().split()


def test_a_lost_run_asks_each_prompt_once(spark, tmp_path, folder):
    prompts = spark.createDataFrame([(i, f"p{i % 30}") for i in range(40)], "job_id long, prompt string")
    call, calls = stub(tmp_path, "p17")
    with pytest.raises(Exception):
        requests.call_model(prompts, call, "job_id", parallel=2, ledger=folder)
    before = len(calls())
    assert before < 30
    answers = {r.job_id: r.response for r in requests.call_model(prompts, call, "job_id", parallel=3, ledger=folder).collect()}
    assert answers == {i: f"answer to p{i % 30}" for i in range(40)}
    assert sorted(calls()) == sorted(f"p{i}" for i in range(30))
    requests.call_model(prompts, call, "job_id", ledger=folder)
    assert len(calls()) == 30


def test_lines_cut_off_do_not_count(spark, tmp_path, folder):
    prompts = spark.createDataFrame([(1, "one")], "job_id long, prompt string")
    call, calls = stub(tmp_path)
    requests.call_model(prompts, call, "job_id", ledger=folder)
    from pyarrow import fs

    place = folder.removeprefix("file:")
    file = next(f.path for f in fs.LocalFileSystem().get_file_info(fs.FileSelector(place, recursive=True)) if f.is_file)
    whole = open(file).read()
    with open(file, "a") as f:
        f.write(whole[: len(whole) // 2])
    assert requests.read_log(spark, folder, requests.ANSWERED).count() == 1
    with open(file, "w") as f:
        f.write(whole[:-10])
    requests.call_model(prompts, call, "job_id", ledger=folder)
    assert calls() == ["one", "one"]


def test_a_second_delivery_posts_nothing(spark, tmp_path, folder):
    rows = spark.createDataFrame([(f"j{i}", "v") for i in range(20)] + [("j3", "v")], "job_id string, vendor string")
    call, calls = stub(tmp_path, "j11")
    with pytest.raises(Exception):
        delivery.deliver(rows, call, sleep=lambda _: None, parallel=2, ledger=folder)
    first = delivery.deliver(rows, call, sleep=lambda _: None, parallel=4, ledger=folder).collect()
    assert len(first) == 20
    # The row being posted when its task was lost is in doubt, and all others are delivered once.
    assert {r.job_id for r in first if r.state == "in_doubt"} == {"j11"}
    assert sorted(calls()) == sorted(f"j{i}" for i in range(20) if i != 11)
    second = delivery.deliver(rows, call, sleep=lambda _: None, ledger=folder).collect()
    assert len(calls()) == 19 and not any(r.posted for r in second)
    states = {r.job_id: r.state for r in delivery.delivery_states(spark, folder).collect()}
    assert states == {f"j{i}": "in_doubt" if i == 11 else "delivered" for i in range(20)}
    third = delivery.deliver(rows, call, sleep=lambda _: None, ledger=folder, post_doubtful=True).collect()
    assert [r.job_id for r in third if r.posted] == ["j11"] and calls().count("j11") == 1


def test_failed_rows_are_posted_again(spark, folder):
    rows = spark.createDataFrame([("a", "v"), ("b", "v")], "job_id string, vendor string")
    for attempts in (3, 6):
        found = {r.job_id: r for r in delivery.deliver(rows, lambda r: r["job_id"] == "a", sleep=lambda _: None, ledger=folder).collect()}
        assert (found["a"].attempts, found["b"].attempts, found["b"].state) == (1, attempts, "failed")
    assert not found["a"].posted and found["b"].posted


def test_form_rows_by_either_date(spark):
    rows = spark.createDataFrame([("1", "V", "2024-01-02", None, 1.0), ("2", "V", "", "2024-03-04", 1.0), ("3", "V", None, None, None)],
                                 "job_id string, vendor string, date string, invoice_date string, total double")
    assert {r.job_id: r.date for r in delivery.form_rows(rows).collect()} == {"1": "2024-01-02", "2": "2024-03-04", "3": ""}
    assert delivery.form_rows(rows.drop("date")).filter("job_id = '2'").first().date == "2024-03-04"


def test_changes_touch_few_buckets(spark, folder):
    rows = spark.range(2_000).select(F.concat(F.lit("j"), "id").alias("job_id"), F.lit("OPEN").alias("status"), F.col("id").alias("n"))
    table = KeyedTable(spark, folder)
    first = table.create(rows, "job_id", 32)
    changes = spark.createDataFrame([("j5", "DONE"), ("j77", "DONE"), ("unknown", "DONE")], "job_id string, status string")
    reads = []

    def apply(old, new):
        reads.extend(old.inputFiles())
        return jobs.upsert(old, new)

    second = table.change(changes, apply)
    moved = {b for b in first.folders if first.folders[b] != second.folders.get(b)}
    assert 1 <= len(moved) <= 3 and all(any(f"_bucket={b}/" in f for b in moved | {b for b in range(32) if b not in first.folders}) or len(moved) == 3 for f in reads)
    assert len(reads) <= 3 * spark.read.parquet(f"{folder}/{first.folders[0]}").rdd.getNumPartitions() + 3
    assert {r.job_id for r in table.read().filter("status = 'DONE'").collect()} == {"j5", "j77"} and table.read().count() == 2_000
    assert table.read(0).filter("status = 'DONE'").count() == 0  # a reader of the old version sees all of it
    assert [r.n for r in table.lookup(spark.createDataFrame([("j77",), ("nobody",)], "job_id string")).collect()] == [77]
    assert table.change(changes.limit(0), apply).number == 1


def test_writers_and_old_versions(spark, folder):
    rows = spark.range(50).select(F.col("id").cast("string").alias("job_id"), F.lit(0).alias("n"))
    one, other = KeyedTable(spark, folder), KeyedTable(spark, folder)
    one.create(rows, "job_id", 4)
    change = spark.createDataFrame([("7", 1)], "job_id string, n int")

    def slow(old, new):
        one.change(change, jobs.upsert)
        return jobs.upsert(old, new)

    with pytest.raises(Conflict):
        other.change(change.withColumn("n", F.lit(2)), slow)
    assert one.read().filter("job_id = '7'").first().n == 1 and one.versions() == [0, 1]
    with pytest.raises(ValueError, match="buckets"):
        one.change(change, lambda old, new: old.unionByName(rows.withColumn("job_id", F.concat(F.lit("x"), "job_id"))))
    for n in range(2, 5):
        one.change(change.withColumn("n", F.lit(n)), jobs.upsert)
    assert one.vacuum(2) == 3 and one.versions() == [3, 4]
    assert one.read().count() == 50 and one.read(3).filter("n = 3").count() == 1
    with pytest.raises(FileNotFoundError):
        KeyedTable(spark, f"{folder}/none").read()


class Stop(Exception):
    pass


@pytest.mark.parametrize("stopped", ["round-0-jobs", "round-1-outcomes"])
def test_a_stopped_run_ends_like_an_unbroken_one(spark, small, folder, tmp_path, monkeypatch, stopped):
    from docfields import fixtures
    from docfields.catalog.extraction import today
    from docfields.catalog.jobs import now
    from docfields.catalog.requests import stubborn
    from docfields.session import materialise

    words = materialise(fixtures.receipt_words(spark, small).filter("doc_id < 400"), "few-words")
    log = str(tmp_path / "asked")

    def call(prompt):
        with open(log, "a") as f:
            f.write("x")
        return stubborn(prompt)

    def rows(run):
        return sorted(map(tuple, run.jobs.collect()), key=str), sorted(map(tuple, run.attempts.collect()), key=str), sorted(map(tuple, run.counters.collect()))

    whole = rows(rounds.run_rounds(words, call, today(), now=now(), sleep=lambda _: None, state=f"{folder}-whole"))
    calls = len(open(log).read())
    writer = type(words.write)
    plain = writer.parquet
    monkeypatch.setattr(writer, "parquet", lambda self, path, *a, **k: (_ for _ in ()).throw(Stop()) if path.endswith(stopped) else plain(self, path, *a, **k))
    with pytest.raises(Stop):
        rounds.run_rounds(words, call, today(), now=now(), sleep=lambda _: None, state=folder)
    monkeypatch.setattr(writer, "parquet", plain)
    assert rows(rounds.run_rounds(words, call, today(), now=now(), sleep=lambda _: None, state=folder)) == whole
    assert len(open(log).read()) == 2 * calls
    assert rows(rounds.run_rounds(words, call, today(), now=now(), sleep=lambda _: None, state=folder)) == whole
    assert len(open(log).read()) == 2 * calls


def test_a_tracker_holds_few_rows():
    """One job with 200,000 outcomes, latest first, in frames of 1,000."""
    frames = (pd.DataFrame({"seq": range(at, at + 1_000)}).sample(frac=1, random_state=1) for at in range(199_000, -1, -1_000))
    assert processors.JobTracker._first(frames, 3)["seq"].tolist() == [0, 1, 2]


def test_numbers_as_texts(spark):
    numbers = [0.0, -0.0, 5e-324, 4.94e-322, 2.2250738585072014e-308, -1e-310, 0.1, 1e16, 123456789.125, 1e-4, 9.9e-5, 1 / 3, None]
    found = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double").select("i", num_text(F.col("x")).alias("t"))
    assert {r.i: r.t for r in found.collect()} == {i: None if x is None else repr(x) for i, x in enumerate(numbers)}


def test_an_export_reads_its_jobs_once(spark, small, folder):
    from docfields import fixtures
    from docfields.catalog.jobs import now
    from docfields.session import materialise
    from docfields.sources import exports

    table = materialise(fixtures.jobs(spark, small), "jobs")
    metrics = spark.createDataFrame([("retry_scheduled", 3)], "name string, n long")
    counter = spark.sparkContext.accumulator(0)

    def seen(value):
        counter.add(1)
        return value

    flag = F.udf(seen, "boolean").asNondeterministic()
    exports.write_export(table, flag("has_ocr_snapshot"), metrics, folder, now())
    assert counter.value == table.count()
    report = spark.read.json(f"{folder}/report").first()
    assert report.summary.total_jobs_in_export == table.count() and report.exported_at.startswith("2024-06-01")
    assert {m.name: m.n for m in report.metrics}["retry_scheduled"] == 3
    exports.write_export(table.limit(0), F.col("has_ocr_snapshot"), metrics, f"{folder}-none", now())
    assert spark.read.json(f"{folder}-none/report").first().outcomes.receipt_count == 0


def test_oldest_due_opens_few_folders(spark, folder):
    import datetime

    from docfields.sources import queues

    rows = spark.range(5_000).select(F.concat(F.lit("j"), F.col("id") % 700).alias("job_id"),
                                     F.when(F.col("id") % 50 != 0, F.timestamp_seconds(1_704_067_200 + F.col("id") * 97)).alias("due_at"))
    queues.write_queue(rows, folder)
    for now, limit in ((datetime.datetime(2024, 1, 3), 50), (datetime.datetime(2024, 1, 1, 0, 10), 50), (datetime.datetime(2023, 1, 1), 5),
                       (datetime.datetime(2025, 1, 1), 5_000), (datetime.datetime(2024, 1, 2), 1)):
        found = queues.oldest_due(spark, folder, now, limit)
        expected = jobs.due_retries(rows, F.lit(now), limit)
        assert list(map(tuple, found.collect())) == list(map(tuple, expected.collect()))
    # 50 entries of some 37 an hour: two hours of 135.
    assert queues.hours_of(spark, folder, datetime.datetime(2024, 1, 5), 50) == ["2024010100", "2024010101"]
    assert {f.split("_hour=")[1][:10] for f in queues.oldest_due(spark, folder, datetime.datetime(2024, 1, 5)).inputFiles()} == {"2024010100", "2024010101"}


def test_pages_of_a_long_row(spark):
    from docfields.operators import totals

    n = 30_000
    words = spark.range(n).select(F.lit(1).alias("doc_id"), F.lit(0).cast("long").alias("row_ix"), (F.col("id") * 7 % n).alias("x"), F.lit(5).alias("cy"),
                                  F.col("id").alias("word_id"), F.concat(F.lit("w"), F.col("id") * 7 % n).alias("text"))
    whole = totals.row_texts(words).first().row_text
    for hot_rows in (1_000_000, 100):
        pages = totals.row_text_pages(words, 1_000, hot_rows).orderBy("page").collect()
        assert len(pages) == 30 and " ".join(p.text for p in pages) == whole
        assert all(whole[p.offset : p.offset + len(p.text)] == p.text for p in pages)


def test_rows_are_counted_only_where_a_document_is_cut(spark, monkeypatch):
    """rows of ordinary documents take one pass that counts, not two; the pages are the same."""
    from docfields.catalog import all_queries
    from docfields.operators import scans, totals

    counted, write = [], scans.materialise
    monkeypatch.setattr(scans, "materialise", lambda df, name: counted.append(name) or write(df, name))
    pages = all_queries()["row_text_pages"].run(spark, "/root/testdata/sf0.001")
    assert counted == ["hot-keys"]
    words = totals.total_words(all_queries()["receipt_words"].run(spark, "/root/testdata/sf0.001"))
    cut = totals.paged_row_texts(words, 2, hot_rows=5)
    assert sorted(map(tuple, pages.collect())) == sorted(map(tuple, cut.select(*pages.columns).collect()))


def test_places_of_listed_images(spark, tmp_path):
    from docfields.sources import images

    names = [f"{'Ab'[i % 2]}{i * 7919 % 1_000}.jpg" for i in range(60)]
    for name in names:
        (tmp_path / name).write_bytes(b"x")
    assert [r.name for r in images.image_names(images.image_files(spark, str(tmp_path))).collect()] == sorted(names)
