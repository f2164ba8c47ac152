"""Sources, sinks and streams."""

import glob
import json
import time

from pyspark.sql import functions as F

from docfields import fixtures
from docfields.operators import delivery
from docfields.operators.routing import extract_fields, route
from docfields.sources import exports, images
from docfields.sources.words import collect_snapshot, snapshot_entries, read_words, read_words_stream
from docfields.streaming import processors, stages


def test_only_top_level_images_are_listed(spark, tmp_path):
    for name in ("b.JPG", "a.png", "c.jpeg", "d.txt", "k=v/e.jpg", "sub/f.png"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"x")
    assert [r.name for r in images.image_names(images.image_files(spark, str(tmp_path))).collect()] == ["a.png", "b.JPG", "c.jpeg"]


def test_words_read_under_the_fixed_schema(spark, small, tmp_path):
    words = fixtures.receipt_words(spark, small)
    for file_format in ("parquet", "json"):
        path = str(tmp_path / file_format)
        words.write.format(file_format).save(path)
        assert read_words(spark, path, file_format).exceptAll(words).count() == 0


def test_snapshot_defaults(spark):
    rows = spark.createDataFrame([(1, 0, '[{"text": "a"}, {"conf": 0.5, "bbox": [1, 2, 3, 4]}]')], "doc_id long, page long, snapshot string")
    found = [tuple(r)[2:] for r in snapshot_entries(rows).orderBy("at").collect()]
    assert found == [(0, 0.0, "a", None, None, None, None), (1, 0.5, "", 1, 2, 3, 4)]


def test_snapshot_pages_stay_small(spark, small):
    pages = collect_snapshot(fixtures.receipt_words(spark, small), page_words=100)
    assert pages.filter(F.length("snapshot") > 1000).count() == 0
    assert snapshot_entries(pages).count() == fixtures.receipt_words(spark, small).filter("trim(text) <> ''").count()


def test_export_files(spark, small, tmp_path):
    jobs = fixtures.jobs(spark, small)
    exports.write_buckets(jobs, str(tmp_path / "json"))
    assert sorted(p.rsplit("=", 1)[1] for p in glob.glob(str(tmp_path / "json" / "bucket=*"))) == [
        "legacy_dlq", "needs_human_review", "non_terminal", "valid_invoices"]
    exports.write_csv(jobs, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.count() == 1500 and back.columns[:3] == ["job_id", "file", "vendor"]
    exports.write_csv(jobs.limit(0), str(tmp_path / "empty"))
    assert not (tmp_path / "empty").exists()
    exports.write_summary(jobs, F.col("has_ocr_snapshot"), str(tmp_path / "summary"))
    assert spark.read.json(str(tmp_path / "summary")).first().outcomes.receipt_count == 1500


def test_nested_export_document(spark, tmp_path):
    rows = [{"job_id": str(i), "vendor": "V", "total": 1.5, "status": status} for i, status in enumerate(("SUCCESS", " success ", None, "DLQ"))]
    (tmp_path / "export.json").write_text(json.dumps({"valid_invoices": rows, "needs_human_review": [{"job_id": "9"}]}, indent=2))
    found = exports.read_export_document(spark, str(tmp_path / "export.json"))
    assert sorted(r.job_id for r in found.collect()) == ["0", "1", "2"]


def test_review_queue_file(spark, tmp_path):
    schema = "job_id string, reason string, recorded_at int"
    old = spark.createDataFrame([("a", "x", 1), ("b", "y", 1)], schema)
    new = spark.createDataFrame([("a", "z", 2), ("a", "w", 3)], schema)
    exports.write_review_queue(old, new, str(tmp_path / "queue"))
    assert {tuple(r) for r in spark.read.schema(schema).json(str(tmp_path / "queue")).collect()} == {("a", "w", 3), ("b", "y", 1)}


def test_delivery_retries_with_growing_waits(spark, tmp_path):
    log = str(tmp_path / "waits")

    def sleep(seconds):
        with open(log, "a") as f:
            f.write(f"{seconds}\n")

    rows = spark.createDataFrame([("1", "V")], "job_id string, vendor string")
    out = delivery.deliver(rows, lambda row: False, 3, 0.5, sleep, pause=0.2)
    assert tuple(out.first()) == ("1", False, 3) and open(log).read().split() == ["0.5", "1.0", "2.0", "0.2"]
    report = delivery.delivery_report(out.limit(0)).first()
    assert (report.attempted, report.skipped_no_valid) == (0, True)


def test_streamed_extraction_equals_batch_and_survives_restart(spark, small, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("words", "sink", "state"))
    words = fixtures.receipt_words(spark, small)
    words.filter("doc_id < 700").repartition(2, "doc_id").write.parquet(source)
    today = F.lit("1998-01-01").cast("date")

    def run():
        stages.drain(stages.stream_extract(read_words_stream(spark, source, files=1), sink, state, today))

    run()
    words.filter("doc_id >= 700").repartition(2, "doc_id").write.mode("append").parquet(source)
    run()
    run()
    found = spark.read.parquet(f"{sink}/routed").drop("batch")
    expected = route(extract_fields(words)).select(found.columns)
    assert found.count() == 1500 and found.exceptAll(expected).count() == 0


def test_tracker_remembers_failures_between_batches(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "job_id string, seq long, stage string, ok boolean, error string, strategy string"

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)

    def run(n):
        tracked = processors.track_jobs(spark.readStream.schema(schema).parquet(source), 2, base_ms=10_000_000, cap_ms=10_000_000)
        writer = tracked.writeStream.outputMode("update").option("checkpointLocation", state)
        writer.foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/run={n}")).trigger(once=True).start().awaitTermination()
        return {r.job_id: (r.status, r.failures, r.strategy) for r in spark.read.parquet(f"{out}/run={n}").filter("event = 'outcome'").collect()}

    arrive(("a", 1, "llm", False, "e", None), ("b", 1, "validation", True, None, None))
    assert run(1) == {"a": ("RETRY_SCHEDULED", 1, "strict_json"), "b": ("SUCCESS", 0, None)}
    arrive(("a", 2, "validation", False, "e", "strict_json"), ("b", 2, "llm", False, "late", None))
    assert run(2) == {"a": ("NEEDS_REVIEW", 2, "strict_json")}
    assert [r.history for r in spark.read.parquet(f"{out}/run=2").collect()] == ["llm:e:;validation:e:strict_json"]


def test_scheduled_retries_fall_due(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "job_id string, seq long, stage string, ok boolean, error string, strategy string"
    spark.createDataFrame([("a", 1, "llm", False, "e", "strict_json")], schema).coalesce(1).write.parquet(source)
    tracked = processors.track_jobs(spark.readStream.schema(schema).parquet(source), 2, base_ms=500, cap_ms=500)
    writer = tracked.writeStream.outputMode("update").option("checkpointLocation", state)
    query = writer.foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/run={i}")).trigger(processingTime="1 second").start()
    try:
        deadline, events = time.time() + 60, []
        while "due" not in [e[0] for e in events] and time.time() < deadline:
            time.sleep(2)
            if glob.glob(f"{out}/run=*/_SUCCESS"):
                events = [(r.event, r.status, r.strategy) for r in spark.read.parquet(f"{out}/run=*").collect()]
    finally:
        query.stop()
    assert sorted(events) == [("due", "LLM_PENDING", "ocr_retry"), ("outcome", "RETRY_SCHEDULED", "ocr_retry")]


def test_form_rows_of_the_published_shape(spark):
    rows = spark.createDataFrame(
        [("1", " SWC ENTERPRISE SDN BHD ", "2018-03-23", 41.2), ("2", None, None, None), ("3", "X", "soon", 193.0)],
        "job_id string, vendor string, date string, total double")
    assert [tuple(r)[1:] for r in delivery.form_rows(rows).orderBy("job_id").collect()] == [
        ("SWC ENTERPRISE SDN BHD", "2018-03-23", "41.2"), ("", "", ""), ("X", "soon", "193.0")]
