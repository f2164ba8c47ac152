"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The word table is built and written once (reported as ``build_words``), because a real run reads words, it does not
derive them from orders. Every query is run to its last row into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from docfields import fixtures  # noqa: E402
from docfields.catalog.events import calls  # noqa: E402
from docfields.operators import dates, health, jobs, reports, requests, routing, totals, validation, vendors  # noqa: E402
from docfields.session import local_session  # noqa: E402
from docfields.sources import exports  # noqa: E402
from docfields.sources.words import read_words  # noqa: E402


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, partitions=cores)
    scratch = tempfile.mkdtemp(prefix="spark-")
    took: dict[str, float] = {}

    def timed(name: str, run) -> None:
        begun = time.perf_counter()
        run()
        took[name] = round(time.perf_counter() - begun, 3)

    path = f"{scratch}/words"
    timed("build_words", lambda: fixtures.receipt_words(spark, folder).repartition(2 * cores, "doc_id").write.parquet(path))
    words = read_words(spark, path)
    table = fixtures.jobs(spark, folder)
    today = F.lit("1998-01-01").cast("date")
    n_docs = fixtures.table(spark, folder, "orders").count()
    # Warm-up: generated code, Python workers and file cache.
    drain(validation.validate(routing.rule_payload(routing.extract_fields(words)), today))

    timed("receipt_totals", lambda: drain(totals.extract_total(words)))
    timed("receipt_dates", lambda: drain(dates.extract_date(words)))
    timed("receipt_vendors", lambda: drain(vendors.extract_vendor(words)))
    timed("routed_receipts", lambda: drain(routing.route(routing.extract_fields(words))))
    timed("validated_receipts", lambda: drain(
        validation.validate(routing.rule_payload(routing.extract_fields(words)), today)))
    timed("parsed_responses", lambda: drain(requests.parse_batch(fixtures.responses(spark, folder), "batch_id")))
    timed("batch_prompts", lambda: drain(requests.batch_prompt(requests.assign_batches(
        fixtures.requests(spark, folder).withColumn("text", F.col("file"))))))
    timed("job_completion", lambda: drain(jobs.completion(table.select("job_id"), table)))
    timed("attempt_rollup", lambda: drain(jobs.attempt_rollup(fixtures.attempts(spark, folder))))
    timed("circuit_states", lambda: drain(health.circuit(calls(spark, folder), "key")))
    timed("export_and_evaluation", lambda: (
        exports.write_export(table, F.col("has_ocr_snapshot"), spark.createDataFrame([], "name string, n long"), f"{scratch}/export", F.current_timestamp()),
        drain(reports.failure_modes(table))))

    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(v for k, v in took.items() if k != "build_words"), 3),
        "unit": "sec", "queries": took, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "documents_per_sec": round(n_docs / took["routed_receipts"], 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
