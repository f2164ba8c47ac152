"""Export files and the review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfields.functions.text import strip
from docfields.operators.jobs import upsert_review
from docfields.operators.reports import bucket, export_buckets, export_row, report_of, run_profile, run_report
from docfields.session import materialise

EXPORT_ROW = (
    "job_id string, file string, vendor string, date string, total double, confidence double, source string, "
    "status string, retry_count int, last_error string"
)


def write_buckets(jobs: DataFrame, path: str) -> None:
    """JSON lines, one folder per bucket. The writer needs no shuffle; a large bucket is many files."""
    export_buckets(jobs).write.mode("overwrite").partitionBy("bucket").json(path)


def read_bucket(spark: SparkSession, path: str, bucket: str) -> DataFrame:
    """Rows of one bucket; the others are not opened."""
    return spark.read.schema(f"{EXPORT_ROW}, bucket string").json(path).filter(F.col("bucket") == bucket).drop("bucket")


# Quotes are doubled and blanks kept, as spreadsheet programs expect and as they were.
CSV = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(jobs: DataFrame, path: str) -> None:
    """All rows, flat, with a header; without rows nothing is written. The rows are computed once."""
    rows = materialise(export_row(jobs), "export-rows")
    if not rows.isEmpty():
        rows.write.mode("overwrite").options(**CSV).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EXPORT_ROW).options(**CSV, multiLine="true").csv(path)


def load_valid(exported: DataFrame) -> DataFrame:
    """Rows fit for delivery: status absent or SUCCESS, whatever its case."""
    status = F.upper(strip(F.col("status")))
    return exported.filter(F.col("status").isNull() | (status == "SUCCESS"))


def read_export_document(spark: SparkSession, path: str) -> DataFrame:
    """S7 from a single nested export document: its ``valid_invoices`` list.

    One document is one task by its nature; a large export is read from its bucket folders (:func:`read_bucket`).
    """
    document = spark.read.option("multiLine", True).schema(f"valid_invoices array<struct<{_fields()}>>").json(path)
    return load_valid(document.select(F.explode("valid_invoices").alias("r")).select("r.*"))


def _fields() -> str:
    return ", ".join(part.replace(" ", ":", 1) for part in EXPORT_ROW.split(", "))


def write_review_queue(existing: DataFrame, new: DataFrame, path: str) -> None:
    """Merge and write to a fresh path; the caller switches over once it is complete."""
    upsert_review(existing, new).write.mode("errorifexists").json(path)


def write_summary(jobs: DataFrame, has_snapshot, path: str, metrics: DataFrame | None = None) -> None:
    """What became of the run as JSON: outcome counts, metrics, observability, histogram, failure modes (one row by
    construction, so one file is right)."""
    told = jobs.sparkSession.createDataFrame([], "name string, n long") if metrics is None else metrics
    run_report(jobs, has_snapshot, told).coalesce(1).write.mode("overwrite").json(path)


def write_export(jobs: DataFrame, has_snapshot: Column, metrics: DataFrame, path: str, exported_at: Column) -> None:
    """The whole export: rows by bucket, the same as CSV, and the report of this moment (``exported_at``).

    Jobs are read once: the exported columns are written as a table from which the files are made, and the report is made
    of counts of that table. Without jobs there are no CSV files. The report comes last, so where there is one the
    export is whole.
    """
    rows = materialise(export_row(jobs, bucket(F.col("status")).alias("bucket"), has_snapshot.alias("_snapshot")), "export-rows")
    profile = materialise(run_profile(rows, F.col("_snapshot")), "profile")
    rows.drop("_snapshot").write.mode("overwrite").partitionBy("bucket").json(f"{path}/buckets")
    if not profile.isEmpty():
        rows.drop("_snapshot", "bucket").write.mode("overwrite").options(**CSV).csv(f"{path}/csv")
    report = report_of(profile, metrics).withColumn("exported_at", exported_at.cast("timestamp"))
    report.coalesce(1).write.mode("overwrite").json(f"{path}/report")
