"""Fixed column layouts, stated once; nothing is inferred from data."""

from pyspark.sql import types as T

BOX = T.StructType([T.StructField(n, T.IntegerType()) for n in ("x", "y", "w", "h")])

WORDS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("word_id", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("conf", T.IntegerType()),
    T.StructField("x", T.IntegerType()),
    T.StructField("y", T.IntegerType()),
    T.StructField("w", T.IntegerType()),
    T.StructField("h", T.IntegerType()),
    T.StructField("page_h", T.IntegerType()),
])

SNAPSHOT = T.ArrayType(T.StructType([
    T.StructField("conf", T.DoubleType()),
    T.StructField("text", T.StringType()),
    T.StructField("bbox", T.ArrayType(T.IntegerType())),
]))

JOBS = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("image_path", T.StringType()),
    T.StructField("vendor", T.StringType()),
    T.StructField("invoice_date", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("source", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("retry_count", T.IntegerType()),
    T.StructField("max_retries", T.IntegerType()),
    T.StructField("next_retry_at", T.TimestampType()),
    T.StructField("failure_class", T.StringType()),
    T.StructField("attempt_strategy", T.StringType()),
    T.StructField("ocr_snapshot", T.StringType()),
    T.StructField("extraction_payload", T.StringType()),
    T.StructField("llm_last_raw", T.StringType()),
    T.StructField("last_error", T.StringType()),
    T.StructField("retry_history", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

ATTEMPTS = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("stage", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("strategy", T.StringType()),
])

# The states in which nothing more happens to a job by itself.
TERMINAL = ("SUCCESS", "NEEDS_REVIEW", "DLQ")
