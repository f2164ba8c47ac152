"""Receipts, jobs, model responses and outcomes derived from the driver's tables.

Each function scans its tables whole; the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return orders.join(customers, orders.o_custkey == customers.c_custkey)


def _by_key(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` dealt by their key before words are made of them, so that what groups words by document moves no word. The
    number of partitions is named, because adaptive execution would count bytes here and put too many words together."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _cents(c: Column) -> Column:
    return c.cast("decimal(12,2)")


def receipt_words(spark: SparkSession, folder: str) -> DataFrame:
    """Word boxes of one receipt per order, item lines from ``lineitem``."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    dd, mm, yyyy = (F.date_format(day, p) for p in ("dd", "MM", "yyyy"))
    total = _cents(F.col("o_totalprice"))
    slash = F.concat_ws("/", dd, mm, yyyy)
    printed_date = (
        F.when(k % 6 == 0, slash)
        .when(k % 6 == 1, F.concat(F.lit("Date:"), slash))
        .when(k % 6 == 2, F.concat_ws("-", dd, mm, F.substring(yyyy, 3, 2)))
        .when(k % 6 == 3, F.concat_ws("-", yyyy, mm, dd))
        .when(k % 6 == 4, F.concat_ws("/", mm, dd, yyyy))
        .otherwise("31/02/2018")
    )
    kinds = ("TRADING", "Enterprise", "MART", "RESTAURANT", "holdings")
    kind = F.element_at(F.array(*[F.lit(s) for s in kinds]), (k % 5 + 1).cast("int"))
    first = (F.when(k % 7 == 0, "GRAND").when(k % 7 == 1, "NET").when(k % 7 == 2, "AMOUNT")
             .when(k % 7 == 3, "ROUNDED").otherwise("THE"))
    second = F.when(k % 7 == 1, "PAYABLE").when(k % 7 == 2, "DUE").otherwise("TOTAL")
    amount = F.concat(F.when(k % 7 == 3, "RM").otherwise(""), total.cast("string"))
    printed = [
        (0, 0, F.col("c_mktsegment")),
        (0, 1, kind),
        (0, 2, F.when(k % 3 == 0, "SDN").when(k % 3 == 1, "LTD").otherwise("CO.")),
        (0, 3, F.when(k % 3 == 0, "BHD")),
        (1, 0, F.lit("No")), (1, 1, F.lit("12")), (1, 2, F.lit("JALAN")),
        (2, 0, F.lit("Invoice")),
        (2, 1, F.when(k % 13 != 0, printed_date)),
        (20, 0, F.lit("SUBTOTAL")), (20, 1, total.cast("string")),
        (21, 0, first), (21, 1, second), (21, 2, F.when(k % 17 != 0, amount)),
        (22, 0, F.lit("CASH")), (22, 1, (total + F.lit(10)).cast("string")),
        (23, 0, F.when(k % 10 == 0, "  ")),
    ]
    cells = F.array(*[
        F.struct(F.lit(line).alias("line_no"), F.lit(pos).alias("pos"), text.alias("text")) for line, pos, text in printed
    ])
    orders = _orders(spark, folder).select("o_orderkey", "o_orderdate", "o_totalprice", "c_mktsegment")
    frame = _by_key(orders, "o_orderkey").select(k.alias("k"), F.explode(cells).alias("c")).select("k", "c.*")
    items = (
        _by_key(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_orderkey")
        .groupBy("l_orderkey", "l_linenumber").agg(F.max("l_extendedprice").alias("price"))
        .select(
            F.col("l_orderkey").alias("k"),
            (F.lit(2) + F.col("l_linenumber")).cast("int").alias("line_no"),
            F.posexplode(F.array(F.lit("ITEM"), _cents(F.col("price")).cast("string"))).alias("pos", "text"),
        )
    )
    return _boxes(frame.filter(F.col("text").isNotNull()).unionByName(items))


def _boxes(printed: DataFrame) -> DataFrame:
    """Texts by document, line and position as word boxes."""
    line, pos, text, k = F.col("line_no"), F.col("pos"), F.col("text"), F.col("k")
    mark = k + line * 3 + pos
    return (
        printed.select(
            k.alias("doc_id"),
            (line * 100 + pos).cast("int").alias("word_id"),
            "text",
            F.when(mark % 41 == 0, -1).when(mark % 37 == 0, 5)
            .otherwise((30 + (k * 7 + line * 13 + pos * 29) % 70).cast("int")).alias("conf"),
            (20 + 90 * pos).cast("int").alias("x"),
            (20 + 40 * line + (pos % 3) * 4).cast("int").alias("y"),
            (10 * F.length(text)).cast("int").alias("w"),
            F.when((k % 11 == 0) & (line == 0) & (pos == 1), 90).otherwise(20).alias("h"),
            F.lit(980).alias("page_h"),
        )
    )


def _more(spark: SparkSession, folder: str, printed: list[tuple[int, int, Column]]) -> DataFrame:
    """Further boxes on the receipts."""
    cells = F.array(*[F.struct(F.lit(line).alias("line_no"), F.lit(pos).alias("pos"), text.alias("text")) for line, pos, text in printed])
    orders = _orders(spark, folder).select("o_orderkey", "o_orderdate", "o_totalprice", "c_mktsegment")
    rows = _by_key(orders, "o_orderkey").select(F.col("o_orderkey").alias("k"), F.explode(cells).alias("c")).select("k", "c.*")
    return _boxes(rows.filter(F.col("text").isNotNull()))


def contested_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Receipts with two to five labelled amounts, some of which score the same (a label 50 better, ten rows lower)."""
    k, total = F.col("o_orderkey"), F.col("o_totalprice")
    amount = lambda less: (_cents(total) - F.lit(less)).cast("string")
    printed = [(line, 0, F.lit("ITEM")) for line in range(24, 32)] + [
        (32, 0, F.lit("AMOUNT")), (32, 1, F.lit("PAYABLE")), (32, 2, amount(4)),
        (33, 0, F.when(k % 2 == 0, "TOTAL")), (33, 1, F.when(k % 2 == 0, "AMOUNT")), (33, 2, F.when(k % 2 == 0, amount(2))),
        (34, 0, F.when(k % 3 == 0, "Balance")), (34, 1, F.when(k % 3 == 0, "due")), (34, 2, F.when(k % 3 == 0, amount(8)))]
    return receipt_words(spark, folder).unionByName(_more(spark, folder, printed))


def contested_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Receipts with up to five dates: with and without a keyword, months in words, equal scores, and words without a box."""
    k = F.col("o_orderkey")
    printed = [
        (1, 3, F.when(k % 4 == 0, "InvoiceDate:05/06/2017")), (1, 4, F.when(k % 3 == 0, "2016/07/08")),
        (2, 2, F.when(k % 5 == 0, "12 Mar 2019").when(k % 5 == 1, "March 3, 2018").when(k % 5 == 2, "日期:7/8/2018")),
        # The same height and confidence, so the earlier word wins.
        (1, 5, F.when(k % 6 == 1, "01/02/2018")), (1, 215, F.when(k % 6 == 1, "03/04/2018"))]
    words = receipt_words(spark, folder).unionByName(_more(spark, folder, printed))
    lost = (F.col("doc_id") % 9 == 0) & (F.col("word_id") == 201)
    return words.withColumns({c: F.when(~lost, F.col(c)) for c in ("x", "y", "w", "h")})


def jobs(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    done = k % 10 < 6
    return _orders(spark, folder).select(
        k.cast("string").alias("job_id"),
        F.concat(F.lit("images/"), k.cast("string"), F.lit(".jpg")).alias("image_path"),
        F.when(done, F.col("c_mktsegment")).alias("vendor"),
        F.when(done, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("invoice_date"),
        F.when(done, F.col("o_totalprice")).alias("total_amount"),
        F.when(done, (k % 100).cast("double") / 100).alias("confidence"),
        F.when(k % 10 < 4, "OCR_RULE").when(k % 10 == 4, "LLM").when(k % 10 == 5, "HUMAN").alias("source"),
        F.when(done, "SUCCESS").when(k % 10 < 8, "NEEDS_REVIEW").when(k % 20 == 8, "DLQ")
        .when(k % 20 == 18, "OCR_DONE").otherwise("LLM_PENDING").alias("status"),
        F.when((k % 10).between(6, 8), 2).otherwise(k % 2).cast("int").alias("retry_count"),
        F.lit(2).alias("max_retries"),
        F.when(k % 10 == 6, "validation_failed_after_retry:date_in_future")
        .when(k % 10 == 7, "llm_parse_failed_after_retry").when(k % 20 == 8, "  ")
        .when(k % 20 == 18, F.repeat(F.lit("x"), 130)).alias("last_error"),
        (k % 9 != 0).alias("has_ocr_snapshot"),
        F.col("o_orderdate").alias("updated_at"),
    )


def responses(spark: SparkSession, folder: str) -> DataFrame:
    """One raw model response per three consecutive orders."""
    k = F.col("o_orderkey")
    amount = _cents(F.col("o_totalprice")).cast("string")
    total = (
        F.when(k % 4 == 0, amount)
        .when(k % 4 == 1, F.concat(F.lit('"RM '), amount, F.lit('"')))
        .when(k % 4 == 2, "null").otherwise('"n/a"')
    )
    item = F.concat(
        F.lit('{"job_id": "'), F.when(k % 19 == 0, "").otherwise(k.cast("string")),
        F.lit('", "vendor": "'), F.col("c_mktsegment"), F.lit('", "total": '), total,
        F.lit(', "date": "'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('"}'),
    )
    items = _orders(spark, folder).select(k.alias("k"), (k - k % 3).alias("batch_id"), item.alias("item"))
    slot = [F.coalesce(F.max(F.when(F.col("k") % 3 == i, F.col("item"))), F.lit("null")) for i in range(3)]
    body = F.concat(F.lit('{"results": ['), F.concat_ws(", ", *slot), F.lit("]}"))
    batch = F.col("batch_id")
    return items.groupBy("batch_id").agg(body.alias("body")).select(
        "batch_id",
        F.when(batch % 23 == 0, "sorry, no JSON here")
        .otherwise(F.concat(F.when(batch % 5 == 0, "Here it is: ").otherwise(""), F.col("body"))).alias("response"),
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Model requests: every order, batched as in :func:`responses`."""
    k = F.col("o_orderkey")
    return _orders(spark, folder).select(
        (k - k % 3).alias("batch_id"), k.cast("string").alias("job_id"),
        F.concat(F.lit("images/"), k.cast("string"), F.lit(".jpg")).alias("file"),
        F.when(k % 4 == 0, "default").when(k % 4 == 1, "strict_json")
        .when(k % 4 == 2, "after_validation_fail").otherwise(F.when(k % 8 == 3, "ocr_retry").otherwise("other"))
        .alias("strategy"),
        F.col("o_orderdate").alias("arrival"),
    )


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Call outcomes: the event log with ``error`` as failure."""
    return table(spark, folder, "events").select(
        "event_id", "ts", F.col("user_id").alias("key"), (F.col("event_type") == "error").alias("failed"),
        F.col("event_type").alias("name"), F.lit(1).alias("n"),
    )


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Failed attempts: the error events, one job per user."""
    events = table(spark, folder, "events").filter("event_type = 'error'")
    e = F.col("event_id")
    return events.select(
        F.col("user_id").cast("string").alias("job_id"), "ts",
        F.when(e % 3 == 0, "ocr").when(e % 3 == 1, "llm").otherwise("validation").alias("stage"),
        F.concat(F.lit("error "), e.cast("string")).alias("error"),
        F.when(e % 4 == 0, "default").when(e % 4 == 1, "strict_json").when(e % 4 == 2, "after_validation_fail")
        .otherwise("ocr_retry").alias("strategy"),
    )
