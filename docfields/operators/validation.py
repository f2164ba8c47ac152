"""The validation gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfields.functions.dates import parse_invoice_date
from docfields.functions.text import is_numeric_text, strip

MAX_TOTAL = 1e9
MIN_YEAR = 1990
VENDOR_LENGTH = (2, 100)


def validation_errors(vendor: Column, date: Column, total: Column, today: Column) -> Column:
    """the broken rules, in a fixed order; the length and number checks count only when nothing else is wrong."""
    parsed = parse_invoice_date(date)
    blank = vendor.isNull() | (strip(vendor) == "")
    rules = F.array_compact(F.array(
        F.when(blank, "vendor_empty").when(is_numeric_text(vendor), "vendor_numeric_only"),
        F.when(date.isNull(), "date_missing").when(parsed.isNull(), "date_invalid_format"),
        F.when(parsed > today, "date_in_future"),
        F.when(F.year(parsed) < MIN_YEAR, "date_unreasonably_old"),
        F.when(total.isNull(), "total_missing")
        .when(F.isnan(total), F.lit(None))
        .when(total <= 0, "total_not_positive")
        .when(total > MAX_TOTAL, "total_out_of_range"),
    ))
    n = F.length(strip(vendor))
    schema = F.array_compact(F.array(
        F.when(n < VENDOR_LENGTH[0], "vendor_too_short").when(n > VENDOR_LENGTH[1], "vendor_too_long"),
        F.when(F.isnan(total), "total_invalid"),
    ))
    return F.when(F.size(rules) > 0, rules).otherwise(schema)


def validate(payloads: DataFrame, today: Column) -> DataFrame:
    """Every payload with ``ok``, ``errors`` and, where ok, the normalised values."""
    errors = validation_errors(F.col("vendor"), F.col("date"), F.col("total"), today)
    checked = payloads.withColumn("errors", errors).withColumn("ok", F.size("errors") == 0)
    ok = F.col("ok")
    return checked.withColumns({
        "norm_vendor": F.when(ok, strip(F.col("vendor"))),
        "norm_date": F.when(ok, parse_invoice_date(F.col("date"))),
        "norm_total": F.when(ok, F.round("total", 2)),
    })
