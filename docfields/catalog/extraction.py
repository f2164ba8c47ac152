"""Queries on word boxes: grouping, candidates, fields, routing, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfields import fixtures
from docfields.catalog import Catalog
from docfields.catalog import sql as S
from docfields.functions.boxes import box, center, corners, to_xywh
from docfields.functions.scores import parse_amount, score_label
from docfields.functions.text import clean_line
from docfields.operators import dates, routing, totals, validation, vendors
from docfields.operators import words as W
from docfields.sources.words import collect_snapshot, explode_snapshot, snapshot_entries

QUERIES = Catalog()
TODAY = "1998-01-01"

words = fixtures.receipt_words


def flat(name: str) -> list[Column]:
    """A box struct as four columns."""
    return [F.col(f"{name}.{c}").alias(c) for c in ("x", "y", "w", "h")]


def xywh() -> Column:
    return box(*[F.col(c) for c in ("x", "y", "w", "h")])


def today() -> Column:
    return F.lit(TODAY).cast("date")


QUERIES.add("receipt_words", "S2", words, f"WITH {S.WORDS} SELECT * FROM words")
QUERIES.add("nonblank_words", "P1", lambda s, d: W.nonblank(words(s, d)),
            f"WITH {S.WORDS} SELECT * FROM words WHERE trim(text) <> ''")
QUERIES.add("confident_words", "P2", lambda s, d: W.min_conf(words(s, d)), f"WITH {S.WORDS} SELECT * FROM words WHERE conf >= 10")
QUERIES.add("header_band_words", "P3", lambda s, d: W.header_band(words(s, d)),
            f"WITH {S.WORDS} SELECT * FROM words WHERE y < floor(page_h * 0.21)")
QUERIES.add("normalized_header_words", "F8 X2", lambda s, d: vendors.header_words(words(s, d)),
            f"WITH {S.WORDS} SELECT doc_id, word_id, trim(text) AS text, conf, x, y, w, h FROM words "
            "WHERE trim(text) <> '' AND y < floor(page_h * 0.21)")
QUERIES.add("document_confidence", "A1", lambda s, d: W.doc_confidence(words(s, d)),
            f"WITH {S.WORDS}, {S.CONFIDENCE} SELECT * FROM doc_conf")
QUERIES.add("document_texts", "A2", lambda s, d: W.document_text(words(s, d)),
            f"WITH {S.WORDS} SELECT doc_id, string_agg(text, chr(10) ORDER BY word_id) AS text FROM words "
            "WHERE trim(text) <> '' GROUP BY doc_id")
QUERIES.add(
    "document_boxes", "A4", lambda s, d: W.line_boxes(words(s, d), ["doc_id"]).select("doc_id", *flat("bbox")),
    f"WITH {S.WORDS} SELECT doc_id, min(x) AS x, min(y) AS y, max(x + w) - min(x) AS w, max(y + h) - min(y) AS h "
    "FROM words GROUP BY doc_id",
)


def box_forms(s, d) -> DataFrame:
    boxes = words(s, d).select("doc_id", "word_id", xywh().alias("b"))
    forms = boxes.select("doc_id", "word_id", to_xywh(corners(F.col("b"))).alias("r"), center(F.col("b")).alias("m"))
    return forms.select("doc_id", "word_id", *flat("r"), "m.cx", "m.cy")


QUERIES.add("box_forms", "F12", box_forms,
            f"WITH {S.WORDS} SELECT doc_id, word_id, {S.box()}, x + w / 2e0 AS cx, y + h / 2e0 AS cy FROM words")
QUERIES.add(
    "snapshot_round_trip", "S3",
    lambda s, d: snapshot_entries(collect_snapshot(words(s, d), page_words=1000)).drop("page", "at"),
    f"WITH {S.WORDS} SELECT doc_id, conf / 100e0 AS conf, text, x, y, w, h FROM words WHERE trim(text) <> ''",
)

QUERIES.add(
    "page_rows", "W1 O5", lambda s, d: W.group_rows(totals.total_words(words(s, d))).select("doc_id", "word_id", "cy", "row_ix"),
    f"WITH {S.WORDS}, {S.TOTALS} SELECT doc_id, word_id, cy, row_ix FROM in_rows",
)
QUERIES.add("row_texts", "A2 W1", lambda s, d: totals.row_texts(W.group_rows(totals.total_words(words(s, d)))),
            f"WITH {S.WORDS}, {S.TOTALS} SELECT * FROM row_texts")
QUERIES.add(
    "row_text_pages", "A2",
    lambda s, d: totals.paged_row_texts(totals.total_words(words(s, d)), page_words=2),
    f"""WITH {S.WORDS}, {S.TOTALS}, n AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, row_ix ORDER BY x, cy, word_id) - 1) // 2 AS page FROM in_rows),
    p AS (SELECT doc_id, row_ix, page, string_agg(trim(text), ' ' ORDER BY x, cy, word_id) AS text FROM n GROUP BY ALL)
    SELECT *, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id, row_ix ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint)
        AS "offset" FROM p""",
)
QUERIES.add(
    "row_labels", "F7",
    lambda s, d: totals.row_texts(W.group_rows(totals.total_words(words(s, d)))).select(
        "doc_id", "row_ix", score_label(F.col("row_text")).alias("label")),
    f"WITH {S.WORDS}, {S.TOTALS} SELECT doc_id, row_ix, label FROM row_labels",
)
QUERIES.add("word_amounts", "F6", lambda s, d: words(s, d).select("doc_id", "word_id", parse_amount(F.col("text")).alias("amount")),
            f"WITH {S.WORDS} SELECT doc_id, word_id, {S.AMOUNT} AS amount FROM words")


def row_amounts(s, d) -> DataFrame:
    rows = totals.with_amounts(W.group_rows(totals.total_words(words(s, d))))
    # A row without an amount is left out, and words without one do not count in any, so they are not sorted into rows.
    best = rows.filter("amount is not null").groupBy("doc_id", "row_ix").agg(totals.row_amount().alias("b"))
    return best.select("doc_id", "row_ix", "b.val", *flat("b.bbox"))


QUERIES.add("row_amounts", "A5", row_amounts, f"WITH {S.WORDS}, {S.TOTALS} SELECT * FROM row_amounts")
QUERIES.add(
    "total_candidates", "F7 F15 A5",
    lambda s, d: totals.total_candidates(words(s, d)).select("doc_id", "row_ix", "label", "score", "val", *flat("bbox")),
    f"WITH {S.WORDS}, {S.TOTALS} SELECT * FROM total_candidates",
)
QUERIES.add(
    "receipt_totals", "C1 F15 W4",
    lambda s, d: totals.extract_total(words(s, d)).select("doc_id", "total", "total_conf", *flat("total_bbox")),
    f"WITH {S.WORDS}, {S.TOTALS} SELECT * FROM totals",
)
QUERIES.add(
    "receipt_totals_oversized", "C1 W1",
    lambda s, d: totals.extract_total(words(s, d), hot_rows=22).select("doc_id", "total", "total_conf", *flat("total_bbox")),
    f"WITH {S.WORDS}, {S.TOTALS} SELECT * FROM totals",
)

QUERIES.add(
    "date_matches", "F2", lambda s, d: dates.all_date_matches(words(s, d)).select("doc_id", "word_id", "match_ix", "raw"),
    f"""WITH {S.WORDS}, {S.DATES} SELECT doc_id, word_id,
    CAST(row_number() OVER (PARTITION BY doc_id, word_id ORDER BY pi, mi) - 1 AS int) AS match_ix, raw FROM date_matches""",
)
QUERIES.add(
    "date_candidates", "F14",
    lambda s, d: dates.date_candidates(words(s, d)).select("doc_id", "word_id", "raw", "date_conf", "score", *flat("bbox")),
    f"""WITH {S.WORDS}, {S.DATES} SELECT doc_id, word_id, raw, date_conf, score, x, y, w, h FROM date_scores
    QUALIFY row_number() OVER (PARTITION BY doc_id, word_id ORDER BY pi, mi) = 1""",
)
QUERIES.add(
    "receipt_dates", "C2 F3 F14 W4",
    lambda s, d: dates.extract_date(words(s, d)).select("doc_id", "date", "date_conf", *flat("date_bbox")),
    f"WITH {S.WORDS}, {S.DATES} SELECT doc_id, date, date_conf, x, y, w, h FROM dates",
)
QUERIES.add(
    "snapshot_dates", "S3 C2",
    lambda s, d: dates.extract_date(explode_snapshot(collect_snapshot(words(s, d)))).select("doc_id", "date", "date_conf", *flat("date_bbox")),
    f"WITH {S.WORDS}, {S.DATES} SELECT doc_id, date, date_conf, x, y, w, h FROM dates",
)

QUERIES.add(
    "contested_total_candidates", "F7 F15 A5 W4",
    lambda s, d: totals.total_candidates(fixtures.contested_totals(s, d)).select("doc_id", "row_ix", "label", "score", "val", *flat("bbox")),
    f"WITH {S.CONTESTED_TOTALS}, {S.TOTALS} SELECT * FROM total_candidates",
)
QUERIES.add(
    "contested_totals", "C1 F15 W4",
    lambda s, d: totals.extract_total(fixtures.contested_totals(s, d)).select("doc_id", "total", "total_conf", *flat("total_bbox")),
    f"WITH {S.CONTESTED_TOTALS}, {S.TOTALS} SELECT * FROM totals",
)
QUERIES.add(
    "contested_totals_oversized", "C1 W1 W4",
    lambda s, d: totals.extract_total(fixtures.contested_totals(s, d), hot_rows=36).select("doc_id", "total", "total_conf", *flat("total_bbox")),
    f"WITH {S.CONTESTED_TOTALS}, {S.TOTALS} SELECT * FROM totals",
)
QUERIES.add(
    "contested_date_candidates", "F14 F2 W4",
    lambda s, d: dates.date_candidates(fixtures.contested_dates(s, d)).select("doc_id", "word_id", "raw", "date_conf", "score", *flat("bbox")),
    f"""WITH {S.CONTESTED_DATES}, {S.DATES} SELECT doc_id, word_id, raw, date_conf, score, x, y, w, h FROM date_scores
    QUALIFY row_number() OVER (PARTITION BY doc_id, word_id ORDER BY pi, mi) = 1""",
)
QUERIES.add(
    "contested_dates", "C2 F3 F14 W4",
    lambda s, d: dates.extract_date(fixtures.contested_dates(s, d)).select("doc_id", "date", "date_conf", *flat("date_bbox")),
    f"WITH {S.CONTESTED_DATES}, {S.DATES} SELECT doc_id, date, date_conf, x, y, w, h FROM dates",
)

QUERIES.add("page_lines", "W2", lambda s, d: W.group_lines(vendors.header_words(words(s, d))).select("doc_id", "word_id", "line_ix"),
            f"WITH {S.WORDS}, {S.VENDORS} SELECT doc_id, word_id, line_ix FROM in_lines")
QUERIES.add("header_lines", "A2 A3 A4 P4", lambda s, d: vendors.header_lines(words(s, d)),
            f"WITH {S.WORDS}, {S.VENDORS} SELECT * FROM header_lines")
QUERIES.add(
    "line_reliability", "A3 P5 F9",
    lambda s, d: vendors.header_lines(words(s, d)).select(
        "doc_id", "line_ix", clean_line(F.col("text")).alias("clean"), W.is_unreliable().alias("unreliable")),
    f"WITH {S.WORDS}, {S.VENDORS} SELECT doc_id, line_ix, clean, unreliable FROM cleaned",
)
QUERIES.add(
    "vendor_lines", "P5 P6 F9 W3",
    lambda s, d: vendors.vendor_lines(vendors.header_lines(words(s, d), tidy=clean_line)),
    f"WITH {S.WORDS}, {S.VENDORS} SELECT * FROM vendor_lines",
)
QUERIES.add(
    "vendor_candidates", "J6 F10 F11 F13",
    lambda s, d: vendors.vendor_candidates(vendors.vendor_lines(vendors.header_lines(words(s, d), tidy=clean_line))),
    f"WITH {S.WORDS}, {S.VENDORS} SELECT * FROM vendor_candidates",
)
QUERIES.add(
    "receipt_vendors", "C3 F13 W4",
    lambda s, d: vendors.extract_vendor(words(s, d)).select("doc_id", "vendor", "vendor_conf", *flat("vendor_bbox")),
    f"WITH {S.WORDS}, {S.VENDORS} SELECT * FROM vendors",
)
QUERIES.add(
    "receipt_vendors_oversized", "C3 W2",
    lambda s, d: vendors.extract_vendor(words(s, d), hot_rows=22).select("doc_id", "vendor", "vendor_conf", *flat("vendor_bbox")),
    f"WITH {S.WORDS}, {S.VENDORS} SELECT * FROM vendors",
)

FIELD_COLUMNS = ("doc_id", "ocr_conf", "n_words", "vendor", "vendor_conf", "total", "total_conf", "date", "date_conf")


def routed(s, d) -> DataFrame:
    return routing.route(routing.extract_fields(words(s, d)))


QUERIES.add("receipt_fields", "C4 J9 P11", lambda s, d: routing.extract_fields(words(s, d)).select(*FIELD_COLUMNS),
            f"WITH {S.FIELDS} SELECT * FROM fields")
QUERIES.add("routed_receipts", "P7 C4", lambda s, d: routed(s, d).select(*FIELD_COLUMNS, "route"),
            f"WITH {S.FIELDS} SELECT * FROM routed")
QUERIES.add("rule_payloads", "P8", lambda s, d: routing.rule_payload(routed(s, d)),
            f"WITH {S.FIELDS} SELECT * EXCLUDE (route) FROM rule_payloads")


def validated(s, d) -> DataFrame:
    checked = validation.validate(routing.rule_payload(routed(s, d)), today())
    return checked.select(
        "job_id", "vendor", "total", "date", "confidence", "ok", F.array_join("errors", ",").alias("errors"),
        "norm_vendor", F.date_format("norm_date", "yyyy-MM-dd").alias("norm_date"), "norm_total",
    )


QUERIES.add(
    "validated_receipts", "C6 F4 F20 F21 F22", validated,
    f"""WITH {S.FIELDS}, {S.validated("rule_payloads", TODAY)}
    SELECT job_id, vendor, total, date, confidence, ok, errors, CASE WHEN ok THEN trim(vendor) END AS norm_vendor,
           CASE WHEN ok THEN strftime(parsed, '%Y-%m-%d') END AS norm_date, CASE WHEN ok THEN round(total, 2) END AS norm_total
    FROM validated""",
)
QUERIES.add(
    "validation_error_counts", "F21",
    lambda s, d: validation.validate(routing.rule_payload(routed(s, d)), today())
    .select(F.explode("errors").alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("jobs")),
    f"""WITH {S.FIELDS}, {S.validated("rule_payloads", TODAY)}
    SELECT error, count(*) AS jobs FROM (SELECT unnest(string_split(errors, ',')) AS error FROM validated WHERE errors <> '')
    GROUP BY error""",
)
