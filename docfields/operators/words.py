"""Words, rows and lines of a page."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfields.functions.boxes import merge_boxes
from docfields.functions.text import is_ascii, is_blank
from docfields.operators.scans import HOT_ROWS, OrderedRows, scan_by_key
ROW_GAP = 14
LINE_GAP = 15
HEADER_SHARE = 0.21
HEADER_LINES = 8
MIN_WORD_CONF = 10
MIN_LINE_CONF = 45


def nonblank(words: DataFrame) -> DataFrame:
    """Drop words that are nothing but blanks."""
    return words.filter(~is_blank(F.col("text")))


def min_conf(words: DataFrame, floor: int = MIN_WORD_CONF) -> DataFrame:
    """Keep words recognised with at least ``floor`` (of 100)."""
    return words.filter(F.col("conf") >= floor)


def header_band(words: DataFrame, share: float = HEADER_SHARE) -> DataFrame:
    """Keep words that start in the top part of the page."""
    return words.filter(F.col("y") < F.floor(F.col("page_h") * share))


def first_lines(lines: DataFrame, n: int = HEADER_LINES) -> DataFrame:
    """Keep the first lines, counted before any line is dropped."""
    return lines.filter(F.col("line_ix") < n)


@F.pandas_udf(T.StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda s: unicodedata.normalize("NFKC", s), na_action="ignore")


def normalize_words(words: DataFrame) -> DataFrame:
    """F8: compatibility-normalised text. Only non-ASCII words visit a Python worker; the split is by filter,
    because a branch of ``when`` would not keep the others out."""
    plain = is_ascii(F.col("text"))
    return words.filter(plain).unionByName(words.filter(~plain).withColumn("text", _nfkc("text")))


def doc_confidence(words: DataFrame) -> DataFrame:
    """A1: mean recognition confidence of the non-blank words of every document, 0.0 without any."""
    return doc_summary(words).drop("n_rows")


def doc_summary(words: DataFrame) -> DataFrame:
    """A1 and ``n_rows``, all rows of the document, from one pass that combines before the shuffle."""
    counted = ~is_blank(F.col("text"))
    total, n = F.sum(F.when(counted, F.col("conf"))), F.count(F.when(counted, F.col("conf")))
    return words.groupBy("doc_id").agg(
        F.coalesce(total / (n * F.lit(100.0)), F.lit(0.0)).alias("ocr_conf"), n.alias("n_words"), F.count(F.lit(1)).alias("n_rows"))


def _mark_rows(rows: OrderedRows, gap: int) -> DataFrame:
    opens = F.when(F.col("cy") - F.col("_prev") > gap, 1).otherwise(0)
    return rows.lag("_prev", F.col("cy")).running("row_ix", opens, "sum").df.drop("_prev", "chunk")


def group_rows(
    words: DataFrame, y_tol: int = ROW_GAP, hot_rows: int | None = HOT_ROWS, hot: DataFrame | None = None
) -> DataFrame:
    """Number the rows of every page from 0; a vertical gap above ``y_tol`` between neighbours opens a row."""
    centred = words.withColumn("cy", F.col("y") + F.floor(F.col("h") / 2).cast("int"))
    return scan_by_key(centred, ["doc_id"], ["cy", "word_id"], lambda r: _mark_rows(r, y_tol), hot_rows, hot)


def _mark_lines(rows: OrderedRows, gap: int) -> DataFrame:
    opens = F.when(F.abs(F.col("y") - F.col("_prev")) >= gap, 1).otherwise(0)
    return rows.lag("_prev", F.col("y")).running("line_ix", opens, "sum").df.drop("_prev", "chunk")


def group_lines(
    words: DataFrame, y_tol: int = LINE_GAP, hot_rows: int | None = HOT_ROWS, hot: DataFrame | None = None
) -> DataFrame:
    """Number the lines of every page in reading order; a vertical jump of ``y_tol`` opens a line."""
    return scan_by_key(words, ["doc_id"], ["word_id"], lambda r: _mark_lines(r, y_tol), hot_rows, hot)


def joined(order: list[str], separator: str = " ", text: Column | None = None) -> Column:
    """A2, as an aggregate: the texts of a group in ``order``, separated."""
    pieces = F.sort_array(F.collect_list(F.struct(*order, (F.col("text") if text is None else text).alias("_text"))))
    return F.array_join(pieces["_text"], separator)


def joined_by_page(
    words: DataFrame, keys: list[str], separator: str, *rest: Column, page_words: int = 4096
) -> DataFrame:
    """A2 where a group may be huge: join pages of at most ``page_words`` words first, then the pages.

    ``word_id`` is unique in a document, so a page is a slice of it and no task collects more than one page of words.
    """
    page = F.floor(F.col("word_id") / page_words).alias("page")
    pages = words.groupBy(*keys, page).agg(joined(["word_id"], separator).alias("text"), *rest)
    return pages.groupBy(*keys).agg(joined(["page"], separator).alias("text"))


def document_text(words: DataFrame, page_words: int = 4096) -> DataFrame:
    """A2: all words of a document, one per line, in reading order."""
    return joined_by_page(nonblank(words), ["doc_id"], "\n", page_words=page_words)


LINE_SUMS = {
    "conf_sum": F.sum, "conf_n": F.sum, "n_words": F.sum, "h_sum": F.sum, "h_max": F.max, "h_min": F.min,
    "x1": F.min, "y1": F.min, "x2": F.max, "y2": F.max,
}


def line_table(
    words: DataFrame, tidy: Callable[[Column], Column] = lambda text: text, page_words: int = 4096, paged: bool = False
) -> DataFrame:
    """A2-A4 per line: text, confidence sum and count (unknown confidences left out), heights, box corners.

    ``tidy`` is applied to the text as it leaves the aggregate, so later filters on it do not repeat the work.
    ``paged`` first folds slices of the words of a line, for documents whose lines may be huge.
    """
    x, y, w, h, conf = (F.col(c) for c in ("x", "y", "w", "h", "conf"))
    known = conf >= 0
    sums = [
        F.coalesce(F.sum(F.when(known, conf)), F.lit(0)).alias("conf_sum"),
        F.count(F.when(known, conf)).alias("conf_n"),
        F.count(F.lit(1)).alias("n_words"), F.sum(h).alias("h_sum"), F.max(h).alias("h_max"), F.min(h).alias("h_min"),
        F.min(x).alias("x1"), F.min(y).alias("y1"), F.max(x + w).alias("x2"), F.max(y + h).alias("y2"),
    ]
    keys = ["doc_id", "line_ix"]
    if not paged:
        return words.groupBy(*keys).agg(tidy(joined(["word_id"])).alias("text"), *sums)
    page = F.floor(F.col("word_id") / page_words).alias("page")
    pages = words.groupBy(*keys, page).agg(joined(["word_id"]).alias("text"), *sums)
    return pages.groupBy(*keys).agg(
        tidy(joined(["page"])).alias("text"), *[fold(name).alias(name) for name, fold in LINE_SUMS.items()]
    )


def is_unreliable(floor: int = MIN_LINE_CONF, of: Callable[[str], Column] = F.col) -> Column:
    """P5 / A3 over :func:`line_table`: handwriting and stamps, by low confidence or uneven height."""
    low = (of("conf_n") == 0) | (of("conf_sum") / F.nullif(of("conf_n"), F.lit(0)) < floor)
    mean_h = of("h_sum") / of("n_words")
    uneven = (of("n_words") > 1) & (mean_h > 0) & (of("h_max") - of("h_min") > mean_h * 1.5)
    return F.coalesce(low, F.lit(True)) | uneven


def line_box() -> Column:
    """A4 over :func:`line_table`."""
    return F.struct(
        F.col("x1").alias("x"), F.col("y1").alias("y"),
        (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"),
    )


def line_boxes(words: DataFrame, keys: list[str]) -> DataFrame:
    """A4 for any grouping of boxes."""
    return words.groupBy(*keys).agg(merge_boxes(*[F.col(c) for c in ("x", "y", "w", "h")]).alias("bbox"))
