"""Total amount of every receipt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfields.functions.boxes import box
from docfields.functions.scores import (
    best_label, has_label_stem, is_labelled, is_skipped, label_only, parse_amount, total_conf, total_score,
)
from docfields.functions.text import strip_word
from docfields.operators.scans import HOT_ROWS, chunked, oversized, scan_by_key, split
from docfields.operators.words import ROW_GAP, _mark_rows, group_rows, joined, min_conf, nonblank

IN_ROW = ["x", "cy", "word_id"]


def total_words(words: DataFrame) -> DataFrame:
    """The words the total is looked for in."""
    return nonblank(min_conf(words)).select("doc_id", "word_id", "text", "x", "y", "w", "h")


def row_texts(rows: DataFrame) -> DataFrame:
    """A2: text of every row, left to right."""
    return rows.groupBy("doc_id", "row_ix").agg(joined(IN_ROW, " ", strip_word(F.col("text"))).alias("row_text"))


def row_text_pages(rows: DataFrame, page_words: int = 4096, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """A2 for rows of any length: the text of every row in pages of at most ``page_words`` words.

    ``page`` numbers them from 0 and ``offset`` is where the page begins in the row's text, counted in characters. The
    pages are those of :func:`row_texts` cut apart, so page, a separator and the next page follow each other. No task holds
    more of a row than a page.
    """
    keys = ["doc_id", "row_ix"]
    words = rows.select(*keys, *IN_ROW, strip_word(F.col("text")).alias("_word"))
    numbered = scan_by_key(words, keys, IN_ROW, lambda r: r.number("_n").df.drop("chunk"), hot_rows)
    page = F.floor((F.col("_n") - 1) / page_words).alias("page")
    pages = numbered.groupBy(*keys, page).agg(joined(["_n"], " ", F.col("_word")).alias("text"))
    before = Window.partitionBy(*keys).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    return pages.withColumn("offset", F.coalesce(F.sum(F.char_length("text") + 1).over(before), F.lit(0)).cast("long"))


def paged_row_texts(
    words: DataFrame, page_words: int = 4096, y_tol: int = ROW_GAP, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """:func:`row_text_pages` of the rows of ``words``. A row is no larger than its document, so rows are counted only where
    a document is cut into chunks."""
    hot = None if hot_rows is None else oversized(words, ["doc_id"], hot_rows)
    rows = group_rows(words, y_tol, hot_rows=None, hot=hot)
    return row_text_pages(rows, page_words, None if hot is None else hot_rows)


def with_amounts(words: DataFrame) -> DataFrame:
    return words.withColumn("amount", parse_amount(F.col("text")))


def row_amount() -> Column:
    """A5, as an aggregate over :func:`with_amounts` of a row: the largest amount and its box, the leftmost of equals."""
    amount = F.col("amount")
    found = F.struct(amount.alias("val"), box(*[F.col(c) for c in ("x", "y", "w", "h")]).alias("bbox"))
    return F.max_by(found, F.when(amount.isNotNull(), F.struct(amount, *[-F.col(c) for c in IN_ROW])))


def _labelled_rows(rows: DataFrame) -> DataFrame:
    """Rows with a label and an amount, of documents of ordinary size; their words are stripped already.

    Rows are numbered before any is dropped; only those with a label stem (a few per document) get a text.
    """
    row = Window.partitionBy("doc_id", "row_ix")
    stemmed = rows.withColumn("stem", F.max(has_label_stem(F.col("text"))).over(row)).filter("stem")
    return (
        with_amounts(stemmed).groupBy("doc_id", "row_ix")
        .agg(F.lower(joined(IN_ROW, " ")).alias("row_text"), row_amount().alias("best"))
        # A filter on the label itself would have it computed twice.
        .filter(F.col("best.val").isNotNull() & is_labelled(F.col("row_text")))
        .select("doc_id", "row_ix", best_label(F.col("row_text")).alias("label"), "best.val", "best.bbox")
    )


def _labelled_rows_large(rows: DataFrame) -> DataFrame:
    """The same without ever holding a row in one place: labels reach over three neighbouring words at most, so they
    are looked for in every run of three and folded."""
    near = (
        chunked(rows, ["doc_id", "row_ix"], IN_ROW)
        .lag("_back1", F.col("text")).lag("_back2", F.col("_back1")).df
    )
    run = F.concat_ws(" ", *[strip_word(F.col(c)) for c in ("_back2", "_back1", "text")])
    return (
        with_amounts(near).groupBy("doc_id", "row_ix")
        .agg(
            F.max(label_only(run)).alias("label"),
            F.max(is_skipped(run).cast("int")).alias("skipped"),
            row_amount().alias("best"),
        )
        .filter("label > 0 and skipped = 0 and best.val is not null")
        .select("doc_id", "row_ix", "label", "best.val", "best.bbox")
    )


def total_candidates(
    words: DataFrame, y_tol: int = ROW_GAP, hot_rows: int | None = HOT_ROWS, hot: DataFrame | None = None
) -> DataFrame:
    """Labelled rows holding an amount: doc_id, row_ix, label, score, val, bbox."""
    usable = total_words(words)
    if hot is None and hot_rows is not None:
        hot = oversized(words, ["doc_id"], hot_rows)
    # Stripped here and not inside the aggregate, which would not compile it.
    tidy = lambda rows: rows.withColumn("text", strip_word(F.col("text")))
    if hot is None:
        found = _labelled_rows(group_rows(tidy(usable), y_tol, hot_rows=None))
    else:
        small, large = split(usable, hot, ["doc_id"])
        centred = large.withColumn("cy", F.col("y") + F.floor(F.col("h") / 2).cast("int"))
        large_rows = _mark_rows(chunked(centred, ["doc_id"], ["cy", "word_id"]), y_tol)
        found = _labelled_rows(group_rows(tidy(small), y_tol, hot_rows=None)).unionByName(_labelled_rows_large(large_rows))
    return found.withColumn("score", total_score(F.col("label"), F.col("row_ix")))


def extract_total(
    words: DataFrame, y_tol: int = ROW_GAP, hot_rows: int | None = HOT_ROWS, hot: DataFrame | None = None
) -> DataFrame:
    """Total, confidence and box of every document that has one."""
    candidates = total_candidates(words, y_tol, hot_rows, hot)
    best = F.max_by(F.struct("val", "score", "bbox"), F.struct("score", -F.col("row_ix")))
    return candidates.groupBy("doc_id").agg(best.alias("b")).select(
        "doc_id", F.col("b.val").alias("total"), total_conf(F.col("b.score")).alias("total_conf"),
        F.col("b.bbox").alias("total_bbox"),
    )
