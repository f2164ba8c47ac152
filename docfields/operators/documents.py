"""Vendor, total and date of documents of ordinary size, from one pass over their words.

The words of a document are gathered once, by one aggregate, and looked through as an array; the operators on tables of words
(:mod:`docfields.operators.totals`, ``vendors``, ``dates``) sort and group them anew for every field, which holds for
documents of any size. What is looked for, and which of equals wins, is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfields.functions.boxes import box
from docfields.functions.dates import ANY_DATE, first_date_match, normalize_date
from docfields.functions.scores import best_label, date_score, has_label_stem, is_labelled, parse_amount, total_conf, total_score, vendor_conf
from docfields.functions.text import (
    NEGATIVE_PHRASES, clean_line, clean_text, compatible, is_bad_line, is_blank, strip_word,
)
from docfields.operators.dates import MAYBE_DATE
from docfields.operators.vendors import RUNS, best_vendor, runs_of_lines
from docfields.operators.words import HEADER_LINES, HEADER_SHARE, LINE_GAP, MIN_WORD_CONF, ROW_GAP, is_unreliable
from docfields.session import once

# A document is gathered in one row if it has no more rows than this and its words are numbered below the other.
DOC_ROWS, DOC_NUMBERS = 1_024, 4_096


def gathered(words: DataFrame, most: int = DOC_ROWS) -> DataFrame:
    """Every document with the figures of its confidence, ``large`` and three arrays of structs: ``words``, those that are not
    blank, which sort from the top down; ``header``, those of the header, which sort in reading order; ``dated``, those that
    may hold a date. No row holds more than ``DOC_NUMBERS`` words; of a ``large`` document it may not hold all.

    What can be told of a word is told here, in compiled code; functions on arrays are not compiled.
    """
    seen, here, told, figures, large = _gathering(most)
    docs = words.withColumn("seen", seen).withColumn("here", here).select(*told).groupBy("doc_id").agg(*figures)
    return docs.select("doc_id", "ocr_conf", "n_words", *GATHERED, large)


@once
def _gathering(most: int) -> tuple[Column, Column, list[Column], list[Column], Column]:
    text, seen, number, here = F.col("text"), F.col("seen"), F.col("word_id"), F.col("here")
    x, y, w, h, conf = (F.col(c) for c in ("x", "y", "w", "h", "conf"))
    word = F.struct(
        (y + F.floor(h / 2).cast("int")).alias("cy"), "word_id", "text", (conf >= MIN_WORD_CONF).alias("usable"),
        has_label_stem(text).alias("stem"), "x", "y", "w", "h")
    top = F.struct(
        "word_id", "y", strip_word(text).alias("text"), F.when(conf >= 0, conf).alias("conf"), "x", "h", (x + w).alias("x2"), (y + h).alias("y2"))
    dated = F.struct("word_id", "text", (conf / F.lit(100.0)).alias("conf"), "y", "h", box(x, y, w, h).alias("bbox"))
    told = [
        F.col("doc_id"), number, F.when(seen, conf).alias("conf"), F.when(here, word).alias("word"),
        F.when(here & (y < F.floor(F.col("page_h") * HEADER_SHARE)), top).alias("top"),
        F.when(here & text.rlike(MAYBE_DATE), dated).alias("dated")]
    n = F.count("conf")
    figures = [
        F.coalesce(F.sum("conf") / (n * F.lit(100.0)), F.lit(0.0)).alias("ocr_conf"), n.alias("n_words"),
        F.collect_list("word").alias("words"), F.collect_list("top").alias("header"), F.collect_list("dated").alias("dated"),
        F.count(F.lit(1)).alias("n_rows"), F.min(number).alias("least"), F.max(number).alias("last"), F.count(number).alias("n_numbers")]
    large = (F.col("n_rows") > most) | (F.col("n_numbers") < F.col("n_rows")) | (F.col("least") < 0) | (F.col("last") >= DOC_NUMBERS)
    return ~is_blank(text), seen & number.between(0, DOC_NUMBERS - 1), told, figures, large.alias("large")


GATHERED = ("words", "header", "dated")


def _box(w: Column) -> Column:
    return box(w["x"], w["y"], w["w"], w["h"])


def with_total(docs: DataFrame, y_tol: int = ROW_GAP) -> DataFrame:
    """C1 over :func:`gathered`: ``total``, ``total_conf``, ``total_bbox``. Only rows with a label stem are put together."""
    usable, heights, opened, best, found = _total_columns(y_tol)
    told = docs.withColumn("_usable", usable).withColumn("_heights", heights).withColumn("_starts", opened).withColumn("_best", best)
    return told.withColumns(found).drop("_usable", "_heights", "_starts", "_best")


@once
def _total_columns(y_tol: int) -> tuple:
    usable, heights, starts = F.col("_usable"), F.col("_heights"), F.col("_starts")

    def row(ix: Column) -> Column:
        start = F.get(starts, ix)
        ws = F.slice(usable, start + 1, F.coalesce(F.get(starts, ix + 1), F.size(usable)) - start)
        return F.struct(ix.alias("ix"), F.sort_array(F.transform(ws, across)).alias("ws"))

    def across(w: Column) -> Column:
        """A word so that it sorts from left to right."""
        return F.struct(*[w[c].alias(c) for c in ("x", "cy", "word_id", "text", "y", "w", "h")])

    def read(w: Column) -> Column:
        return F.struct(parse_amount(w["text"]).alias("val"), -w["x"], -w["cy"], -w["word_id"], _box(w).alias("bbox"))

    def best_amount(ws: Column) -> Column:
        return F.array_max(F.filter(F.transform(ws, read), lambda a: a["val"].isNotNull()))

    opened = F.filter(F.transform(heights, lambda cy, i: i), lambda i: (i == 0) | (F.get(heights, i) - F.get(heights, i - 1) > y_tol))
    stems = F.filter(F.transform(usable["stem"], lambda stem, i: F.when(stem, i)), lambda i: i.isNotNull())
    rows = F.transform(F.array_distinct(F.transform(stems, lambda i: F.size(F.filter(starts, lambda s: s <= i)) - 1)), row)
    texts = F.transform(rows, lambda r: F.struct(
        r["ix"].alias("ix"), F.lower(F.array_join(F.transform(r["ws"]["text"], strip_word), " ")).alias("text"), r["ws"].alias("ws")))
    found = F.transform(F.filter(texts, lambda r: is_labelled(r["text"])), lambda r: F.struct(
        total_score(best_label(r["text"]), r["ix"]).alias("score"), (-r["ix"]).alias("up"), best_amount(r["ws"]).alias("best")))
    best = F.array_max(F.filter(found, lambda r: r["best"].isNotNull()))
    return F.sort_array(F.filter("words", lambda w: w["usable"])), usable["cy"], opened, best, {
        "total": F.col("_best.best.val"), "total_conf": total_conf(F.col("_best.score")), "total_bbox": F.col("_best.best.bbox")}


def with_date(docs: DataFrame) -> DataFrame:
    """C2 over :func:`gathered`: ``date``, ``date_conf``, ``date_bbox``."""
    best, raw, found = _date_columns()
    return docs.withColumn("_best", best).withColumn("_raw", raw).withColumns(found).drop("_best", "_raw")


@once
def _date_columns() -> tuple:
    def cleaned(w: Column) -> Column:
        return F.struct(clean_text(w["text"]).alias("text"), w.alias("word"))

    def candidate(m: Column) -> Column:
        w = m["word"]
        return F.struct(date_score(m["text"], w["y"], w["h"], w["conf"]).alias("score"), (-w["word_id"]).alias("first"),
                        first_date_match(m["text"]).alias("raw"), w["conf"].alias("conf"), w["bbox"].alias("bbox"))

    maybe = F.transform("dated", cleaned)
    best = F.array_max(F.transform(F.filter(maybe, lambda w: w["text"].rlike(ANY_DATE)), candidate))
    return best, F.col("_best.raw"), {
        "date": normalize_date(F.col("_raw")), "date_conf": F.col("_best.conf"), "date_bbox": F.col("_best.bbox")}


def with_vendor(docs: DataFrame, phrases=NEGATIVE_PHRASES, y_tol: int = LINE_GAP, n: int = HEADER_LINES) -> DataFrame:
    """C3 over :func:`gathered`: ``vendor``, ``vendor_conf``, ``vendor_bbox``; the gathered words are left out.

    Lines are cut out of the header and told of in rows, at most ``n`` a document, with the other columns beside them.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", *GATHERED)]
    header, heights, opened, begun, ws, joined, cleaned, figures, kept, told, shown, i = _vendor_columns(tuple(phrases or ()), y_tol, n)
    cut = (
        docs.withColumn("_header", header).withColumn("_heights", heights).withColumn("_opens", opened)
        .select("doc_id", *rest, "_header", "_opens", begun).select("doc_id", *rest, "_at", ws)
    )
    lines = (
        cut.withColumn("_joined", joined).withColumn("_text", cleaned).withColumn("_figures", figures).withColumn("_kept", kept)
        .select("doc_id", *rest, *told).filter(shown)
    )
    runs = runs_of_lines(lines.withColumn("i", i), *rest).select("doc_id", *rest, F.greatest(*RUNS).alias("run"))
    best = runs.groupBy("doc_id").agg(F.max("run").alias("b"), *[F.first(c).alias(c) for c in rest])
    return best_vendor(best, "doc_id", *rest)


@once
def _vendor_columns(phrases: tuple[str, ...], y_tol: int, n: int) -> tuple:
    header, opens, heights, at, start = (F.col(c) for c in ("_header", "_opens", "_heights", "_at", "_start"))
    opened = F.filter(
        F.transform(heights, lambda y, i: i), lambda i: (i == 0) | (F.abs(F.get(heights, i) - F.get(heights, i - 1)) >= y_tol))
    of_line = F.slice(header, start + 1, F.coalesce(F.get(opens, at + 1), F.size(header)) - start)
    ws, h, conf, text, kept = F.col("_words"), F.col("_words.h"), F.col("_words.conf"), F.col("_text"), F.col("_kept")

    def total(numbers: Column) -> Column:
        return F.aggregate(numbers, F.lit(0).cast("long"), lambda s, v: s + F.coalesce(v, F.lit(0)))

    figures = F.struct(
        total(conf).alias("conf_sum"), F.size(F.array_compact(conf)).alias("conf_n"), F.size(ws).alias("n_words"),
        F.when(F.array_max(h).isNotNull(), total(h)).alias("h_sum"), F.array_max(h).alias("h_max"), F.array_min(h).alias("h_min"))
    named = (text != "") & ~is_bad_line(text, phrases)
    reliable = F.col("_figures").isNotNull() & ~is_unreliable(of=lambda c: F.col(f"_figures.{c}"))
    corners = {"x1": F.array_min("_words.x"), "y1": F.array_min("_words.y"), "x2": F.array_max("_words.x2"), "y2": F.array_max("_words.y2")}
    # Rows are numbered so that the filter is not computed before the rows are, which would clean every line twice.
    told = [at, kept, F.monotonically_increasing_id().alias("line_ix"), F.when(kept, text).alias("clean"),
            *[F.when(kept, value).alias(name) for name, value in corners.items()]]
    # The first line of a document stands for it where no line is kept; kept lines follow each other.
    before = Window.partitionBy("doc_id").orderBy("line_ix").rowsBetween(Window.unboundedPreceding, 0)
    return (F.sort_array("header"), header["y"], opened, F.posexplode_outer(F.slice(opens, 1, n)).alias("_at", "_start"),
            of_line.alias("_words"), F.array_join("_words.text", " "), clean_line(compatible(F.col("_joined"))), F.when(named, figures),
            F.coalesce(reliable, F.lit(False)), told, kept | (F.coalesce(at, F.lit(0)) == 0),
            (F.sum(kept.cast("int")).over(before) - 1).cast("int"))


@once
def text(words: str) -> Column:
    """A2 over :func:`gathered`: the words, one per line, in reading order."""
    in_order = F.sort_array(F.transform(words, lambda w: F.struct(w["word_id"], w["text"].alias("text"))))
    return F.array_join(in_order["text"], "\n")
