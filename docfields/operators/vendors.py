"""Vendor name of every receipt."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfields.functions.scores import vendor_conf, vendor_score_of
from docfields.functions.text import (
    NEGATIVE_PHRASES, capitals, clean_line, compatible, is_bad_line, letters, positive_bits, positive_phrases, strip_word,
)
from docfields.operators.scans import HOT_ROWS, chunked, oversized, split
from docfields.operators.words import (
    HEADER_LINES, HEADER_SHARE, LINE_GAP, _mark_lines, first_lines, group_lines, header_band, is_unreliable,
    line_table, nonblank, normalize_words,
)
from docfields.session import once


def header_words(words: DataFrame, share: float = HEADER_SHARE, normal: bool = True) -> DataFrame:
    """Words of the header; ``normal`` has each compatibility-normalised in full."""
    kept = nonblank(header_band(words, share)).select(
        "doc_id", "word_id", strip_word(F.col("text")).alias("text"), "conf", "x", "y", "w", "h"
    )
    return normalize_words(kept) if normal else kept


def header_lines(
    words: DataFrame, share: float = HEADER_SHARE, y_tol: int = LINE_GAP, n: int = HEADER_LINES,
    hot_rows: int | None = HOT_ROWS, hot: DataFrame | None = None, tidy: Callable[[Column], Column] = lambda text: text,
    normal: bool = True,
) -> DataFrame:
    """The first lines of the header with text, confidence and height figures and box."""
    header = header_words(words, share, normal)
    if hot is None and hot_rows is not None:
        hot = oversized(words, ["doc_id"], hot_rows)
    if hot is None:
        return line_table(first_lines(group_lines(header, y_tol, hot_rows=None), n), tidy)
    small, large = split(header, hot, ["doc_id"])
    large_lines = _mark_lines(chunked(large, ["doc_id"], ["word_id"]), y_tol)
    return line_table(first_lines(group_lines(small, y_tol, hot_rows=None), n), tidy).unionByName(
        line_table(first_lines(large_lines, n), tidy, paged=True)
    )


def vendor_lines(lines: DataFrame, phrases=NEGATIVE_PHRASES) -> DataFrame:
    """Of lines with cleaned text those that may name a vendor, renumbered from 0 (at most eight a document)."""
    kept = lines.filter((F.col("text") != "") & ~is_unreliable() & ~is_bad_line(F.col("text"), phrases))
    per_doc = Window.partitionBy("doc_id").orderBy("line_ix")
    return kept.select(
        "doc_id", "line_ix", (F.row_number().over(per_doc) - 1).alias("i"), F.col("text").alias("clean"), "x1", "y1", "x2", "y2"
    )


def vendor_candidates(kept: DataFrame) -> DataFrame:
    """Every run of one to three neighbouring lines, by looking ahead instead of joining ranges.

    Lines are ordered as in :func:`vendor_lines`, so both windows share one sort.
    """
    runs = _runs(kept).select("doc_id", "i", F.explode(F.array(*RUNS)).alias("r"))
    return runs.filter("r.text IS NOT NULL").select("doc_id", "i", "r.text", "r.bbox.*", "r.score")


RUNS = ("run1", "run2", "run3")


def runs_of_lines(kept: DataFrame, *more: str) -> DataFrame:
    """Columns ``more`` and the runs of one, two and three lines that begin at every line, as structs of score, text and bbox; score and text are
    null, and so the least, where the document has no such run.

    Letters, capitals and single words are looked for in each line once and added up over a run. Nothing here hangs on a
    condition of its own: what a branch repeats would be computed again each time.
    """
    marks, ahead, texts, runs = _run_columns()
    lines = kept.select("*", *marks).select("doc_id", *more, "i", *ahead)
    for name, text in texts.items():
        lines = lines.withColumn(name, text)
    return lines.select("doc_id", *more, "i", *runs)


@once
def _run_columns() -> tuple:
    per_doc = Window.partitionBy("doc_id").orderBy("line_ix")
    marks = [letters(F.col("clean")).alias("letters"), capitals(F.col("clean")).alias("capitals"), positive_bits(F.col("clean")).alias("bits")]
    line = F.struct("clean", "x1", "y1", "x2", "y2", "letters", "capitals", "bits")
    ahead = [line.alias("a"), F.lead(line, 1).over(per_doc).alias("b"), F.lead(line, 2).over(per_doc).alias("c")]
    texts = {f"text{n}": text for n, text in enumerate(lengthened([F.col(f"{a}.clean") for a in LINES]), 1)}
    return marks, ahead, texts, [scored_run(n, F.col).alias(name) for n, name in enumerate(RUNS, 1)]


LINES = ("a", "b", "c")


def lengthened(texts: list[Column]) -> list[Column]:
    """The texts of the runs of one, two and three lines."""
    return [texts[0], *[reduce(lambda x, y: F.concat(x, F.lit(" "), y), texts[:n]) for n in range(2, len(texts) + 1)]]


def scored_run(n: int, of: Callable[[str], Column]) -> Column:
    """Score, text and box of the run of ``n`` lines: ``of`` gives the lines ``a``, ``b``, ``c``, the text of the run and ``i``."""
    lines, text = [of(name) for name in LINES[:n]], of(f"text{n}")

    def fold(f: Callable[..., Column], k: str) -> Column:
        return f(*[line[k] for line in lines]) if n > 1 else lines[0][k]

    def add(k: str) -> Column:
        return reduce(lambda x, y: x + y, [line[k] for line in lines])

    bits = reduce(lambda x, y: x.bitwiseOR(y), [line["bits"] for line in lines])
    upper = F.when(add("letters") == 0, F.lit(0.0)).otherwise(add("capitals") / add("letters"))
    score = vendor_score_of(text, upper, F.bit_count(bits) + positive_phrases(text), of("i"))
    left, top = fold(F.least, "x1"), fold(F.least, "y1")
    box = F.struct(left.alias("x"), top.alias("y"), (fold(F.greatest, "x2") - left).alias("w"), (fold(F.greatest, "y2") - top).alias("h"))
    return F.struct(score.alias("score"), text.alias("text"), box.alias("bbox"))


_runs = runs_of_lines


def best_vendor(best: DataFrame, *columns: str) -> DataFrame:
    """C3 of the best run ``b`` of every document."""
    strong = F.col("b.score") >= 80
    return best.select(
        *columns, F.when(strong, F.col("b.text")).alias("vendor"), vendor_conf(F.col("b.score")).alias("vendor_conf"),
        F.when(strong, F.col("b.bbox")).alias("vendor_bbox"))


def extract_vendor(
    words: DataFrame, phrases=NEGATIVE_PHRASES, hot_rows: int | None = HOT_ROWS, hot: DataFrame | None = None
) -> DataFrame:
    """Best vendor name, confidence and box; among equal scores the greatest text, then box."""
    # Lines, not words, are normalised: at most eight a document, and without a Python worker.
    lines = header_lines(words, hot_rows=hot_rows, hot=hot, tidy=lambda text: clean_line(compatible(text)), normal=False)
    # The best run of a line is told in its row; rows still lie by document, so nothing is exploded or sorted again.
    best = F.max("run")
    runs = _runs(vendor_lines(lines, phrases)).select("doc_id", F.greatest(*RUNS).alias("run"))
    return best_vendor(runs.groupBy("doc_id").agg(best.alias("b")), "doc_id")
