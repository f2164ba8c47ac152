"""Invoice date of every receipt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfields.functions.boxes import box
from docfields.functions.dates import ANY_DATE, date_matches, first_date_match, normalize_date
from docfields.functions.scores import date_score
from docfields.functions.text import BLANKS, clean_text
from docfields.operators.words import nonblank

# Every written date holds a digit before a slash, a dash or a blank: one cheap test keeps nearly all words out.
MAYBE_DATE = f"[0-9](?:[/-]|,?[{BLANKS}])"


def date_candidates(words: DataFrame) -> DataFrame:
    """Words holding a date: every match in a word scores the same, so its first one stands for it."""
    maybe = words.filter(F.col("text").rlike(MAYBE_DATE)).withColumn("text", clean_text(F.col("text")))
    # One pattern tells whether there is a date; a filter on ``raw`` would look for every form twice.
    found = maybe.filter(F.col("text").rlike(ANY_DATE)).select("*", first_date_match(F.col("text")).alias("raw"))
    conf = F.col("conf") / F.lit(100.0)
    return found.select(
        "doc_id", "word_id", "raw", conf.alias("date_conf"),
        date_score(F.col("text"), F.col("y"), F.col("h"), conf).alias("score"),
        box(*[F.col(c) for c in ("x", "y", "w", "h")]).alias("bbox"),
    )


def all_date_matches(words: DataFrame) -> DataFrame:
    """F2 over a table: one row per match, in order."""
    cleaned = nonblank(words).select("doc_id", "word_id", clean_text(F.col("text")).alias("text"))
    return cleaned.select("doc_id", "word_id", F.posexplode(date_matches(F.col("text"))).alias("match_ix", "raw"))


def extract_date(words: DataFrame) -> DataFrame:
    """Best date, its confidence and box; the earliest word wins among equals. No row order is needed, so a
    document of any size folds before the shuffle."""
    best = F.max_by(F.struct("raw", "date_conf", "bbox", "score"), F.struct("score", -F.col("word_id")))
    return date_candidates(words).groupBy("doc_id").agg(best.alias("b")).select(
        "doc_id", normalize_date(F.col("b.raw")).alias("date"), F.col("b.date_conf").alias("date_conf"),
        F.col("b.bbox").alias("date_bbox"),
    )
