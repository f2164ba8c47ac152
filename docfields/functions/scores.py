"""Scores of vendor, date and total candidates."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from docfields.functions.text import positive_score, strip, uppercase_ratio

# A row naming any of these is not the total.
SKIP_LABELS = (
    r"\bdiscount\b", r"rounding", r"total\s*gst", r"sub.?total", r"tax", r"paid", r"total\s*qty", r"total\s*item",
    r"change", r"cash", r"tendered",
)

# Total labels with their scores, best first; the first that matches counts.
TOTAL_LABELS = (
    (r"total\s*payable", 4000),
    (r"net\s*payable", 3950),
    (r"amount\s*payable", 3900),
    (r"amount\s*due", 3850),
    (r"balance\s*due", 3800),
    (r"rounded\s*total\s*\(?rm\)?", 3200),
    (r"total\s*rounded", 3100),
    (r"grand\s*total", 3100),
    (r"total\s*sales\s*[\(\[]?inclu", 2900),
    (r"total\s*amount", 2500),
    (r"total\s*sales", 2400),
    (r"total\s*amt", 2300),
    (r"total\s*gross", 2200),
    (r"\btotal\b", 2000),
)
# Every label holds one of these inside a single word, so rows without them need no text at all.
LABEL_STEMS = ("total", "payable", "due")
# No label or skip pattern reaches over more than this many words.
LABEL_SPAN = 3


# Digits of other scripts that receipts print: full-width, Arabic-Indic, Persian.
WIDE_DIGITS = "".join(chr(zero + i) for zero in (0xFF10, 0x0660, 0x06F0) for i in range(10))
# An amount as most words print it, and a digit without which a word is none.
PLAIN_AMOUNT = r"^0*[1-9][0-9]*(\.[0-9]{1,2})?\z"
AMOUNT_DIGIT = "[1-9" + "".join(c for c in WIDE_DIGITS if int(c)) + "]"


def parse_amount(c: Column) -> Column:
    """the amount a word stands for, null when it is none or below 1.

    Words without a digit and plain numbers, which nearly all are, take one pattern; only the others are rewritten.
    """
    t = F.regexp_replace(strip(F.lower(c)), "^rm", "")
    t = F.regexp_replace(F.translate(t, "o," + WIDE_DIGITS, "0." + 3 * string.digits), "[^0-9.]", "")
    # At least 1 means a digit other than 0 before the point, so one pattern decides both form and size.
    written = F.regexp_extract(t, r"^0*[1-9][0-9]*(\.[0-9]{1,2})?$", 0).try_cast("double")
    plain = (c >= "0") & (c < ":") & c.rlike(PLAIN_AMOUNT)
    return F.when(plain, c.try_cast("double")).when(c.rlike(AMOUNT_DIGIT), written)


def has_label_stem(c: Column) -> Column:
    lowered = F.lower(c)
    found = F.lit(False)
    for stem in LABEL_STEMS:
        found = found | lowered.contains(stem)
    return found


def is_skipped(c: Column) -> Column:
    return F.lower(c).rlike("(?U)" + "|".join(SKIP_LABELS))


def is_labelled(lowered: Column) -> Column:
    """Does :func:`score_label` give more than 0? One pattern each for the skip list and for all labels."""
    found = lowered.rlike("(?U)" + "|".join(pattern for pattern, _ in TOTAL_LABELS))
    return found & ~lowered.rlike("(?U)" + "|".join(SKIP_LABELS))


def best_label(lowered: Column) -> Column:
    """Score of the best label in a lower-case text that has one of the stems."""
    score = F.lit(0)
    for pattern, value in reversed(TOTAL_LABELS):
        score = F.when(lowered.rlike("(?U)" + pattern), F.lit(value)).otherwise(score)
    return score


def label_only(c: Column) -> Column:
    """Score of the best label in the text, skip list left aside; 0 without one."""
    return F.when(has_label_stem(c), best_label(F.lower(c))).otherwise(F.lit(0))


def score_label(c: Column) -> Column:
    """0 for skipped rows, else the score of the first label that matches."""
    return F.when(is_skipped(c), F.lit(0)).otherwise(label_only(c))


def total_score(label: Column, row_ix: Column) -> Column:
    """F15, ranking part: upper rows win over lower ones."""
    return label - 5 * row_ix


def total_conf(score: Column) -> Column:
    """F15, confidence part: 0.0 without a candidate; may be negative far down a page."""
    return F.when(score.isNull(), F.lit(0.0)).otherwise(F.least(F.lit(1.0), score / F.lit(3200.0)))


def date_score(text: Column, y: Column, h: Column, conf: Column) -> Column:
    """keyword, height on the page and recognition confidence of a word holding a date."""
    lowered = F.lower(text)
    keywords = F.when(lowered.contains("date"), 50).otherwise(0) + F.when(lowered.contains("invoice"), 20).otherwise(0)
    # A word without a box counts as the top of the page.
    height = F.greatest(F.lit(0.0), F.lit(100.0) - F.coalesce(y + h / 2, F.lit(0.0)) * F.lit(0.5))
    return keywords + height + conf * F.lit(20.0)


def vendor_score(text: Column, i: Column) -> Column:
    """F13, ranking part, for a candidate that starts at surviving line ``i``."""
    return vendor_score_of(text, uppercase_ratio(text), positive_score(text), i)


def vendor_score_of(text: Column, upper: Column, positive: Column, i: Column) -> Column:
    """The same where the share of capitals and the number of list entries are known."""
    n = F.length(text)
    spaces = n - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return (
        upper * 120
        + positive * 40
        - F.when((positive == 0) & (upper < 0.5), 40).otherwise(0)
        + F.when((n > 5) & (n < 45), 60).when(n > 60, -50).otherwise(0)
        - F.when(spaces > 5, 30).otherwise(0)
        + F.greatest(F.lit(0), 50 - i * 10)
        + F.when(i < 2, 25).otherwise(0)
    )


def vendor_conf(score: Column) -> Column:
    """F13, confidence part: null and weak scores (below 80) give 0.0."""
    scaled = F.round(F.least(F.lit(1.0), score / F.lit(295.0)), 3)
    return F.when(score >= 80, scaled).otherwise(F.lit(0.0))
