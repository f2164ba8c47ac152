"""Date functions (F2-F5), by rewriting to ISO order and one validity check instead of a chain of format attempts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docfields.functions.text import strip

# The written forms of a date, in order of preference.
DATE_PATTERNS = (
    r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b",
    r"\b\d{4}[/-]\d{1,2}[/-]\d{1,2}\b",
    r"\b\d{1,2}\s+[A-Za-z]{3,9}\s+\d{2,4}\b",
    r"\b[A-Za-z]{3,9}\s+\d{1,2},?\s+\d{2,4}\b",
)
# Word borders by Unicode letters, whatever the Java release takes for a word.
UNICODE = "(?U)"
ANY_DATE = UNICODE + "|".join(DATE_PATTERNS)
ISO = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}$"


def _group(c: Column, pattern: str, i: int) -> Column:
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, i))


def _reorder(c: Column, pattern: str, order: str) -> Column:
    """Rewrite a text of the given form; any other text stays as it is."""
    return F.regexp_replace(c, pattern, order)


def day_first(c: Column, sep: str, short_years: bool = False) -> Column:
    """day/month/year as year-month-day; two-digit years turn at 69."""
    out = _reorder(c, rf"^(\d{{1,2}}){sep}(\d{{1,2}}){sep}(\d{{4}})$", "$3-$2-$1")
    if short_years:
        out = _reorder(out, rf"^(\d{{1,2}}){sep}(\d{{1,2}}){sep}(69|[7-9]\d)$", "19$3-$2-$1")
        out = _reorder(out, rf"^(\d{{1,2}}){sep}(\d{{1,2}}){sep}(\d{{2}})$", "20$3-$2-$1")
    return out


def month_first(c: Column, sep: str) -> Column:
    return _reorder(c, rf"^(\d{{1,2}}){sep}(\d{{1,2}}){sep}(\d{{4}})$", "$3-$1-$2")


def year_first(c: Column, sep: str) -> Column:
    return _reorder(c, rf"^(\d{{4}}){sep}(\d{{1,2}}){sep}(\d{{1,2}})$", "$1-$2-$3")


def existing_date(iso: Column) -> Column:
    """The date a year-month-day text names, null if it does not exist; there is no year 0."""
    return F.when(iso.rlike(ISO), iso.try_cast("date"))


def date_matches(c: Column) -> Column:
    """every dated-looking piece of the text, pattern by pattern."""
    return F.concat(*[F.regexp_extract_all(c, F.lit(UNICODE + p), F.lit(0)) for p in DATE_PATTERNS])


def first_date_match(c: Column) -> Column:
    """The first element of :func:`date_matches` without building the array; null when there is none."""
    return F.coalesce(*[_group(c, UNICODE + p, 0) for p in DATE_PATTERNS])


def normalize_date(c: Column) -> Column:
    """a written date as dd/MM/yyyy; a text in no known form is returned as it is."""
    s = F.replace(c, F.lit(","), F.lit(""))
    # What a text begins with tells which of the rewritings can apply to it.
    digits = (
        F.when(s.rlike(r"^\d{1,2}/"), day_first(s, "/", True)).when(s.rlike(r"^\d{1,2}-"), day_first(s, "-", True))
        .when(s.rlike(r"^\d{4}/"), year_first(s, "/")).otherwise(s)
    )
    named = _reorder(
        _reorder(s, r"^(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})$", "$3-$2-$1"),
        r"^([A-Za-z]+)\s+(\d{1,2})\s+(\d{4})$", "$3-$1-$2",
    )
    spelled = F.when(
        named.rlike(r"^(?!0000)\d{4}-[A-Za-z]+-\d{1,2}$"),
        F.coalesce(F.try_to_date(named, "yyyy-MMM-d"), F.try_to_date(named, "yyyy-MMMM-d")),
    )
    return F.coalesce(F.date_format(F.coalesce(existing_date(digits), spelled), "dd/MM/yyyy"), c)


def parse_invoice_date(c: Column) -> Column:
    """year-month-day, else day/month/year, else month/day/year."""
    s = strip(c)
    return F.coalesce(existing_date(day_first(s, "/")), existing_date(month_first(s, "/")))


def parse_form_date(c: Column) -> Column:
    """The five written forms the form accepts, or a leading ISO date."""
    s = strip(c)
    # A text in year-month-day is rewritten by none of the patterns.
    whole = F.when(s.rlike(ISO), s.try_cast("date")).otherwise(existing_date(day_first(day_first(s, "/", True), "-", True)))
    return F.coalesce(whole, existing_date(_group(s, r"^(\d{4}-\d{2}-\d{2})", 1)))


def format_form_date(c: Column, mode: str = "iso") -> Column:
    """date for the form, ``iso`` or ``dmy``; an unreadable one is only trimmed, null becomes empty."""
    pattern = "dd/MM/yyyy" if mode.lower() in ("dmy", "dd/mm/yyyy", "eu") else "yyyy-MM-dd"
    return F.coalesce(F.date_format(parse_form_date(c), pattern), strip(c), F.lit(""))
