"""Text functions."""

from __future__ import annotations

import re
import string
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character the receipt rules treat as blank, and the same as a pattern class.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NOT_BLANK = f"[^{BLANKS}]"
BLANK_RUN = r"(?U)[\s\x1c-\x1f]+"

# Words that make a header line look like a business name.
POSITIVE_WORDS = (
    "enterprise", "trading", "store", "mart", "supermarket", "restaurant", "restoran", "cafe", "bakery", "coffee",
    "shop", "sdn bhd", "sdn. bhd", "bhd", "ltd", "limited", "co.", "hardware", "machinery", "motor", "perniagaan",
    "gift", "deco",
)

# Phrases that disqualify a header line. Personal names are a parameter, never a built-in.
NEGATIVE_PHRASES = (
    "tax invoice", "simplified tax invoice", "invoice", "receipt", "cash bill", "cash sales", "tel:", "fax:", "gst",
    "reg no", "co.reg", "date", "time", "cashier", "salesperson", "member", "thank you", "welcome", "change:", "cash:",
    "amount", "jalan", "jln", "road", "street", "lane", "drive", "taman", "tmn", "bandar", "lot ", "block", "johor",
    "selangor", "kuala lumpur", "shah alam", "seri kembangan", "petaling jaya",
)

NUMBER_SYNTAX = (
    r"^[+-]?(?:[0-9]+(?:_[0-9]+)*(?:\.(?:[0-9]+(?:_[0-9]+)*)?)?|\.[0-9]+(?:_[0-9]+)*)"
    r"(?:[eE][+-]?[0-9]+(?:_[0-9]+)*)?$"
)
NUMBER_WORDS = r"(?i)^[+-]?(?:inf|infinity|nan)$"


def strip(c: Column) -> Column:
    """Trim every kind of blank, not only the space."""
    return F.trim(c, F.lit(BLANKS))


def is_blank(c: Column) -> Column:
    """Nothing but blanks. A first character between ``!`` and ``~`` settles it for nearly every word without a pattern."""
    return ~(((c >= "!") & (c < "\x7f")) | c.rlike(NOT_BLANK))


def strip_word(c: Column) -> Column:
    """:func:`strip` for a plain column of words, most of which have nothing to strip at either end."""
    last = F.substring(c, -1, 1)
    tidy = (c >= "!") & (c < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(tidy, c).otherwise(strip(c))


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def clean_text(c: Column) -> Column:
    """collapse blank runs to one space and trim; null becomes the empty text."""
    return F.coalesce(F.trim(F.regexp_replace(c, BLANK_RUN, " ")), F.lit(""))


# The ASCII characters that :func:`clean_line` keeps, one by one: such a class is a table, not a chain of ranges.
KEPT_ASCII = string.ascii_letters + "".join(c for c in BLANKS if c < "\x80") + "&.'()"
ODD_ASCII = f"[^{KEPT_ASCII}\\-]+"


def clean_line(c: Column) -> Column:
    """keep letters, blanks and ``& . ' - ( )``."""
    every = F.regexp_replace(c, r"(?U)[^A-Za-z\s\x1c-\x1f&.'\-()]", "")
    return strip(F.when(is_ascii(c), F.regexp_replace(c, ODD_ASCII, "")).otherwise(every))


def _compatible_forms() -> tuple[str, str, dict[str, str], str]:
    """By rule from Unicode: what compatibility normalisation makes of each character, as far as :func:`clean_line` keeps
    it: characters with one result and those results, characters with several, and a pattern of letter and mark pairs
    that become one accented letter, which is not kept."""
    kept = re.compile(r"[A-Za-z\s\x1c-\x1f&.'\-()]")
    single, to, several = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        made = "" if 0xD800 <= code < 0xE000 else "".join(kept.findall(unicodedata.normalize("NFKC", c)))
        if len(made) == 1 and made != c:
            single.append(c)
            to.append(made)
        elif len(made) > 1:
            several[c] = made
    marks = [chr(m) for m in range(0x300, 0x370)]
    pairs = ((a, "".join(m for m in marks if len(unicodedata.normalize("NFC", a + m)) == 1)) for a in string.ascii_letters)
    return "".join(single), "".join(to), several, "|".join(f"{a}[{m}]" for a, m in pairs if m)


SINGLE_FORMS, SINGLE_RESULTS, SEVERAL_FORMS, ACCENTED_PAIRS = _compatible_forms()


def compatible(c: Column) -> Column:
    """F8 for a line that :func:`clean_line` comes next to: compatibility-normalised as far as that keeps it, without
    leaving the JVM. Only lines with other than ASCII characters are touched."""
    one = F.translate(F.regexp_replace(c, ACCENTED_PAIRS, ""), SINGLE_FORMS, SINGLE_RESULTS)
    forms = F.create_map(*[F.lit(x) for pair in SEVERAL_FORMS.items() for x in pair])
    whole = F.array_join(F.transform(F.split(one, ""), lambda x: F.coalesce(F.try_element_at(forms, x), x)), "")
    return F.when(is_ascii(c), c).otherwise(F.when(one.rlike(f"[{''.join(SEVERAL_FORMS)}]"), whole).otherwise(one))


def letters(c: Column) -> Column:
    return F.length(F.regexp_replace(c, f"[^{string.ascii_letters}]+", ""))


def capitals(c: Column) -> Column:
    return F.length(F.regexp_replace(c, f"[^{string.ascii_uppercase}]+", ""))


def uppercase_ratio(c: Column) -> Column:
    """share of capitals among the letters of a cleaned line; 0.0 without letters."""
    return F.when(letters(c) == 0, F.lit(0.0)).otherwise(capitals(c) / letters(c))


def contains_any(c: Column, phrases) -> Column:
    """True when the lower-cased text holds any of ``phrases``."""
    return F.lower(c).rlike("|".join(re.escape(p) for p in phrases)) if phrases else F.lit(False)


def positive_score(c: Column, words=POSITIVE_WORDS) -> Column:
    """how many of the list entries occur in the text."""
    lowered = F.lower(c)
    score = F.lit(0)
    for word in words:
        score = score + lowered.contains(word).cast("int")
    return score


def positive_bits(c: Column, words=POSITIVE_WORDS) -> Column:
    """Which of the list entries without a space occur in the text, a bit each: none of them runs over the space between two
    lines, so the bits of several lines are those of each. The list has fewer than 63 entries."""
    lowered, bits = F.lower(c), F.lit(0).cast("long")
    for k, word in enumerate(words):
        if " " not in word:
            bits = bits + F.when(lowered.contains(word), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
    return bits


def positive_phrases(c: Column, words=POSITIVE_WORDS) -> Column:
    """How many of the list entries with a space occur in the text."""
    return positive_score(c, [word for word in words if " " in word])


def is_bad_line(c: Column, phrases=NEGATIVE_PHRASES) -> Column:
    """Too short or holding a disqualifying phrase."""
    return (F.length(c) < 3) | contains_any(c, phrases)


def clip(c: Column, n: int) -> Column:
    """The store limits of raw responses."""
    return F.substring(c, 1, n)


def parse_number(c: Column) -> Column:
    """A number written the way a float literal may be, else null; sized suffixes and hex are rejected."""
    s = strip(c)
    return F.when(s.rlike(NUMBER_SYNTAX) | s.rlike(NUMBER_WORDS), F.regexp_replace(s, "_", "").try_cast("double"))


def is_numeric_text(c: Column) -> Column:
    """the text is nothing but a number once commas are gone; null and blank are not."""
    s = strip(F.regexp_replace(c, ",", ""))
    return F.coalesce(s.rlike(NUMBER_SYNTAX) | s.rlike(NUMBER_WORDS), F.lit(False))


def money_digits(c: Column) -> Column:
    """The text of an amount without currency marks and thousands commas."""
    return strip(F.replace(F.replace(F.replace(strip(c), F.lit(","), F.lit("")), F.lit("RM"), F.lit("")), F.lit("$"), F.lit("")))


def money(c: Column) -> Column:
    """money text to double, null when empty or not a number."""
    return parse_number(money_digits(c))


def num_text(c: Column) -> Column:
    """F16: a total as the form expects it: the shortest text of the number, with at least one decimal; an exponent only
    from 1e16 on and below 0.0001. Zero keeps its sign."""
    number = c.cast("double")

    def first(digits) -> Column:
        tried = [F.format_string(f"%.{n}e", number) for n in digits]
        return F.coalesce(*[F.when(t.try_cast("double") == number, t) for t in tried])

    # Numbers below the normal ones have fewer digits of their own.
    shortest = F.when(F.abs(number) < 2.3e-308, first(range(17))).otherwise(first((14, 15, 16)))
    plain = F.regexp_replace(shortest.try_cast("decimal(38,20)").cast("string"), r"(\.[0-9]+?)0+$", "$1")
    size = F.abs(number)
    zero = F.when(F.format_string("%.0e", number).startswith("-"), "-0.0").otherwise("0.0")
    # Of at most fifteen digits no two name the same number, so one with two decimals has no shorter text.
    cents = number.try_cast("decimal(13,2)")
    short = F.regexp_replace(cents.cast("string"), r"(\.[0-9])0$", "$1")
    return F.when(size == 0, zero).when(cents.cast("double") == number, short).when((size >= 1e-4) & (size < 1e16), plain).otherwise(
        F.replace(F.lower(F.regexp_replace(shortest, r"\.?0+e", "e")), F.lit("infinity"), F.lit("inf")))


def json_span(c: Column) -> Column:
    """from the first ``{`` to the last ``}``, null when there is none."""
    return F.nullif(F.regexp_extract(c, r"(?s)\{.*\}", 0), F.lit(""))


def truncate_json(c: Column, limit: int = 12000) -> Column:
    """JSON text over ``limit`` characters becomes a marked preview of its first half."""
    preview = F.concat(F.substring(c, 1, limit // 2), F.lit("..."))
    short = F.to_json(F.struct(F.lit(True).alias("_truncated"), preview.alias("preview")))
    return F.when(F.length(c) > limit, short).otherwise(c)


# What a quota error says (any of the marks, or both of the pair), where it names the seconds to wait,
# what is added to them, and how long to wait if it names none.
QUOTA_MARKS, QUOTA_PAIR = ("429", "resource exhausted", "rate limit"), ("quota", "exceed")
RETRY_HINTS = (r"(?i)retry in ([0-9.]+)\s*s", r"seconds:\s*([0-9]+)")
RETRY_MARGIN, RETRY_DEFAULT = 0.75, 62.0


def is_rate_limit(c: Column) -> Column:
    """does an error text mean a quota was hit?"""
    s = F.lower(c)
    found = s.contains(QUOTA_PAIR[0]) & s.contains(QUOTA_PAIR[1])
    for mark in QUOTA_MARKS:
        found = found | s.contains(mark)
    return found


def retry_after(c: Column, margin: float = RETRY_MARGIN, default: float = RETRY_DEFAULT) -> Column:
    """seconds to wait as told by the error text, else ``default``."""
    told = [F.nullif(F.regexp_extract(c, p, 1), F.lit("")).try_cast("double") + margin for p in RETRY_HINTS]
    return F.coalesce(*told, F.lit(default))


def hidden_input(html: Column, name: str) -> Column:
    """F32: value of a named form input, trying the three attribute orders in turn."""
    orders = (
        rf'name="{name}"\s+value="([^"]*)"',
        rf"name=\"{name}\"\s+value='([^']*)'",
        rf'value="([^"]*)"\s+name="{name}"',
    )
    value = F.lit(None).cast("string")
    for pattern in reversed(orders):
        value = F.when(html.rlike(pattern), F.regexp_extract(html, pattern, 1)).otherwise(value)
    return value


def job_id(path: Column) -> Column:
    """a job key that depends only on the file, so repeated ingestion is idempotent."""
    return F.sha2(path, 256)
