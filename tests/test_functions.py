"""Functions on literal cases, and against plain Python where Python has the same notion."""

import datetime
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from docfields.functions import dates as D
from docfields.functions import retries as R
from docfields.functions import scores as S
from docfields.functions import text as X
from docfields.operators import requests as Q
from docfields.operators.validation import validation_errors
from docfields.operators.words import normalize_words


def results(spark, values, *columns, schema="s string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    out = rows.select("i", *[c.alias(f"c{k}") for k, c in enumerate(columns)]).orderBy("i").collect()
    return [tuple(r)[1] if len(columns) == 1 else tuple(r)[1:] for r in out]


s = F.col


def test_amounts(spark):
    cases = {"RM12.50": 12.5, "1,234.50": None, "1,234": None, "1,50": 1.5, "0.50": None, "1O.00": 10.0, "20/06/18": 200618.0,
             "Total": None, "12.345": None, "1": 1.0, "0.99": None, "007.5": 7.5, "": None, "rm5": 5.0, None: None}
    assert results(spark, list(cases), S.parse_amount(s("s"))) == list(cases.values())


def test_amounts_of_plain_words_need_no_rewriting(spark):
    """plain numbers and words without a digit do not pass the rewriting patterns, with the results of those."""
    texts = ["12.50", "007", "0.99", "1.234", "12\n", " 12", "12 ", "", None, "total", "o0", "rm1o", "RM12.50", "1,234.5", "١٢", "9:", "1:2", "-5", "12.", "0"]
    texts += ["1" * 400, "٠", "６.０", "12.5\x85"]
    t = F.translate(F.regexp_replace(X.strip(F.lower(s("s"))), "^rm", ""), "o," + S.WIDE_DIGITS, "0." + 3 * "0123456789")
    whole = F.regexp_extract(F.regexp_replace(t, "[^0-9.]", ""), r"^0*[1-9][0-9]*(\.[0-9]{1,2})?$", 0).try_cast("double")
    assert results(spark, texts, S.parse_amount(s("s"))) == results(spark, texts, whole)
    plan = spark.createDataFrame([("1",)], "s string").select(S.parse_amount(s("s")))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and plan.index("RLIKE") < plan.index("regexp_extract")


def test_normalized_dates(spark):
    cases = {"25/12/2018": "25/12/2018", "25-12-18": "25/12/2018", "2018/12/25": "25/12/2018", "25/12/75": "25/12/1975",
             "25/12/69": "25/12/1969", "25/12/68": "25/12/2068", "25/12/201": "25/12/201", "12/25/2018": "12/25/2018",
             "25/12-2018": "25/12-2018", "25 Dec 18": "25 Dec 18", "Dec 25, 2018": "25/12/2018", "25 december 2018": "25/12/2018",
             "31/02/2018": "31/02/2018", "0000-01-01": "0000-01-01", "1/2/2018": "01/02/2018", "29/02/2016": "29/02/2016"}
    assert results(spark, list(cases), D.normalize_date(s("s"))) == list(cases.values())


def test_dates_agree_with_strptime(spark):
    forms = ("%d/%m/%Y", "%d-%m-%Y", "%d/%m/%y", "%d-%m-%y", "%Y/%m/%d", "%Y-%m-%d", "%d %b %Y", "%d %B %Y", "%b %d %Y", "%B %d %Y")
    texts = [f"{a}{sep}{b}{sep}{c}" for sep in "/-" for a in ("1", "09", "31", "1999", "00") for b in ("2", "12", "13", "29") for c in ("68", "69", "2016", "5", "31")]
    texts += [f"{d} {m} {y}" for d in ("1", "31") for m in ("Feb", "JUNE", "Foo", "Sept") for y in ("2016", "16")]

    def by_hand(text):
        for form in forms:
            try:
                return datetime.datetime.strptime(text.replace(",", ""), form).strftime("%d/%m/%Y")
            except ValueError:
                continue
        return text

    assert results(spark, texts, D.normalize_date(s("s"))) == [by_hand(t) for t in texts]


def test_invoice_and_form_dates(spark):
    cases = {" 1999-05-04 ": ("1999-05-04", "1999-05-04"), "05/13/1999": ("1999-05-13", "05/13/1999"),
             "05/06/1999": ("1999-06-05", "1999-06-05"), "31/02/1998": (None, "31/02/1998"), "1999-05-04T10:00": (None, "1999-05-04"),
             "04-05-99": (None, "1999-05-04"), "": (None, ""), None: (None, "")}
    found = results(spark, list(cases), F.date_format(D.parse_invoice_date(s("s")), "yyyy-MM-dd"), D.format_form_date(s("s")))
    assert found == list(cases.values())
    assert results(spark, ["1999-05-04"], D.format_form_date(s("s"), "dmy")) == ["04/05/1999"]


VALIDATION = [
    ("ACME", "1999-05-04", 10.0, []), (None, "1999-05-04", 10.0, ["vendor_empty"]), ("  ", "1999-05-04", 10.0, ["vendor_empty"]),
    ("12,345", "1999-05-04", 10.0, ["vendor_numeric_only"]), ("1_000", "1999-05-04", 10.0, ["vendor_numeric_only"]),
    ("12d", "1999-05-04", 10.0, []), ("nan", "1999-05-04", 10.0, ["vendor_numeric_only"]),
    ("ACME", None, 10.0, ["date_missing"]), ("ACME", "31/02/1998", 10.0, ["date_invalid_format"]),
    ("ACME", "2001-01-01", 10.0, ["date_in_future"]), ("ACME", "1989-12-31", 10.0, ["date_unreasonably_old"]),
    ("ACME", "05/13/1999", 10.0, []), ("ACME", "1999-05-04", None, ["total_missing"]),
    ("ACME", "1999-05-04", 0.0, ["total_not_positive"]), ("ACME", "1999-05-04", 2e9, ["total_out_of_range"]),
    ("ACME", "1999-05-04", float("nan"), ["total_invalid"]), ("A", "1999-05-04", 10.0, ["vendor_too_short"]),
    ("A" * 101, "1999-05-04", 10.0, ["vendor_too_long"]), ("A", "1999-05-04", 0.0, ["total_not_positive"]),
    (None, None, None, ["vendor_empty", "date_missing", "total_missing"]),
]


def test_validation_codes(spark):
    rows = spark.createDataFrame([(i, *v[:3]) for i, v in enumerate(VALIDATION)], "i int, v string, d string, t double")
    errors = validation_errors(s("v"), s("d"), s("t"), F.lit("2000-01-01").cast("date"))
    assert [r[0] for r in rows.orderBy("i").select(errors).collect()] == [v[3] for v in VALIDATION]


@pytest.mark.parametrize("failed,previous,expected", [
    ("llm", None, "strict_json"), ("llm", "", "strict_json"), ("llm", "strict_json", "ocr_retry"), ("llm", "ocr_retry", "ocr_retry"),
    ("validation", "default", "after_validation_fail"), ("validation", "after_validation_fail", "strict_json"),
    ("validation", "strict_json", "ocr_retry"), ("validation", "ocr_retry", "ocr_retry"), ("ocr", "default", "strict_json"),
])
def test_next_strategy(spark, failed, previous, expected):
    from docfields.functions.retries import next_strategy_of

    assert results(spark, [previous], R.next_strategy(F.lit(failed), s("s"))) == [expected]
    assert next_strategy_of(failed, previous) == expected


def test_backoff_grows_to_the_cap_with_stable_jitter(spark):
    first, again = (results(spark, ["a"] * 12, R.backoff(s("s"), s("i"))) for _ in range(2))
    assert first == again
    for k, delay in enumerate(first):
        assert 0 <= delay - min(900, 5 * 2 ** k) < 1.5


def test_rate_limits(spark):
    cases = {"429 slow down, retry in 12.5s": (True, 13.25), "Resource exhausted ... seconds: 30": (True, 30.75),
             "quota exceeded": (True, 62.0), "bad request": (False, 62.0)}
    assert results(spark, list(cases), X.is_rate_limit(s("s")), X.retry_after(s("s"))) == list(cases.values())
    for text, (limited, wait) in cases.items():
        assert (Q.is_rate_limited(text), Q.seconds_hinted(text)) == (limited, wait)


def test_hidden_inputs(spark):
    cases = {'<input name="fbzx" value="1">': "1", "<input name=\"fbzx\" value='2'>": "2", '<input value="3" name="fbzx">': "3",
             '<input name="fbzx" value="">': "", "<p>": None}
    assert results(spark, list(cases), X.hidden_input(s("s"), "fbzx")) == list(cases.values())


def test_labels(spark):
    cases = {"GRAND TOTAL 5": 3100, "sub-total 5": 0, "Cashier 1 total": 0, "total": 2000, "totals": 0, "AMOUNT DUE": 3850,
             "Total Payable (RM)": 4000, "rounded total (rm)": 3200, "total sales [inclusive": 2900, "due": 0, "discount total": 0}
    assert results(spark, list(cases), S.score_label(s("s"))) == list(cases.values())


def test_number_and_money_text(spark):
    assert results(spark, [12345678.0, 8.2, 10.25, None, 1e9], X.num_text(s("s")), schema="s double") == [
        "12345678.0", "8.2", "10.25", None, "1000000000.0"]
    cases = {"RM 1,234.50": 1234.5, "$5": 5.0, "": None, "RM": None, "n/a": None, "1e3": 1000.0, "12f": None, None: None}
    assert results(spark, list(cases), X.money(s("s"))) == list(cases.values())


def test_blanks_and_lines(spark):
    assert results(spark, ["a\u00a0 \tb\n", None, "\u00a0"], X.clean_text(s("s"))) == ["a b", "", ""]
    assert results(spark, ["AC-ME & Co. (M) 12!", "é"], X.clean_line(s("s"))) == ["AC-ME & Co. (M)", ""]
    assert results(spark, ["ABc", "-"], X.uppercase_ratio(s("s"))) == [2 / 3, 0.0]
    assert results(spark, ["Foo Sdn Bhd", "x"], X.positive_score(s("s"))) == [2, 0]
    assert results(spark, ["ab", "JALAN 1", "a lot of", "Ballot", "Acme"], X.is_bad_line(s("s"))) == [True, True, True, False, False]


def test_long_json_is_previewed(spark):
    long = '{"a": "' + "x" * 12000 + '"}'
    kept, cut = results(spark, ['{"a": 1}', long], X.truncate_json(s("s")))
    assert kept == '{"a": 1}' and '"_truncated":true' in cut and len(cut) < 6200


def test_compatibility_normalisation(spark):
    texts = ["plain", "ＡＣＭＥ", "ﬁne №5", "e\u0301", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").filter("text is not null")
    found = {r.i: r.text for r in normalize_words(rows).collect()}
    assert found == {i: unicodedata.normalize("NFKC", t) for i, t in enumerate(texts) if t}


def test_single_responses(spark):
    cases = {'x {"vendor": "V", "total": "RM 5", "date": "d"} y': ("V", 5.0, "d"), '{"total": ""}': (None, None, None),
             '{"vendor": "V", "total": "n/a"}': None, "none": None, '{"broken": ': None, '{"total": null}': (None, None, None)}
    found = results(spark, list(cases), Q.parse_single(s("s")))
    assert [tuple(r) if r else None for r in found] == list(cases.values())


def test_batch_responses(spark):
    raw = ('text {"results": [{"job_id": " 1 ", "vendor": "old", "total": 1}, 7, null, {"vendor": "nobody"}, {"job_id": ""}, '
           '{"job_id": 2, "vendor": "two", "total": "n/a"}, {"job_id": "1", "vendor": "new", "total": "1,000.5", "date": "d"}]}')
    rows = spark.createDataFrame([("a", raw), ("b", "nothing"), ("c", '{"results": {}}'), ("d", '{"results": []}')], "batch string, response string")
    found = sorted(tuple(r) for r in Q.parse_batch(rows).collect())
    assert found == [("a", "1", "new", 1000.5, "d"), ("a", "2", "two", None, None)]


def test_rows_need_a_stem_for_every_label():
    for pattern, _ in S.TOTAL_LABELS:
        pieces = re.split(r"\\s\*", pattern)
        assert any(stem in piece for stem in S.LABEL_STEMS for piece in pieces)
        assert len(pieces) <= S.LABEL_SPAN


def test_totals_as_the_form_gets_them(spark):
    import math

    values = [41.257, 0.001, 12.0, 1e17, 1.5e16, 9999999999999998.0, 4.31411e20, 0.0001, 1.5e-5, 123456789.125, -7.1, 0.0, 1 / 3, math.nan, None]
    found = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", X.num_text(F.col("v")).alias("t")).collect()
    assert [r.t for r in sorted(found)] == [None if v is None else str(v) for v in values]


def test_amounts_in_other_digits(spark):
    assert [r.a for r in spark.createDataFrame([("RM１２.５０",), ("٣٤.٥",), ("12.5",)], "t string").select(S.parse_amount(F.col("t")).alias("a")).collect()] == [12.5, 34.5, 12.5]


def test_a_date_without_a_box_scores_as_the_top_of_the_page(spark):
    row = spark.sql("SELECT 'x' AS t, CAST(NULL AS int) AS y, CAST(NULL AS int) AS h, 0.5D AS c").select(
        S.date_score(F.col("t"), F.col("y"), F.col("h"), F.col("c")).alias("s")).first()
    assert row.s == 110.0


def test_lines_are_normalised_as_far_as_they_are_kept(spark):
    """Against the standard library: every character on its own between letters, and mixed lines."""
    import random
    import sys

    rng = random.Random(8)
    texts = [f"a{chr(c)}B" for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Mn"]
    alphabet = ["Ｋ", "ﬁ", "℡", "Ⅷ", "é", "é", "q́", "㈱", "　", "ａ", "x", ". ", "№", "日", "½", " "]
    texts += ["".join(rng.choices(alphabet, k=8)) for _ in range(3000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", X.clean_line(X.compatible(F.col("t"))).alias("c"))
    plain = spark.createDataFrame([(i, unicodedata.normalize("NFKC", t)) for i, t in enumerate(texts)], "i int, t string").select("i", X.clean_line(F.col("t")).alias("c"))
    assert rows.exceptAll(plain).count() == 0


def test_field_extraction_stays_in_the_jvm(spark, small):
    from docfields import fixtures
    from docfields.operators.routing import extract_fields
    from docfields.session import materialise

    words = materialise(fixtures.receipt_words(spark, small), "words")
    plan = extract_fields(words)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert plan.count("FileScan") <= 4
