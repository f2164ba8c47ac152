"""Documents gathered in one row tell the same as the operators on tables of words."""

import random

from pyspark.sql import functions as F

from conftest import SMALL
from docfields import fixtures
from docfields.operators import documents, routing
from docfields.schema import WORDS

TEXTS = ["GRAND", "Total", "total:", "SUBTOTAL", "due", "Amount", "payable", "RM12.50", "7", "12.5o", "0.50", " ", "", None, "ACME", "Mart", "sdn bhd", "CO.",
         "Jalan", "é́ﬁ №5", " Trading ", "Date:05/06/2017", "12 Mar 2019", "March 3, 2018 ", "2016-7-8", "31/02/2018", "日期:7/8/2018", "12 ", "cash"]


def odd_words(spark):
    rng = random.Random(7)
    rows = []
    for doc in range(120):
        y = 0
        for word in rng.sample(range(60), rng.randrange(1, 40)):
            y += rng.choice([0, 0, 3, 14, 15, 40])
            box = [rng.randrange(90), y, rng.randrange(50), rng.choice([10, 20, 20, 90])] if rng.random() > 0.05 else [None] * 4
            rows.append((doc, word, rng.choice(TEXTS), rng.choice([-1, 5, 10, 60, 99, None]), *box, rng.choice([980, 2000, None])))
    rows += [(200, 5000 + i, TEXTS[i % 10], 90, 10 * i, 30 * (i // 4), 9, 20, 980) for i in range(12)]  # numbered beyond what is gathered
    rows += [(201, -1, "ACME MART", 90, 1, 1, 9, 20, 980), (202, 1, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, WORDS)


def test_gathered_documents_tell_what_scans_tell(spark):
    for words, most in ((odd_words(spark), 20), (fixtures.contested_dates(spark, SMALL).filter("doc_id < 300"), documents.DOC_ROWS)):
        found = routing.extract_fields(words, hot_rows=most, texts=True)
        expected = routing._scanned_fields(words, routing.NEGATIVE_PHRASES, None, True)
        # A document without words that are not blank has no text.
        whole = {"text": F.when(routing._weak(), F.coalesce("text", F.lit("")))}
        rows = [sorted(map(str, df.withColumns(whole).select(found.columns).collect())) for df in (found, expected)]
        assert rows[0] == rows[1] and found.filter("total is not null and date is not null").count() > 0


def test_words_are_read_once(spark):
    words = fixtures.receipt_words(spark, SMALL)
    docs = documents.with_vendor(documents.with_date(documents.with_total(documents.gathered(words))))
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == words._jdf.queryExecution().executedPlan().toString().count("FileScan") and "Python" not in plan
