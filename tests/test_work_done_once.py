"""Plans of the receipt fields: what a row has told is not made, sorted or looked for again."""

from pyspark.sql import functions as F

from docfields import fixtures
from docfields.operators import dates, totals, vendors

SMOKE = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_best_run_of_lines_is_found_without_exploding_them(spark):
    lines = vendors.header_lines(fixtures.receipt_words(spark, SMOKE), hot_rows=None, normal=False)
    kept = vendors.vendor_lines(lines)
    made = vendors._runs(kept).select("doc_id", F.greatest(*vendors.RUNS).alias("r")).groupBy("doc_id").agg(F.max("r").alias("r"))
    best = {r["doc_id"]: (r["r"]["score"], r["r"]["text"]) for r in made.collect()}
    every = vendors.vendor_candidates(kept).groupBy("doc_id").agg(F.max(F.struct("score", "text")).alias("r"))
    assert best == {r["doc_id"]: tuple(r["r"]) for r in every.collect()} and best
    words = fixtures.receipt_words(spark, SMOKE)
    # The one that is left deals out the printed words of an order; the items are the other.
    assert plan(vendors.extract_vendor(words, hot_rows=None)).count("Generate") == plan(words).count("Generate")


def test_forms_of_a_date_and_labels_are_not_looked_for_twice(spark):
    words = fixtures.receipt_words(spark, SMOKE)
    assert plan(dates.date_candidates(words)).count("coalesce(CASE WHEN RLIKE") <= 2  # one for each side of the union
    total = plan(totals.total_candidates(words, hot_rows=None))
    assert total.count(r"net\s*payable, 1)") + total.count(r"(?U)net\s*payable)") <= 1


def test_scores_of_runs_are_those_of_their_texts(spark):
    from docfields.functions.scores import vendor_score

    rows = [(1, i, i, text, 1, 1, 9, 9) for i, text in enumerate(["ABC Sdn", "Bhd Mart", "x", "&.", "sdn. bhd LTD"])]
    kept = spark.createDataFrame(rows, "doc_id long, line_ix int, i int, clean string, x1 int, y1 int, x2 int, y2 int")
    found = vendors.vendor_candidates(kept).withColumn("again", vendor_score(F.col("text"), F.col("i"))).collect()
    assert len(found) == 12 and all(r["score"] == r["again"] for r in found)
    assert "ABC Sdn Bhd Mart" in {r["text"] for r in found}
