"""What a delivery writes to its ledger, and texts of totals."""

import uuid

from pyspark.sql import functions as F

from docfields.functions.text import num_text
from docfields.operators import delivery
from docfields.session import run_folder
from docfields.sources import ledgers


def test_an_outcome_is_flushed_with_the_next_beginning(spark, monkeypatch):
    folder, flushed = f"{run_folder(spark)}/test-{uuid.uuid4().hex}", spark.sparkContext.accumulator(0)
    write = ledgers.TaskLog.write

    def counted(self, *entries):
        flushed.add(1)
        write(self, *entries)

    rows = spark.createDataFrame([(str(i),) for i in range(20)], "job_id string")
    monkeypatch.setattr(delivery, "TaskLog", type("Counting", (ledgers.TaskLog,), {"write": counted}))
    out = delivery.deliver(rows, lambda row: int(row["job_id"]) % 4 > 0, sleep=lambda _: None, parallel=1, ledger=folder).collect()
    assert sum(r.ok for r in out) == 15 and len(out) == 20
    log = ledgers.read_log(spark, folder, delivery.LOGGED)
    assert log.count() == 40 and log.filter("ok IS NULL").count() == 20
    assert flushed.value == 21


def test_totals_are_written_as_python_writes_them(spark):
    values = [0.05, 0.5, 1.0, 12.3, 12.34, 100.0, 99999999999.99, 999999999999.99, 1e11, 1e16, 0.1 + 0.2, 1.005, 0.001, 1e-5, -7.1, -0.0,
              float("nan"), float("inf"), 123456.78, 2**53 / 100]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", num_text(F.col("v")).alias("t")).collect()
    assert [r.t for r in rows] == [repr(r.v) for r in rows]
