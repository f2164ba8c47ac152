"""What streams keep and how they are dealt out."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from conftest import SMALL
from docfields import fixtures
from docfields.operators import documents
from docfields.operators.routing import extract_fields
from docfields.schema import WORDS
from docfields.sources.words import read_words_stream
from docfields.streaming import batching, stages
from test_at_scale import Handle


def test_pages_of_words_shrink_in_state(spark):
    columns = spark.range(0).selectExpr("id as doc_id", "id as word_id", "'' as text", "id as n_words").schema
    task, handle, rng = batching.Assembly(columns, "doc_id", "word_id", "n_words", 60_000), Handle(), np.random.default_rng(5)
    task.init(handle)
    order = rng.permutation(20_000)
    frame = pd.DataFrame({"doc_id": order // 20 * 64, "word_id": order % 20 * 100, "text": [f"{k % 977}.50" for k in order], "n_words": 21})
    assert not list(task.handleInputRows((0,), iter([frame[:10_000], frame[10_000:]]), handle))
    assert sum(len(page) for page, in task.pages.values) < pa.Table.from_pandas(frame).nbytes / 4
    last = pd.DataFrame({"doc_id": np.arange(1_000) * 64, "word_id": 5_000, "text": "x", "n_words": 21})
    out = pd.concat(task.handleInputRows((0,), iter([last]), handle))
    whole = pd.concat([frame, last]).sort_values(["doc_id", "word_id"], ignore_index=True)
    assert out["complete"].all() and out.sort_values(["doc_id", "word_id"], ignore_index=True)[whole.columns].equals(whole)


def test_a_trigger_does_not_make_its_columns_anew(spark):
    words = spark.createDataFrame([], WORDS)
    client, calls = spark.sparkContext._gateway._gateway_client, []
    send = client.send_command
    client.send_command = lambda *args, **options: calls.append(1) or send(*args, **options)
    try:
        for phrases in (("a", "b"), ("a", "b")):
            documents.with_vendor(documents.gathered(words, 77), phrases, y_tol=17)
            calls.append(0)
    finally:
        client.send_command = send
    first = calls.index(0)
    assert len(calls) - first < first / 2


def test_words_of_a_trigger_are_dealt_out_as_they_are_read(spark, tmp_path):
    fixtures.receipt_words(spark, SMALL).filter("doc_id < 300").coalesce(1).write.parquet(str(tmp_path / "words"))
    tasks = []

    def gathered(words, *args, **options):
        tasks.append(words.rdd.getNumPartitions())
        return extract_fields(words, *args, **options)

    was, stages.extract_fields = stages.extract_fields, gathered
    try:
        stages.drain(stages.stream_extract(
            read_words_stream(spark, str(tmp_path / "words")), str(tmp_path / "sink"), str(tmp_path / "state"), F.lit("1998-01-01").cast("date")))
    finally:
        stages.extract_fields = was
    assert tasks == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
