"""The queries of the corpus operators against SQL or brute force, over whole small tables."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers as P
import pytest
from oracle import compare, connect

import corpus_pipeline
from conftest import SMALL
from docfields.llm import queries as Q


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").collect()


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_matches_sql(name, spark):
    assert compare(Q.QUERIES[name](spark, SMALL), Q.SQL[name], connect(SMALL)) is None


def test_kneser_ney_scores(spark, documents):
    model = brute.KneserNey([d.text for d in documents if not brute.held_out(d.doc_id)])
    found = {r.doc_id: r for r in Q.op1_kneser_ney(spark, SMALL).collect()}
    assert len(found) == len(documents)
    held = []
    for d in documents:
        n, known, base, score = model.score(d.text)
        r = found[d.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (brute.held_out(d.doc_id), n, known, model.n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)
        if r.held_out:
            held.append((r.score, r.base_score))
    assert sum(s for s, _ in held) > sum(b for _, b in held)


def test_probabilities_add_up():
    model = brute.KneserNey(["a b a b c", "b c d", "a a a"])
    for v in ("a", "b", ("begin",), "never"):
        assert sum(model.after(v, w) for w in [*model.words, "unknown"]) == pytest.approx(1)


def test_near_duplicate_classes(spark, documents):
    classes = brute.near_classes([(d.doc_id, d.text) for d in documents])
    least = {c: min(d.doc_id for d, k in zip(documents, classes) if k == c) for c in classes}
    found = {r.doc_id: r for r in Q.op3_bagminhash(spark, SMALL).collect()}
    sizes = Counter(classes)
    for d, c in zip(documents, classes):
        r = found[d.doc_id]
        assert (r.class_id, r.group_size, r.kept) == (least[c], sizes[c], d.doc_id == least[c])


def test_bpe_ids_and_bytes(spark, documents):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(Q.MULTI_50K), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: r for r in Q.op4_prefix_bpe(spark, SMALL).collect()}
    for d in documents:
        ids = library.encode_ordinary(d.text)
        r = found[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()


def test_token_files_give_back_every_document(spark, documents):
    encode = brute.tokenizer()
    found = {r.doc_id: r for r in Q.op5_token_files(spark, SMALL).collect()}
    at = 0
    for d in sorted(documents, key=lambda d: d.doc_id):
        ids = [*encode(d.text), 0]
        assert tuple(found[d.doc_id]) == (d.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_extracted_text(spark):
    import html
    import re

    wrong = 0
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    found = {r.page_id: r for r in Q.op8_tree_model(spark, "/root/testdata/sf0.01").collect()}
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", " ", b)) for b in re.split(r"</?(?:p|h1)>", article)]
        expected = "\n\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)
        wrong += found[p.page_id].text != expected or found[p.page_id].n_chars != len(expected)
    assert len(found) == len(pages) and not wrong


def test_added_tokens_have_their_ids(spark, tmp_path):
    """Ids of the queries and the pipeline's last stage against the library with its defaults."""
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}", f"it's  {end}  's\t", f"<|endof{end}text|>", "<|endof", "text|>", f"日本 {end}é", None, "", f"'{end}'s <|",
             f"x {end[:-1]}", "> y"] + [f"{'word ' * 700}{end}\n" * 3]
    pair = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    pair.write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(P.path(Q.BPE_50K))
    expected = {k: [*library.encode(t or "", add_special_tokens=False).ids, 0] for k, t in enumerate(texts)}
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert expected[0] == [64, 220, 50256, 275, 0]
    at = 0
    for r in sorted(Q.op5_token_files(spark, str(tmp_path)).collect(), key=lambda r: r.doc_id):
        assert tuple(r) == (r.doc_id, at, len(expected[r.doc_id]), crc(expected[r.doc_id]))
        at += r.n_tokens
    assert at == sum(map(len, expected.values()))
    for packed in (Q.op9_packing(spark, str(tmp_path)), corpus_pipeline.STAGES[-1][1](spark, pair, str(tmp_path))):
        rows = packed.collect()
        assert sum(r.length for r in rows) == at
        assert all(r.ids_crc32 == crc(expected[r.doc_id][r.start : r.start + r.length]) for r in rows)


def packing_holds(rows, texts, length=1024):
    """Every id in one piece, sequences without gaps and within the limit; returns the share of padding."""
    encode, by, sequences = brute.tokenizer(), defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for key, text in texts.items():
        ids, at = [*encode(text), 0], 0
        for r in sorted(by[key], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : at], "<u4").tobytes())
        assert at == len(ids)
    total = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
        total += length
    return 1 - sum(r.length for r in rows) / total


def test_packing(spark, documents):
    assert packing_holds(Q.op9_packing(spark, SMALL).collect(), {d.doc_id: d.text for d in documents}) < 0.01


def test_ring(spark, documents):
    found = {r.doc_id: r for r in Q.op10_ring(spark, SMALL).collect()}
    loads, slots = Counter(), defaultdict(list)
    for d in documents:
        r = found[d.doc_id]
        assert r.size == len(d.text.encode()) + 1 and r.text_crc32 == zlib.crc32(d.text.encode())
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(found) == len(documents) and set(loads) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    longest = max(r.size for r in found.values())
    assert max(loads.values()) - min(loads.values()) <= 2 * longest


def test_pipeline(spark, documents):
    bad = {d.doc_id for d in documents if brute.rejected(d.text)}
    hosts = {r.doc_id for r in Q.op2_host_rules(spark, SMALL).collect() if r.kept}
    kept = [d for d in documents if d.doc_id not in bad and d.doc_id in hosts]
    last = {brute_lower(d.text): d for d in sorted(kept, key=lambda d: d.doc_id)}
    kept = sorted(last.values(), key=lambda d: d.doc_id)
    classes = brute.near_classes([(d.doc_id, d.text) for d in kept])
    first = {}
    for d, c in zip(kept, classes):
        first.setdefault(c, d)
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == {d.doc_id for d in first.values()}
    packing_holds(rows, {d.doc_id: d.text for d in first.values()})


def brute_lower(text):
    return (text or "").translate(brute.LOWER)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
