"""Awkward rows, empty tables, limits and keyed access of the corpus operators."""

import math
import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docfields.llm import (
    bagminhash,
    host_rules,
    kneser_ney,
    large_groups,
    packing,
    prefix_bpe,
    ring,
    token_files,
    tree_merge,
    tree_model,
    warc,
)
from docfields.llm.components import components
from docfields.llm.queries import BPE_50K, MULTI_50K
from docfields.session import materialise


@pytest.fixture(scope="module")
def odd(spark):
    return materialise(brute.odd_docs(spark), "odd")


@pytest.fixture(scope="module")
def empty(spark):
    return materialise(brute.odd_docs(spark).limit(0), "none")


def test_scores_of_odd_rows(odd):
    rows = odd.collect()
    model, plain = kneser_ney.fit(odd), brute.KneserNey([r.text for r in rows])
    found = {r.n_chars: r for r in kneser_ney.score(odd, model, keep=["n_chars"]).collect()}
    for r in rows:
        n, known, base, score = plain.score(r.text)
        got = found[r.n_chars]
        assert (got.n_tokens, got.n_known) == (n, known)
        assert got.base_score == pytest.approx(base) and got.score == pytest.approx(score)


def test_scores_without_training(odd, empty):
    model = kneser_ney.fit(empty)
    assert {(r.n_known, r.score, r.base_score) for r in kneser_ney.score(odd, model, keep=[]).collect()} == {(0, 0.0, 0.0)}
    assert kneser_ney.score(empty, model).count() == 0


class Trigrams(brute.KneserNey):
    """By the formulas: pairs count the words before them, those at a text's begin their occurrences."""

    def __init__(self, texts):
        super().__init__(texts)
        chains = [[("begin",), *self.tokens(t)] for t in texts]
        self.triples = Counter(x for c in chains for x in zip(c, c[1:], c[2:]))
        after = Counter((v, w) for _, v, w in self.triples)
        self.pairs = Counter({(v, w): c if v == ("begin",) else after[v, w] for (v, w), c in self.pairs.items()})
        self.total, self.kinds = self.context(self.pairs)
        self.d2, self.d3 = self.discounts(self.pairs.values()), self.discounts(self.triples.values())
        self.total3, self.kinds3 = self.context(self.triples)

    @staticmethod
    def context(grams):
        total, kinds = Counter(), defaultdict(lambda: [0, 0, 0])
        for g, c in grams.items():
            total[g[:-1] if len(g) > 2 else g[0]] += c
            kinds[g[:-1] if len(g) > 2 else g[0]][min(c, 3) - 1] += 1
        return total, kinds

    def after_two(self, u, v, w):
        if not self.total3[u, v]:
            return self.after(v, w)
        c, left = self.triples[u, v, w], sum(d * k for d, k in zip(self.d3, self.kinds3[u, v]))
        return (c - self.d3[min(c, 3) - 1] if c else 0) / self.total3[u, v] + left / self.total3[u, v] * self.after(v, w)

    def log(self, text):
        c = [None, ("begin",), *self.tokens(text)]
        return sum(math.log10(self.after_two(*x)) for x in zip(c, c[1:], c[2:]))


def test_scores_by_two_words_of_context(spark, odd, empty):
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for train, others in (([r.text for r in odd.collect()], docs[:20]), (docs[20:], docs[:20])):
        plain = Trigrams(train)
        assert sum(plain.after_two(*next(iter(plain.triples))[:2], w) for w in [*plain.words, "unknown"]) == pytest.approx(1)
        schema = "doc_id long, text string"
        model = kneser_ney.fit(spark.createDataFrame(list(enumerate(train)), schema), order=3)
        texts = [*train, *others, None, "never seen", "the cat never"]
        for r in kneser_ney.score(spark.createDataFrame(list(enumerate(texts)), schema), model).collect():
            assert r.score == pytest.approx(plain.log(texts[r.doc_id]), rel=1e-9)
    assert {r.score for r in kneser_ney.score(odd, kneser_ney.fit(empty, order=3), keep=[]).collect()} == {0.0}


def test_quality_of_odd_rows(odd, empty):
    rows = host_rules.judge(odd).collect()
    assert len(rows) == 13 and all(r._kept <= (not brute.rejected(r.text)) for r in rows)
    assert host_rules.drop_low_quality(odd).columns == odd.columns
    assert host_rules.drop_low_quality(empty).count() == 0


def test_a_bad_host_loses_its_documents(spark):
    good = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(k, "bad", good(k) if k % 10 == 0 else "short") for k in range(300)]
    rows += [(k, "good", good(k) if k % 10 else "short") for k in range(300, 600)]
    rows += [(600, "new", "short"), (601, "new", good(601))]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    kept = {(r.source, r.doc_id) for r in host_rules.drop_low_quality(docs).collect()}
    assert kept == {("good", k) for k in range(300, 600) if k % 10} | {("new", 601)}


def test_near_duplicates_of_odd_rows(odd, empty):
    rows = odd.collect()
    found = bagminhash.near_groups(odd).collect()
    assert len(found) == 13 and sum(r.kept for r in found) == len({r.class_id if r.class_id is not None else ("none", r.group_size) for r in found})
    classes = brute.near_classes([(r.doc_id, r.text) for r in rows])
    assert sum(r.kept for r in found) == len(set(classes))
    assert bagminhash.drop_near_copies(odd).columns == odd.columns
    assert bagminhash.near_groups(empty).count() == 0


def test_near_duplicate_families(spark, monkeypatch):
    """Edited copies of a few texts, also where a bucket is cut to blocks: the classes of brute force."""
    rng, rows = random.Random(3), []
    for family in range(4):
        words = [f"f{family}w{rng.randrange(400)}" for _ in range(120)]
        for k in range(40):
            copy = words[:]
            for _ in range(rng.randrange(6)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            rows.append((1000 * family + k, " ".join(copy)))
    rows.append((9, "again and again " * 200))
    rows.append((10, "again and again " * 210))
    rng.shuffle(rows)
    classes = brute.near_classes(rows)
    least = {c: min(i for (i, _), k in zip(rows, classes) if k == c) for c in classes}
    expected = {i: least[c] for (i, _), c in zip(rows, classes)}
    assert len(set(expected.values())) > 6
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (4096, 7):
        monkeypatch.setattr(bagminhash, "BLOCK", block)
        assert {r.doc_id: r.class_id for r in bagminhash.near_groups(docs).collect()} == expected


def test_signatures_estimate_weighted_similarity():
    shared, rng = np.arange(1, 41, dtype=np.uint64), np.random.default_rng(1)
    agree, trials = 0, 40
    a_count, b_count = rng.integers(1, 9, 40), rng.integers(1, 9, 40)
    true = np.minimum(a_count, b_count).sum() / np.maximum(a_count, b_count).sum()
    for t in range(trials):
        value = np.tile(bagminhash.mix(shared + np.uint64(1000 * t)), 2)
        s = bagminhash.signatures(np.repeat([0, 1], 40), value, np.concatenate([a_count, b_count]), 2)
        agree += (s[0] == s[1]).mean() / trials
    assert abs(agree - true) < 4 * (true * (1 - true) / (trials * bagminhash.SIZE)) ** 0.5


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 103), (103, 101), (7, 7)], "a long, b long")
    found = {r.id: r.label for r in components(links).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100, 103: 100}
    assert components(links.limit(0)).count() == 0


def test_bpe_of_odd_rows(odd, empty):
    import tiktoken

    path = P.path(MULTI_50K)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=prefix_bpe.read_ranks(path), special_tokens={})
    found = prefix_bpe.decode(prefix_bpe.encode(odd, path), path).collect()
    for r in found:
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.bytes) == (r.text or "").encode()
    assert len(found) == 13 and prefix_bpe.encode(empty, path).count() == 0


def test_prefix_tables_append_and_edit():
    merges, rng = prefix_bpe.load(P.path(MULTI_50K))[0], random.Random(5)
    alphabet = [b"th", b"e", b"ing", b"\xc3\xa9", b"x", b"aa", b"00", b"\xff"]
    for _ in range(300):
        piece = b"".join(rng.choices(alphabet, k=rng.randrange(12)))
        more, by = (b"".join(rng.choices(alphabet, k=rng.randrange(5))) for _ in range(2))
        a, b = sorted((rng.randrange(len(piece) + 1), rng.randrange(len(piece) + 1)))
        assert prefix_bpe.PrefixTable(merges, piece).append(more).last == prefix_bpe.PrefixTable(merges, piece + more).last
        assert prefix_bpe.PrefixTable(merges, piece).edit(a, b, by).last == prefix_bpe.PrefixTable(merges, piece[:a] + by + piece[b:]).last


def test_token_files_of_odd_rows(spark, odd, empty):
    shards = token_files.write(odd, P.path(BPE_50K))
    encode = brute.tokenizer()
    expected = sorted(((-1 if r.doc_id is None else r.doc_id), [*encode(r.text), 0]) for r in odd.collect())
    found = token_files.read(shards).orderBy("start").collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids) for r in found) == expected
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()
    wanted = spark.createDataFrame([(3,), (5,), (77,), (None,)], "doc_id long")
    assert sorted((r.doc_id, r.ids) for r in token_files.fetch(wanted, shards).collect()) == [x for x in expected if x[0] in (3, 5)]
    assert token_files.read(token_files.write(empty, P.path(BPE_50K))).count() == 0


def test_perfect_hash_is_minimal():
    for n in (0, 1, 2, 1000, 50_000):
        hashes = token_files.hashed(np.arange(n) * 7 - 3)
        assert sorted(token_files.PerfectHash.build(hashes).slots(hashes).tolist()) == list(range(n))


def test_exact_copies_of_odd_rows(odd, empty):
    rows, found = odd.collect(), tree_merge.exact_groups(odd).collect()
    texts = {(r.text or "").translate(brute.LOWER) for r in rows}
    assert len(found) == 13 and sum(r.kept for r in found) == len(texts)
    assert tree_merge.drop_copies(odd).columns == odd.columns
    assert tree_merge.drop_copies(odd).count() == len(texts)
    assert {r.keep_id for r in found if r.doc_id == 3} == {4} and {r.group_size for r in found if r.doc_id == 3} == {3}
    assert tree_merge.exact_groups(empty).count() == 0


def test_runs_merge_without_a_shuffle_or_a_sort(spark):
    rows = spark.range(3000).select((F.col("id") % 700).cast("string").alias("a"), (F.col("id") % 2).alias("b"), F.col("id").alias("row")).repartition(8)
    leaves = rows.withColumn("run", F.pmod(F.spark_partition_id(), F.lit(4))).groupBy("a", "b", "run").agg(F.max("row").alias("keep"), F.count(F.lit(1)).alias("group_size"))
    name = tree_merge.write_runs(leaves.repartition(5, "a", "b"), ["a", "b"], 5)
    with tree_merge.ordered_scans(spark):
        plan = tree_merge.merge_round(spark.table(name), ["a", "b"], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan and not re.search(r"\bSort\b", plan), plan
    spark.sql(f"DROP TABLE {name}")
    expected = rows.groupBy("a", "b").agg(F.max("row").alias("keep"), F.count(F.lit(1)).alias("group_size"))
    for runs in (2, 8):
        assert sorted(tree_merge.merge_runs(rows, ["a", "b"], runs).collect()) == sorted(expected.collect())
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("docfields_runs")]


def test_large_groups_of_copies_are_joined_by_broadcast(spark):
    docs = spark.range(30_001).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Same").when(F.col("id") % 1000 == 1, "few").otherwise(F.col("id").cast("string")).alias("text"))
    found = tree_merge.exact_groups(docs)
    sizes = {(r.group_size, r.n, r.kept) for r in found.groupBy("group_size").agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("kept")).collect()}
    few = docs.where("text = 'few'").count()
    assert sizes == {(10_001, 10_001, 1), (few, few, 1), (1, 20_000 - few, 20_000 - few)}
    assert {r.keep_id for r in found.where("group_size = 10001").collect()} == {30_000}


def test_large_near_classes_are_joined_by_broadcast(spark):
    body = [f"w{i}" for i in range(60)]
    rows = [(k, " ".join([*body, f"end{k}"])) for k in range(200)] + [(k, "one text that is often copied word for word") for k in range(200, 400)]
    rows += [(k, " ".join(f"t{k}x{i}" for i in range(9))) for k in range(400, 500)] + [(None, rows[0][1]), (500, None), (501, "")]
    found = bagminhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    expected = {k: (0, 201) for k in range(200)} | {None: (0, 201)} | {k: (200, 200) for k in range(200, 400)} | {k: (k, 1) for k in range(400, 500)} | {k: (500, 2) for k in (500, 501)}
    assert {r.doc_id: (r.class_id, r.group_size) for r in found} == expected
    assert {r.doc_id for r in found if r.kept} == {0, 200, *range(400, 501)}


@pytest.mark.parametrize("hot", [2, 10_000])
def test_groups_join_their_rows_at_every_size(spark, monkeypatch, hot):
    monkeypatch.setattr(large_groups, "HOT", hot)
    rows = spark.range(1000).select(F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("size"), F.min("v").alias("least")).where("k <> 3")
    plain = rows.join(groups.drop("size"), ["k"], "left")
    found = large_groups.join_groups(rows, groups, ["k"], "size", 1000)
    assert found.columns == plain.columns
    assert sorted(found.fillna(-1).collect()) == sorted(plain.fillna(-1).collect())


def test_archives_of_odd_rows(spark):
    rows = [(1, "http://a/b c", "<p>x</p>"), (2, None, "<p>x</p>"), (2, None, "<p>x</p>"), (None, "u", None), (3, "ü\r\nX: y", ""), (4, "z", "\x1f\x8b\x08 é" * 99)]
    pages = spark.createDataFrame([(*r, "c", "f") for r in rows], "page_id long, url string, html string, payload string, first string")
    files = warc.write(pages)
    for split in (64, 1 << 20):
        found = warc.read(spark, files, split=split).collect()
        assert len(found) == len(rows)
        assert sorted((r.key or 0, r.record_type, r.refers_to_key or 0, r.payload_bytes) for r in found) == [
            (0, "revisit", 3, 0), (1, "response", 0, 8), (2, "revisit", 1, 8), (2, "revisit", 1, 8), (3, "response", 0, 0), (4, "response", 0, 693)]
        assert {r.payload.decode() for r in found if r.record_type == "response"} == {"<p>x</p>", "", rows[5][2]}
    assert {r.record_type for r in warc.read(spark, warc.write(pages, least=9)).collect()} == {"response"}
    assert warc.read(spark, warc.write(pages.limit(0))).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h2>Site</h2></header><nav><ul><li><a href=x>Menu</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><div id="main-content"><h1>Head &amp; line</h1><p>First <b>bold</b> words,
 long enough to be read as a sentence of the article.<p>Second paragraph, one &lt;tag&gt;, also with enough words to count.
<ul><li>One point of the list, said in full.</li><li>Another point of the list, said in full.</li></ul></div>
<aside class=sidebar><p>Related stories you may like, with several more words.</p></aside><form><label>Mail</label><button>Send</button></form>
<section id="comments"><p>I think this is great, and I say so at some length here.</p></section><script>x("</p>")</script><footer>&copy; me</footer>"""


def test_text_of_a_page_without_an_article_tag(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    odd = spark.createDataFrame([(1, PAGE, "u"), (2, None, "u"), (3, "", "u"), (3, "", "u"), (4, "<" * 5000 + "<p", None), (None, "<div>" * 3000 + "deep", "u")],
                                "page_id long, html string, text string")
    found = [(r.page_id, r.text) for r in tree_model.extract(odd, tree_model.fit(pages), keep=["page_id"]).collect()]
    assert dict(found)[1].split("\n\n") == [
        "Head & line", "First bold words, long enough to be read as a sentence of the article.",
        "Second paragraph, one <tag>, also with enough words to count.", "One point of the list, said in full.", "Another point of the list, said in full."]
    assert [t for k, t in found if k in (2, 3)] == ["", "", ""] and len(found) == 6
    assert tree_model.extract(odd.limit(0), tree_model.fit(odd.limit(0))).count() == 0


def test_marginals_are_exact():
    """Against all labellings of a small tree."""
    import itertools
    import math

    tree = tree_model.Tree("<div><p>a b.</p><ul><li><a href=x>y</a></li></ul></div><footer>z</footer>")
    model = tree_model.TreeModel(tuple(0.3 * ((i * 7) % 5 - 2) for i in range(len(tree_model.FEATURES))), 0.3, ((0.2, 0.7), (0.4, 0.9)))
    bits, n = tree.features(), len(tree.tag)
    odds = [sum(w for i, w in enumerate(model.weights) if b >> i & 1) - math.log(0.3 / 0.7) for b in bits]
    weight = [[0.0, 0.0] for _ in range(n)]
    for labels in itertools.product((0, 1), repeat=n):
        w = 0.3 if labels[0] else 0.7
        for i, y in enumerate(labels):
            w *= math.exp(odds[i] * y)
            if i:
                on = model.below[tree_model.begins(bits[i])][labels[tree.parent[i]]]
                w *= on if y else 1 - on
        for i, y in enumerate(labels):
            weight[i][y] += w
    assert model.marginals(tree) == pytest.approx([math.log(b / a) for a, b in weight])


def test_packing_of_odd_rows(odd, empty):
    rows = packing.pack(odd, P.path(BPE_50K), length=64, max_segments=3, max_loss=40).collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    assert all(len(s) <= 3 and sum(r.length for r in s) <= 40 for s in by.values())
    assert sum(r.length for r in rows) == sum(len(brute.tokenizer()(r.text)) + 1 for r in odd.collect())
    assert packing.pack(empty, P.path(BPE_50K)).count() == 0


def test_packing_in_less_memory_gives_the_same_pieces(odd):
    """The pipeline packs with smaller batches and fewer remembered pieces than a worker may have alone."""
    assert corpus_pipeline.PACK_BYTES < packing.LIBRARY_BATCH and corpus_pipeline.PACK_REMEMBERED < packing.LIBRARY_REMEMBERED
    columns = ("start", "length", "doc_tokens", "offset", "sequence_id", "ids")
    whole, small = (sorted(map(repr, packing.pack(odd, P.path(BPE_50K), **limits).select(*columns).collect()))
                    for limits in ({}, {"batch_bytes": 64, "remembered": 5}))
    assert whole == small


def test_packing_limits_with_prompts(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(k, "word " * rng.randrange(1, 90), rng.randrange(60)) for k in range(300)], "doc_id long, text string, prompt int")
    prompts = {r.doc_id: r.prompt for r in docs.collect()}
    rows = packing.pack(docs, P.path(BPE_50K), length=128, max_segments=5, max_loss=64, loss_from="prompt").collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for pieces in by.values():
        assert len(pieces) <= 5 and sum(r.length for r in pieces) <= 128
        assert sum(max(0, r.start + r.length - max(r.start, prompts[r.doc_id])) for r in pieces) <= 64


def test_ring_of_odd_rows(odd, empty):
    found = ring.deal(odd, 3).collect()
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(found) == 13 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert ring.deal(empty).count() == 0


def test_ring_keeps_its_bound_and_moves_little():
    rng = random.Random(4)
    loads = [(c, 0, rng.randrange(1, 100)) for c in range(16_384)]
    before, after = ring.walk(loads, 16_384, 8), ring.walk(loads, 16_384, 9)
    total = sum(x[2] for x in loads)
    for placed, n in ((before, 8), (after, 9)):
        held = [0] * n
        for c, s, w in loads:
            held[placed[c, s]] += w
        assert max(held) <= (1 + ring.SLACK) * total / n + 100
    assert sum(w for c, s, w in loads if before[c, s] != after[c, s]) < 0.2 * total


@pytest.mark.parametrize("n", [200, 20_000])
def test_ring_keeps_copies_together(spark, n):
    """Pairs of copies and a group near a shard's room have one shard; only a group beyond that room is spread."""
    rng = random.Random(6)
    texts = [f"{k} ".ljust(rng.randrange(500, 8000), "x") for k in range(n // 2)] * 2
    mean = sum(map(len, texts)) / 8
    texts += ["y" * 999] * int(mean / 1000) + ["z" * 999] * int(2.5 * mean / 1000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found, shards, loads, slots = ring.deal(docs, 8).collect(), {}, [0] * 8, {}
    for r in found:
        shards.setdefault(texts[r.doc_id], set()).add(r.shard)
        slots.setdefault(r.shard, []).append(r.slot)
        loads[r.shard] += r.size
    assert len(found) == len(texts) and {t[0] for t, s in shards.items() if len(s) > 1} == {"z"}
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads) - min(loads) <= 2 * 16_000


def test_stages_take_odd_rows(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, "").collect()
