"""Texts that are alike for weak hashes, colliding hashes, columns with clashing names, very long texts, many files."""

import base64
import math
import random
import zlib

import brute
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

from docfields.llm import arrays, bagminhash, host_rules, kneser_ney, open_bins, packing, pieces, prefix_bpe, token_files, tree_model
from docfields.llm.queries import BPE_50K, MULTI_50K, crc32
from docfields.session import materialise


def thue_morse(n, flip=0):
    return "".join("ab"[(bin(i).count("1") + flip) & 1] for i in range(n))


@pytest.fixture(scope="module")
def hard(spark):
    """Pairs of texts of which one is the other's complement, as words, lines and shingles."""
    rows = []
    for n in (1024, 2048, 8192):
        a, b = thue_morse(n), thue_morse(n, 1)
        rows += [(a, "h"), (b, "h"), (f"{a}\n{b}\n{a} {b} x", "h"), (f"one {a} three four five six seven", "h"), (f"one {b} three four five six seven", "h")]
    docs = spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(rows)], "doc_id long, text string, source string")
    return materialise(docs, "hard")


def test_ids_of_hard_words(spark, hard):
    import tiktoken

    path = P.path(MULTI_50K)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=prefix_bpe.read_ranks(path), special_tokens={})
    texts = {r.doc_id: r.text for r in hard.collect()}
    for r in prefix_bpe.encode(hard, path, keep=["doc_id"]).collect():
        assert r.ids == library.encode_ordinary(texts[r.doc_id])
    encode = brute.tokenizer()
    ids = {k: np.array([*encode(t), 0], "<u4") for k, t in texts.items()}
    for r in token_files.read(token_files.write(hard, P.path(BPE_50K)), {"ids_crc32": ("long", crc32)}).collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id].tobytes())
    for pack in (packing.pack, open_bins.pack):
        for r in pack(hard, P.path(BPE_50K), derive={"ids_crc32": ("long", crc32)}).collect():
            assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())


def test_hard_words_apart(spark, hard):
    rows = hard.collect()
    groups = {r.doc_id: r.class_id for r in bagminhash.near_groups(hard).collect()}
    assert groups == {r.doc_id: r.doc_id for r in rows}
    model, plain = kneser_ney.fit(hard), brute.KneserNey([r.text for r in rows])
    assert model.size == plain.v and model.tokens == plain.n
    texts = {r.doc_id: r.text for r in rows}
    for r in kneser_ney.score(hard, model).collect():
        n, known, base, score = plain.score(texts[r.doc_id])
        assert r.score == pytest.approx(score) and r.base_score == pytest.approx(base)
    for r in host_rules.measure(hard).collect():
        lines = [x for x in r.text.split("\n") if x.strip()]
        assert r._measures.n_dup_lines == len(lines) - len(set(lines)) and r._measures.n_repeat_words == 0


def test_ranges_by_length():
    rng = random.Random(4)
    words = ["".join(rng.choices("abü", k=rng.randrange(1, 260))) for _ in range(4_000)] + ["a\0", "a", "a\0\0", "x" * 70_000]
    texts = arrays.Texts(pa.array(words * 2))
    raw = texts.data
    for seed in (None, 1, arrays.new_seed()):
        found = arrays.range_hash(seed)(raw, texts.offsets[:-1], texts.offsets[1:])
        assert (found[: len(words)] == found[len(words) :]).all()
        assert len(set(found.tolist())) == len(set(words))
    a, b = (arrays.RangeHash(s)(raw, texts.offsets[:-1], texts.offsets[1:]) for s in (1, 2))
    assert not (a == b).any()


def test_pieces_whose_hashes_collide(monkeypatch):
    """With hardly any hash at all the ids stay right: every find is compared byte by byte."""
    encode = brute.tokenizer()
    texts = ["the cat sat on the mat", "", "and then it left, it's 12 o'clock", "Ünïcödé 日本語 😀 " * 3, thue_morse(2048), thue_morse(2048, 1)]
    monkeypatch.setattr(pieces, "range_hash", lambda: lambda data, low, high: (high - low).astype(np.uint64) % np.uint64(3))
    monkeypatch.setattr(pieces, "_encoders", {})
    for _ in range(2):
        ids, counts = pieces.library_encoder(P.path(BPE_50K)).ids(arrays.Texts(pa.array(texts)))
        assert ids.tolist() == [i for t in texts for i in encode(t)] and counts.tolist() == [len(encode(t)) for t in texts]


def test_every_kind_of_letter():
    import tiktoken
    from tokenizers import Tokenizer

    points = [c for low, high in (*pieces.LATER_LETTERS, *pieces.LATER_NUMBERS) for c in range(low, high + 1)]
    points += [c for c in range(0x80, 0x110000, 41) if not 0xD800 <= c < 0xE000]
    path = P.path(MULTI_50K)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}, special_tokens={})
    other = Tokenizer.from_file(P.path(BPE_50K))
    texts = ["".join(f"{chr(c)}'s 1{chr(c)}2 " for c in points[at : at + 500]) for at in range(0, len(points), 500)]
    for encoder, ids in ((prefix_bpe.load(path)[1], library.encode_ordinary), (pieces.library_encoder(P.path(BPE_50K)), lambda t: other.encode(t, add_special_tokens=False).ids)):
        for text in texts:
            assert encoder.ids(arrays.Texts(pa.array([text])))[0].tolist() == ids(text)


def test_long_texts_in_parts(monkeypatch):
    encode, rng = brute.tokenizer(), random.Random(2)
    monkeypatch.setattr(pieces, "LONGEST", 40)
    words = ["the", "cat's", "日本語", "12³", " ", "\n", "  ", "\t", "été", "<|endoftext|>", "😀", "　"]
    for _ in range(60):
        text = "".join(rng.choice(words) + rng.choice(["", " ", "  ", "\n"]) for _ in range(rng.randrange(150)))
        ids, counts = pieces.library_encoder(P.path(BPE_50K)).ids(arrays.Texts(pa.array([text])))
        assert ids.tolist() == encode(text) and counts.tolist() == [len(ids)]


def test_edits_are_local():
    merges, rng = prefix_bpe.load(P.path(MULTI_50K))[0], random.Random(1)
    piece = "".join(rng.choices("abcdefghijklmnop", k=200_000)).encode()
    table, made = prefix_bpe.PrefixTable(merges, piece), [0]

    class Finder:
        def iter(self, text):
            made[0] += len(text)
            return merges.finder.iter(text)

    whole = type("Counted", (), {"__getattr__": lambda self, name: Finder() if name == "finder" else getattr(merges, name)})()
    table.merges = whole
    for start, end, by in ((100_000, 100_003, b"zzz"), (0, 1, b""), (5, 5, b"xyz"), (199_000, 199_999, b"q")):
        table.edit(start, end, by)
        piece = piece[:start] + by + piece[end:]
    assert table.piece == piece and table.last == prefix_bpe.PrefixTable(merges, piece).last
    assert made[0] < 40 * merges.longest


def test_columns_with_names_of_the_operators(spark):
    text = "some words that are long enough " * 12
    docs = materialise(spark.createDataFrame([(1, text, "h", 1.5, 7, "a", True, "b", "c"), (2, None, None, None, None, None, None, None, None)],
        "doc_id long, text string, source string, score double, n_tokens int, _text string, _bad boolean, _measures string, _kept string"), "clashes")
    scored = kneser_ney.score(docs, kneser_ney.fit(docs))
    assert [c for c in scored.columns if c == "score"] == ["score"] and "_text" in scored.columns
    assert {r.doc_id: r.n_tokens for r in scored.collect()} == {1: 73, 2: 1}
    judged = {r.doc_id: r for r in host_rules.judge(docs).collect()}
    assert judged[1]._bad is True and judged[1]._measures.n_words == 72 and judged[2]._kept is False
    kept = host_rules.drop_low_quality(docs)
    assert kept.columns == docs.columns
    pages = spark.createDataFrame([(1, "<article><p>Hello there, this is a sentence.</p></article>", "x", "y")], "page_id long, html string, _page string, TEXT string")
    assert tree_model.extract(pages, tree_model.fit(pages)).columns == ["page_id", "_page", "text"]


def test_formulas_and_drawings_are_text(spark):
    html = ("<body><article><p>Long enough a sentence so that it is content, and the formula is <math><mi>E</mi><mo>=</mo><mi>m</mi>"
            "<annotation>E=m</annotation></math> as one knows, <svg><path d='M 0'/><g><title>no</title><text x='1'>drawn</text></g></svg>. More of <b>it</b>.</p></article></body>")
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    text = tree_model.extract(pages, tree_model.fit(pages)).first().text
    assert "the formula is E=m as one knows, drawn. More of it." in text and "E=mE" not in text


def test_packing_wastes_little_on_short_texts(spark):
    for texts in ([""] * 3_000, ["a b c"] * 2_000, ["", "word " * 300] * 400):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
        rows = packing.pack(docs, P.path(BPE_50K), derive={"n": ("long", len)}).collect()
        used, sequences = sum(r.length for r in rows), len({r.sequence_id for r in rows})
        assert sequences <= 1.02 * used / 1024 + 1


def test_model_of_many_files(spark, monkeypatch):
    """A worker keeps a bounded number of files open, whatever the number of ranges."""
    monkeypatch.setattr(kneser_ney.Mapped, "KEPT", 5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    docs = materialise(spark.createDataFrame([(i, f"some words w{i} w{i + 1} w{i * 7 % 40}") for i in range(60)], "doc_id long, text string"), "few")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        model = kneser_ney.fit(docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    files = kneser_ney.Mapped(model)
    ids, _, first = files.text_ids(arrays.Texts(pa.array([r.text for r in docs.collect()])))
    assert np.isfinite(files.log_probability(ids, first)).all() and len(files.kept) <= 5
    plain = brute.KneserNey([r.text for r in docs.collect()])
    for r in kneser_ney.score(docs, model, keep=["doc_id"]).collect():
        text = f"some words w{r.doc_id} w{r.doc_id + 1} w{r.doc_id * 7 % 40}"
        assert math.isclose(r.score, plain.score(text)[3], rel_tol=1e-9)


def test_a_range_is_read_about_once():
    import io

    from docfields.llm import warc

    rng = random.Random(3)
    members, places, at = [], [], 0
    for i in range(2_000):
        body = rng.randbytes(rng.randrange(3_000))
        members.append(warc.record("response", f"<urn:x-row:{i}:0:0>", "http://x", warc.sha1_base32(body), body, ""))
        places.append(at)
        at += len(members[-1])
    data, read = b"".join(members), [0]

    class Counted(io.BytesIO):
        def read(self, n=-1):
            found = super().read(n)
            read[0] += len(found)
            return found

    found = [place for place, _ in warc.Range(Counted(data), len(data), 0, len(data)).records()]
    assert found == places and read[0] < 1.1 * len(data)
    split, found = 100_000, []
    for low in range(0, len(data), split):
        found += [place for place, _ in warc.Range(Counted(data), len(data), low, low + split).records()]
    assert found == places


def test_keys_meet_their_shards_only(spark):
    docs = materialise(spark.createDataFrame([(i * i if i < 300 else -i, f"text {i}") for i in range(400)], "doc_id long, text string"), "keyed")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        shards = token_files.write(docs, P.path(BPE_50K))
        wanted = spark.createDataFrame([(i,) for i in (*range(-420, 1_000), 299 * 299, 2**62, -(2**62))], "doc_id long")
        got = token_files.fetch(wanted, shards)
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    encode = brute.tokenizer()
    inside = {r.doc_id: r.text for r in docs.collect() if -420 <= r.doc_id < 1_000 or r.doc_id == 299 * 299}
    assert {r.doc_id: r.ids for r in got.collect()} == {k: [*encode(t), 0] for k, t in inside.items()}
