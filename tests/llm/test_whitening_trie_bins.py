"""Whitening, the prefix trie and bounded-space best fit against plain versions, with awkward rows and forced splits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest

from conftest import SMALL
from docfields.llm import open_bins, prefix_trie, whitening
from docfields.llm import queries as Q
from docfields.session import materialise

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Whitening


def exact(vectors, wanted=4):
    """Components of the distinct rows by a dense solver."""
    x = np.array(sorted({tuple(v) for v in vectors}))
    c = x - x.mean(axis=0)
    values, directions = np.linalg.eigh(c.T @ c / len(x))
    return x, values[::-1][:wanted], directions[:, ::-1][:, :wanted], values.sum()


def held_to_a_dense_solver(found, rows, wanted=4):
    """``found``: rows of ``whiten``; ``rows``: key to whole-number vector."""
    x, values, directions, trace = exact(rows.values(), wanted)
    n, sums = len(x), x.sum(axis=0)
    by = {(r[0], r.component): r for r in found}
    assert len(by) == len(found) == len(rows) * len(values)
    for k in range(len(values)):
        ours = np.array([by[key, k + 1].whitened for key in rows])
        theirs = (np.array(list(rows.values())) - sums / n) @ directions[:, k] / np.sqrt(values[k])
        sign = np.sign(ours @ theirs)
        assert ours * sign == pytest.approx(theirs, abs=1e-8)
    for key, v in rows.items():
        r = by[key, 1]
        assert (r.n, r.deviation) == (n, sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums)))
        assert 0 <= r.identity_error <= 1e-4
    for k in range(len(values)):
        assert by[next(iter(rows)), k + 1].explained == pytest.approx(values[k] / trace, rel=1e-9)


def test_whitened_embeddings(spark):
    table = {r.vec_id: np.floor(np.array(r.embedding, dtype=np.float64) * 256).astype(int)
             for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()}
    held_to_a_dense_solver(Q.op11_lanczos_whitening(spark, SMALL).collect(), table)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, [1]) for i, v in rows], "vec_id long, embedding array<double>, whitened double, _x array<int>")


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = {1: [0.5, -1.0, 2.0], 2: [0.25, 0.0, -0.0], 3: [1.5, 2.0, 1.0], 4: [0.5, -1.0, 2.0], 5: [9.0, 1.0, 0.001], None: [-3.0, 0.0, 0.0]}
    bad = [(10, None), (11, [1.0, None, 2.0]), (12, [1.0, nan, 2.0]), (13, [inf, 0.0, 1.0])]
    table = vectors(spark, [*good.items(), *bad])
    rows = {k: np.floor(np.array(v) * 256).astype(int) for k, v in good.items()}
    held_to_a_dense_solver(whitening.whiten(table, whitening.fit(table)).collect(), rows, 3)
    twice = whitening.whiten(table.union(table), whitening.fit(table.union(table))).collect()
    once = whitening.whiten(table, whitening.fit(table)).collect()
    assert len(twice) == 2 * len(once) and {r.deviation for r in twice} == {r.deviation for r in once}


def test_whitening_without_spread(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        table = vectors(spark, rows)
        assert whitening.whiten(table, whitening.fit(table)).collect() == []
    with pytest.raises(ValueError, match="entries"):
        whitening.fit(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def test_equal_deviations_and_missing_directions(spark):
    """A start vector meets a space of equal deviations in one direction only; a rank below the number of components."""
    table = vectors(spark, [(i, [float(a == i) * s for a in range(6)] + [0.0, 3.0]) for i in range(6) for s in (1, -1)])
    model = whitening.fit(table, components=6)
    assert len(model.variances) == 6 and model.variances == pytest.approx([model.variances[0]] * 6)
    assert model.components.T @ model.components == pytest.approx(np.eye(6), abs=1e-12)
    line = vectors(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)])
    assert len(whitening.fit(line).variances) == 1


def test_sums_of_many_partitions(spark):
    random.seed(5)
    rows = [(i, [random.gauss(0, 1 + k) for k in range(5)]) for i in range(400)]
    table = vectors(spark, rows)
    before, whitening.SUMS = whitening.SUMS, 2
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = whitening.whiten(table, whitening.fit(table)).collect()
    finally:
        whitening.SUMS = before
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    held_to_a_dense_solver(found, {k: np.floor(np.array(v) * 256).astype(int) for k, v in rows})


# Prefix trie


def grown(conversations):
    """Nodes of a trie by its definition: conversation to its list of (role, text)."""
    members, kids, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path, own in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids.get(path)
            saved[path[:d]] += (len(own) - 1) * len(WORD.findall(path[-1][1])) if path else 0
    out = set()
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(conversations[c]) == len(path))
        out.add((min(own), len(path), min(members[path[:-1]]) if path else None, len(own), kids.get(path, 0), leaves[path], saved[path],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def turns_of(rows):
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    return own


def rebuilt(own):
    head = lambda c: zlib.crc32(str(c).encode()) % 4
    return {c: own.get(c - c % 20, [])[: head(c)] + own[c][head(c) :] for c in list(own)}


def test_trie_of_all_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = [tuple(r) for r in Q.op12_prefix_trie(spark, SMALL).collect()]
    assert len(found) == len(set(found)) and set(found) == grown(rebuilt(turns_of(rows)))


SCHEMA = "conv_id long, turn int, role string, text string, key int, depth string, n_convs array<int>"


def made(spark, rows):
    return materialise(spark.createDataFrame([(*r, 1, "x", [2]) for r in rows], SCHEMA), "turns")


def trie(turns, band=prefix_trie.BAND, hot_rows=1_000_000):
    convs, rows = prefix_trie.plain(prefix_trie.numbered_turns(turns, hot_rows=hot_rows))
    out = prefix_trie.peel(convs, prefix_trie.prefixes(rows, hot_rows, band), band)
    found = [tuple(r) for r in out.collect()]
    assert out.columns == prefix_trie.NODE and len(found) == len(set(found))
    return set(found)


def test_trie_of_odd_rows(spark):
    rows = [(7, 0, "user", "hello there"), (7, 1, None, ""), (3, 0, "user", "hello there"), (3, 1, "", None), (3, 2, "user", "x " * 20_000),
            (5, None, "user", "hello there"), (5, 4, "bot", "b\n\tc"), (-2, 0, None, None), (None, 0, "user", "nobody's"), (9, 0, "us", "erhello there")]
    assert trie(made(spark, rows)) == grown(turns_of(rows))
    assert trie(made(spark, [])) == set()
    same = [(1, 0, "a", "x"), (1, 0, "a", "x"), (2, 0, "a", "x")]  # a repeated row is a turn of its own
    assert {r[:4] for r in trie(made(spark, same))} == {(1, 0, None, 2), (1, 1, 1, 2), (1, 2, 1, 1)}


@pytest.mark.parametrize(("band", "hot_rows", "span", "most"), [(8, 1_000_000, 100_000, 50_000), (2, 5, 3, 2), (3, 40, 7, 1)])
def test_trie_in_small_parts(spark, monkeypatch, band, hot_rows, span, most):
    """Chunked scans, short bands, split joins and lists: copies, prefixes of one another, long tails, a common first turn."""
    random.seed(band)
    rows, number = [], 0
    stem = [("u", f"turn {i} of the stem") for i in range(19)]
    paths = [stem[:k] for k in (3, 8, 8, 9, 16, 16, 17, 19)] + [[("u", "alone")] + stem * 2] + [stem[:1]] * 6
    for _ in range(25):
        paths.append([(random.choice("ub"), random.choice(["x", "y z"])) for _ in range(random.randint(1, 11))])
    random.shuffle(paths)
    for path in paths:
        number += random.randint(1, 4)
        rows += [(number, i, role, text) for i, (role, text) in enumerate(path)]
    monkeypatch.setattr(prefix_trie, "SPAN", span)
    monkeypatch.setattr(prefix_trie, "LIST", most)
    assert trie(made(spark, rows), band, hot_rows) == grown(turns_of(rows))


def test_rebuilt_conversations_without_turns(spark):
    # 21 takes from 20, which is not there; short ones lose all their turns.
    rows = [(c, t, "u", f"{c % 3} {t}") for c in (0, 1, 2, 3, 4, 5, 19, 21, 22, 23, 24, -3) for t in range(1 + c % 3)]
    turns = prefix_trie.numbered_turns(made(spark, rows))
    from pyspark.sql import functions as F

    conv = F.col("conv")
    convs, out = prefix_trie.rebuilt(turns, base=conv - conv % 20, head=F.crc32(conv.cast("string").cast("binary")) % 4)
    own = turns_of(rows)
    head = lambda c: zlib.crc32(str(c).encode()) % 4
    base = lambda c: c - int(np.fmod(c, 20))
    expected = {c: own.get(base(c), [])[: head(c)] + own[c][head(c) :] for c in list(own)}
    assert any(not v for v in expected.values())
    assert {tuple(r) for r in prefix_trie.peel(convs, prefix_trie.prefixes(out)).collect()} == grown(expected)


# Bounded-space best fit


def test_bins_are_the_best_fitting(spark):
    random.seed(3)
    for size, most in ((10, 3), (50, 8), (50, 1), (2048, 40)):
        lengths = [random.randint(1, size) for _ in range(800)]
        bins = open_bins.OpenBins(size, most)
        found, room, order, made = [bins.place(n) for n in lengths], {}, [], 0
        for n, (b, offset) in zip(lengths, found):
            free = size - offset
            fits = [f for f in room.values() if f >= n]
            if fits:
                assert free == min(fits) and room[b] == free
            else:
                assert free == size and b == made
                made += 1
            room.pop(b, None)
            if free > n:
                if len(room) == most:  # the fullest closes
                    closed = next(x for x in reversed(order) if room.get(x) == min(room.values()))
                    room.pop(closed)
                room[b] = free - n
            order = [x for x in order if x != b] + [b]
        assert bins.opened == len(room)


def held_to_the_ids(rows, docs, encode, length):
    """``rows`` of ``pack`` with ids, ``docs`` key to text."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(docs)
    for key, text in docs.items():
        ids, pieces = [*encode(text), 0], sorted(by_doc[key], key=lambda r: r.piece)
        first = (len(ids) - 1) % length + 1
        assert [(p.piece, p.start, p.length) for p in pieces] == [
            (k, 0 if not k else first + (k - 1) * length, length if k else first) for k in range(-(-len(ids) // length))]
        assert [i for p in pieces for i in p.ids] == ids
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= length


def test_packed_documents(spark):
    encode = brute.tokenizer()
    rows = Q.op13_open_bins(spark, SMALL).collect()
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    total, sequences = 0, {r.sequence_id for r in rows}
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for key, text in docs.items():
        ids = np.array([*encode(text), 0], "<u4")
        pieces = sorted(by_doc[key], key=lambda r: r.piece)
        assert [p.ids_crc32 for p in pieces] == [zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for p in pieces]
        assert sum(p.length for p in pieces) == len(ids)
        total += len(ids)
    assert len(sequences) <= 1.05 * -(-total // 2048) + 1


def test_packing_of_odd_rows(spark):
    docs = materialise(brute.odd_docs(spark), "odd-bins").where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in docs.collect()}
    encode = brute.tokenizer()
    for length, most in ((16, 4), (2048, 8_192), (1, 1)):
        held_to_the_ids(open_bins.pack(docs, Q.public_tokenizers.path(Q.BPE_50K), length, most).collect(), texts, encode, length)
    every = brute.odd_docs(spark)
    assert len({(r.sequence_id, r.offset) for r in open_bins.pack(every, Q.public_tokenizers.path(Q.BPE_50K)).collect()}) >= 13
    assert open_bins.pack(docs.limit(0), Q.public_tokenizers.path(Q.BPE_50K)).collect() == []
