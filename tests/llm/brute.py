"""Plain versions of the operators, for small tables; and a table with every awkward row."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import public_tokenizers as P

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def odd_docs(spark):
    """Null ids and texts, empty and long texts, equal rows, ties, non-ASCII text, and columns with clashing names."""
    same = "the cat sat on the mat and then it left for good because the dog came in " * 5
    rows = [
        (1, None, "a"), (2, "", "a"), (None, "no id but words " * 20, None), (3, same, "a"), (3, same, "a"), (4, same.upper(), None),
        (5, "word " * 60_000, "b"), (6, "Ünïcödé 日本語 😀\n\nline\nline\r\n" * 9, "b"), (7, "x", "c"), (8, "\n\t \x0b", "c"),
        (None, None, None), (9, same + "more words at the end", "a"), (10, "<|endoftext|> it's 12³ ok", "b")]
    rows = [(*r, i, "k", [i], "s", 1.0, b"x") for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, keep string, ids array<int>, shard string, score double, bytes binary")


def shingles(text, size=5):
    words = WORD.findall(text or "")
    if 0 < len(words) < size:
        return Counter([tuple(words)])
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_classes(docs):
    """Class of each row of ``(id, text)``: rows with equal texts, or shingles that overlap by 0.8, are connected."""
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    bags = [shingles(t) for _, t in docs]
    sizes = [sum(b.values()) for b in bags]
    for i in range(len(docs)):
        for j in range(i):
            equal = (docs[i][1] or "") == (docs[j][1] or "")
            if not equal and (not sizes[i] or not sizes[j] or min(sizes[i], sizes[j]) < 0.8 * max(sizes[i], sizes[j])):
                continue
            common = 0 if equal else sum((bags[i] & bags[j]).values())
            if equal or Fraction(common, sizes[i] + sizes[j] - common) >= Fraction(4, 5):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(docs))]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


class KneserNey:
    """Interpolated modified Kneser-Ney over bigrams, by the formulas."""

    def __init__(self, texts):
        self.words, pairs = Counter(), Counter()
        for t in texts:
            tokens = self.tokens(t)
            self.words.update(tokens)
            pairs.update(zip([("begin",), *tokens[:-1]], tokens))
        self.pairs, self.follows, self.total = pairs, Counter(w for _, w in pairs), Counter()
        self.kinds = defaultdict(lambda: [0, 0, 0])
        for (v, _), c in pairs.items():
            self.total[v] += c
            self.kinds[v][min(c, 3) - 1] += 1
        self.d2, self.d1 = self.discounts(pairs.values()), self.discounts(self.follows.values())
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.spare = sum(self.d1[min(c, 3) - 1] for c in self.follows.values()) / max(1, len(pairs)) if pairs else 1.0

    @staticmethod
    def tokens(text):
        return [*WORD.findall((text or "").translate(LOWER)), ("end",)]

    @staticmethod
    def discounts(counts):
        n = Counter(counts)
        if not (n[1] and n[2] and n[3]):
            return 0.5, 1.0, 1.5
        y = n[1] / (n[1] + 2 * n[2])
        return tuple(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0), k) for k in (1, 2, 3))

    def word(self, w):
        c = self.follows[w]
        return (c - self.d1[min(c, 3) - 1] if c else 0) / max(1, len(self.pairs)) + self.spare / (self.v + 1)

    def after(self, v, w):
        if not self.total[v]:
            return self.word(w)
        c = self.pairs[v, w]
        left = sum(d * k for d, k in zip(self.d2, self.kinds[v]))
        return (c - self.d2[min(c, 3) - 1] if c else 0) / self.total[v] + left / self.total[v] * self.word(w)

    def score(self, text):
        tokens = self.tokens(text)
        base = sum(math.log10((self.words[w] + 1) / (self.n + self.v + 1)) for w in tokens)
        return len(tokens), sum(self.words[w] > 0 for w in tokens), base, sum(
            math.log10(self.after(v, w)) for v, w in zip([("begin",), *tokens[:-1]], tokens))


def tokenizer(name="byte_bpe_50k.json"):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def rejected(text):
    words = WORD.findall(text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    often = {i + d for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for d in range(3)}
    return len(words) < 50 or 100 * len(often) > 50 * len(words)
