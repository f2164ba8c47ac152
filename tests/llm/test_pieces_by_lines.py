"""Many pieces encoded as the lines of one text have the ids that each has alone."""

import numpy as np
import public_tokenizers

from docfields.llm.arrays import Texts
from docfields.llm.pieces import by_lines, library_encoder
from docfields.llm.queries import BPE_50K
import pyarrow as pa


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(BPE_50K))


def test_lines_have_the_ids_of_pieces():
    calls = []

    def encode(pieces):
        calls.append(len(pieces))
        return [e.ids for e in tokenizer().encode_batch_fast(pieces, add_special_tokens=False)]

    pieces = ["a", " b", "'s", "'", " '", "!'", "\n", "\n\n", " ", "  ", "\t", " ", "\x1c", "　\n", "12", " 34", "<|endoftext|>", " <|",
              "|>", "é", " \U0001f600", "中文", "​", " x" * 1, "\x00", "'ll", "\x85"]
    flat = by_lines(encode, np.uint16, ["<|endoftext|>"])
    calls.clear()
    ids, sizes = flat(pieces)
    assert len(calls) == 2 and calls[0] == 1
    alone = [tokenizer().encode(p, add_special_tokens=False).ids for p in pieces]
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == alone
    assert flat(["\n"])[0].tolist() == tokenizer().encode("\n").ids and flat([])[1].tolist() == []


def test_texts_of_all_kinds_have_the_ids_of_the_library():
    drawn = np.random.default_rng(5)
    signs = list("ab c  \n\t'streé中1٢!<|>\x1c\x85  　") + ["<|endoftext|>", "\r\n", "'ll", "\U0001f600", "́"]
    texts = ["".join(drawn.choice(signs, drawn.integers(0, 40))) for _ in range(3000)]
    ids, counts = library_encoder(public_tokenizers.path(BPE_50K), True).ids(Texts(pa.array(texts)))
    own = tokenizer()
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [own.encode(t, add_special_tokens=False).ids for t in texts]
