"""Words by Arrow and symbols counted at once, held against Python's words and a count for each place."""

import numpy as np
import pyarrow as pa

from ragset.llm import mixing

CODE = mixing.Code([b"", b"a", b"bb", b"the"], [9, 7, 5, 3], 4, [1 + i % 3 for i in range(256)], 8)


def test_words_are_those_between_ascii_white_space():
    texts = [None, "", " ", " \t\n", "a", " A  bB\x0b\x0cthe\r\n", "É\u00a0x\x1cY \u2003z", "the\x00 end ", "日本 語"]
    words, counts = mixing.words_of(pa.array(texts, pa.string()).slice(0))
    want = [[*(t or "").encode().lower().split(), b""] for t in texts]
    assert mixing.listed(words) == [w for t in want for w in t] and counts.tolist() == [len(t) for t in want]
    tail, some = mixing.words_of(pa.array(texts, pa.string()).slice(4, 2))
    assert mixing.listed(tail) == want[4] + want[5] and some.tolist() == [2, 4]


def test_bits_of_repeated_words_are_made_once(monkeypatch):
    """A hundred copies of a text: the bits of one are made, and counted a hundred times."""
    made, paths = [], mixing.Code.paths
    monkeypatch.setattr(mixing.Code, "paths", lambda self, sym: made.append(len(sym)) or paths(self, sym))
    text = [b"a", b"bb", b"spelt", b"the", b"bb", b"a"]
    one, many = (np.zeros((mixing.CONTEXTS, 2 << 8), np.int32) for _ in range(2))
    mixing.add_bits(one, mixing.bits_of(CODE, [text]))
    once = sum(made)
    made.clear()
    mixing.add_bits(many, mixing.bits_of(CODE, [text] * 100))
    assert (many == 100 * one).all() and sum(made) <= once


def test_batches_do_not_change_scores():
    rng = np.random.default_rng(3)
    tables = [mixing.quantised(rng.integers(0, 30, 256), rng.integers(0, 30, 256)) for _ in range(4)]
    texts = [" ".join(rng.choice(["the", "a", "bb", "x", "rare", "Ö"], n)) for n in (0, 3, 700, 40, 0, 129, 1)]
    words, counts = mixing.words_of(pa.array(texts))
    got = [mixing.score_bits(b, tables, len(b.sizes)) for b in mixing.batches_of(CODE, words, counts, 50)]
    assert len(got) > 2
    alone = [mixing.score_bits(mixing.bits_of(CODE, [t.encode().lower().split()]), tables, 1)[0] for t in texts]
    assert np.allclose(np.concatenate(got), alone, rtol=1e-5)
