"""Words are looked up once: one that is asked for and not known is encoded, and repeats are not encoded again."""

import numpy as np

from ragset.llm import pieces, tokens

TEXTS = ["ab ab, ab. cd,", None, "", "x, x. x  y\n\nz. ,", ".", "a,. b.,", "é. ü, 5. 日本, x."]


def test_each_word_is_looked_up_once(monkeypatch):
    import sentencepiece

    path = tokens.public_path("piece_bpe_32k.model")
    t, sp = pieces.Transducer(path), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = TEXTS + ["a" * 100 + " ab," * 3, "q\x00r 😀😀a"]
    asked = []
    missing = pieces.Known.__missing__
    monkeypatch.setattr(pieces.Known, "__missing__", lambda self, w: (asked.append(w), missing(self, w))[1])
    for _ in range(2):
        assert [np.frombuffer(g[0], "<u4").tolist() for g in t.encode(texts)] == [sp.encode(x or "") for x in texts]
        assert not t.known.new
    short = [w for w in asked if len(w) <= pieces.SHARED]
    assert len(short) == len(set(short)) and max(map(len, t.known)) <= pieces.SHARED
    monkeypatch.setattr(pieces, "MAX_PAIRS", 5)
    fresh = pieces.Transducer(path)
    assert [g[0] for g in fresh.encode(texts)] == [g[0] for g in t.encode(texts)] and sum(map(len, fresh.allowed)) <= 7
