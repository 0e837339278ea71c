"""Pieces are looked up once: one that is asked for and not known gets a place, and is encoded once."""

import numpy as np
import pytest

from ragset.llm import tokens

TEXTS = ["ab ab, ab. cd,", None, "", "x, x. x  y\n\nz. ,", ".", "a,. b.,", "<|endoftext|> a b.", "é. ü, 5. 日本, x."]


def test_each_piece_is_looked_up_once(monkeypatch):
    enc = tokens.TextEncoder(tokens.public_path("byte_bpe_50k.json"))
    want = [np.array(enc.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in TEXTS]
    asked = []
    missing = tokens.Known.__missing__
    monkeypatch.setattr(tokens.Known, "__missing__", lambda self, p: (asked.append(p), missing(self, p))[1])
    for most in (400_000, 3):  # with and without dropping what is new
        monkeypatch.setattr(tokens, "MAX_PIECES", most)
        assert enc.encode(TEXTS) == want and enc.encode(TEXTS[::-1]) == want[::-1]
        assert len(asked) == len(set(asked)) and all(type(v) is bytes for v in enc.known.values())


def test_a_failed_batch_leaves_no_empty_places(monkeypatch):
    enc = tokens.TextEncoder(tokens.public_path("byte_bpe_50k.json"))
    want = enc.encode(["one two three"])
    whole = enc._encode_new
    monkeypatch.setattr(enc, "_encode_new", lambda p: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        enc.encode(["four two, five."])
    monkeypatch.setattr(enc, "_encode_new", whole)
    assert enc.encode(["one two three"]) == want
    assert enc.encode(["four two, five."]) == [np.array(enc.tokenizer.encode("four two, five.").ids, "<u4").tobytes()]
