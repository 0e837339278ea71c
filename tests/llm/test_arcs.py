"""Arcs by the characters they end with, held against all pieces."""

import numpy as np

from ragset.llm import pieces, tokens


def test_arcs_are_the_pieces_that_end_there():
    import sentencepiece

    path = tokens.public_path("piece_bpe_32k.model")
    t, sp = pieces.Transducer(path), sentencepiece.SentencePieceProcessor(model_file=path)
    word = "▁international,x日😀ing.."
    for end in range(1, len(word) + 1):
        got = t.arcs(word[max(0, end - pieces.END) : end])
        want = [k for k in range(1, end + 1) if word[end - k : end] in t.id_of]
        found = [k for k, i, _ in got if k <= end and (i is None or i >= 0) and word[end - k : end] in t.id_of]
        assert found == want and [k for k, *_ in got] == sorted(k for k, *_ in got)
        assert all(i is None or i < 0 or (t.pieces[i] == word[end - k : end] and w == t.weight[i]) for k, i, w in got)
        assert (got[0][1] == -1) == (word[end - 1] not in t.id_of)
    texts = ["", "a", "日", " x😀y  zz ", "walkinging,walk.ing", "ab" * 60, "\x00\n,."]
    assert [np.frombuffer(g[0], "<u4").tolist() for g in t.encode(texts)] == [sp.encode(x) for x in texts]
