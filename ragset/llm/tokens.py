"""Token ids by the tokenizers library, with each distinct piece of text encoded once in a worker.

A byte-level vocabulary without normaliser cuts a text where a single space stands between other characters, and one
that drops white space cuts it at every space, whatever stands around. So a text's ids are the ids of the pieces
between, one after another; a comma or full stop after a letter or digit is a piece of its own as well. Other
vocabularies, and texts with the marks of added tokens, are encoded whole.
"""

from __future__ import annotations

import re

import numpy as np

#: Between two characters that are not white space (to Python, which counts more as such): the start of a byte-level piece.
_START = re.compile(r"(?<=\S)(?= \S)")
#: White space besides space and line feed.
_WHITE = "\t\r\x0b\x0c\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_PLAIN = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ")
MAX_PIECES, JOINED = 400_000, 200
_loaded: dict[str, "TextEncoder"] = {}


class Known(dict):
    """Ids of pieces. A piece that is asked for and not known gets an empty place, to be filled in, and stands in new."""

    def __init__(self):
        super().__init__({"": b""})
        self.new: list[str] = []

    def __missing__(self, piece: str) -> bytearray:
        self.new.append(piece)
        place = self[piece] = bytearray()
        return place

    def take_new(self) -> list[str]:
        new, self.new = self.new, []
        return new


class TextEncoder:
    """encode(texts): for each text its ids as little-endian uint32 bytes, as the library gives them without special tokens added.

    A null text is an empty one and has no ids. An added token's string in a text becomes that token, as in the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        kind = str(self.tokenizer.pre_tokenizer)
        white_dropped = 'Replace(pattern=Regex("\\s+"), content=" "), Lowercase()' in str(self.tokenizer.normalizer) and "invert=True" in kind
        plain_bytes = self.tokenizer.normalizer is None and kind.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in kind
        self.split = self._words if white_dropped else self._spaced if plain_bytes else None
        self.bytewise = plain_bytes
        self.marks = sorted({t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()})
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a word
        self.width = np.zeros(len(self.last), np.int64)  # bytes of an id
        for token, i in vocab.items():
            self.last[i], self.width[i] = token.endswith("</w>"), len(token)
        self.known = Known()

    @staticmethod
    def _words(text: str) -> list[str]:
        """Pieces where white space is dropped. Latin-1 letters are put in lower case here, others by the library."""
        try:
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            pass
        return text.replace("\n", " ").split(" ")

    @staticmethod
    def _spaced(text: str) -> list[str]:
        """Pieces where a space belongs to the word after it; a line feed between others is a piece."""
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or "\x00" in text or any(map(text.__contains__, _WHITE)):
            return _START.split(text)
        return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")

    def _encode(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _encode_new(self, pieces: list[str]) -> dict[str, bytes]:
        """Pieces go to the tokenizer many at a time where their ids can be told apart: by their bytes, or by the ends of plain words."""
        if self.bytewise:
            joined = [p for p in pieces if p[:1] == " " and not (p[1:2] or " ").isspace() and not p[-1].isspace()]
        else:
            joined = [p for p in pieces if p.isalpha()]
        out: dict[str, bytes] = {}
        groups = [joined[a:b] for a, b in slices(len(joined), JOINED)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([("" if self.bytewise else " ").join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            if self.bytewise:
                ends = np.cumsum([len(p.encode()) for p in group])
                at = np.searchsorted(np.cumsum(self.width[ids]), ends) + 1
                told = np.array_equal(np.cumsum(self.width[ids])[at - 1], ends)
            else:
                at = np.flatnonzero(self.last[ids]) + 1
                told = len(at) == len(group) and len(ids) == at[-1]
            if told:
                raw, at = ids.tobytes(), (4 * at).tolist()
                out.update(zip(group, map(raw.__getitem__, map(slice, [0, *at], at))))
        rest = [p for p in pieces if p not in out]
        out.update(zip(rest, self._encode(rest)))
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        whole = [t or "" for t in texts]
        if self.split is None:
            return self._encode(whole)
        marked = [i for i, t in enumerate(whole) if any(m in t for m in self.marks)]
        apart = dict(zip(marked, self._encode([whole[i] for i in marked])))
        known = self.known
        try:
            # one look for each piece: rows hold the places, those of new pieces are filled below
            rows = [[] if i in apart else list(map(known.__getitem__, self.split(t))) for i, t in enumerate(whole)]
            new = known.take_new()
            signed = [p for p in new if p[-1] in ",." and len(p) > 1 and p[-2] in _PLAIN]
            stems = [(known[p[:-1]], known[p[-1]]) for p in signed]
            apart_signs = set(signed)
            plain = [p for p in new if p not in apart_signs] + known.take_new()
            fresh = self._encode_new(plain)
            for p, ids in fresh.items():
                known[p] += ids
            for p, (stem, sign) in zip(signed, stems):
                known[p] += stem + sign
                fresh[p] = bytes(known[p])
            out = [apart[i] if i in apart else b"".join(row) for i, row in enumerate(rows)]
        except BaseException:
            self.known = Known()  # places may be empty
            raise
        if len(known) > MAX_PIECES:  # the early, frequent pieces stay
            for piece in fresh:
                del known[piece]
        else:
            known.update(fresh)
        return out


def encoder(path: str) -> TextEncoder:
    """One encoder a worker and file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _loaded:
        _loaded[path] = TextEncoder(path)
    return _loaded[path]


def public_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def slices(n: int, step: int):
    return ((i, min(n, i + step)) for i in range(0, n, step))
