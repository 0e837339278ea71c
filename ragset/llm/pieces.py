"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Four transducers are compiled from the model. The normaliser (read from the model: a space in front, spaces written as
U+2581; others are refused). The pieces: an arc a piece, which emits its id and weighs the negated score. The byte
fallback: an arc for each character without a piece, which emits its bytes' ids. The order of merging, for byte-pair
vocabularies: an acceptor of pairs of ids, in which an arc may follow another only if merging their joined text by score
gives those two pieces again. Composed with an input they make a lattice, whose states are a place and the piece before
it; the encoding is the lattice's shortest path, weights added along a path and the least taken at each place.
Spaces begin pieces and never stand inside one, so an input is composed word by word and each word once in a worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragset.llm.tokens import public_path, slices

SPACE, MAX_WORDS, MAX_PATHS, MAX_PAIRS = "▁", 400_000, 150_000, 600_000
#: Words up to this length share the paths of their beginnings and are remembered.
SHARED = 32
#: Characters by which the arcs that end at a place are looked up, and how many such ends are remembered.
END, MAX_ENDS = 4, 100_000
_loaded: dict[str, "Transducer"] = {}


def proto_fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(number, value) of the fields of a message in the protocol-buffer format."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[at]
            value |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def check_normaliser(model: bytes) -> None:
    """Raises unless the model's normaliser (field 3) only puts a space in front and writes spaces as U+2581."""
    spec = dict(proto_fields(next((v for k, v in proto_fields(model) if k == 3), b"")))
    if spec.get(2, b"") or not spec.get(3, 1) or spec.get(4, 1) or not spec.get(5, 1):  # character map, space in front, spaces dropped, spaces written
        raise ValueError("the model's normaliser is not one that this transducer compiles")


class Known(dict):
    """(ids, weight) of words; a word that is asked for and not known is encoded, and stands in new."""

    def __init__(self, owner: "Transducer"):
        super().__init__({"": (b"", 0.0)})
        self.owner, self.new = owner, []

    def __missing__(self, word: str) -> tuple[bytes, float]:
        if word[-1] in self.owner.tails and word[-2:-1].isalpha():
            a, b = self[word[:-1]], self[word[-1]]
            got = (a[0] + b[0], a[1] + b[1])
        else:
            got = self.owner.shortest(word)
        self.new.append(word)
        self[word] = got
        return got


class Transducer:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        check_normaliser(model.serialized_model_proto())
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in range(n) if model.is_byte(i)}
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.id_of = {self.pieces[i]: i for i in plain}
        self.weight = [-model.get_score(i) for i in range(n)]
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of):
            raise ValueError("a piece holds a space inside")
        # a comma or full stop that no piece joins to a letter ends a word's path
        self.tails = {c for c in ",." if not any(c in p and any(x.isalnum() for x in p) for p in self.id_of)}
        self.byte_values = np.full(n, -1)
        for b, i in self.bytes.items():
            self.byte_values[i] = b
        self.coded = [i.to_bytes(4, "little") for i in range(n)]
        longer: dict[str, set[int]] = {}
        for p in self.id_of:
            if len(p) > END:
                longer.setdefault(p[-END:], set()).add(len(p))
        self.longer = {e: tuple((k, None, 0.0) for k in sorted(x)) for e, x in longer.items()}  # of the pieces of more than END characters that end so
        self.ends: dict[str, tuple] = {}
        self.known = Known(self)
        self.paths: dict[str, tuple] = {"": (None, None, 0.0, b"")}  # last id, path before it, weight, what the last arc emits
        self.allowed: list[dict[int, bool]] = [{} for _ in range(n)]  # of a piece, by the id before it
        self.n_pairs = 0
        self.spines: dict[tuple[int, bool], list | None] = {}

    def merged(self, text: str) -> list[tuple[str, str, str]]:
        """The merges (left, right, joined) of a text's characters: again and again where the joined piece weighs least, the first such on ties."""
        parts, out = list(text), []
        while len(parts) > 1:
            best, at = min((self.weight[self.id_of[a + b]] if a + b in self.id_of else np.inf, i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == np.inf:
                break
            out.append((parts[at], parts[at + 1], parts[at] + parts[at + 1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return out

    def spine(self, i: int, right: bool) -> list[tuple[str, float, float]] | None:
        """The parts at a piece's right (or left) end, with the weights at which each is formed and used up; None where merging does not give the piece by growing weights."""
        if (i, right) not in self.spines:
            text = self.pieces[i]
            steps = {s[2]: s for s in self.merged(text)}
            out, own, until = [], text, np.inf
            while True:
                formed = self.weight[self.id_of[own]] if len(own) > 1 else -np.inf
                if (len(own) > 1 and own not in steps) or not formed < until:
                    out = None
                    break
                out.append((own, formed, until))
                if len(own) == 1:
                    break
                own, until = steps[own][1 if right else 0], formed
            self.spines[i, right] = out
        return self.spines[i, right]

    def follows(self, i: int, k: int) -> bool:
        """Whether merging the joined text of pieces i and k gives those two again: nothing merges over their border."""
        left, right = self.spine(i, True), self.spine(k, False)
        if left is None or right is None:
            a, b = self.pieces[i], self.pieces[k]
            parts = list(a + b)
            for x, y, z in self.merged(a + b):
                at = next(p for p in range(len(parts) - 1) if parts[p] == x and parts[p + 1] == y)
                parts[at : at + 2] = [z]
            return parts == [a, b]
        for x, x_formed, x_used in left:
            for y, y_formed, y_used in right:
                # both there at one time, and joined before either is used up; of equal merges the left one goes first
                both = self.id_of.get(x + y)
                if both is not None and x_formed <= y_used and y_formed < x_used and self.weight[both] < x_used and self.weight[both] <= y_used:
                    return False
        return True

    def admitted(self, i: int, k: int) -> bool:
        """follows(), remembered."""
        if self.n_pairs > MAX_PAIRS:
            for own in self.allowed:
                own.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        got = self.allowed[k][i] = self.follows(i, k)
        return got

    def arcs(self, end: str) -> tuple[tuple[int, int | None, float], ...]:
        """(length, id, weight) of the arcs that may end with these END characters (fewer where the word begins), by length; those of more than END characters without id, and id -1 where a character has no piece."""
        out = [(k, i, self.weight[i]) for k in range(1, len(end) + 1) if (i := self.id_of.get(end[-k:])) is not None]
        if end[-1] not in self.id_of:
            out.insert(0, (1, -1, 0.0))
        if len(self.ends) > MAX_ENDS:
            self.ends.clear()
        got = self.ends[end] = (*out, *self.longer.get(end, ()))
        return got

    def shortest(self, word: str) -> tuple[bytes, float]:
        """Ids (little-endian uint32) and weight of the shortest path through the word's lattice, in time and memory linear in its length.

        Of the paths to a place, those that the pair acceptor admits, the lightest stays.
        """
        paths, id_of, ends, allowed, weight, coded, n = self.paths, self.id_of, self.ends, self.allowed, self.weight, self.coded, len(word)
        own, share = [paths[""]], n <= SHARED
        if share:  # the beginnings of a remembered one are remembered
            for k in range(1, n + 1):
                path = paths.get(word[:k])
                if path is None:
                    break
                own.append(path)
        for end in range(len(own), n + 1):
            least, at, arrived = np.inf, None, None
            arc = word[end - END if end > END else 0 : end]
            for size, i, w in ends.get(arc) or self.arcs(arc):
                if i is None:
                    if size > end:
                        break
                    i = id_of.get(word[end - size : end])
                    if i is None:
                        continue
                    w = weight[i]
                before = own[end - size]
                total = before[2] + w
                if total >= least:
                    continue
                last = before[0]
                if last is not None and i >= 0:
                    ok = allowed[i].get(last)
                    if ok is None:
                        ok = self.admitted(last, i)
                    if not ok:
                        continue
                least, at, arrived = total, before, i
            if arrived < 0:
                best = (None, at, least, b"".join([coded[self.bytes[b]] for b in arc[-1].encode()]))
            else:
                best = (arrived, at, least, coded[arrived])
            own.append(best)
            if share and len(paths) < MAX_PATHS:
                paths[word[:end]] = best
        at, ids = own[n], []
        while at[1] is not None:
            ids.append(at[3])
            at = at[1]
        ids.reverse()
        return b"".join(ids), own[n][2]

    def words(self, text: str) -> list[str]:
        """The normalised text, cut before the spaces that follow another character."""
        if not text:
            return []
        full = SPACE + text.replace(" ", SPACE)
        if SPACE * 2 not in full and full[-1] != SPACE:
            return [SPACE + p for p in full[1:].split(SPACE)]
        out, run = [], 0
        for p in full.split(SPACE)[1:]:
            run += 1
            if p:
                out.append(SPACE * run + p)
                run = 0
        return out + [SPACE * run] if run else out

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, float]]:
        known, out = self.known, []
        for t in texts:
            got = list(map(known.__getitem__, self.words(t or "")))
            out.append((b"".join([g[0] for g in got]), float(sum([g[1] for g in got]))))
        full = len(known) > MAX_WORDS
        for w in known.new:
            if full or len(w) > SHARED:  # the early, frequent words stay
                del known[w]
        known.new = []
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The inverse: pieces' text, byte pieces as UTF-8, U+2581 as space, without the space in front."""
        if not len(ids):
            return ""
        values = self.byte_values[ids]
        if (values < 0).all():
            text = "".join(map(self.pieces.__getitem__, ids.tolist()))
        else:
            text = b"".join(bytes([v]) if v >= 0 else self.pieces[i].encode() for i, v in zip(ids.tolist(), values.tolist())).decode("utf-8", "replace")
        text = text.replace(SPACE, " ")
        return text[1:] if text[:1] == " " else text


def transducer(path: str) -> Transducer:
    if path not in _loaded:
        _loaded[path] = Transducer(path)
    return _loaded[path]


def encode_pieces(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, ids (little-endian uint32) and weight of the path, of every row; a null or empty text has no ids.

    Repeated rows and rows without a doc_id stay rows of their own; other columns are ignored.
    """
    path = model or public_path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(path)
        for batch in batches:
            for a, b in slices(batch.num_rows, 256):
                part = batch.slice(a, b - a)
                got = t.encode(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.float64())], ["doc_id", "ids", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary, weight double")


def decode_pieces(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """encoded with the text that its ids stand for."""
    path = model or public_path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(path)
        for batch in batches:
            texts = [t.decode(np.frombuffer(i, "<u4")) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    return encoded.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in encoded.dtypes) + ", text string")


def piece_digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_ids, ids_crc32, weight, decoded_chars, decoded_crc32 of every row: encoded, then decoded again."""
    back = decode_pieces(encode_pieces(docs, model), model)
    return back.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"), F.round("weight", 3).alias("weight"),
        F.length("text").cast("long").alias("decoded_chars"), F.crc32(F.col("text").cast("binary")).alias("decoded_crc32"),
    )
