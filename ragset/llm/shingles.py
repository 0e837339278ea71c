"""Word shingles as 64-bit hashes, the same in every worker, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_C, _P = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: What a byte becomes: A-Z lower, ASCII white space 0, others themselves; as a factor of the word hash.
_LOW = np.arange(256, dtype=np.uint64)
_LOW[65:91] += 32
_LOW[0] = 256
_LOW[[9, 10, 11, 12, 13, 32]] = 0
BYTES = 1 << 17


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(0, n - 1), _P)]), dtype=np.uint64)


def _sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    low = _LOW[np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)]
    inside = low != 0
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)]) + 1  # where each text's bytes begin
    if len(starts):
        at = np.flatnonzero(inside)
        pos = at - np.repeat(starts, ends - starts)
        terms = (low[at] + np.uint64(1)) * _powers(int(pos.max()) + 1)[pos]
        first = np.cumsum(ends - starts) - (ends - starts)
        h = _mix(np.add.reduceat(terms, first) + (ends - starts).astype(np.uint64) * _C)
    else:
        h = np.zeros(0, np.uint64)
    bounds = np.searchsorted(starts, begin).tolist()

    def joined(x: np.ndarray, n: int) -> np.ndarray:
        if len(x) < n:
            return x[:0]
        s = np.full(len(x) - n + 1, n, np.uint64)
        for k in range(n):
            s = _mix(s * _C + x[k : len(x) - n + 1 + k])
        return s

    every = joined(h, words)  # those over two texts are left out below
    out = []
    for a, b in zip(bounds, bounds[1:]):
        x = np.sort(every[a : b - words + 1] if b - a >= words else joined(h[a:b], b - a) if b > a else h[:0])
        out.append(x[np.append(True, x[1:] != x[:-1])] if len(x) else x)
    return out


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """Of each text the distinct shingles of its words (A-Z in lower case), sorted; of fewer words than asked, one of all; of none, none."""
    run: list[bytes] = []
    size = 0
    for text in texts:
        run.append((text or "").encode())
        size += len(run[-1])
        if size >= BYTES:
            yield from _sets(run, words)
            run, size = [], 0
    if run:
        yield from _sets(run, words)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    return _sets([(text or "").encode()], words)[0]
