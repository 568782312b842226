"""Words of many texts at once: their places and 64-bit hashes, by array operations only."""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np

from tallywell.llm.common import mix

# The bytes between words are the space and those from 9 to 13.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(9, 14)]] = True

#: For terms: every ASCII byte that is neither a letter nor a digit separates.
MARKS = np.zeros(256, bool)
MARKS[:128] = [not chr(i).isalnum() for i in range(128)]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones(n, np.uint64)
    up, down = one.copy(), one.copy()
    up[1:], down[1:] = _BASE, _INVERSE
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Words(NamedTuple):
    data: np.ndarray  # the texts' bytes, a newline after each
    start: np.ndarray  # of each word in data
    end: np.ndarray
    hash: np.ndarray  # equal words, equal hashes, in any process
    first: np.ndarray  # of each text: the index of its first word; one more entry for the end
    offset: np.ndarray  # of each text: where its bytes begin; one more entry for the end


def words(texts: list[str], lower: bool = True, blank: np.ndarray = BLANK) -> Words:
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    offset = np.concatenate([[0], np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)])
    if lower:
        data = _LOWER[data]
    gap = blank[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[::2], edge[1::2]  # the last byte is a newline, so every word ends
    up, down = _powers(1 << max(19, int(data.size - 1).bit_length()))
    total = np.zeros(data.size + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: data.size], out=total[1:])
    code = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    return Words(data, start, end, code, np.searchsorted(start, offset), offset)


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): one hash for each run of ``size`` words within a text, and where each text's begin."""
    n = w.hash.size
    per = np.maximum(np.diff(w.first) - size + 1, 0)
    first = np.concatenate([[0], np.cumsum(per)])
    if not first[-1]:
        return np.zeros(0, np.uint64), first
    code = np.zeros(n - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            code = code * _BASE + w.hash[k : n - size + 1 + k]
    at = np.repeat(w.first[:-1] - first[:-1], per) + np.arange(first[-1])
    return mix(code[at]), first
