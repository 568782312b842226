"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding by offsets.

Boundaries are found without a regex. Each code point has a class; a seven-symbol automaton tells where a
contraction may begin and where it ends. Every symbol is a transition function on the automaton's states;
composition of such functions is associative, so the states before all characters come from one prefix scan
(over blocks, then over the blocks' totals) of table look-ups. The slices then go through a cache of merges.

Null texts count as empty, with no tokens; an empty table gives an empty one. Repeated rows give repeated
results. Only the id and text columns are read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallywell.llm.common import id_text, ready, rows_to_batch, texts_of

# Classes of code points.
LETTER, NUMBER, OTHER, SPACE, WHITE = range(5)
# Symbols of the automaton: the classes, and an apostrophe that one or two letters of a contraction follow.
SHORT, LONG = 5, 6
# States before a character: an apostrophe may begin a contraction; it may not; one or two letters of a
# contraction are still to come; a contraction has just ended.
OPEN, CLOSED, ONE, TWO, DONE = range(5)

# The pattern's white space and contractions.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SHORT_ENDS = "stmd"
LONG_ENDS = ("re", "ve", "ll")

CACHE = 400_000  # slices that a worker keeps


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point."""
    kind = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kind.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    out[WHITE_SPACE] = WHITE
    out[0x20] = SPACE
    return out


_NEXT = np.array(
    [  # by symbol, then state
        [OPEN, OPEN, DONE, ONE, OPEN],
        [OPEN, OPEN, OPEN, OPEN, OPEN],
        [CLOSED, CLOSED, CLOSED, CLOSED, CLOSED],
        [CLOSED, CLOSED, CLOSED, CLOSED, CLOSED],
        [OPEN, OPEN, OPEN, OPEN, OPEN],
        [ONE, CLOSED, CLOSED, CLOSED, ONE],
        [TWO, CLOSED, CLOSED, CLOSED, TWO],
    ],
    np.uint8,
)


@functools.cache
def monoid() -> tuple[np.ndarray, np.ndarray]:
    """(functions, table): every composition of the symbols' functions, and table[f, g] = first f, then g.

    The first seven functions are the symbols', the last is the identity.
    """
    found = [tuple(r) for r in _NEXT.tolist()]
    index: dict[tuple, int] = {}
    for f in found:
        index.setdefault(f, len(index))
    todo = list(index)
    while todo:
        f = todo.pop()
        for g in list(index):
            for h in (tuple(g[s] for s in f), tuple(f[s] for s in g)):
                if h not in index:
                    index[h] = len(index)
                    todo.append(h)
    index.setdefault(tuple(range(5)), len(index))
    functions = np.array(list(index), np.uint8)
    table = np.array([[index[tuple(g[s] for s in f)] for g in index] for f in index], np.uint8)
    return functions, table


@functools.cache
def _symbol_function() -> np.ndarray:
    functions, _ = monoid()
    rows = [tuple(r) for r in functions.tolist()]
    return np.array([rows.index(tuple(r)) for r in _NEXT.tolist()], np.uint8)


def scan(f: np.ndarray, block: int = 256) -> np.ndarray:
    """Exclusive prefix compositions of the functions f, by look-ups in the composition table."""
    functions, table = monoid()
    unit = np.uint8(len(functions) - 1)
    for k, row in enumerate(functions.tolist()):
        if row == list(range(5)):
            unit = np.uint8(k)
    n = f.size
    if n <= block:
        out, now = np.empty(n, np.uint8), unit
        for i in range(n):
            out[i] = now
            now = table[now, f[i]]
        return out
    rows = -(-n // block)
    grid = np.full(rows * block, unit, np.uint8)
    grid[:n] = f
    grid = np.ascontiguousarray(grid.reshape(rows, block).T)
    flat, width = table.ravel(), len(functions)
    wide = np.empty_like(grid)
    now = np.full(rows, unit, np.uint8)
    for i in range(block):
        wide[i] = now
        now = flat[now.astype(np.int32) * width + grid[i]]
    before = scan(now, block)
    out = flat[before.astype(np.int32)[None, :] * width + wide]
    return np.ascontiguousarray(out.T).reshape(-1)[:n]


def starts(points: np.ndarray, breaks: np.ndarray | None = None) -> np.ndarray:
    """Whether a slice begins at each code point. ``breaks``: places where a text begins (texts are then laid
    end to end with one newline after each, which is no part of them and begins a slice of its own)."""
    n = points.size
    if not n:
        return np.zeros(0, bool)
    kind = classes()[points]
    symbol = kind.copy()
    for i in np.flatnonzero(points == 0x27):
        two = points[i + 1 : i + 3]
        if two.size and two[0] < 128:
            a = chr(two[0])
            if a in SHORT_ENDS:
                symbol[i] = SHORT
            elif two.size > 1 and two[1] < 128 and a + chr(two[1]) in LONG_ENDS:
                symbol[i] = LONG
    state = monoid()[0][scan(_symbol_function()[symbol]), OPEN]
    last = np.empty(n, np.uint8)
    last[0], last[1:] = WHITE, kind[:-1]
    white = kind >= SPACE
    # words, numbers and the rest begin where the class changes, unless a space is in front, and after a contraction
    out = ~white & (kind != last) & (last != SPACE)
    out &= ~((state == ONE) | (state == TWO))
    out |= (state == DONE) & ~white
    # white space begins where it follows something else; its last character begins a slice of its own, or
    # leads what follows, unless the text ends there
    end = np.ones(n, bool)
    end[:-1] = ~white[1:]
    if breaks is None:
        end[-1] = False
    else:
        closing = breaks[1:] - 1  # the newlines between the texts
        end[closing[closing > 0] - 1] = False
        out[closing] = out[breaks[:-1]] = True
    out |= white & (end | (last < SPACE))
    out[0] = True
    return out


class Bpe:
    """The merges of a rank file. ``encode`` gives ids; with offsets, where each token's bytes begin."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        size = max(self.bytes_of) + 1
        self.table = [self.bytes_of.get(i, b"") for i in range(size)]
        self.decimal = [str(i).encode() for i in range(size)]
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """The lowest-ranked pair merges first, the leftmost of equals, until none is in the ranks."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return (whole,)
        if len(piece) > 400:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(piece[i : i + 2], 1 << 30) for i in range(len(piece) - 1)]
        while pairs:
            best = min(pairs)
            if best == 1 << 30:
                break
            i = pairs.index(best)
            parts[i] += parts.pop(i + 1)
            pairs.pop(i)
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 30)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 30)
        return tuple([ranks[p] for p in parts])

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a heap over a linked list, for slices of any length."""
        import heapq

        ranks, n = self.ranks, len(piece)
        end, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i] if alive[i] else n
            if not alive[i] or j >= n or end[j] != stop:
                continue
            alive[j], end[i] = False, stop
            if stop < n:
                prev[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if i and (r := ranks.get(piece[prev[i] : stop])) is not None:
                heapq.heappush(heap, (r, prev[i], stop))
        return tuple(ranks[piece[i : end[i]]] for i in range(n) if alive[i])

    def slices(self, texts: list[str]) -> list[list[bytes]]:
        """The slices of each text, for all texts at once."""
        if not texts:
            return []
        raw = [t.encode() for t in texts]
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        breaks = np.concatenate([[0], np.cumsum(lengths)])
        width = np.ones(points.size, np.int64)
        if sum(map(len, raw)) + len(raw) != points.size:
            width += (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        at = np.concatenate([[0], np.cumsum(width)])
        cuts = np.flatnonzero(starts(points, breaks))
        places = at[cuts]
        data = b"\n".join(raw) + b"\n"
        bounds = places.tolist()
        bounds.append(len(data))
        every = [data[a:b] for a, b in zip(bounds, bounds[1:])]
        ends = np.searchsorted(cuts, breaks[1:] - 1).tolist()  # the newline's own slice
        out, k = [], 0
        for e in ends:
            out.append(every[k:e])
            k = e + 1
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        cache, merge, out = self.cache, self.merge, []
        if len(cache) > CACHE:
            cache.clear()
        for pieces in self.slices(texts):
            ids: list[int] = []
            for p in pieces:
                got = cache.get(p)
                if got is None:
                    got = merge(p)
                    if len(p) <= 64:
                        cache[p] = got
                ids += got
            out.append(ids)
        return out

    def offsets(self, ids: list[int]) -> list[int]:
        """Where each token's bytes begin, and the end of the last."""
        return np.concatenate([[0], np.cumsum([len(self.table[i]) for i in ids], dtype=np.int64)]).tolist()

    def decode(self, ids: list[int]) -> bytes:
        table = self.table
        return b"".join([table[i] for i in ids])


@functools.cache
def loaded(path: str) -> Bpe:
    return Bpe(path)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>, offsets array<long>: the tokens and their places in the text's bytes."""
    ready(df.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("offsets", pa.list_(pa.int64()))])

    def run(batches):
        bpe = loaded(path)
        for ids, texts in texts_of(batches):
            made = bpe.encode(texts)
            yield rows_to_batch(schema, [ids, made, [bpe.offsets(x) for x in made]])

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, offsets array<long>")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by a space), decoded_sha256 (of the decoded bytes)."""
    ready(df.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        bpe = loaded(path)
        decimal, sha = bpe.decimal, hashlib.sha256
        for ids, texts in texts_of(batches):
            made = bpe.encode(texts)
            yield rows_to_batch(schema, [ids, [len(x) for x in made], [sha(b" ".join([decimal[i] for i in x])).hexdigest() for x in made], [sha(bpe.decode(x)).hexdigest() for x in made]])

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
