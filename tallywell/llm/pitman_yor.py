"""LM scoring with a hierarchical Pitman-Yor model.

Each context is a restaurant whose dishes are tokens; its tables send customers to one parent restaurant that all
contexts share, whose own tables draw from a uniform base over the vocabulary and one unknown token. A context is
the token before, whichever it is; before a text's first token stands its predecessor's end. So every context is a
token, and has as many customers as the token has training occurrences.

Seatings follow the Chinese restaurant process and are sampled by Gibbs sweeps. Only the number of tables of each
dish matters for prediction, so a sweep draws it anew for every dish of every restaurant, given the tables of all
others, from its conditional distribution: exactly, by generalised Stirling numbers, for counts up to EXACT, and by
their saddlepoint approximation beyond, at a cost that does not grow with the count. Predictive terms are averaged
over the last sweeps.

One pass over the texts makes blocks: each block's distinct (token, context) pairs with training counts, cut into
hash buckets by token. A piece lists its contexts once, the FREQUENT commonest tokens by number, the others by their
64-bit hash. A bucket holds every restaurant's customers of its tokens, so all of a token's seatings are resampled
in one task; what it needs of the other buckets are totals per context. The first sweeps estimate them from its own
part; then every bucket sends each context's tables to the bucket that owns the context's token, which sends back
exact sums for the last sweeps. The averaged tables go to the owners again, who answer each block in the block's own
order, without the tokens: per token the parent's term, the training count and the tables of the context that it is,
per pair the pair's term. A second pass over the texts meets them there. The number of buckets depends on the bytes
of text only and every order is by value, so scores do not depend on how the rows are laid out.

Null texts have one token, the end. An empty table gives an empty one; without training rows every token is
unknown. Repeated rows get equal scores. Only the id and text columns are read.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import cut, id_crc, id_text, ready, rows_to_batch, signed, texts_of
from tallywell.llm.words import words

FREQUENT = 190  # tokens that stand by number in lists of contexts
SHARE = 2000  # of the training tokens, a part that such a token makes up at least
END = np.uint64(0x6A09E667F3BCC908)
BLOCK = 8 << 20  # bytes of text
BUCKET = 32 << 20  # bytes of text to a bucket
DISCOUNT, STRENGTH = 0.8, 1.0  # of contexts
DISCOUNT_1, STRENGTH_1 = 0.7, 1.0  # of the parent
BURN, SAMPLES = 3, 4  # sweeps
EXACT = 512  # customers up to which the conditional is exact
GRID = 49  # points at which it is taken beyond
STEPS, ZOOMS = 9, 8
FOLDS, HELD_OUT = 7, 2


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed string: lengths, then the bytes of each."""
    head = np.array([a.nbytes for a in arrays], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)]))


def _unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    out, at = [], 8 * len(kinds)
    for n, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(raw, kind, n // np.dtype(kind).itemsize, at))
        at += n
    return out


def _planes(x: np.ndarray) -> np.ndarray:
    """Numbers of 32 bits by byte places, which compress better apart."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).ravel()


def _joined(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(4, -1).T).ravel().view("<u4")


def _ordered(hashes: np.ndarray) -> np.ndarray:
    """Sorted 64-bit hashes by the byte places of their differences."""
    return np.ascontiguousarray(np.diff(hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).ravel()


def _hashes(planes: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).ravel().view(np.uint64), dtype=np.uint64)


# --- contexts


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, number per text): lower-cased words, then one end for each text."""
    w = words(texts)
    return np.insert(w.hash, w.first[1:], END), np.diff(w.first) + 1


def _trains(ids: list) -> np.ndarray:
    return np.array([id_crc(i) % FOLDS != HELD_OUT for i in ids], bool)


def _blocks(batches, block_bytes: int):
    """(ids, token hashes, number per text) of runs of texts of about block_bytes."""
    held, size = [], 0
    for ids, texts in texts_of(batches):
        held.append((ids, *tokens(texts)))
        size += sum(map(len, texts))
        if size >= block_bytes:
            yield [i for h in held for i in h[0]], np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            held, size = [], 0
    if held:
        yield [i for h in held for i in h[0]], np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])


def frequent(rows: DataFrame, block_bytes: int = BLOCK) -> np.ndarray:
    """The sorted hashes of the tokens that lists of contexts hold by number, which changes no score.

    A token with a share of the corpus has that share in some block: each block reports those with half the share,
    and whoever has less than half in reports lacks the share. The at most 2 x SHARE others are counted exactly.
    """
    ready(rows.sparkSession)
    schema = pa.schema([("token", pa.int64()), ("n", pa.int64())])

    def counted(batches, wanted: np.ndarray | None):
        for ids, code, size in _blocks(batches, block_bytes):
            own = code[np.repeat(_trains(ids), size)]
            token, n = np.unique(own[own != END], return_counts=True)
            keep = n * (2 * SHARE) >= own.size if wanted is None else np.isin(token, wanted)
            # the block's tokens in all stand under a hash that no token has
            yield rows_to_batch(schema, [[*signed(token[keep]).tolist(), int(signed(END[None])[0])], [*n[keep].tolist(), int(own.size)]])

    def sums(wanted: np.ndarray | None) -> dict[int, int]:
        found = rows.mapInArrow(lambda batches: counted(batches, wanted), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
        end = int(signed(END[None])[0])
        found = found.persist()
        total = found.agg(F.max(F.when(F.col("token") == end, F.col("n")))).first()[0] or 0
        out = {r["token"]: r["n"] for r in found.filter((F.col("n") * (2 * SHARE) >= total) | (F.col("token") == end)).collect()}
        found.unpersist()
        return out

    end = int(signed(END[None])[0])
    reported = sums(None)
    candidates = np.array([t for t in reported if t != end], np.int64).view(np.uint64)
    if not candidates.size:
        return candidates
    exact = sums(candidates)
    total = exact.pop(end)
    best = sorted((t for t, n in exact.items() if n * SHARE >= total), key=lambda t: (-exact[t], t & (1 << 64) - 1))[:FREQUENT]
    return np.sort(np.array(best, np.int64).view(np.uint64))


class Block(NamedTuple):
    token: np.ndarray  # distinct, in order
    per_token: np.ndarray  # pairs of each token
    context: np.ndarray  # of each pair: the place in token of the one before
    count: np.ndarray  # of each pair, in training texts
    number: np.ndarray  # of each token: its place among the common ones, or how many they are


def before(inverse: np.ndarray, size: np.ndarray, end: int) -> np.ndarray:
    """The token before each token; end before the first of a text."""
    out = np.empty_like(inverse)
    out[1:] = inverse[:-1]
    out[np.cumsum(size) - size] = end
    return out


def block(code: np.ndarray, size: np.ndarray, train: np.ndarray, common: np.ndarray) -> Block:
    token, inverse = np.unique(code, return_inverse=True)
    pairs, pair = np.unique(inverse * token.size + before(inverse, size, int(np.searchsorted(token, END))), return_inverse=True)
    count = np.bincount(pair, weights=np.repeat(train, size), minlength=pairs.size).astype(np.uint32)
    number = np.full(token.size, common.size, np.uint8)
    if common.size:
        at = np.minimum(np.searchsorted(common, token), common.size - 1)
        number = np.where(common[at] == token, at, common.size).astype(np.uint8)
    return Block(token, np.bincount(pairs // token.size, minlength=token.size), pairs % token.size, count, number)


def _bounds(token: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's tokens begin in sorted tokens; one more entry for the end."""
    step = (1 << 64) // buckets
    return np.append(np.searchsorted(token, np.array([k * step for k in range(buckets)], np.uint64)), token.size)


def parts(rows: DataFrame, common: np.ndarray, buckets: int, of_texts: bool, block_bytes: int = BLOCK) -> DataFrame:
    """block, bucket, mark, blob: a row of each block with its texts (bucket -1), or one for each bucket that has
    tokens of it. Both passes cut the same blocks of the same rows; ``mark``, a sum of the block's tokens, tells."""
    ready(rows.sparkSession)
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("mark", pa.int64()), ("blob", pa.binary())])

    def run(batches):
        for n, (ids, code, size) in enumerate(_blocks(batches, block_bytes)):
            train = _trains(ids)
            name = (TaskContext.get().partitionId() << 24) | n
            mark = int(signed((code * np.arange(1, 2 * code.size, 2, dtype=np.uint64)).sum(keepdims=True))[0])
            if of_texts:
                whole = np.array([-1 if i is None else i for i in ids], np.int64)
                null = np.array([i is None for i in ids], bool)
                token, inverse = np.unique(code, return_inverse=True)
                end = np.searchsorted(token, np.array([END]))
                out = [(name, -1, mark, _pack(whole, null, train, size.astype(np.int64), end, _planes(inverse), np.diff(_bounds(token, buckets))))]
            else:
                b = block(code, size, train, common)
                bounds, ends, out = _bounds(b.token, buckets), np.concatenate([[0], np.cumsum(b.per_token)]), []
                for k in np.flatnonzero(np.diff(bounds)).tolist():
                    s, e = int(bounds[k]), int(bounds[k + 1])
                    p, q = int(ends[s]), int(ends[e])
                    own, at = np.unique(b.context[p:q], return_inverse=True)
                    others = b.token[own[b.number[own] == common.size]]
                    out.append((name, k, mark, _pack(_ordered(b.token[s:e]), _planes(b.per_token[s:e]), b.number[own], _ordered(others), _planes(at), _planes(b.count[p:q]))))
            if out:
                yield rows_to_batch(schema, list(zip(*out)))

    return rows.mapInArrow(run, "block long, bucket int, mark long, blob binary")


# --- restaurants


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series, after eight steps of the recurrence."""
    x = np.asarray(x, float)
    up = np.log(x * (x + 1) * (x + 2) * (x + 3)) + np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - up


@functools.cache
def stirling(discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers S(c, t) for c, t <= EXACT: the weight of all seatings of c
    customers at t tables."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[0, 0] = 0
    with np.errstate(divide="ignore"):
        for c in range(1, EXACT + 1):
            t = np.arange(1, c + 1)
            out[c, 1 : c + 1] = np.logaddexp(out[c - 1, :c], np.log(np.maximum(c - 1 - discount * t, 0)) + out[c - 1, 1 : c + 1])
    return out


def _saddle(c: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """The logarithm of S(c, t) / c! by the saddlepoint of its generating function ((1 - (1-x)^d) / d)^t / t!."""

    def slope(v):  # of the logarithm of 1 - (1-x)^d, by that of x = 1 - e^-v; it grows from 1
        return discount * -np.expm1(-v) * np.exp((1 - discount) * v) / -np.expm1(-discount * v)

    # t x slope = c; its logarithm is convex in v, so Newton's steps from the right come down to the root
    v = (np.log(c / t) - np.log(discount)) / (1 - discount)
    for _ in range(STEPS):
        v = np.maximum(v, 1e-9)
        x, q = -np.expm1(-v), slope(v)
        v = v - (np.log(q) - np.log(c / t)) / np.maximum(np.exp(-v) / x * (1 - q) + 1 - discount, 1e-12)
    v = np.maximum(v, 1e-9)
    x, q = -np.expm1(-v), slope(v)
    spread = t * q * (1 + (1 - discount) * x * np.exp(v) - q)
    return t * np.log(-np.expm1(-discount * v) / discount) - c * np.log(x) - 0.5 * np.log(2 * np.pi * np.maximum(spread, 1e-12)) - log_gamma(t + 1)


@functools.cache
def _correction(discount: float) -> tuple[np.ndarray, np.ndarray]:
    """By log t, how far the saddlepoint is off at c = EXACT, where the exact numbers are known."""
    t = np.arange(1.0, EXACT)
    c = np.full(t.size, float(EXACT))
    return np.log(t), stirling(discount)[EXACT, 1:EXACT] - log_gamma(c + 1) - _saddle(c, t, discount)


def log_stirling(c: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """The logarithm of S(c, t) / c! for c >= EXACT. The saddlepoint's error depends on t / c^discount, so it is taken
    from EXACT customers at as many tables as correspond; below one table by its slope."""
    at, off = _correction(discount)
    near = np.log(t) - discount * np.log(c / EXACT)
    slope = (off[3] - off[0]) / (at[3] - at[0])
    return _saddle(c, t, discount) + np.interp(near, at, off) + slope * np.minimum(near, 0)


def _log_weight(t: np.ndarray, alpha: np.ndarray, log_p: np.ndarray, discount: float) -> np.ndarray:
    """Of t new tables with a dish of probability p where others weigh alpha: product of (alpha + discount i) p."""
    return t * (np.log(discount) + log_p) + log_gamma(alpha / discount + t) - log_gamma(alpha / discount)


def drawn(count: np.ndarray, alpha: np.ndarray, p: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """The number of tables of each dish, from its conditional given all other tables. alpha: strength and discounted
    tables of the restaurant's other dishes; p: the dish's probability in the parent."""
    out = np.minimum(count, 1).astype(np.int64)
    log_p, u = np.log(p), rng.random(count.size)
    some = np.flatnonzero((count > 1) & (count <= EXACT))
    order = some[np.argsort(count[some], kind="stable")]
    edges = np.flatnonzero(np.diff(count[order], prepend=-1, append=-1))
    table = stirling(discount)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        c = int(count[order[a]])
        step = max(1, (1 << 18) // c)
        for own in (order[k : min(k + step, b)] for k in range(a, b, step)):
            i = np.arange(c)
            weight = np.cumsum(np.log(alpha[own, None] + discount * i) + log_p[own, None], 1) + table[c, 1 : c + 1]
            total = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), 1)
            out[own] = 1 + (total < u[own, None] * total[:, -1:]).sum(1)
    many = np.flatnonzero(count > EXACT)
    for own in (many[k : k + 4096] for k in range(0, many.size, 4096)):
        c, al, lp = count[own].astype(float)[:, None], alpha[own][:, None], log_p[own][:, None]
        rows, t = np.arange(own.size), np.floor(c ** np.linspace(0, 1, GRID))
        for _ in range(ZOOMS):  # ever finer grids about the best point, up to where the rest has no weight
            weight = log_stirling(np.broadcast_to(c, t.shape), np.minimum(t, c - 0.5), discount) + _log_weight(t, al, lp, discount)
            near = weight >= weight.max(1, keepdims=True) - 30
            first, last = near.argmax(1), GRID - 1 - near[:, ::-1].argmax(1)
            if ((last - first > GRID // 2) | (t[:, -1] - t[:, 0] < GRID)).all():
                break
            low, high = t[rows, np.maximum(first - 1, 0)][:, None], t[rows, np.minimum(last + 1, GRID - 1)][:, None]
            t = np.floor(low + (high - low) * np.linspace(0, 1, GRID))
        weight = log_stirling(np.broadcast_to(c, t.shape), np.minimum(t, c - 0.5), discount) + _log_weight(t, al, lp, discount)
        width = np.diff(t, append=t[:, -1:] + 1)  # 0 for a number that stands twice
        total = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)) * width, 1)
        at = np.minimum((total < u[own, None] * total[:, -1:]).sum(1), GRID - 1)
        got = t[rows, at] + np.floor(rng.random(own.size) * width[rows, at])
        out[own] = np.clip(got, 1, count[own]).astype(np.int64)
    return out


class Sums(NamedTuple):
    """Totals over all buckets, or estimates of them."""

    types: float
    customers: np.ndarray  # by context, of those at hand
    tables: np.ndarray
    parent_customers: float
    parent_tables: float


class Seating:
    """The tables of a bucket's dishes. token: each pair's."""

    def __init__(self, token: np.ndarray, context: np.ndarray, count: np.ndarray, n_tokens: int, rng: np.random.Generator):
        self.n, self.rng, self.contexts = n_tokens, rng, int(context.max(initial=-1)) + 1
        self.own = np.flatnonzero(count > 0)
        self.w, self.u, self.c = token[self.own], context[self.own].astype(np.int64), count[self.own].astype(np.int64)
        self.t = np.ceil(self.c ** (DISCOUNT / 2)).astype(np.int64)
        self.c1 = np.bincount(self.w, weights=self.t, minlength=n_tokens).astype(np.int64)
        self.t1 = np.ceil(self.c1 ** (DISCOUNT_1 / 2)).astype(np.int64)

    def sums(self, share: float = 1.0) -> Sums:
        by = lambda x: np.bincount(self.u, weights=x, minlength=self.contexts)
        t = by(self.t)
        # a context is looked at for a pair that it has here: the other shares have what it has here besides
        return Sums(share * float((self.c1 > 0).sum()), share * by(self.c), share * t - (share - 1) * (t > 0), share * float(self.c1.sum()), share * float(self.t1.sum()))

    def sweep(self, all_: Sums) -> Sums:
        """One Gibbs sweep over the contexts' tables, then over the parent's; the totals with this bucket's changes."""
        base = 1 / (all_.types + 1)
        p1 = (self.c1 - DISCOUNT_1 * self.t1 + (STRENGTH_1 + DISCOUNT_1 * all_.parent_tables) * base) / (STRENGTH_1 + all_.parent_customers)
        before = self.sums()
        alpha = STRENGTH + DISCOUNT * np.maximum(all_.tables[self.u] - self.t, 0)
        self.t = drawn(self.c, alpha, p1[self.w], DISCOUNT, self.rng)
        self.c1 = np.bincount(self.w, weights=self.t, minlength=self.n).astype(np.int64)
        some = np.flatnonzero(self.c1)
        alpha_1 = STRENGTH_1 + DISCOUNT_1 * np.maximum(all_.parent_tables - self.t1[some], 0)
        self.t1 = np.zeros(self.n, np.int64)
        self.t1[some] = drawn(self.c1[some], alpha_1, np.full(some.size, base), DISCOUNT_1, self.rng)
        return Sums(*[a + (n - b) for a, n, b in zip(all_, self.sums(), before)])


# --- buckets

_STATE = "bucket int, blob binary, tokens binary, blocks array<long>, marks array<long>, places array<binary>, sends array<binary>, types double, customers double, parent_customers double, parent_tables double"
_SUMS = ["types", "customers", "parent_customers", "parent_tables"]


def _total(rows: DataFrame) -> dict[str, float]:
    """Sums over all buckets."""
    r = rows.agg(*[F.sum(c).alias(c) for c in _SUMS]).first()
    return {c: r[c] or 0.0 for c in _SUMS}


def _scalars(s: Sums) -> tuple[float, ...]:
    return s.types, float(s.customers.sum()), s.parent_customers, s.parent_tables


def _deltas(x: np.ndarray) -> np.ndarray:
    return _planes(np.diff(x, prepend=0))


def _sends(context: np.ndarray, values: np.ndarray, buckets: int) -> list[bytes | None]:
    """For each bucket, the contexts whose tokens it owns, and their values."""
    at = _bounds(context, buckets).tolist()
    return [_pack(_ordered(context[a:b]), values[a:b].astype(np.float32)) if b > a else None for a, b in zip(at, at[1:])]


def _gathered(pdf: pd.DataFrame, buckets: int, common: np.ndarray) -> pd.DataFrame:
    """One bucket's pairs over all blocks, seated by the first sweeps, where each block's stand among them, and each
    context's tables for the context's owner."""
    pdf = pdf.sort_values("block")
    tokens_, per_token, lists, at, counts = [], [], [], [], []
    for b in pdf["blob"]:
        t, per, number, others, place, n = _unpack(b, *[np.uint8] * 6)
        hashes = np.empty(number.size, np.uint64)
        rare = number == common.size
        hashes[rare], hashes[~rare] = _hashes(others), common[number[~rare]]
        for x, y in ((tokens_, _hashes(t)), (per_token, _joined(per)), (lists, hashes), (at, _joined(place)), (counts, _joined(n))):
            x.append(y)
    token, inverse = np.unique(np.concatenate(tokens_), return_inverse=True)
    context, of_list = np.unique(np.concatenate(lists), return_inverse=True)
    first = np.cumsum([0, *map(len, lists)])
    pairs = np.repeat(inverse, np.concatenate(per_token)) * context.size
    pairs += of_list[np.concatenate([x + k for x, k in zip(at, first.tolist())])]
    pairs, pair = np.unique(pairs, return_inverse=True)
    count = np.bincount(pair, weights=np.concatenate(counts), minlength=pairs.size).astype(np.int64)
    bucket, owner, of = int(pdf["bucket"].iloc[0]), pairs // context.size, pairs % context.size
    s = Seating(owner, of, count, token.size, np.random.default_rng(bucket))
    for _ in range(BURN):
        s.sweep(s.sums(buckets))
    places, a, b = [], 0, 0
    for t, p in zip(tokens_, at):
        places.append(_pack(_deltas(inverse[a : a + t.size]), _deltas(pair[b : b + p.size])))
        a, b = a + t.size, b + p.size
    tables = np.zeros(pairs.size, np.uint32)
    tables[s.own] = s.t
    blob = _pack(_planes(np.bincount(owner, minlength=token.size)), _planes(of), count.astype(np.uint64), _planes(tables), _planes(s.t1))
    sums = s.sums()
    row = (bucket, blob, _pack(_ordered(token)), pdf["block"].tolist(), pdf["mark"].tolist(), places, _sends(context, sums.tables, buckets), *_scalars(sums))
    return pd.DataFrame([row], columns=["bucket", "blob", "tokens", "blocks", "marks", "places", "sends", *_SUMS])


def _read_sends(pdf: pd.DataFrame) -> tuple[list[np.ndarray], list[np.ndarray]]:
    got = [_unpack(b, np.uint8, np.float32) for b in pdf["blob"]]
    return [_hashes(h) for h, _ in got], [v for _, v in got]


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    """The sums of an owner's contexts over all buckets, for each bucket in its own order."""
    pdf = pdf.sort_values("bucket")
    hashes, values = _read_sends(pdf)
    _, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(inverse, weights=np.concatenate(values))
    ends = np.cumsum([0, *map(len, hashes)]).tolist()
    return pd.DataFrame({"bucket": pdf["bucket"], "owner": pdf["owner"], "blob": [_pack(total[inverse[a:b]].astype(np.float32)) for a, b in zip(ends, ends[1:])]})


_SAMPLED = "bucket int, blob binary, sends array<binary>, types double, customers double, parent_customers double, parent_tables double"


def _sampled(state: pd.DataFrame, totals: pd.DataFrame, all_: dict[str, float], buckets: int) -> pd.DataFrame:
    """The last sweeps of a bucket, from the totals of all: per token the parent's term and the training count, per
    pair its term, and each context's averaged tables for the context's owner."""
    r = state.iloc[0]
    context = np.concatenate([_hashes(_unpack(b, np.uint8, np.float32)[0]) for b in r["sends"] if b is not None])
    tables_of = np.concatenate([_unpack(b, np.float32)[0] for b in totals.sort_values("owner")["blob"]]).astype(float)
    per_token, of, count, tables, parent = _unpack(r["blob"], np.uint8, np.uint8, np.uint64, np.uint8, np.uint8)
    per_token = _joined(per_token)
    owner = np.repeat(np.arange(per_token.size), per_token)
    s = Seating(owner, _joined(of).astype(np.int64), count, per_token.size, np.random.default_rng((int(r["bucket"]), 1)))
    s.t, s.t1 = _joined(tables).astype(np.int64)[s.own], _joined(parent).astype(np.int64)
    s.c1 = np.bincount(s.w, weights=s.t, minlength=s.n).astype(np.int64)
    total = Sums(all_["types"], np.zeros(1), tables_of, all_["parent_customers"], all_["parent_tables"])
    left, parent_left, mean = np.zeros(count.size), np.zeros(s.n), None
    for _ in range(SAMPLES):
        total = s.sweep(total)
        left[s.own] += (s.c - DISCOUNT * s.t) / SAMPLES
        parent_left += (s.c1 - DISCOUNT_1 * s.t1) / SAMPLES
        now = [x / SAMPLES for x in s.sums()]
        mean = now if mean is None else [a + b for a, b in zip(mean, now)]
    seen = np.bincount(owner, weights=count, minlength=per_token.size).astype(np.uint64)
    mean = Sums(*mean)
    row = (r["bucket"], _pack(parent_left.astype(np.float32), seen, left.astype(np.float32)), _sends(context, mean.tables, buckets), *_scalars(mean))
    return pd.DataFrame([row], columns=["bucket", "blob", "sends", *_SUMS])


_ANSWERS = "block long, bucket int, mark long, blob binary"
STATE, SAMPLE, SENT = range(3)  # kinds of an owner's rows


def _answered(pdf: pd.DataFrame) -> pd.DataFrame:
    """What each block needs of a bucket: per token the parent's term, the training count and the tables of its
    context, per pair its term."""
    state, sample, sent = (pdf[pdf["kind"] == k] for k in (STATE, SAMPLE, SENT))
    r = state.iloc[0]
    token = _hashes(_unpack(r["blob"], np.uint8)[0])
    parent_left, seen, left = _unpack(sample["blob"].iloc[0], np.float32, np.uint64, np.float32)
    tables = np.zeros(token.size, np.float32)
    if len(sent):
        hashes, values = _read_sends(sent.sort_values("bucket"))
        tables = np.bincount(np.searchsorted(token, np.concatenate(hashes)), weights=np.concatenate(values), minlength=token.size).astype(np.float32)
    rows = []
    for name, mark, place in zip(r["blocks"], r["marks"], r["places"]):
        own, mine = (np.cumsum(_joined(x), dtype=np.int64) for x in _unpack(place, np.uint8, np.uint8))
        rows.append((name, r["bucket"], mark, _pack(parent_left[own], seen[own], tables[own], left[mine])))
    return pd.DataFrame(rows, columns=["block", "bucket", "mark", "blob"])


def _scored(pdf: pd.DataFrame, t: dict[str, float]) -> pd.DataFrame:
    """The scores of one block: its texts' row and its buckets' answers."""
    if pdf["mark"].nunique() != 1 or (pdf["bucket"] < 0).sum() != 1:
        raise RuntimeError("the two passes over the texts saw different rows: give a table whose rows stay in place")
    texts = pdf[pdf["bucket"] < 0]["blob"].iloc[0]
    ids, null, train, size, end, inverse, held = _unpack(texts, np.int64, bool, bool, np.int64, np.int64, np.uint8, np.int64)
    inverse = _joined(inverse).astype(np.int64)
    answers = [_unpack(b, np.float32, np.uint64, np.float32, np.float32) for b in pdf[pdf["bucket"] >= 0].sort_values("bucket")["blob"]]
    parent_left, seen, tables, left = (np.concatenate([a[k] for a in answers]).astype(float) for k in range(4))
    context = before(inverse, size, int(end[0]))
    _, pair = np.unique(inverse * seen.size + context, return_inverse=True)
    spare = (STRENGTH + DISCOUNT * tables) / (STRENGTH + seen)
    spare_1 = (STRENGTH_1 + DISCOUNT_1 * t["parent_tables"]) / (STRENGTH_1 + t["parent_customers"])
    p1 = parent_left / (STRENGTH_1 + t["parent_customers"]) + spare_1 / (t["types"] + 1)
    p = left[pair] / (STRENGTH + seen[context]) + spare[context] * p1[inverse]
    first = np.cumsum(size) - size
    tokens_, types = round(t["customers"]), round(t["types"])
    base = np.log10(seen + 1) - np.log10(tokens_ + types + 1)
    add = lambda x: np.add.reduceat(x, first)
    out = pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "held_out": ~train, "n_tokens": size, "n_known": add((seen > 0)[inverse].astype(np.int64)), "train_tokens": tokens_, "base_score": add(base[inverse]), "score": add(np.log10(p))})
    out.loc[null, "doc_id"] = pd.NA
    return out


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scores(df: DataFrame, buckets: int | None = None, block_bytes: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row. The texts are read four
    times: by default one more pass over their lengths sets the number of buckets."""
    rows = id_text(df, id_col, text_col)
    buckets = buckets or max(16, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET))
    common = frequent(rows, block_bytes)
    state = cut(parts(rows, common, buckets, False, block_bytes).groupBy("bucket").applyInPandas(lambda pdf: _gathered(pdf, buckets, common), _STATE))
    start = _total(state)
    sent = lambda x: x.select("bucket", F.posexplode("sends").alias("owner", "blob")).filter("blob is not null")
    totals = sent(state).groupBy("owner").applyInPandas(_added, "bucket int, owner int, blob binary").groupBy("bucket")
    seated = state.select("bucket", "blob", "sends").groupBy("bucket").cogroup(totals)
    sampled = cut(seated.applyInPandas(lambda a, b: _sampled(a, b, start, buckets), _SAMPLED))
    final = _total(sampled)
    none = [F.lit(None).cast(t).alias(c) for c, t in (("blocks", "array<long>"), ("marks", "array<long>"), ("places", "array<binary>"))]
    own = state.select("bucket", F.lit(STATE).alias("kind"), F.col("bucket").alias("owner"), F.col("tokens").alias("blob"), "blocks", "marks", "places")
    own = own.unionByName(sampled.select("bucket", F.lit(SAMPLE).alias("kind"), F.col("bucket").alias("owner"), "blob", *none))
    own = own.unionByName(sent(sampled).select("bucket", F.lit(SENT).alias("kind"), "owner", "blob", *none))
    both = parts(rows, common, buckets, True, block_bytes).unionByName(own.groupBy("owner").applyInPandas(_answered, _ANSWERS))
    return both.groupBy("block").applyInPandas(lambda pdf: _scored(pdf, final), _SCORES)
