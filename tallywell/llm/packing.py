"""Packing by cutting-stock column generation.

Documents become token ids with an end id each. Pieces of a whole sequence stand alone; what remains of a
document is cut once more at half a sequence, since halves leave far less room unused. Each such piece has a
length class (its length rounded up to ``grain``), so the histogram of classes has a fixed number of
entries however many documents there are. A linear program over patterns (how many pieces of each class fill
one sequence) is solved by column generation: knapsack dynamic programming prices new patterns with the dual
values. The rounded-down solution and best-fit patterns for what is left cover the histogram; pieces are
ranked within their class and the rank decides pattern, sequence and place.

Null texts are empty: one piece with the end id. Repeated rows are packed each on their own; an empty table
gives an empty one. Only the id and text columns are read.
"""

from __future__ import annotations

import functools
import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywell.llm.common import cut, id_text, ready, rows_to_batch, texts_of

LENGTH = 2048
GRAIN = 8
END = 1
RANKED = 500_000  # pieces of a class that one task ranks, about
LONG = 1000


@functools.cache
def encoder(path: str):
    """text -> ids by a tokenizer file of byte-level BPE, as its own library gives them.

    The vocabulary and merges run in the faster of two libraries. Added tokens (special strings) are cut out
    first, as the file's library does. That one encodes by itself what the faster cannot: files with a normaliser
    or added tokens that take in blanks, and texts with LONG blanks in a row.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    @functools.cache
    def whole() -> Tokenizer:  # tens of megabytes that few workers need
        return Tokenizer.from_file(path)

    def by_library(text: str) -> list[int]:
        return whole().encode(text, add_special_tokens=False).ids

    with open(path) as f:
        file = json.load(f)
    added = {t["content"]: t for t in file["added_tokens"]}
    if file.get("normalizer") or any(t[k] for t in added.values() for k in ("single_word", "lstrip", "rstrip", "normalized")):
        return by_library
    # Fixed rule of byte-level BPE: printable bytes stand for themselves, the others for 256 and up.
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stands = {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in keep)}
    ranks = {bytes(stands[c] for c in word): i for word, i in file["model"]["vocab"].items() if all(c in stands for c in word) and word not in added}
    plain = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    marks = re.compile("|".join(f"({re.escape(c)})" for c in sorted(added, key=len, reverse=True)) or "(?!)")
    blanks = re.compile(rf"\s{{{LONG}}}")

    def encode(text: str) -> list[int]:
        if blanks.search(text):
            return by_library(text)
        out, at = [], 0
        for m in marks.finditer(text):
            out += [*plain(text[at : m.start()]), added[m[0]]["id"]]
            at = m.end()
        return out + plain(text[at:]) if at else plain(text)

    return encode


def pieces(df: DataFrame, path: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: each document's ids and end id, in pieces of length, then of
    half of it, then the rest."""
    ready(df.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])

    def run(batches):
        encode = encoder(path)
        for ids, texts in texts_of(batches):
            out = []
            for i, text in zip(ids, texts):
                tokens = np.array([*encode(text), END], "<u4")
                cuts = [*range(0, tokens.size - length + 1, length)]
                s = tokens.size // length * length
                cuts += range(s, tokens.size, length // 2)
                cuts.append(tokens.size)
                out += [(i, a, b - a, zlib.crc32(tokens[a:b].tobytes()), tokens.size) for a, b in zip(cuts, cuts[1:])]
            yield rows_to_batch(schema, list(zip(*out)))

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


# --- the plan: patterns for a histogram of fixed size, on the driver


def knapsack(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: values[k] is class k+1's, of size k+1, each usable any number of times."""
    best, pick = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        gains = values[:c] + best[c - 1 :: -1][: min(c, values.size)] if c <= values.size else values + best[c - 1 : c - 1 - values.size : -1]
        k = int(np.argmax(gains))
        best[c], pick[c] = (gains[k], k + 1) if gains[k] > best[c - 1] + 1e-12 else (best[c - 1], 0)
    pattern, c = np.zeros(values.size, np.int64), capacity
    while c > 0:
        if pick[c]:
            pattern[pick[c] - 1] += 1
            c -= pick[c]
        else:
            c -= 1
    return float(best[capacity]), pattern


def fractional(demand: np.ndarray, rounds: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns and their numbers that cover demand (demand[k] pieces of size k+1, sequences of size
    demand.size), by the revised simplex method with priced columns. Every round is a feasible solution, so
    the limit on rounds bounds time, not correctness."""
    n, kinds = demand.size, np.flatnonzero(demand > 0)
    m = kinds.size
    if not m:
        return np.zeros((0, n), np.int64), np.zeros(0)
    columns = np.zeros((m, m))
    columns[np.arange(m), np.arange(m)] = n // (kinds + 1)
    inverse, x = np.diag(1.0 / np.diag(columns)), demand[kinds] / np.diag(columns)
    for _ in range(rounds):
        dual = np.ones(m) @ inverse
        values = np.full(n, -1.0)
        values[kinds] = dual
        worth, pattern = knapsack(values, n)
        if worth <= 1 + 1e-7:
            break
        column = pattern[kinds].astype(float)
        d = inverse @ column
        ok = d > 1e-9
        if not ok.any():
            break
        ratio = np.where(ok, x / np.where(ok, d, 1), np.inf)
        r = int(np.argmin(ratio))
        step = ratio[r]
        x = np.maximum(x - step * d, 0)
        x[r] = step
        columns[:, r] = column
        row = inverse[r] / d[r]
        inverse -= np.outer(d, row)
        inverse[r] = row
    patterns = np.zeros((m, n), np.int64)
    patterns[:, kinds] = np.rint(columns.T).astype(np.int64)
    return patterns, x


def plan(demand: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(pattern, number of sequences): together exactly demand."""
    patterns, x = fractional(demand)
    left, out = demand.copy(), []
    for p, k in sorted(zip(patterns, np.floor(x + 1e-9).astype(np.int64)), key=lambda t: -t[1]):
        used = p > 0
        k = int(min(k, (left[used] // p[used]).min())) if used.any() else 0
        if k > 0:
            left -= k * p
            out.append((p, k))
    # what rounding leaves: the largest piece first, each into the fullest sequence that still holds it
    open_at: dict[int, list[np.ndarray]] = {}
    n = demand.size
    done: list[np.ndarray] = []
    for kind in np.flatnonzero(left)[::-1]:
        for _ in range(int(left[kind])):
            size = int(kind) + 1
            room = next((r for r in range(size, n) if open_at.get(r)), 0)
            pattern = open_at[room].pop() if room else np.zeros(n, np.int64)
            pattern[kind] += 1
            rest = (room or n) - size
            if rest:
                open_at.setdefault(rest, []).append(pattern)
            else:
                done.append(pattern)
    merged: dict[bytes, list] = {}
    for p in [*done, *(p for ps in open_at.values() for p in ps)]:
        merged.setdefault(p.tobytes(), [p, 0])[1] += 1
    return out + [(p, k) for p, k in merged.values()]


def schedule(planned: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows kind, first_rank, ranks, per_sequence, first_sequence, order: where each class's ranks go."""
    seen: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, k in planned:
        for order, kind in enumerate(np.flatnonzero(pattern)[::-1].tolist()):
            each = int(pattern[kind])
            rows.append((kind + 1, seen.get(kind, 0), each * k, each, sequence, order))
            seen[kind] = seen.get(kind, 0) + each * k
        sequence += k
    return rows


def pack(cut_pieces: DataFrame, length: int = LENGTH, grain: int = GRAIN, ranked: int = RANKED) -> DataFrame:
    """cut_pieces with sequence_id and offset. A class's pieces are ranked in parts of about ``ranked``, whose sizes
    give each part's first rank, so no task ranks a whole class, however common a length is."""
    spark = cut_pieces.sparkSession
    kept = cut(cut_pieces.withColumn("kind", F.ceil(F.col("length") / grain).cast("int")))
    parts = np.ones(length // grain + 1, np.int64)
    for kind, n in kept.groupBy("kind").agg(F.count(F.lit(1))).collect():
        parts[kind] = -(-n // ranked)
    salt = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.get(F.array(*[F.lit(int(n)) for n in parts]), F.col("kind")))
    kept = kept.withColumn("salt", salt.cast("int"))
    demand = np.zeros(length // grain, np.int64)
    first = []
    for kind, part, n in sorted(map(tuple, kept.groupBy("kind", "salt").agg(F.count(F.lit(1))).collect())):
        first.append((kind, part, int(demand[kind - 1])))
        demand[kind - 1] += n
    rows = schedule(plan(demand))
    # the first table has a row for each ``ranked`` pieces and class, the other one for each class of a pattern
    starts = spark.createDataFrame(first, "kind int, salt int, before long")
    where = spark.createDataFrame(rows, "kind int, first_rank long, ranks long, per_sequence long, first_sequence long, order int")
    where = where.groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("first_rank", "ranks", "per_sequence", "first_sequence", "order"))).alias("spans"))
    rank = F.row_number().over(Window.partitionBy("kind", "salt").orderBy("doc_id", "start", "ids_crc32"))
    placed = kept.withColumn("rank", rank).join(F.broadcast(starts), ["kind", "salt"]).withColumn("rank", F.col("rank") - 1 + F.col("before")).join(F.broadcast(where), "kind")
    span = F.get(F.filter("spans", lambda s: (F.col("rank") >= s["first_rank"]) & (F.col("rank") < s["first_rank"] + s["ranks"])), F.lit(0))
    sequence = F.col("span.first_sequence") + F.floor((F.col("rank") - F.col("span.first_rank")) / F.col("span.per_sequence"))
    placed = placed.withColumn("span", span).withColumn("sequence_id", sequence.cast("long"))
    inside = Window.partitionBy("sequence_id").orderBy("span.order", "rank").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long")
    return placed.withColumn("offset", offset).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def packed(df: DataFrame, path: str, length: int = LENGTH, grain: int = GRAIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return pack(pieces(df, path, length, id_col, text_col), length, grain)
