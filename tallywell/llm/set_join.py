"""N-gram Jaccard join by universe partition and the pigeonhole principle, verified exactly.

A document's set holds the hashes of its distinct word shingles. Two sets of s <= l shingles with a Jaccard
similarity of 0.8 differ in at most (s + l) / 9 <= s / 4 of them. Sizes fall into bands of powers of two; each
band cuts the universe of shingles into its own number of segments by a hash. As each differing shingle lies
in one segment only, of any floor(s / 4) + 1 segments that are not empty one must be equal in both sets. A
document therefore indexes only a subset of its segments, the first so many that are not empty, in an order
that both sides share (with T the shorter of the two prefixes of that order, the pigeonhole argument holds
inside T). Cost decides the order and the kind of index:

* shingles that a corpus-wide counting sketch shows to be common go to segments of their own, which come last,
  so that passages shared by many documents are not indexed while rarer shingles suffice;
* in small bands two segments cost less if each also indexes its one-deletion neighbourhood, which lets it
  absorb a difference and halves the number of segments needed.

A document near the upper end of its band also indexes the next band's segments. Equal sets are one class from
the start. Documents that share an index entry meet at the entry's least class, the leader; all documents that
met at a leader are verified exactly against each other, leader first, skipping pairs that are known to be
connected or that the triangle inequality of the Jaccard distance rules out. Meetings of many members or of
long ones are split in blocks, so that a task's memory does not grow with either, and only members that the
leader's component lacks are compared across blocks. No pair is dropped or capped. A set that fills fewer segments
than it must index is thin: it indexes all it has, so the argument holds for it and any set that is not, and the thin
sets of a band share one more entry, by which they are verified against each other. By chance n shingles in m
segments are thin with at most C(m, n // 4) (n // 4 / m)^n (``thin``), so that few meet unless texts are made to.
Shingles have 64 bits in the index and 56 in the verification: two sets of 20,000 shingles hold a pair that falls
together by chance once in 2e8 pairs of sets.

Null and empty texts and texts without words have an empty set and link with nothing; repeated rows and copies
share a class; an empty table gives an empty one. Only the id and text columns are read (``first_of_groups``
keeps the others as they are).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywell.llm.common import cut, fresh, id_text, mix, ready, rows_to_batch, signed, texts_of
from tallywell.llm.words import windows, words

WORDS = 5
NUMERATOR, DENOMINATOR = 4, 5  # the similarity, 0.8
SLOTS = 1 << 22  # of the counting sketch
SLICES = 64
BLOCK = 2000  # members of a meeting that one task verifies
SHINGLES = 4 << 20  # that a block's members hold, about
SMALL = 3  # the last band with one-deletion neighbourhoods
BITS = 1 << 24  # of the bitmap of classes that met another
THIN = np.uint64(0x27D4EB2F165667C5)  # makes a band's entry of its own

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def sets(texts: list[str], size: int = WORDS) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes: with fewer words than size, one of the whole sequence."""
    w = words(texts)
    code, first = windows(w, size)
    out = []
    for k in range(len(texts)):
        own = np.sort(code[first[k] : first[k + 1]])
        if own.size:
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
            continue
        h = w.hash[w.first[k] : w.first[k + 1]]
        out.append(mix(np.array([sum((j + 2) * int(x) for j, x in enumerate(h.tolist())) + 977 * h.size & (1 << 64) - 1], np.uint64)) if h.size else h)
    return out


def class_of(s: np.ndarray) -> int:
    """A signed hash of the set; equal sets, equal classes."""
    return int(signed(mix(np.array([(int(mix(s * _A).sum()) + s.size) & (1 << 64) - 1], np.uint64)))[0])


def band(n: int) -> int:
    return n.bit_length() - 1


def segments(k: int) -> int:
    """The number of segments of a band (and of as many more for common shingles)."""
    top = 2 << k
    if k <= SMALL + 1:
        return 1 if k < SMALL else 2 if k == SMALL else 128
    return top if top <= 64 else 2 * top // 5 + 13 if top <= 256 else math.ceil(1.25 * (top // 4 + 1))


def thin(n: int, m: int) -> float:
    """A bound on the chance, as a decimal logarithm, that n shingles fill at most n // 4 of m segments."""
    few = n // 4
    return (math.lgamma(m + 1) - math.lgamma(few + 1) - math.lgamma(m - few + 1) + n * math.log(few / m)) / math.log(10)


def entries(s: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The index entries of a set. common: by sketch slot."""
    n = s.size
    if not n:
        return s
    out = []
    k = band(n)
    for b in [k, k + 1] if 5 * n >= 4 * (2 << k) else [k]:
        m = np.uint64(segments(b))
        salt = np.uint64((b + 1) * int(_B) & (1 << 64) - 1)
        value = mix(s + salt)
        seg = (mix(s ^ salt) >> np.uint64(11)) % m
        if b <= SMALL:
            for j in range(int(m)):
                own = value[seg == j]
                whole = own.sum(dtype=np.uint64)
                out.append(mix(np.concatenate([[whole], whole - own] if n >= 5 else [[whole]]).astype(np.uint64) + salt + np.uint64(j * int(_C) & (1 << 64) - 1)))
            continue
        seg = seg + np.where(common[(s >> np.uint64(42)).astype(np.int64)], m, np.uint64(0))
        order = np.argsort(seg, kind="stable")
        seg, value = seg[order], value[order]
        head = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
        sums = np.add.reduceat(value, head)[: n // 4 + 1]
        out.append(mix(sums + salt + seg[head[: n // 4 + 1]] * _C))
        if head.size <= n // 4:
            out.append(mix(salt[None] ^ THIN))  # where the band's thin sets meet
    return np.unique(np.concatenate(out))


# --- passes over the texts

_SEEN = "doc_id long, n long, class long, slice int, blob binary"


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document (doc_id, n, class), and the counting sketch in slices: each task's counters, once
    a class and task."""
    ready(df.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("class", pa.int64()), ("slice", pa.int32()), ("blob", pa.binary())])

    def run(batches):
        seen: set[int] = set()
        slots = np.zeros(SLOTS, np.uint32)
        for ids, texts in texts_of(batches):
            own = sets(texts)
            names = [class_of(s) for s in own]
            new = [s for s, c in zip(own, names) if c not in seen and not seen.add(c)]
            if new:
                at, n = np.unique(np.concatenate(new) >> np.uint64(42), return_counts=True)
                slots[at.astype(np.int64)] += n.astype(np.uint32)
            yield rows_to_batch(schema, [ids, [s.size for s in own], names, [None] * len(ids), [None] * len(ids)])
        if seen:
            pack = zstandard.ZstdCompressor(level=1).compress
            parts = slots.reshape(SLICES, -1)
            yield rows_to_batch(schema, [[None] * SLICES] * 3 + [list(range(SLICES)), [pack(p.tobytes()) for p in parts]])

    return id_text(df, id_col, text_col).mapInArrow(run, _SEEN)


def common_slots(seen: DataFrame) -> np.ndarray:
    """Which slots of the sketch hold far more than their share: a bitmap of fixed size."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor().decompress
        total = np.zeros(SLOTS // SLICES, np.int64)
        for b in pdf["blob"]:
            total += np.frombuffer(unpack(b), np.uint32)
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "bits": [total.astype(np.uint64).tobytes()]})

    def flag(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(pdf["bits"].iloc[0], np.uint64)
        mean = total.mean()
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "bits": [np.packbits(total > mean + 6 * math.sqrt(mean) + 24).tobytes()]})

    rows = seen.filter("slice is not null").select("slice", "blob").groupBy("slice").applyInPandas(lambda pdf: flag(add(pdf)), "slice int, bits binary").collect()
    out = np.zeros((SLICES, SLOTS // SLICES), bool)
    for k, bits in rows:
        out[k] = np.unpackbits(np.frombuffer(bits, np.uint8))
    return out.ravel()


def index(df: DataFrame, common: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """entry, class: the index entries of every set, once a class and task."""
    ready(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(np.packbits(common))
    schema = pa.schema([("entry", pa.int64()), ("class", pa.int64())])

    def run(batches):
        marked = np.unpackbits(shared.value).view(bool)
        seen: set[int] = set()
        for _, texts in texts_of(batches):
            made, names = [], []
            for s in sets(texts):
                c = class_of(s)
                if s.size and c not in seen:
                    seen.add(c)
                    made.append(entries(s, marked))
                    names.append(c)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(made))), pa.array(np.repeat(np.array(names, np.int64), [x.size for x in made]))], schema=schema)

    return id_text(df, id_col, text_col).mapInArrow(run, "entry long, class long")


def meetings(entries_: DataFrame) -> DataFrame:
    """leader, member: distinct classes that share an entry, with the entry's least class."""
    w = Window.partitionBy("entry").orderBy("class")
    rows = entries_.select(F.first("class").over(w).alias("leader"), F.col("class").alias("member")).filter("leader <> member")
    return rows.groupBy("leader", "member").agg(F.lit(1).alias("x")).select("leader", "member")


def heads(seen: DataFrame) -> DataFrame:
    """class, least, n: the smallest doc_id of every class with words, and its number of shingles."""
    return seen.filter("slice is null and n > 0").groupBy("class").agg(F.min("doc_id").alias("least"), F.max("n").alias("n"))


def _marked(met: DataFrame, first: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the first documents of the classes that met: class and doc_id share a bit."""
    keys = met.select(F.explode(F.array("leader", "member")).alias("class")).distinct().join(first, "class")
    place = F.pmod(F.col("class").bitwiseXOR(F.coalesce("least", F.lit(0).cast("long"))), F.lit(bits)) + 1  # buckets of this function begin at 1
    rows = keys.select(F.bitmap_bucket_number(place).alias("b"), F.bitmap_bit_position(place).alias("p")).groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for b, m in rows:
        out[4096 * (b - 1) : 4096 * b] = np.frombuffer(m, np.uint8)
    return out


KEPT = 7  # bytes of a shingle's hash


def packed(s: np.ndarray) -> bytes:
    """The upper KEPT bytes of the hashes."""
    return np.ascontiguousarray((s >> np.uint64(64 - 8 * KEPT)).view(np.uint8).reshape(-1, 8)[:, :KEPT]).tobytes()


def unpacked(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // KEPT, 8), np.uint8)
    out[:, :KEPT] = np.frombuffer(b, np.uint8).reshape(-1, KEPT)
    return out.reshape(-1).view(np.uint64)


def members(df: DataFrame, met: DataFrame, first: DataFrame, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """member, blob: the sets of all classes in met, from each class's first document (and of the few others that
    share a bit with one)."""
    ready(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(_marked(met, first, bits))
    schema = pa.schema([("member", pa.int64()), ("blob", pa.binary())])

    def run(batches):
        wanted, seen = shared.value, set()
        for ids, texts in texts_of(batches):
            out = []
            for i, s in zip(ids, sets(texts)):
                c = class_of(s)
                at = (c ^ (i or 0)) % bits
                if s.size and wanted[at >> 3] >> (at & 7) & 1 and c not in seen:
                    seen.add(c)
                    out.append((c, packed(s)))
            if out:
                yield rows_to_batch(schema, list(zip(*out)))

    return id_text(df, id_col, text_col).mapInArrow(run, "member long, blob binary")


# --- verification


def linked(a: int, b: int, both: np.ndarray | int):
    return DENOMINATOR * both >= NUMERATOR * (a + b - both)


def closure(names: list[int], own: list[np.ndarray], first: int, outside: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect whatever links among the sets connect. ``first`` is compared with all, and the triangle
    inequality about it rules out others. With ``outside``, only pairs of one set outside and one inside matter."""
    n = len(own)
    size = np.array([s.size for s in own])
    token, ident = np.unique(np.concatenate(own), return_inverse=True)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(ident, kind="stable")
    posting, start = owner[order], np.concatenate([[0], np.cumsum(np.bincount(ident, minlength=token.size))])
    offset = np.concatenate([[0], np.cumsum(size)])
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def shared(x: int) -> np.ndarray:
        ids = ident[offset[x] : offset[x + 1]]
        a, m = start[ids], start[ids + 1] - start[ids]
        at = np.repeat(a - np.cumsum(m) + m, m) + np.arange(m.sum())
        return np.bincount(posting[at], minlength=n)

    out = []

    def join(x: int, ys: np.ndarray) -> None:
        for y in ys.tolist():
            a, b = root(x), root(y)
            if a != b:
                parent[b] = a
                out.append((names[x], names[y]))

    both = shared(first)
    distance = 1 - both / (size[first] + size - both)
    join(first, np.flatnonzero(linked(size[first], size, both) & (np.arange(n) != first)))
    rest = np.flatnonzero(outside) if outside is not None else np.array([x for x in range(n) if root(x) != root(first)], np.int64)
    limit = 1 - NUMERATOR / DENOMINATOR + 1e-9
    for x in rest.tolist():
        near = (np.abs(distance - distance[x]) <= limit) & (DENOMINATOR * np.minimum(size, size[x]) >= NUMERATOR * np.maximum(size, size[x]))
        near[x] = False
        if outside is not None:
            near &= ~outside
        if near.any():
            both = shared(x)
            join(x, np.flatnonzero(near & linked(size[x], size, both)))
    return out


_LINKS = "a long, b long"


def _verify(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.drop_duplicates("member")
    names = pdf["member"].tolist()
    own = [unpacked(b) for b in pdf["blob"]]
    return pd.DataFrame(closure(names, own, names.index(pdf["leader"].iloc[0])), columns=["a", "b"])


def _verify_across(pdf: pd.DataFrame) -> pd.DataFrame:
    # a set may stand on both sides: once inside its own block, once outside
    pdf = pdf.drop_duplicates(["member", "outside"]).sort_values("outside", kind="stable")
    names = pdf["member"].tolist()
    own = [unpacked(b) for b in pdf["blob"]]
    at = next(k for k, x in enumerate(names) if x == pdf["leader"].iloc[0])
    links = closure(names, own, at, pdf["outside"].to_numpy(bool))
    return pd.DataFrame([x for x in links if x[0] != x[1]], columns=["a", "b"])


def links(met: DataFrame, own: DataFrame, block: int = BLOCK, first: DataFrame | None = None, shingles: int = SHINGLES) -> DataFrame:
    """a, b: exact links that connect all that the meetings' links connect. With ``first`` (see ``heads``), blocks
    are bounded by their members' shingles too."""
    n = F.lit(0).cast("long").alias("n")
    met = met.select("leader", "member", n) if first is None else met.join(first.select(F.col("class").alias("member"), "n"), "member").select("leader", "member", "n")
    tasks = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / shingles)).cast("int")
    size = met.groupBy("leader").agg(tasks.alias("blocks"))
    led = size.select("leader", F.col("leader").alias("member"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    placed = met.join(size, "leader").select("leader", "member", "n", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int").alias("block"))
    rows = placed.drop("n").unionByName(led).join(own, "member")
    near = cut(rows.groupBy("leader", "block").applyInPandas(_verify, _LINKS))
    large = size.filter("blocks > 1")
    if large.isEmpty():
        return near
    # across the blocks of large meetings: members that the leader's component lacks, against all others
    comp = components(near)
    here = placed.join(large, "leader").join(comp.select(F.col("class").alias("member"), F.col("component").alias("of_member")), "member", "left").join(comp.select(F.col("class").alias("leader"), F.col("component").alias("of_leader")), "leader", "left")
    apart = here.filter(F.coalesce("of_member", "member") != F.coalesce("of_leader", "leader"))
    parts = apart.groupBy("leader").agg(tasks.alias("parts"))
    outside = apart.join(parts, "leader").select("leader", "member", "blocks", "parts", F.pmod(F.xxhash64("member", F.lit(1)), F.col("parts")).cast("int").alias("part"))
    outside = outside.select("leader", "member", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "part", F.lit(True).alias("outside"))
    inside = here.join(parts, "leader").select("leader", "member", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("outside"))
    heads = large.join(parts, "leader").select("leader", F.col("leader").alias("member"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "parts")
    heads = heads.select("leader", "member", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("outside"))
    rows = outside.unionByName(inside).unionByName(heads).join(own, "member")
    return near.unionAll(cut(rows.groupBy("leader", "block", "part").applyInPandas(_verify_across, _LINKS)))


def components(edges: DataFrame) -> DataFrame:
    """class, component: the least class that links reach, for every class with a link.

    Each round every class takes the least label of its neighbours and then that label's own label; rounds grow
    with the logarithm of the diameter. Labels are checkpointed, so lineage stays short.
    """
    both = cut(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(both.groupBy(F.col("a").alias("class")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        near = both.join(label, both["b"] == label["class"]).groupBy("a").agg(F.min("component").alias("near"))
        step = label.join(near, label["class"] == near["a"]).select("class", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        jump = label.select(F.col("class").alias("new"), F.col("component").alias("further"))
        after = cut(step.join(jump, "new", "left").select("class", "old", F.least(F.col("new"), F.coalesce("further", "new")).alias("component")))
        moved = after.filter("component <> old").limit(1).count()
        label = after.select("class", "component")
        if not moved:
            return label


def grouped(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class, n_shingles, component_id (the smallest doc_id that links reach) of every row."""
    seen = cut(classes(df, id_col, text_col))
    met = cut(meetings(index(df, common_slots(seen), id_col, text_col)))
    first = heads(seen)
    comp = components(links(met, members(df, met, first, id_col=id_col, text_col=text_col), first=first))
    docs = seen.filter("slice is null").select("doc_id", "n", "class")
    reach = first.join(comp, "class", "left").select("class", "least", F.coalesce("component", "class").alias("component"))
    smallest = reach.groupBy("component").agg(F.min("least").alias("component_id"))
    named = reach.join(smallest, "component").select("class", "component_id")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return docs.join(named, "class", "left").select("doc_id", "class", F.col("n").alias("n_shingles"), own.alias("component_id"))


def joined(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach) of every row."""
    return grouped(df, id_col, text_col).drop("class")


def first_of_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one document of each group, the one with the smallest id; rows without words or without an id all
    stay. Rows that share an id and a set of shingles stay or go together; where an id has several texts, each text
    is judged by its own group, so none goes but for a copy that stays."""
    rows = grouped(df, id_col, text_col)
    # a group's document that stays: its smallest id, with the least class of that id
    kept = rows.filter("n_shingles > 0 and doc_id = component_id").groupBy("component_id").agg(F.min("class").alias("kept"))
    judged = rows.filter("n_shingles > 0 and doc_id is not null").join(kept, "component_id")
    drop = judged.filter("doc_id <> component_id or class <> kept").select(F.col("doc_id").alias("dropped"), F.col("class").alias("of_class")).distinct()
    own = fresh(df, "set_class")

    @F.pandas_udf("long")
    def classed(text):
        return pd.Series([class_of(s) for t in text.fillna("") for s in sets([t])], dtype="int64")

    ready(df.sparkSession)
    marked = df.withColumn(own, classed(F.col(text_col).cast("string"))).alias("d")
    same = (F.col(f"d.`{id_col}`").cast("long") == F.col("x.dropped")) & (F.col(f"d.{own}") == F.col("x.of_class"))
    return marked.join(drop.alias("x"), same, "left_anti").drop(own)
