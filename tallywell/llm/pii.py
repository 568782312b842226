"""PII: fixed patterns, and terms that reveal them, found by corpus co-occurrence.

Protected entities are what the patterns find, at three levels: the identifier itself, its group (an e-mail's
domain, an address's network, a card's issuer, a telephone number but its last four digits) and its kind. A term
anywhere in an entity's document reveals it as far as seeing the term tells that the entity is there:
PMI(term, entity) over the corpus's documents, against the entity's information IC(entity) = log(documents /
documents with it). A term exceeds the threshold with PMI >= disclosure x IC, seen in at least ``support``
different documents of the entity, and with evidence n x PMI >= log(documents) + ``margin`` of its n documents with
the entity, so that chance does not make rare words revealing, however many there are. All its spans in that
entity's documents are added and ``sanitise`` generalises them. Documents differ here by the ``passage`` words
on either side of the entity: copies of a passage repeat them, so a copied document does not make its words
revealing. An identifier in fewer than ``support`` documents is protected at the levels above it only.

Null texts are empty; an empty table gives an empty one; repeated rows give repeated results; a term that reveals
several entities is one span. Only the id and text columns are read (``sanitise`` keeps the others as they are).
Counts cover all documents, and all of them count documents. The corpus counts of entities and terms go through
bitmaps of fixed size, exact counts through joins on hashes. Pairs are at most those entities' documents times
their terms, four times. They are dealt by their terms to buckets whose number grows with them: a document has a
term once, so even a word of all documents is a small part of a bucket, and an entity's pairs spread over all.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import cut, fresh, id_text, ready, rows_to_batch, signed, texts_of
from tallywell.llm.words import MARKS, words

# The kinds of personal data, in order, and their patterns. Each is written so that a scan takes
# linear time; the matches are those of the leftmost non-overlapping scan.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

PASSAGE = 10
SUPPORT = 3
DISCLOSURE = 0.9
MARGIN = 5.0  # of evidence, in natural logarithms
BITS = 1 << 23
CHUNK = 1 << 18  # rows that a task holds before it sends them
PAIRS, BUCKET = 1000, 1 << 20  # pairs that a document has, about, and a bucket should


def emails(text: str) -> list[tuple[int, int]]:
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        s = at
        while s > last and text[s - 1] in _LOCAL_CHARS:
            s -= 1
        if s < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((s, m.end()))
            last = m.end()
            at = text.find("@", last)
        else:
            last = max(last, s)
            at = text.find("@", at + 1)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's number, start, end) in code points, by kind, then start."""
    out = [(0, *x) for x in emails(text)] if "@" in text else []
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def _hash(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little", signed=True)


def levels(kind: int, found_text: str) -> tuple[str, str, str]:
    """What a span protects: the identifier, its group and its kind."""
    if kind == 0:
        own = found_text.lower()
        group = own[own.index("@") :]
    elif kind == 1:
        own, group = found_text, found_text[: found_text.rindex(".")]
    else:
        own = _digits(found_text)
        group = own[:6] if kind == 2 else own[:-4]
    return f"{KINDS[kind]}:{own}", f"{KINDS[kind]} group:{group}", KINDS[kind]


def _entities(kind: int, found_text: str) -> list[int]:
    return [_hash(x) for x in levels(kind, found_text)]


def _byte_spans(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The spans' places in the text's bytes."""
    if text.isascii():
        return [(s, e) for _, s, e in spans]
    edges = sorted({x for _, *span in spans for x in span})
    at, n, of = 0, 0, {}
    for x in edges:
        n += len(text[at:x].encode())
        at, of[x] = x, n
    return [(of[s], of[e]) for _, s, e in spans]


def _free(start: np.ndarray, end: np.ndarray, taken: list[tuple[int, int]]) -> np.ndarray:
    """Which words no span touches."""
    taken = sorted(taken)
    lo, hi = np.array([x for x, _ in taken]), np.maximum.accumulate(np.array([x for _, x in taken]))
    before = np.searchsorted(lo, end, "left") - 1
    return ~((before >= 0) & (hi[before] > start))


_FOUND = "doc_id long, text_key long, counts array<long>, base string, entities array<struct<entity:long,passage:long>>"


def found(df: DataFrame, passage: int = PASSAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: base spans as kind:start:end, joined, and its different entities with the words about them."""
    ready(df.sparkSession)
    entities_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("entity", "passage")]))
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("counts", pa.list_(pa.int64())), ("base", pa.string()), ("entities", entities_type)])

    def run(batches):
        for ids, texts in texts_of(batches):
            w = words(texts, blank=MARKS)
            code = signed(w.hash)
            out = []
            for k, (i, text) in enumerate(zip(ids, texts)):
                spans = base_spans(text)
                a, b, origin = int(w.first[k]), int(w.first[k + 1]), int(w.offset[k])
                about: dict[int, int] = {}  # an entity's passage in this document: the least of its places
                for (kind, s, e), (s1, e1) in zip(spans, _byte_spans(text, spans)):
                    p, q = a + int(np.searchsorted(w.end[a:b], origin + s1, "right")), a + int(np.searchsorted(w.start[a:b], origin + e1, "left"))
                    around = hash((tuple(code[max(a, p - passage) : p].tolist()), tuple(code[q : min(b, q + passage)].tolist())))
                    for entity in _entities(kind, text[s:e]):
                        about[entity] = min(about.get(entity, around), around)
                counts = [0] * len(KINDS)
                for kind, _, _ in spans:
                    counts[kind] += 1
                out.append((i, _hash(text), counts, ",".join([f"{KINDS[kind]}:{s}:{e}" for kind, s, e in spans]), [{"entity": x, "passage": y} for x, y in about.items()]))
            yield rows_to_batch(schema, list(zip(*out)))

    return id_text(df, id_col, text_col).mapInArrow(run, _FOUND)


def _with_entities(batches, wanted: np.ndarray, passage: int | None = None):
    """(id, text, word hashes, starts, ends in bytes, entities with their passages) of the texts that have an entity
    whose bit is set; words are those that no span touches."""
    for ids, texts in texts_of(batches):
        kept = []
        for i, text in zip(ids, texts):
            spans = base_spans(text)
            entities = [[x for x in _entities(kind, text[s:e]) if wanted[x % wanted.size]] for kind, s, e in spans]
            if any(entities):
                kept.append((i, text, spans, entities))
        if not kept:
            continue
        w = words([x[1] for x in kept], blank=MARKS)
        code = signed(w.hash)
        for k, (i, text, spans, entities) in enumerate(kept):
            a, b = int(w.first[k]), int(w.first[k + 1])
            start, end, own = w.start[a:b] - w.offset[k], w.end[a:b] - w.offset[k], code[a:b]
            places = _byte_spans(text, spans)
            about: dict[int, int] = {}
            for held, (s, e) in zip(entities, places):
                around = 0
                if passage is not None and held:
                    p, q = int(np.searchsorted(end, s, "right")), int(np.searchsorted(start, e, "left"))
                    around = hash((tuple(own[max(0, p - passage) : p].tolist()), tuple(own[q : q + passage].tolist())))
                for entity in held:
                    about[entity] = min(about.get(entity, around), around)
            free = _free(start, end, places)
            yield i, text, own[free], start[free], end[free], about


def _bitmap(keys: DataFrame, bits: int, column: str = "term") -> np.ndarray:
    """A bitmap of the keys' residues: of fixed size, built by aggregation."""
    place = F.pmod(F.col(column), F.lit(bits))
    rows = keys.select(F.bitmap_bucket_number(place).alias("b"), F.bitmap_bit_position(place).alias("p")).groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect()
    out = np.zeros(bits + 32768, bool)
    for b, m in rows:
        on = np.unpackbits(np.frombuffer(m, np.uint8), bitorder="little")
        at = 32768 * (b - 1)
        for lead in (0, 1):  # the first bucket begins at 0 or 1, by the sign of the value
            out[at + lead : at + lead + on.size] |= on.astype(bool)[: out.size - at - lead]
    return out[:bits]


_LINKED = "bucket int, blob binary"
ANY = 0  # stands for every document that has an entity


def pairs(df: DataFrame, entities: DataFrame, buckets: int, passage: int = PASSAGE, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """bucket, blob: each document's terms with its entities (those given, ones that share their bit, and ANY), packed
    by the term's bucket: an entity and its passage stand once in a blob, a term and the number of that link each time."""
    wanted = _bitmap(entities, bits, "entity")
    ready(df.sparkSession)
    schema = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])
    shift = np.uint64(64 - (buckets.bit_length() - 1))

    def sent(terms: list[np.ndarray], links: list[tuple[int, int]]):
        term = np.concatenate(terms).view(np.uint64)
        link = np.repeat(np.arange(len(links), dtype=np.uint32), [t.size for t in terms])
        at = (term >> shift).astype(np.int64)
        order = np.argsort(at, kind="stable")
        edges = np.searchsorted(at[order], np.arange(buckets + 1))
        head = np.array(links, np.int64).tobytes()
        pack = zstandard.ZstdCompressor(level=1).compress
        rows = []
        for k in np.flatnonzero(np.diff(edges)).tolist():
            own = order[edges[k] : edges[k + 1]]
            rows.append((k, pack(np.array([len(links), own.size], np.int64).tobytes() + head + term[own].tobytes() + link[own].tobytes())))
        return rows_to_batch(schema, list(zip(*rows)))

    def run(batches):
        terms, links, size = [], [], 0
        for _, _, code, _, _, about in _with_entities(batches, wanted, passage):
            own = np.unique(code)
            if not own.size:
                continue
            for link in [(ANY, 0), *about.items()]:
                terms.append(own)
                links.append(link)
                size += own.size
            if size >= CHUNK:
                yield sent(terms, links)
                terms, links, size = [], [], 0
        if size:
            yield sent(terms, links)

    rows = id_text(df, id_col, text_col)
    return (rows if wanted.any() else rows.limit(0)).mapInArrow(run, _LINKED)


def _supported_pairs(pdf: pd.DataFrame, support: int) -> pd.DataFrame:
    """entity, term, n_pair, n_any of one bucket's pairs that have the support."""
    entity, passage, term = [], [], []
    for blob in pdf["blob"]:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        links, n = np.frombuffer(raw, np.int64, 2).tolist()
        table = np.frombuffer(raw, np.int64, 2 * links, 16).reshape(-1, 2)
        link = np.frombuffer(raw, np.uint32, n, 16 + 16 * links + 8 * n)
        term.append(np.frombuffer(raw, np.int64, n, 16 + 16 * links))
        entity.append(table[link, 0])
        passage.append(table[link, 1])
    entity, passage, term = map(np.concatenate, (entity, passage, term))
    order = np.lexsort((passage, entity, term))
    entity, passage, term = entity[order], passage[order], term[order]
    new = np.ones(term.size, bool)
    new[1:] = (term[1:] != term[:-1]) | (entity[1:] != entity[:-1])
    other = new.copy()
    other[1:] |= passage[1:] != passage[:-1]
    first = np.flatnonzero(new)
    total, kinds = np.diff(first, append=term.size), np.add.reduceat(other, first)
    any_terms, any_totals = term[first][entity[first] == ANY], total[entity[first] == ANY]
    keep = (entity[first] != ANY) & (kinds >= support)
    of = np.searchsorted(any_terms, term[first][keep])
    return pd.DataFrame({"entity": entity[first][keep], "term": term[first][keep], "n_pair": total[keep], "n_any": any_totals[of]})


def term_counts(df: DataFrame, candidates: DataFrame, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """term, n: in how many documents the candidates (and terms that share their bit) occur."""
    marked = _bitmap(candidates, bits)
    ready(df.sparkSession)
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def run(batches):
        def out(codes):
            term, n = np.unique(np.concatenate(codes), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(signed(term)), pa.array(n.astype(np.int64))], schema=schema)

        held, size = [], 0
        for _, texts in texts_of(batches):
            w = words(texts, blank=MARKS)
            on = np.flatnonzero(marked[np.mod(signed(w.hash), bits)])
            code, doc = w.hash[on], np.searchsorted(w.first, on, "right")
            order = np.lexsort((code, doc))
            code, doc = code[order], doc[order]
            first = np.ones(code.size, bool)
            first[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
            code = code[first]
            held.append(code)
            size += code.size
            if size > 1 << 20:
                yield out(held)
                held, size = [], 0
        if size:
            yield out(held)

    rows = id_text(df, id_col, text_col)
    return (rows if marked.any() else rows.limit(0)).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def revealing(
    df: DataFrame, base: DataFrame, passage: int = PASSAGE, support: int = SUPPORT, disclosure: float = DISCLOSURE, margin: float = MARGIN, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """entity, term, pmi, ic of the terms that exceed the disclosure threshold. ``base``: a kept ``found(df)``."""

    def supported(rows: DataFrame, *keys: str) -> DataFrame:
        by = rows.groupBy(*keys, "passage").agg(F.count(F.lit(1)).alias("n")).groupBy(*keys)
        return by.agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total")).filter(F.col("kinds") >= support)

    entities = cut(supported(base.select(F.explode("entities").alias("x")).select("x.entity", "x.passage"), "entity").select("entity", F.col("total").alias("n_entity")))
    total = float(max(base.count(), 2))
    log_total = math.log(total)
    docs = base.filter(F.size("entities") > 0).count()
    buckets = 1 << max(4, (docs * PAIRS // BUCKET).bit_length())
    linked = pairs(df, entities, buckets, passage, bits, id_col, text_col).groupBy("bucket").applyInPandas(lambda pdf: _supported_pairs(pdf, support), "entity long, term long, n_pair long, n_any long")
    # a term stands in as many documents at least as have any entity, so these bounds lose no pair
    known = linked.join(F.broadcast(entities) if _few(entities) else entities, "entity")
    most = F.log(F.col("n_pair") / F.col("n_any")) + F.lit(log_total) - F.log("n_entity")
    most_ic = F.lit(log_total) - F.log("n_entity")
    both = cut(known.filter((most >= disclosure * most_ic - 1e-9) & (F.col("n_pair") * most >= log_total + margin - 1e-9)).drop("n_any"))
    counts = term_counts(df, both.select("term"), bits, id_col, text_col)
    out = both.join(counts, "term")
    pmi = F.log(F.least(F.col("n_pair") / F.col("n"), F.lit(1.0)) * total / F.col("n_entity"))
    ic = F.lit(log_total) - F.log("n_entity")
    rows = out.select("entity", "term", "n_pair", pmi.alias("pmi"), ic.alias("ic")).filter((F.col("ic") > 0) & (F.col("pmi") >= disclosure * F.col("ic")))
    return rows.filter(F.col("n_pair") * F.col("pmi") >= log_total + margin).select("entity", "term", "pmi", "ic")


def _few(rows: DataFrame, most: int = 200_000) -> bool:
    """Whether rows may be broadcast: counted, at most so many (of 16 bytes here)."""
    return rows.count() <= most


_PLACES = "doc_id long, text_key long, entity long, term long, start long, end long"


def places(df: DataFrame, bad: DataFrame, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where the terms of ``bad`` (entity, term) stand in the documents of its entities; pairs of others may be among them."""
    entities, terms = _bitmap(bad, bits, "entity"), _bitmap(bad, bits)
    ready(df.sparkSession)
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "text_key", "entity", "term", "start", "end")])

    def run(batches):
        held, size = [], 0
        for i, text, code, start, end, about in _with_entities(batches, entities):
            own = np.flatnonzero(terms[np.mod(code, bits)])
            if not own.size:
                continue
            code, start, end, key = code[own], start[own], end[own], _hash(text)
            if not text.isascii():  # from bytes to code points
                points = np.concatenate([[0], np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)])
                start, end = points[start], points[end]
            for entity in about:
                held += zip([i] * own.size, [key] * own.size, [entity] * own.size, code.tolist(), start.tolist(), end.tolist())
                size += own.size
                if size >= CHUNK:
                    yield rows_to_batch(schema, list(zip(*held)))
                    held, size = [], 0
        if held:
            yield rows_to_batch(schema, list(zip(*held)))

    rows = id_text(df, id_col, text_col)
    return (rows if entities.any() else rows.limit(0)).mapInArrow(run, _PLACES)


def spans(df: DataFrame, passage: int = PASSAGE, support: int = SUPPORT, disclosure: float = DISCLOSURE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, counts, base, terms (the revealing terms' spans, by start) of every row."""
    base = cut(found(df, passage, id_col, text_col))
    bad = cut(revealing(df, base, passage, support, disclosure, id_col=id_col, text_col=text_col).select("entity", "term"))
    hits = places(df, bad, id_col=id_col, text_col=text_col).join(bad, ["entity", "term"])
    terms = hits.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("terms"))
    joined = base.alias("b").join(terms.alias("t"), F.col("b.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("b.text_key") == F.col("t.text_key")), "left")
    return joined.select("b.doc_id", "b.text_key", "b.counts", "b.base", F.coalesce(F.col("t.terms"), F.array().cast("array<struct<start:long,end:long>>")).alias("terms"))


def digest(marked: DataFrame) -> DataFrame:
    terms = F.array_join(F.transform("terms", lambda x: F.concat_ws(":", F.lit(TERM), x["start"], x["end"])), ",")
    return marked.select("doc_id", *[F.get("counts", F.lit(k)).alias(f"n_{kind}") for k, kind in enumerate(KINDS)], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(F.size("terms") > 0, terms)).alias("spans"))


def redact(text: str, spans_: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named for the first."""
    out, at = [], 0
    for kind, s, e in sorted(spans_, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def sanitise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """df with identifiers and revealing terms replaced; all rows and columns stay, null texts stay null.

    Identifiers are replaced where they are found; only the rows' revealing terms come by a join on the id and
    a hash of the text.
    """
    ready(df.sparkSession)
    own = fresh(df, "text_hash")
    marked = spans(df, id_col=id_col, text_col=text_col, **how).filter(F.size("terms") > 0)
    terms = marked.select("doc_id", "text_key", "terms").dropDuplicates(["doc_id", "text_key"])

    @F.pandas_udf("long")
    def key(text):
        return text.fillna("").map(_hash)

    @F.pandas_udf("string")
    def clean(text, found_terms):
        def one(t, xs):
            if t is None:
                return None
            return redact(t, [(KINDS[k], s, e) for k, s, e in base_spans(t)] + [(TERM, x["start"], x["end"]) for x in (xs if xs is not None else ())])

        return text.combine(found_terms, one) if len(text) else text

    hashed = df.withColumn(own, key(F.col(text_col))).alias("d")
    joined = hashed.join(terms.alias("t"), F.col(f"d.`{id_col}`").cast("long").eqNullSafe(F.col("t.doc_id")) & (F.col(f"d.{own}") == F.col("t.text_key")), "left")
    return joined.select(*[clean(F.col(f"d.`{c}`"), F.col("t.terms")).alias(c) if c == text_col else F.col(f"d.`{c}`") for c in df.columns])
