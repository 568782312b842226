"""Quality rules with an n-gram perplexity: a modified Kneser-Ney model per language, counted by Spark.

Each language has an alphabet of its own: every code point that its texts use has a class, but for capitals,
digits and symbols, which fold by kind, so Cyrillic, Thai or Chinese characters are told apart as Latin ones are.
The LETTERS commonest have the lowest classes: a language with no more has at most 64^3 trigrams, which tasks count
in arrays; the trigrams of a larger alphabet are counted by sorting, and sent on whenever a task holds SPARSE of
them. Only documents that pass the base rules count. Spark adds the counts, one task a language smooths them, and
the model is kept as sorted arrays of hashes with their log probabilities and back-off weights (12 bytes an entry;
the driver and every worker hold one such set a language: 3 MB at most for up to LETTERS code points, else as many
entries as the texts have different trigrams, pairs and characters). A document's perplexity
must lie between its language's lower and upper limits, robust limits about the median over all documents that
pass the base rules: text that is far too predictable (repetition) or far too strange (symbols, shouting, binary,
another language) is rejected. Word order beyond three characters does not count.

Each language of RARE documents or more has a model and a band of its own, keyed by its name; those of fewer,
which give no band, share one model that no other language uses. Null texts have no words and fail the
base rules; a null language is one of its own; an empty table gives an empty one; repeated rows give repeated
verdicts; ties in an alphabet go to the lower code point. Only the id, text and language columns are read
(``good_rows`` keeps the others as they are).
"""

from __future__ import annotations

import functools
import uuid
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import cut, fresh, mix, ready, rows_to_batch
from tallywell.llm.words import windows, words

CLASSES = 64
LETTERS = 59  # code points with a class below CLASSES, further ones have those from there; the class 0 is a text's end
CAPITAL, DIGIT, SYMBOL, OTHER = 60, 61, 62, 63
SPARSE = 1 << 20  # different trigrams of large alphabets that a task holds
LANGUAGES = 64  # whose counts or tables a task holds at once
RARE = 20  # documents that a language has at least for a model of its own
MIN_WORDS = 20
REPEAT_WORDS = 8
REPEAT_PERCENT = 30
STEPS = 64  # histogram bins to a doubling of the perplexity
WIDTH = 4.0  # of the band, in half interquartile ranges of the doublings
LEAST = 0.12  # doublings that the band reaches at least
SMALL = 400.0  # characters; shorter texts scatter more and get a wider band
POINTS = 0x110000

_SYMBOLS = "#*$%&|<>"


@functools.cache
def folded() -> np.ndarray:
    """The class of each code point that every alphabet folds; 0 for those that may have one of their own."""
    out = np.zeros(POINTS, np.uint8)
    for c in range(0x2000):
        x = chr(c)
        out[c] = CAPITAL if x.isupper() else DIGIT if x.isdigit() else 0
    out[[ord(c) for c in _SYMBOLS]] = SYMBOL
    out[0] = OTHER
    return out


def size_of(alphabet: tuple[int, ...]) -> int:
    """The number of classes."""
    return CLASSES + max(0, len(alphabet) - LETTERS)


def bits_of(alphabet: tuple[int, ...]) -> int:
    """Of a class within a code: 6, or up to 21 for more than LETTERS code points."""
    return (size_of(alphabet) - 1).bit_length()


@functools.lru_cache(maxsize=LANGUAGES)
def classes(alphabet: tuple[int, ...]) -> np.ndarray:
    """The class of each code point for a language with this alphabet."""
    out = folded().astype(np.min_scalar_type(size_of(alphabet) - 1))
    out[out == 0] = OTHER
    at = np.arange(len(alphabet))
    out[list(alphabet)] = np.where(at < LETTERS, at + 1, at - LETTERS + CLASSES)
    return out


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def codes(texts: list[str], alphabet: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(trigram codes, first): one code for each character of each text and one for its end."""
    table = classes(alphabet)
    raw = [points(t) for t in texts]
    pad, b = np.zeros(2, table.dtype), bits_of(alphabet)
    data = np.concatenate([pad, *(x for r in raw for x in (table[r], pad))]).astype(np.int32 if b == 6 else np.int64)[:-1]
    code = (data[:-2] << 2 * b) | (data[1:-1] << b) | data[2:]
    size = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    first = np.concatenate([[0], np.cumsum(size)])
    keep = np.ones(code.size, bool)
    keep[(first[1:-1] + np.arange(len(raw) - 1))] = False  # a code that begins a text's second pad
    return code[keep], first


def numbers(df: DataFrame, lang_col: str = "lang", rare: int = RARE) -> dict[str | None, int]:
    """language -> its number, from 1; the rare ones, which are not in it, are 0."""
    rows = df.groupBy(F.col(lang_col).cast("string").alias("lang")).count().filter(F.col("count") >= rare).collect()
    return {lang: k for k, lang in enumerate(sorted((r["lang"] for r in rows), key=lambda x: (x is not None, x or "")), 1)}


def _read(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.col(lang_col).cast("string").alias("lang"))


def _runs(batches, known: dict[str | None, int], size: int = 1 << 18):
    """(ids, languages' numbers, texts) in runs of about size bytes of text."""
    for batch in batches:
        ids, names, texts = (batch.column(c).to_pylist() for c in ("doc_id", "lang", "text"))
        langs = [known.get(x, 0) for x in names]
        a = n = 0
        for b, t in enumerate(texts):
            n += len(t)
            if n >= size:
                yield ids[a : b + 1], langs[a : b + 1], texts[a : b + 1]
                a, n = b + 1, 0
        if a < len(texts):
            yield ids[a:], langs[a:], texts[a:]


class _Sparse:
    """Counts of codes without a bound, by sorting."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, code: np.ndarray) -> None:
        self.parts.append(np.unique(code, return_counts=True))
        self.size += self.parts[-1][0].size

    def pack(self) -> None:
        self.parts = [self.sums()]
        self.size = self.parts[0][0].size

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        code, inverse = np.unique(np.concatenate([c for c, _ in self.parts]), return_inverse=True)
        n = np.zeros(code.size, np.int64)
        np.add.at(n, inverse, np.concatenate([n for _, n in self.parts]))
        return code, n


def _summed(df: DataFrame, known: dict[str | None, int], width: int, count, id_col: str, text_col: str, lang_col: str, sparse: frozenset[int] = frozenset()) -> DataFrame:
    """lang, code, n over all documents, where count(lang, texts) gives the codes' numbers, below width but for the
    ``sparse`` languages; each task sends a language's code once, or again after some others."""
    ready(df.sparkSession)
    schema = pa.schema([("lang", pa.int32()), ("code", pa.int64()), ("n", pa.int64())])
    held = max(1, LANGUAGES * CLASSES**3 // width)  # languages that a task counts at once

    def sent(total):
        for lang, n in total.items():
            code, n = n.sums() if isinstance(n, _Sparse) else (at := np.flatnonzero(n), n[at])
            for k in range(0, code.size, CLASSES**3):
                own = code[k : k + CLASSES**3]
                yield rows_to_batch(schema, [np.full(own.size, lang, np.int32), own, n[k : k + CLASSES**3]])

    def run(batches):
        total: dict[int, np.ndarray] = {}
        wide: dict[int, _Sparse] = {}
        for _, langs, texts in _runs(batches, known):
            by: dict[int, list[str]] = {}
            for lang, t in zip(langs, texts):
                by.setdefault(lang, []).append(t)
            for lang, own in by.items():
                if lang not in sparse and lang not in total:
                    if len(total) >= held:
                        yield from sent(total)
                        total = {}
                    total[lang] = np.zeros(width, np.int64)
                for code in count(lang, own):
                    if lang in sparse:
                        wide.setdefault(lang, _Sparse()).add(code)
                    elif code.size < width // 16:
                        at, n = np.unique(code, return_counts=True)
                        total[lang][at] += n
                    else:
                        total[lang] += np.bincount(code, minlength=width)
            if sum(x.size for x in wide.values()) >= SPARSE:
                for x in wide.values():
                    x.pack()
                if sum(x.size for x in wide.values()) >= SPARSE // 2:
                    yield from sent(wide)
                    wide = {}
        yield from sent(total)
        yield from sent(wide)

    return _read(df, id_col, text_col, lang_col).mapInArrow(run, "lang int, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def alphabets(df: DataFrame, known: dict[str | None, int], id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[int, tuple[int, ...]]:
    """Each language's code points but those that every alphabet folds: the LETTERS most used in order, then all
    others in order. The driver gets a row for each."""

    def count(lang: int, texts: list[str]):
        own = points("".join(texts))
        yield own[folded()[own] == 0].astype(np.int64)

    out: dict[int, list[tuple[int, int]]] = {}
    for r in _summed(df, known, POINTS, count, id_col, text_col, lang_col).collect():
        out.setdefault(r["lang"], []).append((-r["n"], r["code"]))
    ranked = {lang: [c for _, c in sorted(x)] for lang, x in out.items()}
    return {lang: (*sorted(x[:LETTERS]), *sorted(x[LETTERS:])) for lang, x in ranked.items()}


def counts(df: DataFrame, known: dict[str | None, int], letters: dict[int, tuple[int, ...]], id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, code, n: the trigrams of all documents that pass the base rules."""

    def count(lang: int, texts: list[str]):
        good = [t for t, r in zip(texts, base_columns(texts)) if not r[-1]]
        if good:
            yield codes(good, letters.get(lang, ()))[0]

    large = frozenset(lang for lang, x in letters.items() if len(x) > LETTERS)
    return _summed(df, known, CLASSES**3, count, id_col, text_col, lang_col, large)


# --- the model


class Model(NamedTuple):
    """Sorted hashes of (language, n-gram) with log2 probabilities, and of contexts with log2 back-off weights."""

    grams: np.ndarray
    log_p: np.ndarray
    contexts: np.ndarray
    log_back: np.ndarray


def _key(lang: int, order: int, code: np.ndarray) -> np.ndarray:
    """The leading bits tell the order, so that no two n-grams of a language share a key."""
    mark = np.uint64((0b111 << 61, 0b11 << 62, 0b1 << 63, 0)[order])
    return mix((code.astype(np.uint64) | mark) ^ mix(np.uint64([lang])))


def _discounts(n: np.ndarray) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of one, two and more."""
    c = [float((n == k).sum()) for k in (1, 2, 3, 4)]
    if not c[0] or not c[1]:
        return 0.5, 0.75, 0.9
    y = c[0] / (c[0] + 2 * c[1])
    raw = (1 - 2 * y * c[1] / c[0], 2 - 3 * y * c[2] / c[1], 3 - 4 * y * c[3] / c[2] if c[2] else 1.5)
    return tuple(min(max(d, 0.05), k) for d, k in zip(raw, (0.95, 1.9, 2.9)))  # type: ignore[return-value]


def _smoothed(code: np.ndarray, n: np.ndarray, b: int, lower) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probabilities, contexts, their back-off weights) of sorted codes (context, next) with counts n over the lower
    order's probabilities."""
    take = np.select([n == 1, n == 2], _discounts(n)[:2], _discounts(n)[2])
    context = code >> b
    first = np.flatnonzero(np.diff(context, prepend=-1))
    size = np.diff(first, append=code.size)
    total = np.add.reduceat(n, first).astype(float)
    back = np.add.reduceat(take, first) / total
    return (n - take) / np.repeat(total, size) + np.repeat(back, size) * lower, context[first], back


def model_of(lang: int, code: np.ndarray, n: np.ndarray, b: int = 6, size: int = CLASSES) -> Model:
    """One language's model from its trigram counts: seen n-grams with their probability, contexts with their
    weight, each by hash. b: bits of a class, size: number of classes."""
    by = np.argsort(code, kind="stable")
    three, n3 = code[by].astype(np.int64), n[by]
    two, n2 = np.unique(three & ((1 << 2 * b) - 1), return_counts=True)  # in how many left contexts a pair occurs
    one, n1 = np.unique(two & ((1 << b) - 1), return_counts=True)
    p1, c0, b0 = _smoothed(one, n1, b, 1 / size)
    p2, c1, b1 = _smoothed(two, n2, b, p1[np.searchsorted(one, two & ((1 << b) - 1))])
    p3, c2, b2 = _smoothed(three, n3, b, p2[np.searchsorted(two, three & ((1 << 2 * b) - 1))])

    def ordered(tables):
        k = np.concatenate([_key(lang, order, at) for order, at, _ in tables])
        v = np.concatenate([np.log2(v) for *_, v in tables])
        by = np.argsort(k)
        return k[by], v[by].astype(np.float32)

    return Model(*ordered(((3, three, p3), (2, two, p2), (1, one, p1))), *ordered(((2, c2, b2), (1, c1, b1), (0, c0, b0))))


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not keys.size:
        return np.zeros(wanted.size, bool), np.zeros(wanted.size, np.float32)
    at = np.minimum(np.searchsorted(keys, wanted), keys.size - 1)
    hit = keys[at] == wanted
    return hit, np.where(hit, values[at], np.float32(0))


def log_probability(m: Model, lang: int, code: np.ndarray, b: int = 6, size: int = CLASSES) -> np.ndarray:
    """log2 p of each trigram code: the longest seen n-gram's, after the back-off weights of longer contexts."""
    out = np.zeros(code.size, np.float64)
    left = np.arange(code.size)
    for order in (3, 2, 1):
        own = code[left] & ((1 << (b * order)) - 1)
        hit, value = _find(m.grams, m.log_p, _key(lang, order, own))
        out[left[hit]] += value[hit]
        left, own = left[~hit], own[~hit]
        out[left] += _find(m.contexts, m.log_back, _key(lang, order - 1, own >> b))[1]
    out[left] -= np.log2(size)
    return out


class Rules(NamedTuple):
    """All that scoring needs: languages' numbers, alphabets and models."""

    known: dict[str | None, int]
    letters: dict[int, tuple[int, ...]]
    models: dict[int, Model]


class Scorer:
    """Looks the codes of each language's CLASSES lowest classes up in its sorted arrays once, then reads its table;
    other codes, and all those beyond LANGUAGES tables, are looked up where they occur."""

    def __init__(self, rules: Rules):
        self.rules, self.tables = rules, {}

    def bits(self, lang: int, code: np.ndarray) -> np.ndarray:
        letters = self.rules.letters.get(lang, ())
        b, size = bits_of(letters), size_of(letters)
        if lang not in self.rules.models:
            return np.full(code.size, -np.log2(size), np.float32)
        look = lambda x: log_probability(self.rules.models[lang], lang, x, b, size).astype(np.float32)
        if lang not in self.tables:
            if len(self.tables) >= LANGUAGES:
                return look(code)
            low = np.arange(CLASSES, dtype=np.int64)
            self.tables[lang] = look(((low[:, None, None] << 2 * b) | (low[:, None] << b) | low).ravel())
        if b == 6:
            return self.tables[lang][code]
        x, y, z = code >> 2 * b, code >> b & (1 << b) - 1, code & (1 << b) - 1
        own = (x | y | z) < CLASSES
        out = self.tables[lang][np.where(own, x << 12 | y << 6 | z, 0)]
        out[~own] = look(code[~own])
        return out

    def log_perplexity(self, langs: list[int], texts: list[str]) -> np.ndarray:
        """log2 of each text's perplexity per character, its end included."""
        out = np.empty(len(texts))
        by: dict[int, list[int]] = {}
        for k, lang in enumerate(langs):
            by.setdefault(lang, []).append(k)
        for lang, own in by.items():
            code, first = codes([texts[k] for k in own], self.rules.letters.get(lang, ()))
            out[own] = -np.add.reduceat(self.bits(lang, code), first[:-1], dtype=np.float64) / np.diff(first)
        return out


_SCORERS: dict[str, Scorer] = {}


def _scorer(name: str, shared) -> Scorer:
    """One scorer of each fit in a worker; name: the fit's own, which no other has."""
    if name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[name] = Scorer(shared.value)
    return _SCORERS[name]


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Rules:
    """Counted by all tasks, smoothed by one task a language; the driver gets each language's sorted arrays."""
    known = numbers(df, lang_col)
    letters = alphabets(df, known, id_col, text_col, lang_col)

    sizes = {lang: (bits_of(x), size_of(x)) for lang, x in letters.items()}

    def smoothed(pdf: pd.DataFrame) -> pd.DataFrame:  # a language's different trigrams
        lang = int(pdf["lang"].iloc[0])
        m = model_of(lang, pdf["code"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), *sizes.get(lang, ()))
        return pd.DataFrame([(lang, *(x.tobytes() for x in m))], columns=["lang", *Model._fields])

    rows = counts(df, known, letters, id_col, text_col, lang_col).groupBy("lang").applyInPandas(smoothed, "lang int, grams binary, log_p binary, contexts binary, log_back binary").collect()
    kinds = (np.uint64, np.float32, np.uint64, np.float32)
    return Rules(known, letters, {r["lang"]: Model(*[np.frombuffer(r[c], t) for c, t in zip(Model._fields, kinds)]) for r in rows})


# --- the rules

def base_columns(texts: list[str]) -> list[tuple[int, int, int, int, int, bool]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed of each text."""
    w = words(texts, lower=False)
    code, first = windows(w, REPEAT_WORDS)
    points = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    chars = np.concatenate([[0], np.cumsum(points[w.end] - points[w.start])])
    out = []
    for k, t in enumerate(texts):
        a, b = int(w.first[k]), int(w.first[k + 1])
        raw = t.encode()
        lines = [x for x in raw.split(b"\n") if x.strip(b" \t\r\x0b\x0c")] if b"\n" in raw else ()
        own, repeated = code[first[k] : first[k + 1]], 0
        ranked = np.sort(own)
        same = ranked[1:] == ranked[:-1]
        if same.any():
            _, inverse, n = np.unique(own, return_inverse=True, return_counts=True)
            covered = np.zeros(b - a + 1, np.int64)
            at = np.flatnonzero(n[inverse] > 1)
            np.add.at(covered, at, 1)
            np.add.at(covered, at + REPEAT_WORDS, -1)
            repeated = int((np.cumsum(covered)[:-1] > 0).sum())
        n_words = b - a
        out.append((n_words, int(chars[b] - chars[a]), len(raw) - len(raw.translate(None, _SYMBOLS.encode())), len(lines) - len(set(lines)), repeated, n_words < MIN_WORDS or 100 * repeated > REPEAT_PERCENT * n_words))
    return out


_MEASURES = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, lang int, size long, log_perplexity double"


def measured(df: DataFrame, rules: Rules, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The base columns, lang and log_perplexity (doublings) of every row."""
    ready(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(rules)
    longs = [(c, pa.int64()) for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    schema = pa.schema([*longs, ("base_failed", pa.bool_()), ("lang", pa.int32()), ("size", pa.int64()), ("log_perplexity", pa.float64())])

    def run(batches):
        scorer = Scorer(shared.value)
        for ids, langs, texts in _runs(batches, scorer.rules.known):
            yield rows_to_batch(schema, [ids, *zip(*base_columns(texts)), langs, [len(t) for t in texts], scorer.log_perplexity(langs, texts)])

    return _read(df, id_col, text_col, lang_col).mapInArrow(run, _MEASURES)


def bands(rows: DataFrame, width: float = WIDTH, least: float = LEAST) -> dict[int, tuple[float, float]]:
    """Each language's (median, reach): from a histogram over all rows that pass the base rules, of fixed size."""
    bins = rows.filter(~F.col("base_failed")).groupBy("lang", F.floor(F.col("log_perplexity") * STEPS).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    by: dict[int, list[tuple[int, int]]] = {}
    for lang, b, n in bins.collect():
        by.setdefault(lang, []).append((b, n))
    out = {}
    for lang, h in by.items():
        h.sort()
        at, n = np.array([b for b, _ in h]), np.cumsum([n for _, n in h])
        q = [(at[int(np.searchsorted(n, f * n[-1]))] + 0.5) / STEPS for f in (0.25, 0.5, 0.75)]
        out[lang] = (float(q[1]), max(least, float(width * (q[2] - q[0]) / 2)))
    return out


def _inside(limits: dict[int, tuple[float, float]], within: str = "") -> Column:
    """Whether the row's log perplexity lies within its language's band, wider for short texts. ``within``: the
    struct that holds the row's measures, and a dot."""
    if not limits:
        return F.lit(True)
    got = lambda name: F.col(within + name)

    def pick(k: int) -> Column:
        return F.get(F.array(*[F.lit(limits[lang][k] if lang in limits else None).cast("double") for lang in range(max(limits) + 1)]), got("lang"))

    reach = pick(1) * (1 + F.sqrt(F.lit(SMALL) / (got("size") + 1)))
    return F.coalesce(F.abs(got("log_perplexity") - pick(0)) <= reach, F.lit(True))


def judged(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Every row's base columns, base_failed, kept, and its perplexity."""
    rows = cut(measured(df, fit(df, id_col, text_col, lang_col), id_col, text_col, lang_col))
    kept = ~F.col("base_failed") & _inside(bands(rows))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), F.pow(F.lit(2.0), "log_perplexity").alias("perplexity"))


def good_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """df without the rejected rows: texts are scored where they lie, so none of them moves."""
    ready(df.sparkSession)
    rules = fit(df, id_col, text_col, lang_col)
    limits = bands(measured(df, rules, id_col, text_col, lang_col))
    shared, name = df.sparkSession.sparkContext.broadcast(rules), uuid.uuid4().hex

    @F.pandas_udf("base_failed boolean, lang int, size long, log_perplexity double")
    def look(text, lang):
        out, scorer = [], _scorer(name, shared)
        columns = [pa.array(range(len(text)), pa.int64()), pa.array(lang, pa.string()), pa.array(text.fillna(""), pa.string())]
        for _, langs, texts in _runs([pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang", "text"])], scorer.rules.known):
            out += zip([r[-1] for r in base_columns(texts)], langs, [len(t) for t in texts], scorer.log_perplexity(langs, texts).tolist())
        return pd.DataFrame(out, columns=["base_failed", "lang", "size", "log_perplexity"])

    seen = fresh(df, "measures")
    rows = df.withColumn(seen, look(F.col(text_col).cast("string"), F.col(lang_col).cast("string")))
    return rows.filter(~F.col(f"{seen}.base_failed") & _inside(limits, f"{seen}.")).drop(seen)
