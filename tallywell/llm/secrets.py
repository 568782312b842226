"""Secret scans with DataFrame functions only: fixed patterns and a randomness test battery.

Candidate runs are long runs of encoding characters outside the fixed patterns' matches, cut at equals signs that
are no padding at the end; a run of both base64 alphabets' signs is cut at the signs of one, whichever leaves the
longer part. Each run's encoding (hex, base32, base62, base64 and so on) gives an alphabet, and three tests ask
whether its characters look uniform and independent: chi-squared over the alphabet, Wald-Wolfowitz runs about the
alphabet's middle, and the lag-one serial correlation; Bonferroni's rule combines them in one p-value. Within bands
of length the Benjamini-Hochberg rule turns these p-values into runs that are declared not random, so that few
random ones are lost whatever the corpus holds. The others are discoveries if they are also too unlikely as ordinary
text: the likelihood ratio of the uniform alphabet against the letters of the corpus bounds the p-value of "this is
ordinary text" (p <= 1 / ratio; short runs cannot reach it), and the same rule controls its false discoveries in the
band. Both rules need counts of runs by band, p-value and ratio only, tables of fixed size.

Work grows with the text: places come from running sums in blocks, and a text is rewritten only where a pattern
matches. Null texts are empty; an empty table gives an empty one; repeated rows give repeated results; of equally
long cuts the one at - and _ is taken; spans that start together come in the order of kinds. Only the id and text
columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import cut

# Kinds and patterns, and the lengths that a match must have.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
RANDOM = "random"
RUN = r"[A-Za-z0-9+/_-]{20,}(?:=++(?![A-Za-z0-9+/_-]))?"
LEAST = 20  # characters of a run

# Encodings: pattern and alphabet, the first that fits counts; signs of padding are no part of it.
ENCODINGS = (
    ("digits", "^[0-9]+$", "0123456789"),
    ("hex", "^[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", "^[0-9A-F]+$", "0123456789ABCDEF"),
    ("lower", "^[a-z]+$", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", "^[A-Z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "^[a-z0-9]+$", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("base62", "^[A-Za-z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
LETTERS = "abcdefghijklmnopqrstuvwxyz"
LOST = 0.01  # of the runs declared not random, the share that is random
RATE = 0.01  # of false discoveries
WORDS = 0.9  # weight of the corpus's letters in the model of ordinary text; the rest is uniform
BINS = 2000  # of the log ratio and of the log p-value, a tenth each
BANDS = 12  # of length, by powers of two
STRIDE = 512  # numbers that one running sum folds

_SPANS = "array<struct<s:long,e:long,m:string>>"


def _let(x: Column, body: Callable[[Column], Column]) -> Column:
    """body(x), with x computed once however often the body names it."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def running(values: Column) -> Column:
    """The sums of the numbers before each one. Blocks of STRIDE are folded apart, since a fold copies its array at
    every step."""

    def folded(xs: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<long>").alias("at"))
        return F.aggregate(xs, zero, lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["at"], F.array(a["sum"])).alias("at")))

    def blocks(xs: Column) -> Column:
        last = F.greatest(F.floor((F.size(xs) - 1) / STRIDE).cast("int"), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda k: folded(F.slice(xs, k * STRIDE + 1, F.lit(STRIDE))))

    def lifted(bs: Column) -> Column:
        zipped = F.arrays_zip(bs.alias("b"), folded(F.transform(bs, lambda b: b["sum"]))["at"].alias("base"))
        return F.flatten(F.transform(zipped, lambda z: F.transform(z["b"]["at"], lambda x: x + z["base"])))

    return _let(_let(values, blocks), lifted)


def _located(pieces: Column, first: Column, gap: int) -> Column:
    """Pieces (a lambda's variable) with their places, where each follows the one before after ``gap`` characters."""
    at = running(F.transform(pieces, lambda m: (F.length(m) + gap).cast("long")))
    zipped = F.arrays_zip(pieces.alias("m"), at.alias("at"))
    return F.transform(zipped, lambda x: F.struct((first + x["at"]).alias("s"), (first + x["at"] + F.length(x["m"])).alias("e"), x["m"].alias("m")))


def _marked(text: Column, pattern: str) -> Column:
    """The text cut before each leftmost non-overlapping match, which ends at a control character; empty without one.
    The characters that mark are replaced in the text first by another that no pattern here can match."""
    clean = F.translate(text, "\x01\x02", "\x03\x03")
    parts = F.split(F.regexp_replace(clean, f"({pattern})", "\x01$1\x02"), "\x01")
    return F.when(text.rlike(pattern), parts).otherwise(F.array().cast("array<string>"))


def _match(part: Column) -> Column:
    return F.substring_index(part, "\x02", 1)


def _after(parts: Column) -> Column:
    return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))


def _found(parts: Column) -> Column:
    """array<struct<s long, e long, m string>>: the matches in parts, in code points."""

    def spans_of(own: Column) -> Column:
        first = F.length(F.get(own, F.lit(0))).cast("long")
        at = running(F.transform(_after(own), lambda x: (F.length(x) - 1).cast("long")))
        zipped = F.arrays_zip(F.transform(_after(own), _match).alias("m"), at.alias("at"))
        spans = F.transform(zipped, lambda z: F.struct((first + z["at"]).alias("s"), (first + z["at"] + F.length(z["m"])).alias("e"), z["m"].alias("m")))
        return F.when(F.size(own) > 1, spans).otherwise(F.array().cast(_SPANS))

    return _let(parts, spans_of)


def matches(text: Column, pattern: str) -> Column:
    return _found(_marked(text, pattern))


def _valid(kind: str, m: Column) -> Column:
    """Whether a pattern's match counts."""
    if kind == "assign":
        return F.length(F.regexp_extract(m, ASSIGN_VALUE, 1)) >= 8
    return F.length(m) >= (16 if kind == "access" else 32)


def _masked(parts: Column, kind: str) -> Column:
    """The text that parts are of, with each match that counts blotted out, at the same length."""

    def blot(x: Column) -> Column:
        out = lambda m: F.concat(F.when(_valid(kind, m), F.repeat(F.lit("\x03"), F.length(m))).otherwise(m), F.substring(x, F.length(m) + 2, F.length(x)))
        return _let(_match(x), out)

    return _let(parts, lambda own: F.concat(F.get(own, F.lit(0)), F.array_join(F.transform(_after(own), blot), "")))


def candidates(runs: Column) -> Column:
    """The runs; those that mix the signs of both base64 alphabets as their parts between the signs of one."""
    mixed = lambda x: x["m"].rlike("[+/]") & x["m"].rlike("[_-]")
    longest = lambda parts: F.array_max(F.transform(parts, F.length))

    def cut_up(x: Column) -> Column:
        cuts = F.struct(F.split(x["m"], "[_-]").alias("one"), F.split(x["m"], "[+/]").alias("other"))
        best = _let(cuts, lambda c: F.when(longest(c["one"]) >= longest(c["other"]), c["one"]).otherwise(c["other"]))
        return F.filter(_let(best, lambda own: _located(own, x["s"], 1)), lambda y: F.length(y["m"]) >= LEAST)

    return F.flatten(F.transform(runs, lambda x: F.when(mixed(x), cut_up(x)).otherwise(F.array(x))))


def found(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, assign, access, hex (matches), runs (candidates of the battery), letters (counts in the text)."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("masked", F.col("text"))
    for kind, pattern in zip(KINDS, (ASSIGN, ACCESS, HEX)):
        good = F.filter(matches(F.col("text"), pattern), lambda x: _valid(kind, x["m"]))  # noqa: B023
        rows = rows.withColumn(kind, F.transform(good, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))))
        rows = rows.withColumn("masked", F.when((F.size(kind) > 0) & F.col("masked").rlike(pattern), _masked(_marked(F.col("masked"), pattern), kind)).otherwise(F.col("masked")))
    low = F.lower("text")
    counts = F.array(*[(F.length("text") - F.length(F.replace(low, F.lit(c), F.lit("")))).cast("long") for c in LETTERS])
    return rows.select("doc_id", *KINDS, candidates(matches(F.col("masked"), RUN)).alias("runs"), counts.alias("letters"))


def _upper_tail(z: Column) -> Column:
    """The normal distribution's upper tail, within 2e-4."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.least(F.lit(1.5976) * z + F.lit(0.07056) * z * z * z, F.lit(700.0))))


def battery(runs: Column, background: list[float]) -> Column:
    """Each run with n, encoding, p (of the battery, Bonferroni over its tests) and ratio (log likelihood of the
    uniform alphabet against ordinary text)."""
    name = lambda m: F.coalesce(*[F.when(m.rlike(p), F.lit(n)) for n, p, _ in ENCODINGS], F.lit("other"))
    alphabet = lambda m: F.coalesce(*[F.when(m.rlike(p), F.lit(a)) for _, p, a in ENCODINGS], F.lit(""))
    bare = F.transform(runs, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.regexp_replace(x["m"], "=+$", "").alias("m")))
    coded = F.transform(bare, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), name(x["m"]).alias("encoding"), alphabet(x["m"]).alias("alphabet")))
    coded = F.filter(coded, lambda x: F.length(x["alphabet"]) > 0)
    valued = F.transform(
        coded,
        lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), x["encoding"].alias("encoding"), F.length(x["alphabet"]).cast("double").alias("k"), F.length(x["m"]).cast("double").alias("n"), F.transform(F.split(x["m"], ""), lambda c: F.instr(x["alphabet"], c) - 1).alias("v")),
    )
    zero, one = F.lit(0.0), F.lit(1.0)

    def walked(x: Column, mean: Column) -> Column:
        """One pass for runs, and for products of neighbours."""
        start = F.struct(F.lit(-1).alias("last"), one.alias("runs"), zero.alias("product"), zero.alias("square"))

        def step(a: Column, y: Column) -> Column:
            crossed = (a["last"] >= 0) & ((a["last"] * 2 >= x["k"]) != (y * 2 >= x["k"]))
            product = F.when(a["last"] >= 0, (a["last"] - mean) * (y - mean)).otherwise(zero)
            return F.struct(
                y.cast("int").alias("last"),
                (a["runs"] + F.when(crossed, one).otherwise(zero)).alias("runs"),
                (a["product"] + product).alias("product"),
                (a["square"] + (y - mean) * (y - mean)).alias("square"),
            )

        return F.aggregate(x["v"], start, step)

    def counted(x: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), x["k"].cast("int") - 1), lambda c: F.size(F.filter(x["v"], lambda y: y == c)).cast("double"))
        squares = F.aggregate(each, zero, lambda a, y: a + y * y)
        high = F.size(F.filter(x["v"], lambda y: y * 2 >= x["k"])).cast("double")
        walk = _let(F.aggregate(x["v"], zero, lambda a, y: a + y) / x["n"], lambda mean: walked(x, mean))
        same = [x[c].alias(c) for c in ("s", "e", "m", "encoding", "k", "n")]
        return F.struct(*same, (x["k"] / x["n"] * squares - x["n"]).alias("chi"), high.alias("high"), walk.alias("walk"))

    def tested(x: Column) -> Column:
        df = x["k"] - 1
        z_chi = (F.pow(F.greatest(x["chi"], F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - F.lit(2.0) / (9 * df))) / F.sqrt(F.lit(2.0) / (9 * df))
        low = x["n"] - x["high"]
        two = 2 * x["high"] * low
        spread = two * (two - x["n"]) / (x["n"] * x["n"] * (x["n"] - 1))
        z_runs = F.when(spread > 0, F.abs(x["walk"]["runs"] - (two / x["n"] + 1)) / F.sqrt(spread)).otherwise(F.lit(9.0))
        z_serial = F.when(x["walk"]["square"] > 0, F.abs(x["walk"]["product"] / x["walk"]["square"]) * F.sqrt(x["n"])).otherwise(F.lit(9.0))
        p = F.least(one, 3 * F.least(_upper_tail(z_chi), 2 * _upper_tail(z_runs), 2 * _upper_tail(z_serial)))
        letters = F.array(*map(F.lit, background))
        def ordinary(c):
            at = F.instr(F.lit(LETTERS), F.lower(c))
            # a letter's share is halved where the alphabet has both cases
            share = F.coalesce(F.get(letters, at - 1), zero) * F.when(x["k"] >= 62, F.lit(0.5)).otherwise(one)
            return F.lit(WORDS) * F.when(at > 0, share).otherwise(zero) + F.lit(1 - WORDS) / x["k"]
        ratio = F.aggregate(F.split(x["m"], ""), zero, lambda a, c: a - F.log(ordinary(c))) - x["n"] * F.log(x["k"])
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), x["encoding"].alias("encoding"), x["n"].alias("n"), p.alias("p"), ratio.alias("ratio"))

    return F.transform(F.transform(valued, counted), tested)


def _band(n: Column) -> Column:
    return F.least(F.floor(F.log2(n)), F.lit(BANDS)).cast("int")


def _bin(x: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.floor(x * 10), F.lit(BINS))).cast("int")


def discoveries(counts: dict[int, int], tests: int, rate: float) -> int | None:
    """The least bin that the Benjamini-Hochberg rule takes, of so many tests; counts: bin -> tests in it. A p-value
    is at most exp(-bin / 10), and that bound stands for it."""
    above, least = 0, None
    for b in sorted(counts, reverse=True):
        above += counts[b]
        if b and math.exp(-b / 10) <= rate * above / tests:
            least = b
    return least


def thresholds(tested: DataFrame, lost: float = LOST, rate: float = RATE) -> dict[int, tuple[int, int]]:
    """band -> (from which bin of the battery's p-value a run is declared not random, from which bin of the ratio one
    that is left is a discovery): by the Benjamini-Hochberg rule, from counts of fixed size."""
    x = tested.select(F.explode("tested").alias("x")).select(_band(F.col("x.n")).alias("band"), _bin(-F.log(F.greatest(F.col("x.p"), F.lit(1e-300)))).alias("p"), _bin(F.col("x.ratio")).alias("ratio"))
    by: dict[int, list[tuple[int, int, int]]] = {}
    for band, p, ratio, n in x.groupBy("band", "p", "ratio").agg(F.count(F.lit(1))).collect():
        by.setdefault(band, []).append((p, ratio, n))
    out = {}
    for band, rows in by.items():
        tests = sum(n for *_, n in rows)
        p, ratio = Counter(), Counter()
        for at, _, n in rows:
            p[at] += n
        strange = discoveries(p, tests, lost)
        strange = BINS + 1 if strange is None else strange
        for at, r, n in rows:
            ratio[r if at < strange else 0] += n
        least = discoveries(ratio, tests, rate)
        out[band] = (strange, BINS + 1 if least is None else least)
    return out


def spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lost: float = LOST, rate: float = RATE) -> DataFrame:
    """doc_id, assign, access, hex, random: arrays of spans of every row."""
    base = cut(found(df, id_col, text_col))
    sums = base.agg(*[F.sum(F.get("letters", F.lit(k))).alias(c) for k, c in enumerate(LETTERS)]).first()
    total = sum((x or 0) + 1 for x in sums)
    tested = cut(base.select("doc_id", *KINDS, battery(F.col("runs"), [((x or 0) + 1) / total for x in sums]).alias("tested")))
    limits = thresholds(tested, lost, rate)

    def limit(n: Column, k: int) -> Column:
        return F.coalesce(*[F.when(_band(n) == b, F.lit(v[k])) for b, v in sorted(limits.items())], F.lit(BINS + 1))

    good = F.filter("tested", lambda x: (_bin(-F.log(F.greatest(x["p"], F.lit(1e-300)))) < limit(x["n"], 0)) & (_bin(x["ratio"]) >= limit(x["n"], 1)))
    return tested.select("doc_id", *KINDS, F.transform(good, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias(RANDOM))


def _joined(kinds: tuple[str, ...]) -> Column:
    """kind:start:end by start, then kind as listed."""
    def ranked(n: int, kind: str) -> Column:
        return F.transform(kind, lambda x: F.struct(x["s"].alias("s"), F.lit(n).alias("n"), x["e"].alias("e")))

    rows = F.concat(*[ranked(n, k) for n, k in enumerate(kinds)])
    return F.array_join(F.transform(F.array_sort(rows), lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, kinds)), x["n"] + 1), x["s"], x["e"])), ",")


def digest(found_spans: DataFrame) -> DataFrame:
    return found_spans.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(_joined(KINDS).cast("binary"), 256).alias("base_sha256"), _joined((*KINDS, RANDOM)).alias("spans"))
