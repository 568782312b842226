"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text: one on whole ordinary texts, one on windows of toxic text.
A window is a word between blanks; those of toxic texts are taken that begin with, or are, letters which toxic texts
use more than ordinary ones do (a test of proportions over documents, for every beginning of a word), so that
families of inflected or invented words count as well as single ones; copies and near copies count once. zstandard's trainer chooses what of them
enters the dictionary; windows that it leaves without a distance are appended as they are. What ordinary training
words share with that dictionary by chance is added to the ordinary one, ROUNDS times. Every word of a text
is compressed after the same lead, before the same tail, with the ordinary dictionary and with the ordinary and the
toxic one, each searched whole whatever its size; the difference of the lengths is the window's distance. The largest distance, the number of windows beyond
a threshold, their sum and their share go through a logistic calibration fitted on labelled rows that trained no
dictionary, shifted so that 0.5 is the threshold that separates those rows best at a bounded rate of false alarms.

Fitting uses a bounded sample of labelled rows: ``per_class`` of each label (the lowest hashes of the id) among
those of at most ``most_bytes`` of text, whatever the input's size; the driver holds at most 2 x per_class x
most_bytes. Scores cover all whole texts. An id with several labels counts as toxic if one says so, an id with
several texts gives the one that sorts first. Null texts count as empty; texts without words get the score of no
distance; without rows of both labels, or without a word that tells them apart, every score is 0. An empty table
gives an empty one; repeated rows get equal scores; of equally good thresholds the lowest is taken.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import id_crc, id_text, mix, ready, rows_to_batch, texts_of

PER_CLASS = 2000
MOST_BYTES = 32768
FAR = 3  # bytes of distance that count
ORDINARY_BYTES = 32000
LEAD, TAIL = 48, 24  # bytes about a window
ROOM = 1 << 14  # bytes that a compressor's window has beside its dictionary
SHORTEST = 4  # letters of a word's beginning that are tested
LEAST_Z = 5.0
FALSE_ALARMS = 0.01
SKETCH = 8
ROUNDS = 2
MEMORY = 1 << 16  # words whose distance a worker remembers

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def tokens(text: str) -> list[bytes]:
    return text.encode().translate(_LETTERS).split()


class Model(NamedTuple):
    ordinary: bytes
    toxic: bytes
    center: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]  # empty: no model could be fitted
    bias: float


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Searches for the longest match, of six bytes at least, in all of the content: the window and the tables of
    positions grow with it, as a dictionary that does not fit is left unread."""
    bare = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    log = max(17, (len(content) + ROOM).bit_length())
    how = zstandard.ZstdCompressionParameters(window_log=log, chain_log=min(log, zstandard.CHAINLOG_MAX), hash_log=min(log, zstandard.HASHLOG_MAX), search_log=6, min_match=6, target_length=1, strategy=zstandard.STRATEGY_GREEDY, **bare)
    data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=how)


@functools.lru_cache(maxsize=2)
def distance(ordinary: bytes, toxic: bytes):
    """The function from a word to its distance. The lead and the tail, which both dictionaries hold, give every
    window a match before it and enough bytes behind it: a compressor looks for none in a block's last ones."""
    plain, marked = _compressor(ordinary).compress, _compressor(ordinary + toxic).compress
    lead, tail = ordinary[len(ordinary) // 2 :][:LEAD] + b" ", b" " + ordinary[len(ordinary) // 4 :][:TAIL]

    @functools.lru_cache(maxsize=MEMORY)
    def of(word: bytes) -> int:
        x = lead + word + tail
        return len(plain(x)) - len(marked(x))

    return of


def features(text: str, ordinary: bytes, toxic: bytes) -> tuple[float, float, float, float]:
    of = distance(ordinary, toxic)
    d = [of(w) for w in tokens(text)]
    far = [x for x in d if x >= FAR]
    return (float(max(d)), math.log1p(len(far)), math.log1p(sum(far)), 100 * len(far) / len(d)) if d else (0.0,) * 4


def _beginnings(words: set[bytes]) -> set[bytes]:
    """The words, each with a blank behind it, and their beginnings."""
    return {w + b" " for w in words} | {w[:n] for w in words for n in range(SHORTEST, len(w))}


def distinct(texts: list[list[bytes]]) -> list[list[bytes]]:
    """The texts (as words) without copies and near copies of earlier ones, so that their words count once: copies
    agree in half of SKETCH minima over hashed runs of five words with one that counts."""
    kept = np.empty((len(texts), SKETCH), np.uint64)  # the minima of those that count
    factors = np.random.default_rng(0).integers(1, 1 << 63, SKETCH, dtype=np.uint64) | np.uint64(1)
    out = []
    for words in texts:
        runs = {b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
        code = np.array([zlib.crc32(r) | zlib.crc32(r, 1) << 32 for r in runs], np.uint64)
        least = np.array([mix(code * f).min() for f in factors])
        if ((kept[: len(out)] == least).sum(1) >= SKETCH // 2).any():
            continue
        kept[len(out)] = least
        out.append(words)
    return out


def marks(toxic: list[set[bytes]], ordinary: list[set[bytes]]) -> dict[bytes, float]:
    """The beginnings of words that toxic texts use more, with the test's z; of each text, its words."""
    # only what several toxic texts begin with is counted by name; hashes tell which, in a fraction of the memory
    codes, n_texts = np.unique(np.concatenate([np.fromiter(map(hash, _beginnings(words)), np.int64) for words in toxic]), return_counts=True)
    often = set(codes[n_texts >= 3].tolist())
    first = Counter(h for words in toxic for h in _beginnings(words) if hash(h) in often)
    seen = [Counter(h for words in ordinary for h in _beginnings(words) if h in first), first]
    n = [len(ordinary), len(toxic)]
    out = {}
    for h, k in seen[1].items():
        other = seen[0][h]
        if k >= 3 and other / n[0] < 0.2 * k / n[1]:
            p = (k + other) / sum(n)
            z = (k / n[1] - other / n[0]) / math.sqrt(p * (1 - p) * (1 / n[0] + 1 / n[1]) + 1e-12)
            if z >= LEAST_Z:
                out[h] = z
    return out


def _trained(samples: list[bytes], size: int, segment: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        return b"".join(samples)[-size:]


def dictionaries(rows: list[tuple[str, int]]) -> tuple[bytes, bytes] | None:
    """The ordinary and the toxic dictionary of (text, label) rows; None where nothing tells the labels apart."""
    same: dict[bytes, bytes] = {}  # one object for each word
    shared = lambda text: [same.setdefault(w, w) for w in tokens(text)]
    own = [distinct([words for text, label in rows if label == k and (words := shared(text))]) for k in (0, 1)]
    if not all(own):
        return None
    strong = marks([set(x) for x in own[1]], [set(x) for x in own[0]])

    def z(w: bytes) -> float:
        return max(strong.get(h, 0.0) for h in _beginnings({w}))

    windows = sorted((x, w) for w in {w for words in own[1] for w in words} if (x := z(w)))
    if not windows:
        return None
    ordinary = _trained([b" " + b" ".join(x) + b" " for x in own[0]], ORDINARY_BYTES, 64)
    toxic = _trained([b" " + w + b" " for _, w in windows], max(512, sum(len(w) + 2 for _, w in windows)), 16)
    others = sorted({w for words in own[0] for w in words} - {w for _, w in windows})

    def whole(toxic: bytes) -> bytes:
        """With the windows that have no distance yet, the strongest last, nearest to a window."""
        of = distance(ordinary, toxic)
        return toxic + b"".join([b" " + w + b" " for _, w in windows if of(w) < FAR])

    toxic = whole(toxic)
    for _ in range(ROUNDS):
        # what ordinary words share with the toxic dictionary by chance goes to the ordinary one
        of = distance(ordinary, toxic)
        if not (wrong := [w for w in others if of(w) >= FAR]):
            break
        ordinary = b"".join([b" " + w + b" " for w in wrong]) + ordinary
        toxic = whole(toxic)
    return ordinary, toxic


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit_rows(rows: list[tuple[int, str, int]]) -> Model:
    """From (doc_id, text, label): two thirds train the dictionaries, the others the calibration."""
    rows = sorted(rows, key=lambda r: (r[0], r[1]))
    fold = [id_crc(r[0]) // 5 % 3 for r in rows]
    none = Model(b"", b"", (), (), (), 0.0)
    made = dictionaries([r[1:] for r, f in zip(rows, fold) if f])
    rest = [r for r, f in zip(rows, fold) if not f]
    y = np.array([r[2] for r in rest], float)
    if made is None or not y.size or not 0 < y.sum() < y.size:
        return none
    x = np.array([features(r[1], *made) for r in rest])
    center, scale = x.mean(0), x.std(0) + 1e-9
    weights, bias = _logistic((x - center) / scale, y)
    out = Model(*made, tuple(center.tolist()), tuple(scale.tolist()), tuple(weights.tolist()), bias)
    # move 0.5 to the cut that finds most toxic rows with few false alarms
    logit = ((x - center) / scale) @ weights + bias
    order = np.unique(logit)
    cuts = (order[1:] + order[:-1]) / 2 if order.size > 1 else order
    tpr = np.array([(logit[y == 1] >= c).mean() for c in cuts])
    fpr = np.array([(logit[y == 0] >= c).mean() for c in cuts])
    worth = np.where(fpr <= FALSE_ALARMS, tpr - fpr, -1.0)
    if cuts.size and worth.max() > 0:
        out = out._replace(bias=bias - float(cuts[int(np.argmax(worth))]))
    return out


def score(text: str, model: Model) -> float:
    if not model.weights:
        return 0.0
    z = sum(w * (f - c) / s for w, f, c, s in zip(model.weights, features(text, model.ordinary, model.toxic), model.center, model.scale)) + model.bias
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def training_rows(df: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The bounded sample: doc_id, text, toxic of labelled rows whose crc32 of the id is no multiple of 5."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    own = own.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = id_text(df)
    sizes = rows.groupBy("doc_id").agg(F.max(F.octet_length("text")).alias("bytes")).filter(F.col("bytes") <= most_bytes)
    own = own.join(sizes, "doc_id")  # ids and sizes only
    some = [own.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    picked = some[0].unionAll(some[1]).select("doc_id", "toxic")
    return rows.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")  # at most 2 x per_class rows


def fit(df: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_bytes: int = MOST_BYTES) -> Model:
    return fit_rows([tuple(r) for r in training_rows(df, labels, per_class, most_bytes).select("doc_id", "text", "toxic").collect()])


def scores(df: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    ready(df.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        for ids, texts in texts_of(batches):
            s = [score(t, model) for t in texts]
            yield rows_to_batch(schema, [ids, [id_crc(i) % 5 == 0 for i in ids], s, [int(x >= 0.5) for x in s]])

    return id_text(df).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def score_of(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def run(texts):
        return texts.fillna("").map(lambda t: score(t, model)).astype(float)

    return run(text)


def ordinary_rows(df: DataFrame, labels: DataFrame) -> DataFrame:
    """df without the rows whose text is predicted toxic."""
    ready(df.sparkSession)
    return df.filter(score_of(F.col("text"), fit(df, labels)) < 0.5)
