"""The pipeline's run() against the same stages computed plainly, row by row."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from test_llm_operators import brute, lettered, plain_pii, plain_terms

from tallywell.llm import packing, pii, quality, set_join, toxicity

BAD = ["dreadfulfoe", "vilescum", "rottenfool", "nastyworm"]


def test_run_matches_plain_stages(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(11)
    texts, toxic = [], []
    for i in range(260):
        w = lettered(rng, 80).split()
        label = int(i % 3 == 0)
        for _ in range(5 * label):
            w.insert(int(rng.integers(len(w))), str(rng.choice(BAD)))
        if i % 7 == 1:
            w += ["write", "to", f"joe{i}@site.org", "or", "+1 555 0100 200", "soon"]
        texts.append(" ".join(w))
        toxic.append(label)
    texts += [texts[1], texts[2] + " more", "too short", None, "again the same eight words are here now " * 20]
    toxic += [None] * 5
    docs = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic) if t is not None], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    # toxicity
    model = toxicity.fit_rows([(i, texts[i], t) for i, t in enumerate(toxic) if t is not None and zlib.crc32(str(i).encode()) % 5])
    left = [i for i, t in enumerate(texts) if toxicity.score(t or "", model) < 0.5]
    assert len(left) < len(texts)
    # quality rules
    own = [texts[i] or "" for i in left]
    failed = np.array([r[-1] for r in quality.base_columns(own)])
    seen = Counter(c for t in own for c in t if not (c.isupper() or c.isdigit() or c in "#*$%&|<>"))
    letters = tuple(sorted(ord(c) for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[: quality.LETTERS]))
    code = quality.codes([t for t, f in zip(own, failed) if not f], letters)[0]
    rules = quality.Rules({}, {1: letters}, {1: quality.model_of(1, *np.unique(code, return_counts=True))})
    lp = quality.Scorer(rules).log_perplexity([1] * len(own), own)
    bins = sorted(math.floor(x * quality.STEPS) for x in lp[~failed])
    q = [(bins[math.ceil(f * len(bins)) - 1] + 0.5) / quality.STEPS for f in (0.25, 0.5, 0.75)]
    reach = max(quality.LEAST, quality.WIDTH * (q[2] - q[0]) / 2)
    keep = [not f and abs(x - q[1]) <= reach * (1 + math.sqrt(quality.SMALL / (len(t) + 1))) for f, x, t in zip(failed, lp, own)]
    left = [i for i, k in zip(left, keep) if k]
    # near copies
    groups, _ = brute([texts[i] for i in left])
    left = [i for k, i in enumerate(left) if groups[k] == k]
    # personal data, and the words that stand only beside it
    terms = plain_terms([texts[i] for i in left])
    assert any(terms)
    clean = {i: pii.redact(texts[i], [(pii.KINDS[k], s, e) for k, s, e in plain_pii(texts[i])] + [(pii.TERM, a, b) for a, b in own]) for i, own in zip(left, terms)}
    # packing
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*library.encode(t, add_special_tokens=False).ids, packing.END], "<u4") for i, t in clean.items()}

    rows = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(rows["doc_id"]) == set(left) and 100 < len(left) < 200
    assert (1 in left) != (260 in left) or 1 not in left and 260 not in left
    for i, pieces in rows.groupby("doc_id"):
        assert pieces["length"].sum() == ids[i].size
        assert {(s, zlib.crc32(ids[i][s : s + k].tobytes())) for s, k in zip(pieces["start"], pieces["length"])} == set(zip(pieces["start"], pieces["ids_crc32"]))
    for _, s in rows.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]] and s["length"].sum() <= packing.LENGTH


def test_run_tells_all_characters_apart(spark, tmp_path):
    """Words of characters beyond the 59 commonest are judged too: a text with their characters mixed up goes."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(17)
    usual = ["".join(rng.choice([chr(c) for c in (*range(97, 123), *range(0x430, 0x450))], 4)) for _ in range(150)]
    stems = [[chr(0x4E00 + 4 * k + j) for j in range(3)] for k in range(100)]

    def text(mixed):
        own = [[stems[k][j] for j, k in enumerate(rng.integers(0, 100, 3) if mixed else [int(rng.integers(100))] * 3)] for _ in range(40)]
        both = [*map("".join, own), *rng.choice(usual, 60)]
        return " ".join(both[k] for k in rng.permutation(100))

    texts = [text(i == 90) for i in range(120)]
    docs = [(i, t, "zz", "s", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    assert 90 not in kept and len(kept) >= 117


def test_toxic_stage_with_many_terms(spark, tmp_path):
    """More toxic words than 128 KiB hold: what was learned is looked for whole, so texts full of them go."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(23)
    usual = ["".join(x) for x in rng.choice(list("abcdefghijklmnop"), (3000, 6))]
    bad = ["".join(x) for x in rng.choice(list("ghijklmnopqrstuvwxyz"), (20_000, 9))]
    n = [0 if i % 3 else 1 if i % 2 else 3000 for i in range(1500)]
    rows = [(i, " ".join([*rng.choice(usual, 40), *rng.choice(bad, k)]), int(k > 0)) for i, k in enumerate(n)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    left = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, str(tmp_path)).select("doc_id").collect()}
    assert not any(k > 1 for i, k in enumerate(n) if i in left) and left.issuperset(i for i, k in enumerate(n) if not k)


def test_near_copies_whose_shingles_fill_few_segments(spark):
    """Texts made so that their shingles fall into 3 of 128 segments, all of which three more words change."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    salt = np.uint64(5 * int(set_join._B) & (1 << 64) - 1)

    def text(segments, tag):
        w = [f"{tag}{k}" for k in range(4)]
        for n, own in enumerate([segments] * 16 + [[x] for x in segments]):
            tried = [f"{tag}x{n}x{k}" for k in range(3000)]
            code = np.concatenate(set_join.sets([" ".join([*w[-4:], x]) for x in tried]))
            w.append(tried[int(np.flatnonzero(np.isin((set_join.mix(code ^ salt) >> np.uint64(11)) % np.uint64(128), own))[0])])
        return " ".join(w)

    long = [text(own, tag) for own, tag in (([3, 50, 99], "a"), ([7, 8, 120], "b"), ([3, 50, 99], "c"))]
    texts = [*(" ".join(t.split()[:20]) for t in long), *long, *(lettered(np.random.default_rng(k), 30) for k in range(20))]
    groups, _ = brute(texts)
    assert groups[:6] == [0, 1, 2, 0, 1, 2]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    left = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, docs, "").select("doc_id").collect()}
    assert left == {i for i, g in enumerate(groups) if i == g}
