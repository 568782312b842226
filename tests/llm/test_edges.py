"""Every operator's query over tables with nulls, empty and long texts, repeats, clashing columns, and no rows."""

import pytest

from tallywell.llm.queries import queries

LONG = "wörd " * 40_000 + "x" * 60_000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n int, score double, kept boolean, entity string, class string, bucket int, __id long, `n_words` int"


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    out = {}
    base = [(1, "Plain words here, nothing else. " * 10), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, "Plain words here, nothing else. " * 10), (6, "Plain words here, nothing else. " * 10), (None, "no id, but mail a@b.cd"), (7, "one"), (8, "\x00\x01\x02 odd   bytes 😀 " * 5), (9, "AAAA " * 30)]
    for name, rows in (("some", base), ("none", [])):
        folder = str(tmp_path_factory.mktemp(name))
        spark.createDataFrame([(i, t, "en" if i and i < 8 else None, "s", 0, 1, 0.5, True, "e", "c", 1, 2, 3) for i, t in rows], SCHEMA).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (6, 0, 1), (None, 1, 1), (3, None, None)] if rows else [], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
        out[name] = folder
    return out


@pytest.mark.parametrize("name", sorted(queries()))
def test_edges(spark, folders, name):
    rows = queries()[name](spark, folders["some"]).collect()
    ids = sorted((r["doc_id"] for r in rows), key=str)
    want = sorted([1, 2, 3, 4, 5, 6, 6, None, 7, 8, 9], key=str)
    if name.startswith("op8"):
        assert set(ids) == set(want) and len(rows) > len(want)
    else:
        assert ids == want
    twins = [tuple(v for c, v in r.asDict().items() if c not in ("slot", "start", "sequence_id", "offset")) for r in rows if r["doc_id"] == 6]
    if not name.startswith("op8"):
        assert twins[0] == twins[1]
    assert queries()[name](spark, folders["none"]).count() == 0


def test_pipeline_edges(spark, folders):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    for folder in folders.values():
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        names = docs.columns
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, folder)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == names
        docs.count()


def test_core_does_not_import_llm():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    names = [".".join(p.relative_to(root).with_suffix("").parts) for p in sorted((root / "tallywell").rglob("*.py")) if "llm" not in p.parts]
    code = f"import sys, importlib\nfor m in {names!r}: importlib.import_module(m.removesuffix('.__init__'))\nassert not [m for m in sys.modules if m.startswith('tallywell.llm')]"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)
