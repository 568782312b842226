import json
import zipfile

import pytest

from tallywell.sources import files, ingest
from tallywell.sources.store import Store, truncation
from tallywell.streaming.pages import append_pages


@pytest.mark.parametrize(
    ("answer", "want"),
    [
        ([{"type": "text", "text": '[{"a": 1}]'}], [{"a": 1}]),
        ({"content": [{"type": "text", "text": '{"items": [{"a": {"b": 2, "links": []}, "links": 3}]}'}]}, [{"a.b": 2}]),
        ('{"columns": [{"name": "x"}, "y"], "rows": [[1, 2], [3, 4]]}', [{"x": 1, "y": 2}, {"x": 3, "y": 4}]),
        ({"structuredContent": {"deep": {"deeper": [{"q": [1]}]}}}, [{"q": "[1]"}]),
        ([[1, 2]], [{"c0": 1, "c1": 2}]),
        (["a", "b"], [{"value": "a"}, {"value": "b"}]),
        ([{"name": "top", "children": [{"name": "leaf", "v": 1}]}], [{"section": "", "name": "top"}, {"section": "top", "name": "leaf", "v": 1}]),
        ({"one": 1}, [{"one": 1}]),
    ],
)
def test_extract(answer, want):
    assert ingest.extract(answer).rows == want


def test_paging_and_errors():
    got = ingest.extract({"data": [{"a": 1}], "totalResults": 9, "hasNextPage": True, "pageIndex": 0, "numberOfPages": 5})
    assert got.paging == {"more": True, "total": 9, "index": 0, "pages": 5} and truncation(1, got.paging) == "1 of 9 rows"
    assert ingest.error_of({"success": False, "message": "no"}) == "no" and ingest.error_of('{"status": 403, "detail": "stop"}') == "stop"
    assert ingest.error_of("Error: bad") and ingest.error_of({"data": []}) is None


@pytest.mark.parametrize("junk", ["", "{", "null", "[]", "[null]", "{}", '{"reportData": 3}', '{"reportData": {"0": null}}', '{"items": "x"}', "12", '{"rows": [[]], "columns": []}', '[{"a": {"b": {"c": {"d": {"e": 1}}}}}]'])
def test_junk_never_raises(spark, junk):
    got = ingest.extract(junk)
    ingest.frame(spark, got).count()


def test_frame_types_and_dates(spark):
    df = ingest.frame(spark, ingest.extract([{"n": 1, "d": "2026-3-2", "s": "27/09/2026", "m": 1}, {"n": 2.5, "d": None, "s": "1/2/2026", "m": "x"}]))
    assert dict(df.dtypes) == {"_ord": "bigint", "n": "double", "d": "string", "s": "string", "m": "string"}
    assert [r["d"] for r in df.orderBy("_ord").collect()] == ["2026-03-02", None] and [r["s"] for r in df.orderBy("_ord").collect()] == ["2026-09-27", "2026-02-01"]
    same = ingest.frame(spark, ingest.extract([{"s": "1/2/2026"}, {"s": "3/4/2026"}]))
    assert [r["s"] for r in same.orderBy("_ord").collect()] == ["1/2/2026", "3/4/2026"]


def test_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    df = spark.createDataFrame([("007", "$5.00"), ("008", "$6.50")], "code string, price string")
    old = store.save(df, created="2026-01-01T00:00:00+00:00")
    new = store.save(df, created="2026-01-20T00:00:00+00:00")
    assert store.find(new.id[2:]).rows == 2 and store.load(new.id).schema["price"].metadata["logical"] == "num"
    assert [r["id"] for r in store.listing().collect()] == [new.id, old.id]
    assert store.cleanup("2026-01-21T00:00:00+00:00") == [old.id] and store.find(old.id) is None and store.find(new.id)


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("=1+1", 1.5, "a\tb"), ("-5", None, 'q"x')], "a string, b double, c string")
    files.write_csv(df, str(tmp_path / "c"), spreadsheet=True, single=True)
    assert {r["a"] for r in files.read_csv(spark, str(tmp_path / "c")).collect()} == {"'=1+1", "-5"}
    files.write_tsv(df, str(tmp_path / "t"))
    assert {r["c"] for r in files.read_tsv(spark, str(tmp_path / "t")).collect()} == {"a b", 'q"x'}
    assert files.write_xlsx(df, str(tmp_path / "x.xlsx")) == 2
    assert "<v>1.5</v>" in zipfile.ZipFile(tmp_path / "x.xlsx").read("xl/worksheets/sheet1.xml").decode()


def test_audit(spark, tmp_path):
    rows = [{"ts": f"2026-01-0{d}T00:00:00Z", "session": "s", "tool": "q", "decision": "deny", "note": "a, b"} for d in (1, 2, 3)]
    (tmp_path / "a.jsonl").write_text("\n".join(map(json.dumps, rows)))
    df = files.audit(spark, str(tmp_path / "a.jsonl"), "s", 2)
    assert df.count() == 2 and {r["rule"]: r["n"] for r in files.denials(df).collect()} == {"a": 2, "b": 2}


def test_stream_of_pages(spark, tmp_path):
    spark.range(3).selectExpr("id", "0 as page").write.parquet(str(tmp_path / "in/0"))
    for want in (3, 3):
        append_pages(spark, str(tmp_path / "in/*"), "id long, page int", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == want
