import json

import pytest

from tallywell.cli import run


def test_results(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = [{"id": k, "customer": f"C{k % 3}", "trandate": f"2026-0{1 + k % 2}-1{k % 9}", "amount": k + 0.5, "currency": "USD"} for k in range(12)]
    ids = []
    for n, part in enumerate((rows[:6], rows[6:])):
        (tmp_path / f"{n}.json").write_text(json.dumps({"data": part, "totalResults": 12}))
        out = run(spark, ["--store", store, "results", "add", str(tmp_path / f"{n}.json"), "--query", json.dumps({"q": "SELECT 1", "pageIndex": n, "pageSize": 6})])
        assert "6 of 12 rows" in out
        ids.append(out.split(":")[0])
    go = lambda *a: run(spark, ["--store", store, "results", *a])
    whole = go("concat", *ids).split(":")[0]
    assert "C0" in go("agg", whole, "--by", "customer", "--sum", "amount") and "72" in go("agg", whole, "--sum", "amount")
    assert go("filter", whole, "--where", "amount > 10", "--cols", "id,amount").splitlines()[0].split() == ["id", "amount"]
    assert go("filter", whole, "--where", "amount > 99") == "No rows match."
    assert go("head", whole, "--sort", "amount", "-n", "1").splitlines()[1].split()[0] == "11"
    assert "2026-01" in go("pivot", whole, "--rows", "customer", "--columns", "trandate", "--sum", "amount")
    assert "only_a" in go("diff", whole, ids[0], "--on", "id", "--cols", "amount")
    assert "amount" in go("profile", whole) and whole in go("list") and "C1" in go("raw", whole, "--term", "c1")
    assert go("export", whole, str(tmp_path / "x.xlsx")) == "12 rows"
    with pytest.raises(ValueError):
        go("agg", whole, "--sum", "id")


def test_sql(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "t"))
    assert run(spark, ["sql", "run", "SELECT TOP 2 id FROM t ORDER BY id DESC", "--table", f"t={tmp_path / 't'}"]).split() == ["id", "4", "3"]
    assert "select-star" in run(spark, ["sql", "lint", "SELECT * FROM t"]) and run(spark, ["sql", "lint", "SELECT a FROM t LIMIT 3", "--lenient"]) == "ok"
