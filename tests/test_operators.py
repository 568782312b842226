import pytest
import pytest
from pyspark.sql import functions as F

from tallywell.operators import catalog, concat, diff, pivot, profile, report, sorting
from tallywell.operators.aggregate import Metric, aggregate
from tallywell.operators.predicate import filtered, search


@pytest.fixture(scope="module")
def invoices(spark):
    rows = [(1, "2026-1-5", "Ação", "USD", "A", 10.5), (2, "2026-1-15", "acao", "USD", "A", 20.0), (3, "1/20/2026", "Beta", "EUR", "B", 5.0), (4, None, " ", "EUR", "B", None)]
    return spark.createDataFrame(rows, "id int, trandate string, customer string, currency string, subsidiary string, amount double")


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("customer = ACAO", [1, 2]), ("amount >= 10.5", [1, 2]), ("amount != 20", [1, 3]), ("customer is null", [4]), ("customer is not null", [1, 2, 3]),
        ("trandate >= 2026-01-15", [2, 3]), ("trandate = 1/20/2026", [3]), ("trandate != 2026-01-20", [1, 2]), ("customer ~ CA", [2]), ("customer !~ b", [1, 2, 4]),
        ("currency = EUR and amount < 9 or id = 1", [1, 3]), ("'customer' = 'beta'", [3]),
    ],
)
def test_where(invoices, text, want):
    assert ids(filtered(invoices, text)) == want


def test_where_errors(invoices):
    for bad in ("nope = 1", "amount >", "amount = = 3", "amount"):
        with pytest.raises(ValueError):
            filtered(invoices, bad).collect()


def test_where_reaches_the_scan(spark, tmp_path):
    spark.range(10).withColumn("v", F.col("id") * 1.5).write.parquet(str(tmp_path / "t"))
    df = filtered(spark.read.parquet(str(tmp_path / "t")), "v > 3 and id < 7")
    assert "GreaterThan(v,3.0)" in (plan := df._jdf.queryExecution().toString()) and "LessThan(id,7)" in plan


def test_sort(spark):
    df = spark.createDataFrame([(1, "a10"), (2, "A9"), (3, " "), (4, "b")], "id int, t string")
    assert [r["id"] for r in sorting.sort_rows(df, "t", order=["id"]).collect()] == [2, 1, 4, 3]
    assert [r["id"] for r in sorting.sort_rows(df, "t", ascending=True, order=["id"]).collect()] == [4, 1, 2, 3]


def test_currency_guard(invoices):
    r = aggregate(invoices.drop("subsidiary"), ["currency"], [Metric("sum", "amount")])
    assert {x["currency"]: x["sum_amount"] for x in r.df.collect()} == {"USD": 30.5, "EUR": 5.0}
    assert r.totals.first()["sum_amount_na"] == "n/a (2 currencies)" and r.warnings
    r = aggregate(invoices.drop("subsidiary"), [], [Metric("sum", "amount"), Metric("max", "amount")])
    assert r.df.first()["sum_amount"] is None and r.df.first()["sum_amount_na"] == "n/a (2 currencies)" and r.df.first()["max_amount"] == 20.0


def test_subsidiary_and_unknown_guards(invoices):
    r = aggregate(invoices.drop("currency"), [], [Metric("sum", "amount")])
    assert r.df.first()["sum_amount_na"] == "n/a (2 subsidiaries)"
    r = aggregate(invoices.drop("currency"), ["subsidiary"], [Metric("sum", "amount")])
    assert {x[0]: x[1] for x in r.df.select("subsidiary", "sum_amount").collect()} == {"A": 30.5, "B": 5.0}
    r = aggregate(invoices.select("id", F.col("amount").alias("foreigntotal")), [], [Metric("sum", "foreigntotal")])
    assert r.df.first()["sum_foreigntotal_na"] == "n/a (currency unknown)"


def test_header_repeat(spark):
    df = spark.createDataFrame([("T1", 1, 100.0), ("T1", 2, 100.0), ("T1", 3, 100.0), ("T2", 1, 50.0)], "tranid string, lineno int, total double")
    assert aggregate(df, [], [Metric("sum", "total")]).df.first()["sum_total_na"] == "n/a (repeats per tranid)"
    assert aggregate(df, ["tranid"], [Metric("max", "total")]).df.count() == 2


def test_refusals(invoices, spark):
    for bad in (Metric("sum", "id"), Metric("sum", "customer"), Metric("median", "amount")):
        with pytest.raises(ValueError):
            aggregate(invoices, [], [bad])
    rep = spark.createDataFrame([("a", 0, False, "section", 1.0), ("b", 1, False, "line", 1.0)], "line string, depth int, is_detail boolean, kind string, Amount double")
    with pytest.raises(ValueError, match="nest"):
        aggregate(rep, [], [Metric("sum", "Amount")])


def test_empty_input(invoices):
    none = invoices.filter("id < 0")
    assert aggregate(none, [], [Metric("sum", "amount")]).df.count() == 0 and aggregate(none, ["currency"]).df.count() == 0


def test_skipped_text(spark):
    df = spark.createDataFrame([("1",), ("2",), ("x",)], "qty string")
    with pytest.raises(ValueError):
        aggregate(df, [], [Metric("sum", "qty")])


def test_big_sum(spark):
    n = 3000
    df = spark.range(n).select((F.col("id") * 37 % 9000 + 0.5).alias("amount"))
    assert aggregate(df, [], [Metric("sum", "amount")]).df.first()[0] == sum(i * 37 % 9000 + 0.5 for i in range(n))


def test_pivot(invoices, spark):
    r = {x["customer"]: x for x in pivot.pivot(invoices.drop("subsidiary"), "customer", "currency", Metric("sum", "amount")).collect()}
    assert r["Beta"]["EUR"] == 5.0 and r["Beta"]["USD"] is None and " " in r
    many = spark.range(40).select((F.col("id") % 20).cast("string").alias("c"), F.lit("x").alias("r"))
    out = pivot.pivot(many, "r", "c")
    assert out.columns[-1] == pivot.OTHER and len(out.columns) == 14 and out.first()[pivot.OTHER] == 16


def test_diff(spark):
    a = spark.createDataFrame([("1", 10.0), ("2", 5.0), ("3", 1.0)], "k string, v double")
    b = spark.createDataFrame([("1.0", 12.0), (" 2 ", 5.0), ("4", 7.0)], "k string, v double")
    d = diff.diff(a, b, ["k"], ["v"])
    got = {r["k"]: (r["v_delta"], r["v_pct"], r["_presence"], r["_outcome"]) for r in d.df.collect()}
    assert got == {"1": (2.0, 20.0, "both", "changed"), "2": (0.0, 0.0, "both", "same"), "3": (None, None, "only_a", "changed"), "4": (None, None, "only_b", "changed")}
    assert d.changed().count() == 3 and diff.diff(a, b, ["k"], ["v"], 2).counts()["same"] == 2
    with pytest.raises(ValueError):
        diff.diff(a, b, ["k"], ["v"], -1)
    assert "not unique" in diff.diff(a.union(a), b, ["k"], ["v"]).warnings[0]


def test_diff_currencies(spark):
    a = spark.createDataFrame([("x", "USD", 10.0), ("y", "USD", 1.0), ("y", "EUR", 2.0)], "k string, currency string, amount double")
    b = spark.createDataFrame([("x", "EUR", 12.0), ("y", "USD", 1.0)], "k string, currency string, amount double")
    got = {r["k"]: r["amount_na"] for r in diff.diff(a, b, ["k"], ["amount"]).df.collect()}
    assert got == {"x": "n/a (USD vs EUR)", "y": "n/a (2 currencies)"}


def test_concat(spark):
    df = spark.range(5)
    page = lambda i, q="select a", **k: concat.Page(df, q, index=i, size=5, rows=5, **k)
    j = concat.concat([page(2), page(0, "select  a", total=99)])
    assert j.df.count() == 10 and j.notes == ["pages missing: 1"] and j.truncated == "10 of 99 rows"
    for bad in ([page(0)], [page(0), page(0)], [page(0), page(1, "select b")]):
        with pytest.raises(ValueError):
            concat.concat(bad)
    with pytest.raises(ValueError, match="overlap"):
        concat.concat([concat.Page(df, "q", start=0, rows=5), concat.Page(df, "q", start=3, rows=5)])


def test_profile(invoices):
    rows = {r["name"]: r for r in profile.profile(invoices).collect()}
    assert rows["amount"]["sum_na"] == "mixed currencies" and rows["amount"]["nulls"] == 1 and rows["id"]["type"] == "id" and rows["trandate"]["type"] == "date"
    assert rows["trandate"]["min"] == "2026-01-05" and rows["customer"]["distinct"] == 3
    assert len(profile.summary(invoices)) <= 1400
    assert profile.render(-0.001) == "0" and profile.render(1234567.125) == "1,234,567.13"


def test_report():
    doc = {"reportData": {"0": {"value": None, "label": None}, "1": {"alias": "s", "value": "Sales"}, "2": {"alias": "a", "parent": "s", "value": "Goods", "summaryLineValues": [{"amt": 5}]}, "10": {"parent": "a", "isDetailLine": True, "detailLineValues": [{"amt": 5}]}, "11": {"alias": "b", "parent": "s", "value": "Other", "summaryLineValues": [{"amt": 2}]}}, "reportColumns": [{"id": "amt", "label": "Amount", "path": "Amount"}]}
    rows, columns, _ = report.flatten_document(doc)
    assert [(r["line"], r["depth"], r["kind"], r["Amount"]) for r in rows] == [(None, -1, "structural", None), ("Sales", 0, "section", None), ("Goods", 1, "line", 5), ("Goods", 2, "detail", 5), ("Other", 1, "line", 2)]
    names, _ = report.column_names([{"id": "2026-01 x", "label": "Amount"}, {"id": "2026-2 x", "label": "Amount"}, {"id": "empty", "label": "Amount"}])
    assert [c["name"] for c in names] == ["2026-01", "2026-Q2", "Total"]


def test_section_signs(spark):
    rows = [("r", 0, "S", 0, False, "section", 7.0), ("r", 1, "a", 1, False, "line", 5.0), ("r", 2, "b", 1, False, "line", 2.0), ("r", 3, "E", 0, False, "section", -4.0), ("r", 4, "c", 1, False, "line", 4.0)]
    df = spark.createDataFrame(rows, "id string, ord long, line string, depth int, is_detail boolean, kind string, Amount double")
    assert {r["line"]: r["sign"] for r in report.section_signs(df, "Amount").collect()} == {"S": 1, "E": -1}


def test_catalog(spark):
    raw = spark.createDataFrame([("1", "One", None), ("2", "Two", "T")], "internalid string, Name string, isElimination string")
    assert [r["real"] for r in catalog.split_subsidiaries(catalog.section(raw, "subsidiaries")).orderBy("id").collect()] == [True, False]
    assert not catalog.may_replace(10, 3) and catalog.may_replace(3, 1) and catalog.amount("1.5m") == 1.5e6
    df = spark.createDataFrame([("HTTP 429",), ("Unknown identifier x",), ("fine",)], "m string")
    assert [r[0] for r in df.select(catalog.classify(F.col("m"))).collect()] == ["rate-limit", "field", "other"]
    periods = spark.createDataFrame([(str(m), f"{m}/1/2025", f"{m}/28/2025", "F", "F", "F", "F") for m in range(1, 13)], "id string, startdate string, enddate string, closed string, isyear string, isquarter string, isadjust string")
    assert catalog.last_twelve_months(periods, "2026-02-01").count() == 12


def test_search(spark):
    df = spark.createDataFrame([("Open bills",), ("Bills",), ("My open bills",), ("Other",)], "title string")
    assert [r[0] for r in search(df, ["bills"]).collect()] == ["Bills", "Open bills", "My open bills"]
    assert [r[0] for r in search(df, ["open|other"]).collect()] == ["Other", "Open bills", "My open bills"]


def test_small_sums_are_exact(spark):
    df = spark.range(100_000).select(F.lit(4e-7).alias("qty"), F.lit(0.1).alias("weight"), F.lit(1e21).alias("size"))
    r = aggregate(df, [], [Metric("sum", "qty"), Metric("sum", "weight"), Metric("avg", "qty"), Metric("sum", "size")]).df.first()
    assert (r["sum_qty"], r["sum_weight"], r["avg_qty"]) == (0.04, 10000.0, 4e-7) and r["sum_size"] == pytest.approx(1e26)


def test_natural_order_of_long_numbers(spark):
    from tallywell.functions import values

    names = ["a9", "a10", "a" + "9" * 40, "a1" + "0" * 40, "A2", "a002"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(values.natural_key(F.col("n")), "n").collect()]
    assert got == ["A2", "a002", "a9", "a10", "a" + "9" * 40, "a1" + "0" * 40]


def test_parents_at_any_depth(spark):
    from tallywell.operators import report

    depths = [*range(20), 3, 4, 0, 1, 1, -1, 2]
    rows = report.parents(spark.createDataFrame([("x", k, d) for k, d in enumerate(depths)], "id string, ord long, depth int")).collect()
    want = {k: max((j for j in range(k) if depths[j] == d - 1), default=None) for k, d in enumerate(depths)}
    assert len(rows) == len(depths) and {r["ord"]: r["parent"] for r in rows} == want


def test_broken_reports_give_a_row_each(spark):
    import json

    from tallywell.operators import report

    good = {"reportColumns": [{"id": "v", "label": "v", "path": "v"}], "reportData": [{"alias": "a", "value": "A", "summaryLineValues": [{"v": "oops"}]}, {"alias": "b", "value": "B", "summaryLineValues": [{"v": "2"}]}]}
    docs = [("good", json.dumps(good)), ("cut", json.dumps(good)[:40]), ("list", "[1, 2]"), ("text", "nothing"), ("none", None)]
    rows = report.flatten(spark.createDataFrame(docs, "id string, text string"), "id", "text", ["v"]).collect()
    assert {(r["id"], r["kind"]) for r in rows} == {("good", "section"), ("cut", "error"), ("list", "error"), ("text", "error")}
    assert [r["v"] for r in rows if r["id"] == "good"] == [None, 2.0]


def test_gaps_over_many_spans(spark, monkeypatch):
    from tallywell.operators import concat

    monkeypatch.setattr(concat, "RANGES", 7)
    starts = [*range(0, 300, 10), 305, *range(320, 900, 10), 2000, 2010]
    got = {tuple(r) for r in concat.gaps(spark.createDataFrame([(x, 10) for x in starts], "s long, n long"), "s", "n").collect()}
    assert got == {(b, a + 10) for a, b in zip(starts, starts[1:]) if b != a + 10}


def test_dominant_currency_ties_go_by_name(spark):
    from tallywell.operators import catalog

    rows = [("s", "EUR", 2), ("s", "EGP", 1), ("s", "EGP", 1), ("t", "USD", 1)]
    for part in (1, 3):
        got = {r["subsidiary"]: (r["currency"], r["share"]) for r in catalog.dominant_currency(spark.createDataFrame(rows[::-1], "subsidiary string, currency string, n int").repartition(part)).collect()}
        assert got == {"s": ("EGP", 0.5), "t": ("USD", 1.0)}
