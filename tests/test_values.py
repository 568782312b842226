import pytest
from pyspark.sql import functions as F

from tallywell.functions import names, values


def column(spark, cells, f):
    df = spark.createDataFrame([(k, c) for k, c in enumerate(cells)], "k int, c string")
    return [r[0] for r in df.orderBy("k").select(f(F.col("c"))).collect()]


def test_numbers(spark):
    cells = ["1,234.5", ".00", "-3", "$1,234.00", "EUR 1,234.00", "1,234.00 USD", "-$5", "(1,234.00)", "1e3", "007", " 7 "]
    assert column(spark, cells, values.to_number) == [1234.5, 0.0, -3.0, 1234.0, 1234.0, 1234.0, -5.0, -1234.0, 1000.0, 7.0, 7.0]
    assert column(spark, ["12%", "(-5)", "--5", "XYZ 5", "5 ABCD", "", None, "1,23", "12\n3"], values.to_number) == [None] * 9


def test_blank_and_dates(spark):
    assert column(spark, [None, "", " ", " \t", "x"], values.is_blank) == [True, True, True, True, False]
    assert column(spark, ["3/7/2026", "2026-3-7", "2026-03-07T07:18:00Z", "other text"], values.date_key) == ["2026-03-07", "2026-03-07", "2026-03-07 07:18:00Z", "other text"]
    assert column(spark, ["13/7/2026", "2026-3-7 7:18 am", "12/31/2025", "2026"], values.is_date) == [False, True, True, False]
    cells = ["2018-9-17 7:18 am", "2018-9-17 12:05 PM", "2018-2-30", "2018-9-17 25:00", "2018-9-17"]
    assert column(spark, cells, values.normalised_date) == ["2018-09-17 07:18", "2018-09-17 12:05", "2018-2-30", "2018-9-17 25:00", "2018-09-17"]


def test_keys(spark):
    assert column(spark, ["1.50", " 7 ", "007", "-0", "x", None], values.canonical) == ["1.5", "7", "007", "0", "x", ""]
    keyed = column(spark, ["a10", "A9", "b1"], values.natural_key)
    assert sorted(keyed) == [keyed[1], keyed[0], keyed[2]]


@pytest.mark.parametrize(("name", "want"), [("t.currency", True), ("ccy", True), ("Exchange Rate Currency", False), ("Amount (Foreign Currency)", False), ("currentbalance", False)])
def test_currency_names(name, want):
    assert names.is_currency(name) is want


def test_names():
    assert names.is_id("Last Run By") and names.is_id("entity") and not names.is_id("amountpaid") and not names.is_id("paid")
    assert names.is_money("foreigntotal") and not names.is_money("exchangerate")
    assert names.resolve("doc number", ["Doc_Number", "x"]) == "Doc_Number"
    assert names.resolve("A", ["a", "A"]) == "A" and names.resolve("aa", ["Aa", "AA"]) is None
    with pytest.raises(ValueError, match="nope"):
        names.resolve_all(["nope"], ["a"])
    assert names.edit_distance("tpye", "type") == 1 and names.closest("tpye", ["type", "other"]) == "type"
