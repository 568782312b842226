"""Column profiles in one long-form aggregation, logical types, and what follows from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.functions import names, values
from tallywell.operators import guards


def _tests(df: DataFrame, c: str) -> list:
    """present, truth, number, date, leading zero, whole, plain small codes of a column's cells."""
    x, kind = values.col(c), values.type_of(df, c)
    blank, text = values.is_blank(x, kind), values.trimmed(x)
    numeric = isinstance(kind, values.NUMERIC)
    number = values.to_number(x, kind)
    if numeric:  # no test of the text form is needed
        none = F.lit(0)
        return [F.count(x), none, F.count(number), none, F.count(F.when(number == F.floor(number), 1)), none]
    n = lambda test: F.count(F.when(~blank & test, 1))
    return [
        F.count(F.when(~blank, 1)),
        n(text.rlike(values.TRUTH)),
        n(number.isNotNull() & (F.lit(numeric) | ~text.rlike(r"^0\d"))),
        n(values.is_date(x)) if not numeric else F.lit(0),
        n(text.rlike(r"^-?\d+\z")) if not numeric else n(number == F.floor(number)),
        n(text.rlike(r"^\d{1,4}\z")),
    ]


def logical_types(df: DataFrame, distinct: dict[str, int] | None = None) -> dict[str, str]:
    """bool, num, id, date or str for each column: one aggregation over all of them."""
    # texts are trimmed once, below the tests that read them
    kinds_ = dict(df.dtypes)
    own = df.select(*[values.trimmed(values.col(c)).alias(c) if kinds_[c] == "string" else values.col(c) for c in df.columns])
    tests = [t.alias(f"t{k}_{j}") for k, c in enumerate(own.columns) for j, t in enumerate(_tests(own, c))]
    row = own.agg(*tests).first()
    out = {}
    for k, c in enumerate(df.columns):
        n, truth, number, date, whole, small = (row[f"t{k}_{j}"] for j in range(6))
        kind = kinds_[c]
        if not n:
            out[c] = "str"
        elif truth == n:
            out[c] = "bool"
        elif number == n:
            out[c] = "id" if is_id_column(c, n, whole == n, kind == "string", (distinct or {}).get(c), small == n) else "num"
        elif date == n or kind.startswith(("timestamp", "date")):
            out[c] = "date"
        else:
            out[c] = "str"
    return out


def is_id_column(name: str, present: int, whole: bool, text: bool, distinct: int | None, small: bool) -> bool:
    """Whole numbers that identify: by name, or (as text) nearly unique, or few small codes."""
    if not present or not whole or names.is_amount(name) or names.is_money(name):
        return False
    if names.is_id(name):
        return True
    if not text or present < 20 or distinct is None:
        return False
    if distinct >= 0.9 * present:
        return True
    return not names.is_measure(name) and distinct <= 12 and distinct <= present / 5 and small


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """A row for each column: name, type, nulls, distinct (of the text form), sum (where adding means something),
    sum_na, min, max. Exact distinct counts go through one long table of (column, text) pairs, so one shuffle
    serves all columns; the approximate form needs none."""
    spark = df.sparkSession
    total = df.count()
    text = {c: values.text_in(df, c) for c in df.columns}
    if approximate:
        row = df.agg(*[x for k, c in enumerate(df.columns) for x in (F.count(text[c]).alias(f"n{k}"), F.approx_count_distinct(values.col(c) if isinstance(values.type_of(df, c), values.NUMERIC) else text[c]).alias(f"d{k}"))]).first()
        n, distinct = ({c: row[f"{p}{k}"] for k, c in enumerate(df.columns)} for p in "nd")
    else:
        pairs = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), text[c].alias("t")) for k, c in enumerate(df.columns)])).alias("x")).select("x.k", "x.t")
        rows = pairs.filter("t is not null").groupBy("k", "t").agg(F.count(F.lit(1)).alias("n")).groupBy("k").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d")).collect()
        n, distinct = ({df.columns[r["k"]]: r[p] for r in rows} for p in "nd")
    kinds = logical_types(df, distinct)
    check, repeats = guards.currency_check(df), guards.header_repeats(df)
    nested = names.is_report(df.columns)
    aggs = []
    for k, c in enumerate(df.columns):
        x, own = values.col(c), values.type_of(df, c)
        number = values.to_number(x, own)
        key = number if kinds[c] == "num" else F.when(~values.is_blank(x, own), values.date_key(x)) if kinds[c] == "date" else text[c]
        aggs += [F.min(key).cast("string").alias(f"a{k}"), F.max(key).cast("string").alias(f"b{k}"), (values.exact_sum(number) if kinds[c] == "num" else F.lit(None).cast("double")).alias(f"s{k}"), F.count(F.when(number != F.floor(number), 1)).alias(f"f{k}")]
    row = df.agg(*aggs).first()
    out = []
    for k, c in enumerate(df.columns):
        why = None
        can = kinds[c] == "num" and summable(c, row[f"f{k}"] > 0)
        if can and nested:
            why = "report rows nest"
        elif can and names.is_money(c) and check.n_values > 1:
            why = "mixed currencies"
        elif can and c in check.unknown:
            why = f"{check.subsidiaries} subsidiaries" if c in check.base_across else "currency unknown"
        elif can and c in repeats:
            why = f"repeats per {repeats[c]}"
        out.append((c, kinds[c], total - n.get(c, 0), distinct.get(c, 0), row[f"s{k}"] if can and not why else None, why, row[f"a{k}"], row[f"b{k}"]))
    return spark.createDataFrame(out, "name string, type string, nulls long, distinct long, sum double, sum_na string, min string, max string")


def summable(name: str, fractions: bool) -> bool:
    if names.is_rate(name):
        return False
    return names.is_amount(name) or names.is_money(name) or names.is_measure(name) or fractions


def typed(df: DataFrame, kinds: dict[str, str] | None = None) -> DataFrame:
    """df with each column's logical type in its metadata, and numbers as doubles."""
    kinds = kinds or logical_types(df)
    return df.select(*[(values.to_number(values.col(c), values.type_of(df, c)) if kinds[c] == "num" else values.col(c)).alias(c, metadata={"logical": kinds[c]}) for c in df.columns])


def hint(rows: Sequence[dict], total: int) -> tuple[str, str] | None:
    """(measure, grouping column) to suggest, from profile rows."""
    measure = next((r["name"] for r in rows if r["type"] == "num" and names.is_hint(r["name"])), None)
    group = next((r["name"] for r in rows if r["type"] == "str" and 1 < r["distinct"] <= total / 2), None)
    return (measure, group) if measure and group else None


def summary(df: DataFrame, budget: int = 1400, warnings: Sequence[str] = ()) -> str:
    """A short text of the table: shape, columns, a few rows; columns and rows give way to the budget, warnings
    never."""
    total = df.count()
    rows = [r.asDict() for r in profile(df).collect()]
    lead = [f"{total} rows x {len(df.columns)} columns", *[f"! {w}" for w in warnings]]
    for n_columns, n_rows, width in ((len(rows), 5, 40), (40, 3, 24), (20, 2, 16), (10, 1, 12), (5, 0, 12), (0, 0, 0)):
        lines = lead + [f"{r['name']} {r['type']}" + (f" sum {render(r['sum'])}" if r["sum"] is not None else f" n/a ({r['sum_na']})" if r["sum_na"] else "") for r in rows[:n_columns]]
        if n_columns < len(rows):
            lines.append(f"... {len(rows) - n_columns} more columns")
        for r in df.limit(n_rows).collect() if n_rows else []:
            lines.append(" | ".join(("" if v is None else str(v))[:width] for v in r[: max(n_columns, 1)]))
        text = "\n".join(lines)
        if len(text) <= budget:
            break
    return text


def render(x: float | int | None, rate: bool = False) -> str:
    """A number with thousands separators, at most two decimals (six for rates), rounded half up, never -0."""
    import math

    if x is None:
        return ""
    places = 6 if rate else 2
    y = math.floor(x * 10**places + 0.5) / 10**places
    text = f"{y:,.{places}f}".rstrip("0").rstrip(".")
    return "0" if text == "-0" else text
