"""When adding rows up would mislead: mixed or unknown currencies, base currencies of several subsidiaries,
header amounts repeated on lines, nested report rows. One aggregation job answers the first three."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.functions import names, values


@dataclass
class Currency:
    status: str = "none"  # mixed, unknown, single or none
    column: str | None = None
    columns: list[str] = field(default_factory=list)
    values: list[str] = field(default_factory=list)  # the first few
    n_values: int = 0
    amounts: list[str] = field(default_factory=list)
    subsidiary: str | None = None
    subsidiaries: int = 0
    base_across: list[str] = field(default_factory=list)
    unknown: list[str] = field(default_factory=list)


def number_of(df: DataFrame, name: str) -> Column:
    return values.to_number(values.col(name), values.type_of(df, name))


def currency_check(df: DataFrame, only: Sequence[str] | None = None) -> Currency:
    """``only``: the columns that are going to be added; without money among them there is nothing to check."""
    money = [c for c in df.columns if names.is_money(c) and not names.is_id(c) and (only is None or c in only)]
    if not money:
        return Currency()
    out = Currency(subsidiary=names.subsidiary_of(df.columns))
    named = [c for c in df.columns if names.is_currency(c)]
    coded = [] if named else [c for c, t in df.dtypes if t == "string" and c not in money and not names.is_id(c)]
    own = named + coded
    picks = {}
    for k, c in enumerate(money):
        picks[f"p{k}"] = F.count(F.when(~values.blank_in(df, c), 1))
        picks[f"v{k}"] = F.count(number_of(df, c))
    for k, c in enumerate(own):
        text = values.text_in(df, c)
        picks[f"n{k}"] = F.count(text)
        picks[f"i{k}"] = F.count(F.when(text.isin(*sorted(names.CURRENCIES)), 1))
        picks[f"d{k}"] = F.count(F.when(text.rlike(r"^-?\d+\z"), 1)) if c in named else F.lit(0)
    ends = {c: f"e{k}" for k, c in enumerate(dict.fromkeys([*own, *([out.subsidiary] if out.subsidiary else [])]))}
    for c, k in ends.items():
        text = values.text_in(df, c)
        picks[f"{k}low"], picks[f"{k}high"] = F.min(text), F.max(text)
    row = df.agg(*[x.alias(k) for k, x in picks.items()]).first().asDict()
    out.amounts = [c for k, c in enumerate(money) if row[f"v{k}"] and row[f"p{k}"] == row[f"v{k}"]]
    if not out.amounts:
        return Currency()
    usable = [k for k, c in enumerate(own) if row[f"n{k}"] and (c in named or row[f"i{k}"] == row[f"n{k}"])]
    out.columns = [own[k] for k in usable] if usable else named
    if usable:  # one that shows codes or names before one of ids
        out.column = own[next((k for k in usable if row[f"d{k}"] < row[f"n{k}"]), usable[0])]
    n = {}
    for c in {out.column, out.subsidiary} - {None}:
        low, high = row[f"{ends[c]}low"], row[f"{ends[c]}high"]
        n[c] = 0 if low is None else 1 if low == high else 2
    if many := [c for c in n if n[c] > 1]:  # the number of values matters only where there are several
        n |= dict(zip(many, df.agg(*[F.count_distinct(values.text_in(df, c)).alias(f"x{k}") for k, c in enumerate(many)]).first()))
    out.n_values, out.subsidiaries = n.get(out.column, 0), n.get(out.subsidiary, 0)
    if out.n_values == 1:
        out.values = [row[f"{ends[out.column]}low"]]
    elif out.n_values:
        own_text = values.text_in(df, out.column)
        out.values = [r[0] for r in df.select(own_text.alias("x")).filter("x is not null").distinct().orderBy("x").limit(8).collect()]
    valued = {c: row[f"v{k}"] for k, c in enumerate(money)}
    if out.subsidiaries > 1:
        out.base_across = [c for c in out.amounts if not names.is_foreign(c) and valued[c] > 1]
    if out.n_values > 1:
        out.status, out.unknown = "mixed", out.base_across
    elif out.column or named:
        out.unknown = out.base_across
        out.status = "unknown" if out.unknown else "single"
    else:
        out.unknown = [c for c in out.amounts if (names.is_foreign(c) or c in out.base_across) and valued[c] > 1]
        out.status = "unknown" if out.unknown else "none"
    return out


def header_repeats(df: DataFrame, only: Sequence[str] | None = None) -> dict[str, str]:
    """Amount column -> the document id per which it repeats: the same on all lines of each document with several,
    in at least two such documents or one of three lines. ``only``: the columns that are going to be added."""
    out: dict[str, str] = {}
    money = [c for c in df.columns if names.is_money(c) and (only is None or c in only)]
    for doc in [c for c in df.columns if names.is_document_id(c)]:
        left = [c for c in money if c not in out and c != doc]
        if not left:
            break
        per = [x for k, c in enumerate(left) for x in (F.count(number_of(df, c)).alias(f"n{k}"), F.min(number_of(df, c)).alias(f"a{k}"), F.max(number_of(df, c)).alias(f"b{k}"))]
        docs = df.filter(~values.blank_in(df, doc)).groupBy(values.text_in(df, doc).alias("doc")).agg(*per)
        tests = []
        for k in range(len(left)):
            many = F.col(f"n{k}") > 1
            tests += [F.count(F.when(many, 1)).alias(f"m{k}"), F.count(F.when(many & (F.col(f"a{k}") != F.col(f"b{k}")), 1)).alias(f"x{k}"), F.count(F.when(F.col(f"n{k}") > 2, 1)).alias(f"l{k}")]
        row = docs.agg(*tests).first()
        for k, c in enumerate(left):
            if not row[f"x{k}"] and (row[f"m{k}"] >= 2 or row[f"l{k}"]):
                out[c] = doc
    return out


def check_levels(df: DataFrame, what: str = "a sum") -> None:
    """Report rows nest; rows of several depths, or detail and structural rows, must not be added."""
    if not names.is_report(df.columns):
        return
    row = df.agg(F.count_distinct(F.when(F.col("kind") != "spacer", F.col("depth"))).alias("depths"), F.count(F.when(F.col("kind").isin("detail", "structural"), 1)).alias("inner")).first()
    if row["depths"] > 1 or row["inner"]:
        raise ValueError(f"report rows nest, so {what} over several levels counts amounts twice; keep one level with --where (depth = 0, kind = section)")
