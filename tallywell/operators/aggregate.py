"""Grouped sums that never print a misleading total: numbers stay numbers, and a reason column says why one is
not available."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.functions import names, values
from tallywell.operators import guards
from tallywell.operators.sorting import sort_rows

FUNCTIONS = ("sum", "avg", "count", "min", "max")


@dataclass(frozen=True)
class Metric:
    function: str
    column: str | None = None

    @property
    def name(self) -> str:
        return f"{self.function}_{self.column}" if self.column else self.function


@dataclass
class Result:
    df: DataFrame  # keys, a value and (for sums and averages) a reason column ..._na of each metric
    totals: DataFrame
    warnings: list[str] = field(default_factory=list)


def metric_kind(df: DataFrame, column: str) -> str:
    """num, date or text."""
    kind = values.type_of(df, column)
    logical = df.schema[column].metadata.get("logical")
    if isinstance(kind, values.NUMERIC):
        return "num"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) or logical == "date":
        return "date"
    if logical:
        return {"num": "num", "id": "id"}.get(logical, "text")
    c = values.col(column)
    blank = values.is_blank(c)
    number = values.to_number(c, kind)
    row = df.agg(F.count(F.when(~blank, 1)), F.count(number), F.count(F.when(~blank & values.is_date(c), 1))).first()
    return "num" if row[0] and row[1] == row[0] else "date" if row[0] and row[2] == row[0] else "text"


def check_metric(m: Metric, kind: str) -> None:
    if m.function not in FUNCTIONS:
        raise ValueError(f"unknown function {m.function}; one of {', '.join(FUNCTIONS)}")
    if m.function not in ("sum", "avg") or not m.column:
        return
    if kind in ("date", "text"):
        raise ValueError(f"{m.column} holds {kind}s: {m.function} needs numbers; use min, max or count")
    if kind == "id" or names.is_id(m.column):
        raise ValueError(f"{m.column} identifies rows: adding ids up means nothing; count them")
    if m.function == "sum" and names.is_rate(m.column):
        raise ValueError(f"{m.column} is a rate: its sum means nothing; use avg, min or max")


def _read(df: DataFrame, column: str, kind: str) -> Column:
    c = values.col(column)
    if kind in ("num", "id"):
        return guards.number_of(df, column)
    blank = values.is_blank(c)
    return F.when(~blank, values.date_key(values.trimmed(c)) if kind == "date" else c.cast("string"))


def _aggregates(df: DataFrame, m: Metric, kind: str, check: guards.Currency, repeats: dict[str, str], k: int) -> list[Column]:
    """value, then what the guards need: number of values, currencies, subsidiaries, repeated documents."""
    if m.function == "count":
        return [(F.count(F.lit(1)) if not m.column else F.count(F.when(~values.blank_in(df, m.column), 1))).alias(m.name)]
    x = _read(df, m.column, kind)  # type: ignore[arg-type]
    value = {"sum": lambda: values.exact_sum(x), "avg": lambda: values.exact_sum(x) / F.count(x), "min": lambda: F.min(x), "max": lambda: F.max(x)}[m.function]()
    out = [value.alias(m.name)]
    if m.function in ("sum", "avg"):
        out.append(F.count(x).alias(f"__n{k}"))
        text = lambda c: F.when(x.isNotNull(), values.text_in(df, c))
        if check.column and check.n_values > 1 and names.is_money(m.column):
            out.append(F.count_distinct(text(check.column)).alias(f"__c{k}"))
        if check.subsidiary and m.column in check.unknown:
            out.append(F.count_distinct(text(check.subsidiary)).alias(f"__s{k}"))
        if m.column in repeats:
            out += [F.count(text(repeats[m.column])).alias(f"__r{k}"), F.count_distinct(text(repeats[m.column])).alias(f"__d{k}")]
    return out


def reason(m: Metric, check: guards.Currency, repeats: dict[str, str], k: int, have: Sequence[str]) -> Column:
    """Why a group's sum or average is not available: the first guard that fires; null where none does."""
    out = F.lit(None).cast("string")
    if f"__r{k}" in have:
        out = F.when(F.col(f"__r{k}") > F.col(f"__d{k}"), F.lit(f"n/a (repeats per {repeats[m.column]})")).otherwise(out)  # type: ignore[index]
    if m.column in check.unknown:
        if m.column in check.base_across and f"__s{k}" in have:
            out = F.when((F.col(f"__s{k}") > 1) & (F.col(f"__n{k}") > 1), F.concat(F.lit("n/a ("), F.col(f"__s{k}"), F.lit(" subsidiaries)"))).otherwise(out)
        else:
            out = F.when(F.col(f"__n{k}") > 1, F.lit("n/a (currency unknown)")).otherwise(out)
    if f"__c{k}" in have:
        out = F.when(F.col(f"__c{k}") > 1, F.concat(F.lit("n/a ("), F.col(f"__c{k}"), F.lit(" currencies)"))).otherwise(out)
    return F.when(F.col(f"__n{k}") > 0, out)


def _finished(grouped: DataFrame, by: Sequence[str], metrics: Sequence[Metric], check: guards.Currency, repeats: dict[str, str], total_of: Sequence[str] = ()) -> DataFrame:
    """total_of: the group columns, where the row is the total of groups."""
    cols: list[Column] = [values.col(b) for b in by]
    for k, m in enumerate(metrics):
        if m.function not in ("sum", "avg"):
            cols.append(values.col(m.name))
            continue
        why = reason(m, check, repeats, k, grouped.columns)
        if total_of:
            why = _total_reason(m, check, total_of, why)
        cols += [F.when(why.isNull(), values.col(m.name)).alias(m.name), why.alias(f"{m.name}_na")]
    return grouped.select(*cols)


def _total_reason(m: Metric, check: guards.Currency, by: Sequence[str], own: Column) -> Column:
    """Totals follow the whole input's currencies, even where each group is fine."""
    if not names.is_money(m.column or ""):
        return own
    if m.column in check.unknown and m.column not in check.base_across:
        return F.lit("n/a (currency unknown)")
    if check.n_values > 1:
        named = any(b in check.columns for b in by)
        return F.lit(f"n/a ({check.n_values} currencies)" if named else f"n/a ({check.n_values} currencies mixed in groups; add --by {check.column})")
    if m.column in check.base_across:
        return F.lit(f"n/a ({check.subsidiaries} subsidiaries)")
    return own


def aggregate(df: DataFrame, by: Sequence[str] = (), metrics: Sequence[Metric] = (), sort: str | None = None, ascending: bool = False, top: int | None = None, order: Sequence[str] = ()) -> Result:
    """Groups with their metrics, sorted, and the totals over all rows. ``order``: columns that break ties."""
    by = names.resolve_all(by, df.columns)
    metrics = [Metric(m.function, names.resolve_all([m.column], df.columns)[0] if m.column else None) for m in dict.fromkeys(metrics or [Metric("count")])]
    kinds = [metric_kind(df, m.column) if m.column and m.function != "count" else "num" for m in metrics]
    for m, kind in zip(metrics, kinds):
        check_metric(m, kind)
    adds = [m for m in metrics if m.function in ("sum", "avg")]
    if adds:
        guards.check_levels(df)
    money = [m.column for m in metrics if m.column and m.function != "count"] if adds else []
    check = guards.currency_check(df, money)
    repeats = guards.header_repeats(df, [m.column for m in adds])
    aggs = [x for k, (m, kind) in enumerate(zip(metrics, kinds)) for x in _aggregates(df, m, kind, check, repeats, k)]
    groups = _finished(df.groupBy(*[values.col(b) for b in by]).agg(*aggs), by, metrics, check, repeats)
    totals = _finished(df.agg(*aggs), (), metrics, check, repeats, total_of=by)
    if not by:  # no rows, no group
        groups = _finished(df.groupBy().agg(*aggs, F.count(F.lit(1)).alias("__rows")).filter("__rows > 0"), by, metrics, check, repeats)
    key = sort_column(sort, by, metrics)
    kind = {m.name: k for m, k in zip(metrics, kinds)}.get(key)
    groups = sort_rows(groups, key, {"num": "num", "id": "num", "date": "date", "text": "str"}.get(kind) if kind else None, ascending, [*order, *by])
    return Result(groups.limit(top) if top else groups, totals, notes(df, by, metrics, kinds, check, repeats))


def sort_column(sort: str | None, by: Sequence[str], metrics: Sequence[Metric]) -> str:
    """The output column that a sort name means: an output, a group column, or the source of just one metric."""
    if not sort:
        return metrics[0].name
    outputs = [*by, *[m.name for m in metrics]]
    if found := names.resolve(sort, outputs):
        return found
    own = [m.name for m in metrics if m.column and names.resolve(sort, [m.column])]
    if len(own) != 1:
        raise ValueError(f"cannot sort by {sort}; one of {', '.join(outputs)}")
    return own[0]


def notes(df: DataFrame, by: Sequence[str], metrics: Sequence[Metric], kinds: Sequence[str], check: guards.Currency, repeats: dict[str, str]) -> list[str]:
    out = []
    money = [m for m in metrics if m.column and m.function != "count" and names.is_money(m.column)]
    if money and check.n_values > 1:
        shown = ", ".join(check.values)
        if any(b in check.columns for b in by):
            out.append(f"{check.column} has {check.n_values} values ({shown}): amounts per group are fine, the total is not.")
        else:
            out.append(f"{check.column} has {check.n_values} values ({shown}): sums that span currencies are not available. Add --by {check.column}.")
    if base := sorted({m.column for m in money if m.column in check.base_across}):
        out.append(f"{', '.join(base)}: in each subsidiary's own currency, over {check.subsidiaries} subsidiaries. Group by {check.subsidiary}.")
    if unknown := sorted({m.column for m in money if m.column in check.unknown and m.column not in check.base_across}):
        out.append(f"currency unknown: there is no currency column, so {', '.join(unknown)} may mix currencies. Add one and group by it.")
    for c in sorted({m.column for m in metrics if m.function in ("sum", "avg") and m.column in repeats}):
        out.append(f"{c} repeats per {repeats[c]} (a header amount on lines): sums count it once a line. Take one row per {repeats[c]}.")
    read = [(m, k) for m, k in zip(metrics, kinds) if m.column and m.function != "count" and k in ("num", "id") and not isinstance(values.type_of(df, m.column), values.NUMERIC)]
    if read:
        bad = [F.when(~values.is_blank(values.col(m.column)) & guards.number_of(df, m.column).isNull(), values.trimmed(values.col(m.column))) for m, _ in read]
        row = df.agg(*[x for k, b in enumerate(bad) for x in (F.count(b).alias(f"n{k}"), F.min(b).alias(f"x{k}"))]).first()
        out += [f'{m.name}: skipped {row[f"n{k}"]} values of {m.column} that are no numbers (such as "{row[f"x{k}"][:30]}").' for k, (m, _) in enumerate(read) if row[f"n{k}"]]
    return out
