"""A keyed comparison of two tables: sums per key on both sides, a full outer join, deltas and their outcome."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.functions import names, values
from tallywell.operators import guards


@dataclass
class Difference:
    df: DataFrame  # keys, per column _a, _b, _delta, _pct and _na, then _presence and _outcome
    on: list[str]
    notes: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    def counts(self) -> dict[str, int]:
        return {r[0]: r[1] for r in self.df.groupBy("_outcome").count().collect()}

    def changed(self) -> DataFrame:
        return self.df.filter("_outcome <> 'same'")


def _key(df: DataFrame, on: Sequence[str]) -> list[Column]:
    return [values.canonical(values.col(c), values.type_of(df, c)).alias(c) for c in on]


def _repeats(df: DataFrame, on: Sequence[str]) -> tuple[int, str]:
    n = df.groupBy(*_key(df, on)).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    row = n.agg(F.count(F.lit(1)), F.max_by(F.concat(F.concat_ws(", ", *[values.col(c) for c in on]), F.lit(" x"), F.col("__n")), "__n")).first()
    return row[0], row[1] or ""


def _side(df: DataFrame, on: Sequence[str], cols: Sequence[str], money: Sequence[str], check: guards.Currency, side: str) -> DataFrame:
    x = {c: guards.number_of(df, c) for c in cols}
    some = reduce(or_, [x[c].isNotNull() for c in money]) if money else F.lit(False)
    own = lambda c: F.when(some, values.text_in(df, c))
    aggs = [values.exact_sum(x[c]).alias(f"{c}_{side}") for c in cols]
    aggs += [F.count(x[c]).alias(f"__n_{side}{k}") for k, c in enumerate(cols)]
    aggs.append((F.count_distinct(own(check.column)) if check.column else F.lit(0)).alias(f"__c_{side}"))
    aggs.append((F.max(own(check.column)) if check.column else F.lit(None).cast("string")).alias(f"__one_{side}"))
    aggs.append((F.count_distinct(own(check.subsidiary)) if check.subsidiary and check.unknown else F.lit(0)).alias(f"__s_{side}"))
    return df.groupBy(*_key(df, on)).agg(*aggs).withColumn(f"__has_{side}", F.lit(True))


def _numbers(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[int, int]]:
    """(cells, cells that are no numbers) of each column; typed ones need no look, texts one aggregation together."""
    texts = [c for c in cols if not isinstance(values.type_of(df, c), values.NUMERIC)]
    out = {c: (0, 0) for c in cols}
    if texts:
        row = df.agg(*[x for c in texts for x in (F.count(values.text_in(df, c)), F.count(F.when(guards.number_of(df, c).isNull(), values.text_in(df, c))))]).first()
        out |= {c: (row[2 * k], row[2 * k + 1]) for k, c in enumerate(texts)}
    return out


def diff(a: DataFrame, b: DataFrame, on: Sequence[str], cols: Sequence[str], tolerance: float = 0.0, currencies: tuple[str, str] | None = None) -> Difference:
    """currencies: those of two reports, whose deltas are not available where they differ."""
    if not tolerance >= 0 or tolerance == float("inf"):
        raise ValueError(f"the tolerance is an absolute amount of at least 0, not {tolerance}")
    on, cols = names.resolve_all(on, a.columns, "a"), names.resolve_all(cols, a.columns, "a")
    names.resolve_all([*on, *cols], b.columns, "b")
    notes, warnings = [], []
    report = names.is_report(a.columns) and names.is_report(b.columns)
    worst = max(_repeats(a, on), _repeats(b, on))
    if report and worst[0]:
        line = values.is_blank(F.col("line"))
        empty = lambda df: line & ~reduce(or_, [F.coalesce(guards.number_of(df, c) != 0, F.lit(False)) for c in cols])
        a, b = [df.filter(~F.col("kind").isin("detail", "structural", "spacer") & ~empty(df)) for df in (a, b)]
        notes.append("report rows: detail, structural and spacer rows are left out; sections and lines carry the values.")
        worst = max(_repeats(a, on), _repeats(b, on))
        if worst[0] and "depth" not in on:
            on = [*on, "depth"]
            notes.append(f"names still repeat among report lines, so rows are keyed on {', '.join(on)}.")
            worst = max(_repeats(a, on), _repeats(b, on))
        if worst[0]:
            raise ValueError(f"the key {', '.join(on)} is not unique among report lines ({worst[0]} keys repeat, such as {worst[1]}); nested rows would be added together")
    if worst[0]:
        warnings.append(f"the key {', '.join(on)} is not unique: {worst[0]} keys repeat (such as {worst[1]}); their values are summed.")
    found = [_numbers(df, cols) for df in (a, b)]
    for c in cols:
        present, wrong = (sum(side[c][k] for side in found) for k in (0, 1))
        if present and wrong == present:
            raise ValueError(f"{c} holds text, and only numbers are compared; put it in the key")
        if wrong:
            warnings.append(f"{c}: skipped {wrong} values that are no numbers.")
    money = [] if report else [c for c in cols if names.is_money(c)]
    check_a, check_b = (guards.currency_check(df, money) for df in (a, b))
    left, right = _side(a, on, cols, money, check_a, "a"), _side(b, on, cols, money, check_b, "b")
    joined = left.join(right, on, "full_outer")
    out: list[Column] = [values.col(c) for c in on]
    outcomes, sizes = [], []
    for k, c in enumerate(cols):
        va, vb = values.col(f"{c}_a"), values.col(f"{c}_b")
        why = F.lit(None).cast("string")
        if c in money:
            why = F.when(F.col("__one_a").isNotNull() & F.col("__one_b").isNotNull() & (F.col("__one_a") != F.col("__one_b")), F.concat(F.lit("n/a ("), F.col("__one_a"), F.lit(" vs "), F.col("__one_b"), F.lit(")")))
        lost_a, lost_b = (_lost(c, k, check, side) if c in money else F.lit(None).cast("string") for check, side in ((check_a, "a"), (check_b, "b")))
        if report and currencies and currencies[0].upper() != currencies[1].upper():
            why = F.when(va.isNotNull() & vb.isNotNull(), F.lit(f"n/a ({currencies[0]} vs {currencies[1]})"))
        reason = F.coalesce(lost_a, lost_b, why)
        a_, b_ = F.when(lost_a.isNull(), va), F.when(lost_b.isNull(), vb)
        delta = F.when(reason.isNull(), b_ - a_)
        pct = F.when(F.abs(a_) >= 1, F.floor(delta / F.abs(a_) * 1000 + 0.5) / 10)
        out += [a_.alias(f"{c}_a"), b_.alias(f"{c}_b"), delta.alias(f"{c}_delta"), pct.alias(f"{c}_pct"), reason.alias(f"{c}_na")]
        one = F.when(reason.isNotNull(), 1).when(va.isNull() & vb.isNull(), 0).when(va.isNull() | vb.isNull(), 2).when(F.abs(vb - va) > tolerance, 2).otherwise(0)
        outcomes.append(one)
        sizes.append(F.coalesce(F.abs(delta), F.abs(a_), F.abs(b_), F.lit(-1.0)))
    presence = F.when(F.col("__has_b").isNull(), "only_a").when(F.col("__has_a").isNull(), "only_b").otherwise("both")
    worst_of = F.greatest(*outcomes, F.lit(0))
    outcome = F.when(worst_of == 2, "changed").when(worst_of == 1, "incomparable").otherwise("same")
    done = joined.select(*out, presence.alias("_presence"), outcome.alias("_outcome"), F.greatest(*sizes, F.lit(-1.0)).alias("__size"))
    return Difference(done.orderBy(F.col("__size").desc(), *[values.col(c) for c in on]).drop("__size"), list(on), notes, warnings)


def _lost(c: str, k: int, check: guards.Currency, side: str) -> Column:
    """Why one side's value is not available."""
    n = F.col(f"__n_{side}{k}")
    out = F.lit(None).cast("string")
    if c in check.unknown:
        if c in check.base_across:
            out = F.when((F.col(f"__s_{side}") > 1) & (n > 1), F.concat(F.lit("n/a ("), F.col(f"__s_{side}"), F.lit(" subsidiaries)")))
        else:
            out = F.when(n > 1, F.lit("n/a (currency unknown)"))
    return F.when((F.col(f"__c_{side}") > 1) & (n > 0), F.concat(F.lit("n/a ("), F.col(f"__c_{side}"), F.lit(" currencies)"))).otherwise(out)
