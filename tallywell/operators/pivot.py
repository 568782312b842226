"""Row by column tables of one metric, with the guards in every cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.functions import names, values
from tallywell.operators import guards
from tallywell.operators.aggregate import Metric, _aggregates, _finished, check_metric, metric_kind

SHOWN = 12
OTHER = "(other)"


def pivot(df: DataFrame, row: str, column: str, metric: Metric | None = None, shown: int = SHOWN, order: str | None = None) -> DataFrame:
    """One row for each value of ``row`` (in order of the least ``order``, or of the text), one column for each of
    the first values of ``column`` by code unit, the others together in "(other)". Cells that a guard blanks are
    null; their reasons stand in a column of the same name with _na. A guard rests where an axis is the currency."""
    row, column = names.resolve_all([row, column], df.columns)
    metric = metric or Metric("count")
    metric = Metric(metric.function, names.resolve_all([metric.column], df.columns)[0] if metric.column else None)
    kind = metric_kind(df, metric.column) if metric.column and metric.function != "count" else "num"
    check_metric(metric, kind)
    adds = metric.function in ("sum", "avg")
    if adds:
        guards.check_levels(df, "a pivot")
    check = guards.currency_check(df, [metric.column] if adds else [])
    repeats = guards.header_repeats(df, [metric.column]) if adds else {}
    text = lambda c: F.coalesce(values.text_form(values.col(c), values.type_of(df, c)), F.lit(""))
    heads = [r[0] for r in df.select(text(column).alias("x")).distinct().orderBy("x").limit(shown + 1).collect()]
    names_, more = heads[:shown], len(heads) > shown
    spot = F.when(text(column).isin(*names_), text(column)).otherwise(OTHER) if more else text(column)
    if row in check.columns or column in check.columns:
        check = guards.Currency(subsidiary=check.subsidiary, subsidiaries=check.subsidiaries)
    cells = df.groupBy(text(row).alias("__row"), spot.alias("__column")).agg(*_aggregates(df, metric, kind, check, repeats, 0), (F.min(values.col(order)) if order else F.lit(0)).alias("__first"))
    long = _finished(cells.withColumnRenamed("__first", "__f"), ["__row", "__column", "__f"], [metric], check, repeats)
    out = [*names_, *([OTHER] if more else [])]
    wanted = [F.first(values.col(metric.name), ignorenulls=True).alias("v"), F.min("__f").alias("f")]
    wanted += [F.first(values.col(f"{metric.name}_na"), ignorenulls=True).alias("na")] if adds else []
    wide = long.groupBy("__row").pivot("__column", out).agg(*wanted)
    wide = wide.withColumn("__f", F.array_min(F.array(*[values.col(f"{c}_f") for c in out]))).orderBy("__f", "__row") if out else wide
    shown_ = [values.col(f"{c}_v").alias(c) for c in out]
    return wide.select(F.col("__row").alias(row), *shown_, *[values.col(f"{c}_na") for c in out if adds])
