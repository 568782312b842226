"""Sorting by a column's type, and the small orderings built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.functions import values


def sort_kind(df: DataFrame, name: str) -> str:
    kind = values.type_of(df, name)
    if isinstance(kind, values.NUMERIC):
        return "num"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    return df.schema[name].metadata.get("logical", "str")


def sort_keys(df: DataFrame, name: str, kind: str | None = None, ascending: bool = False) -> list[Column]:
    """Numbers largest first, dates latest first, text from A in natural order; ascending turns each round.
    Blanks and what does not parse come last either way."""
    kind = kind or sort_kind(df, name)
    c, own = values.col(name), values.type_of(df, name)
    if kind in ("num", "id"):
        key = values.to_number(c, own)
    elif kind == "date":
        key = c if isinstance(own, (T.DateType, T.TimestampType, T.TimestampNTZType)) else F.when(values.is_date(c), values.date_key(c))
    else:
        key = F.when(~values.is_blank(c), values.natural_key(c))
    down = (kind in ("num", "id", "date")) != ascending
    return [key.desc_nulls_last() if down else key.asc_nulls_last()]


def sort_rows(df: DataFrame, name: str, kind: str | None = None, ascending: bool = False, order: Sequence[str] = ()) -> DataFrame:
    """order: columns that decide ties (an ingest ordinal, or keys)."""
    return df.orderBy(*sort_keys(df, name, kind, ascending), *[values.col(c).asc_nulls_last() for c in order])


def head(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def months(periods: DataFrame, today: str, latest: int | None = None) -> DataFrame:
    """Accounting periods that are months: the open ones, the earliest first, without those that ended over a
    year ago unless there are no others; or the latest so many."""
    own = periods.filter((F.col("isyear") == "F") & (F.col("isquarter") == "F"))
    own = own.withColumn("start", F.try_to_date("startdate", "M/d/yyyy")).withColumn("end", F.try_to_date("enddate", "M/d/yyyy"))
    if latest:
        return own.orderBy(F.col("start").desc(), "id").limit(latest)
    open_ = own.filter("closed = 'F'").withColumn("recent", F.col("end") >= F.date_sub(F.lit(today).cast("date"), 365))
    some = F.max("recent").over(Window.partitionBy())  # a few dozen rows
    return open_.withColumn("some", some).filter("recent or not some").drop("recent", "some").orderBy("start", "id")
