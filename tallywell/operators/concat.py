"""Pages of one result put together: identity and contiguity are checked on the pages' few metadata rows."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGING = ("pageIndex", "pageSize", "range_start", "range_end")


@dataclass
class Page:
    df: DataFrame
    query: str | dict
    tool: str = ""
    account: str = ""
    index: int | None = None
    size: int | None = None
    start: int | None = None
    rows: int | None = None
    total: int | None = None


@dataclass
class Joined:
    df: DataFrame
    notes: list[str] = field(default_factory=list)
    truncated: str | None = None


def identity(query: str | dict) -> str:
    """What makes two pages pages of one query: the SQL without extra space, or the arguments without paging."""
    if isinstance(query, str):
        return re.sub(r"\s+", " ", query).strip().rstrip(";").strip()
    return json.dumps({k: v for k, v in query.items() if k not in PAGING}, sort_keys=True, separators=(",", ":"))


def concat(pages: Sequence[Page]) -> Joined:
    """All pages' rows in page order with ``_page``. Overlaps, repeated pages and pages of other queries are errors;
    gaps are noted; a count short of the total marks the result as truncated."""
    if len(pages) < 2:
        raise ValueError("at least two pages are needed")
    first, notes = pages[0], []
    for p in pages[1:]:
        if (p.tool, p.account) != (first.tool, first.account):
            raise ValueError("the pages come from different tools or accounts")
        if p.df.columns != first.df.columns:
            raise ValueError("the pages have different columns")
        if identity(p.query) != identity(first.query):
            raise ValueError("the pages belong to different queries")
    if all(p.index is not None for p in pages):
        if len({p.size for p in pages}) > 1:
            raise ValueError("the pages have different sizes")
        ordered = sorted(pages, key=lambda p: p.index)
        indexes = [p.index for p in ordered]
        if twice := sorted({i for i in indexes if indexes.count(i) > 1}):
            raise ValueError(f"page {twice[0]} is there twice")
        if gaps := sorted(set(range(indexes[0], indexes[-1] + 1)) - set(indexes)):
            notes.append(f"pages missing: {', '.join(map(str, gaps))}")
        if indexes[0] != 0:
            notes.append(f"the first page is {indexes[0]}")
    elif all(p.start is not None and p.rows is not None for p in pages):
        ordered = sorted(pages, key=lambda p: p.start)
        for a, b in zip(ordered, ordered[1:]):
            if b.start < a.start + a.rows:
                raise ValueError(f"the ranges from {a.start} and {b.start} overlap")
            if b.start > a.start + a.rows:
                notes.append(f"rows missing between {a.start + a.rows} and {b.start}")
    else:
        ordered = list(pages)
        notes.append("the pages' places are unknown; they are in the order given")
    df = reduce(DataFrame.unionByName, [p.df.withColumn("_page", F.lit(k)) for k, p in enumerate(ordered)])
    have, total = [p.rows for p in ordered], next((p.total for p in ordered if p.total is not None), None)
    truncated = f"{sum(have)} of {total} rows" if total is not None and None not in have and sum(have) < total else None
    return Joined(df, notes, truncated)


RANGES = 1_000_000  # rows of which one task orders about so many


def gaps(meta: DataFrame, start: str, rows: str) -> DataFrame:
    """Places where ranges leave a gap or overlap: expected and actual start. Starts are cut into spans of equal
    width; a task orders one span, and the first range of each span looks at the last one of the spans before."""
    from pyspark.sql import Window

    span = meta.agg(F.count(F.lit(1)).alias("n"), F.min(start).alias("low"), F.max(start).alias("high")).first()
    parts = max(1, -(-span["n"] // RANGES))
    width = max(1, ((span["high"] or 0) - (span["low"] or 0)) // parts + 1)
    own = meta.select(F.col(start), (F.col(start) + F.col(rows)).alias("__end"), F.floor((F.col(start) - F.lit(span["low"] or 0)) / width).alias("__part"))
    last = own.groupBy("__part").agg(F.max(F.struct(F.col(start), F.col("__end")))["__end"].alias("__last"))
    before = last.select("__part", F.lag("__last").over(Window.partitionBy().orderBy("__part")).alias("__before"))  # a row for each span
    inside = F.lag("__end").over(Window.partitionBy("__part").orderBy(start, "__end"))
    placed = own.withColumn("__inside", inside).join(F.broadcast(before), "__part")
    return placed.select(F.col(start), F.coalesce("__inside", "__before").alias("expected")).filter(F.col("expected") != F.col(start))
