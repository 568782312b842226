"""Tree-shaped financial reports: flattened rows, column names, and checks on sections."""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.functions import values

BUCKETS = ("Current", "1-30", "31-60", "61-90", "91+")
_PERIOD = re.compile(r"^(\d{4})-(\d{2})\b")
_QUARTER = re.compile(r"^(\d{4})-([1-4])\b")


def column_names(columns: Sequence[dict], title: str = "") -> tuple[list[dict], list[str]]:
    """The report's value columns with unique names, and notes on how names were found.

    A label of its own names its column. Repeated labels take a period from the column's id, the aging buckets
    where five columns of an aging report share a path, or else a number.
    """
    labels = [str(c.get("label") or "Value").strip() for c in columns]
    often = Counter(labels)
    paths = Counter(c.get("path") for c in columns)
    aging = [k for k, c in enumerate(columns) if paths[c.get("path")] == len(BUCKETS)] if re.search("aging", title, re.I) else []
    names, notes = [], []
    for k, (c, label) in enumerate(zip(columns, labels)):
        name = label
        if often[label] > 1:
            ident = str(c.get("id") or "")
            if m := _PERIOD.match(ident):
                name = f"{m[1]}-{m[2]}"
            elif m := _QUARTER.match(ident):
                name = f"{m[1]}-Q{m[2]}"
            elif ident.startswith("empty"):
                name = "Total"
            elif k in aging:
                name = BUCKETS[aging.index(k)]
                notes.append(f"column {k + 1} is named {name} by its place among the aging buckets")
            else:
                name = f"{label} {k + 1}"
        names.append(name)
    seen: Counter = Counter()
    out = []
    for c, name in zip(columns, names):
        seen[name] += 1
        out.append({"name": name if seen[name] == 1 else f"{name} ({seen[name]})", "id": c.get("id"), "label": c.get("label"), "path": c.get("path")})
    return out, notes


def _entries(data) -> Iterator[dict]:
    if isinstance(data, dict):
        rank = lambda k: (0, float(k), k) if re.fullmatch(r"-?\d+(\.\d+)?", k) else (1, 0.0, k)
        data = [data[k] for k in sorted(data, key=rank)]
    yield from (x for x in data if isinstance(x, dict))


def _filled(x) -> bool:
    return x is not None and str(x).strip() != ""


def flatten_document(document: dict) -> tuple[list[dict], list[dict], list[str]]:
    """(rows, value columns, notes) of one report. Rows have line, depth, is_detail, kind and a value for each
    column; ``parent`` names the alias of the line above, so nesting comes from the lines still open."""
    columns, notes = column_names(document.get("reportColumns") or [], str(document.get("title") or ""))
    shared = {k for k, n in Counter(x for c in columns for x in {c["path"], c["label"]} if x is not None).items() if n > 1}
    open_lines: list[tuple[str, int, object]] = []
    rows = []
    for entry in _entries(document.get("reportData") or {}):
        alias, parent = entry.get("alias") or None, entry.get("parent") or None
        detail = entry.get("isDetailLine") is True
        owner = None
        if parent is None:
            open_lines.clear()
        else:
            while open_lines and open_lines[-1][0] != parent:
                open_lines.pop()
            owner = open_lines[-1] if open_lines else None
        label = next((entry[k] for k in ("value", "label") if entry.get(k) is not None), None)
        kind = "detail" if detail else "line" if parent else "section" if alias or entry.get("value") is not None else "structural"
        depth = -1 if kind == "structural" else 0 if parent is None else owner[1] + 1 if owner else 1
        raw = next((entry[k] for k in ("summaryLineValues", "detailLineValues") if entry.get(k) is not None), None)
        cells = [raw] if isinstance(raw, dict) else [x for x in raw or [] if isinstance(x, dict)]
        flat = {k: v for x in cells for k, v in x.items()}
        line = owner[2] if label is None and detail and owner else label
        row = {"line": line, "depth": depth, "is_detail": detail, "kind": kind}
        for k, c in enumerate(columns):
            keys = [x for x in (c["id"], *(y for y in (c["path"], c["label"]) if y not in shared)) if x in flat]
            row[c["name"]] = flat[keys[0]] if keys else next(iter(cells[k].values()), None) if len(cells) == len(columns) else None
        if not columns:
            row |= {k: v for k, v in flat.items() if k not in row}
        if kind != "structural" and not _filled(line) and not any(_filled(v) and v != 0 for v in list(row.values())[4:]):
            row["kind"] = "spacer"
        rows.append(row)
        if detail and owner:
            open_lines.pop()
        elif alias and not detail:
            open_lines.append((alias, depth, line))
    return rows, columns, notes


def flatten(documents: DataFrame, id_col: str, json_col: str, value_columns: Sequence[str]) -> DataFrame:
    """Report rows of many documents: id, ord, line, depth, is_detail, kind and a double for each value column.
    Nesting is sequential within a document, so each document is one call; documents spread over tasks. A document
    that cannot be read gives one row of kind "error" with the reason as its line; a cell that is no number is null."""

    def number(x) -> float | None:
        try:
            y = float(x)
        except (TypeError, ValueError):
            return None
        return y if math.isfinite(y) else None

    def run(batches):
        for pdf in batches:
            out = []
            for i, text in zip(pdf["id"], pdf["text"]):
                if text is None:
                    continue
                try:
                    rows, _, _ = flatten_document(json.loads(text))
                except (ValueError, TypeError, AttributeError, KeyError, RecursionError) as e:
                    out.append((i, 0, f"{type(e).__name__}: {e}"[:200], None, None, "error", *[None] * len(value_columns)))
                    continue
                for k, r in enumerate(rows):
                    line = r["line"]
                    out.append((i, k, None if line is None else str(line), r["depth"], r["is_detail"], r["kind"], *[number(r.get(c)) for c in value_columns]))
            yield pd.DataFrame(out, columns=["id", "ord", "line", "depth", "is_detail", "kind", *value_columns])

    fields = ", ".join(["id string, ord long, line string, depth int, is_detail boolean, kind string", *[f"`{c}` double" for c in value_columns]])
    return documents.select(F.col(id_col).cast("string").alias("id"), F.col(json_col).alias("text")).mapInPandas(run, fields)


def identical_columns(df: DataFrame, columns: Sequence[str]) -> list[tuple[str, str]]:
    """Pairs of value columns that agree on every row and are not empty throughout: one aggregation."""
    pairs = [(a, b) for k, a in enumerate(columns) for b in columns[k + 1 :]]
    if not pairs:
        return []
    tests = [x for k, (a, b) in enumerate(pairs) for x in (F.bool_and(values.col(a).eqNullSafe(values.col(b))).alias(f"s{k}"), F.bool_or(values.col(a).isNotNull()).alias(f"f{k}"))]
    row = df.agg(*tests).first()
    return [p for k, p in enumerate(pairs) if row[f"s{k}"] and row[f"f{k}"]]


def parents(df: DataFrame, group: Sequence[str] = ("id",), order: str = "ord") -> DataFrame:
    """df with ``parent``, the order of the row that a row hangs under: the last row before it that is one level up.

    Each row stands twice in one window, as a possible parent at its level and as a seeker at the level above, so
    any depth takes one pass.
    """
    twice = F.explode(F.array(F.struct(F.col("depth").alias("__level"), F.lit(False).alias("__seeks")), F.struct((F.col("depth") - 1).alias("__level"), F.lit(True).alias("__seeks"))))
    both = df.select("*", twice.alias("__x")).select(*[values.col(c) for c in df.columns], F.col("__x.*"))
    w = Window.partitionBy(*group, "__level").orderBy(order, F.desc("__seeks")).rowsBetween(Window.unboundedPreceding, -1)
    up = F.last(F.when(~F.col("__seeks"), F.col(order)), ignorenulls=True).over(w)
    return both.withColumn("parent", up).filter("__seeks").drop("__level", "__seeks")


def section_signs(df: DataFrame, value: str, group: Sequence[str] = ("id",), order: str = "ord") -> DataFrame:
    """Each parent's amount against the sum of its children: sign 1 where they agree, -1 where they agree with the
    sign turned, null where neither holds, within a cent or a millionth."""
    rows = parents(df.filter(~F.col("kind").isin("structural", "spacer", "detail", "error")), group, order)
    kids = rows.filter("parent is not null").groupBy(*group, "parent").agg(values.exact_sum(values.col(value)).alias("children"), F.count(F.lit(1)).alias("n"))
    own = rows.select(*group, F.col(order).alias("parent"), "line", "depth", values.col(value).alias("amount"))
    near = lambda x, y: F.abs(x - y) <= F.greatest(F.lit(0.01), F.abs(y) * 1e-6)
    sign = F.when(near(F.col("amount"), F.col("children")), 1).when(near(-F.col("amount"), F.col("children")), -1)
    return own.join(kids, [*group, "parent"]).select(*group, F.col("parent").alias(order), "line", "depth", "amount", "children", "n", sign.alias("sign"))


def sections(df: DataFrame) -> DataFrame:
    """The rows of a report's summary."""
    return df.filter("kind = 'section'")


def revenue(df: DataFrame, value: str, order: str = "ord") -> float | None:
    """The first section that holds revenue, by the rank of its name."""
    # Names of revenue sections, the strongest first.
    ranks = ("total income", "income", "total revenue", "revenue", "total sales", "sales", "turnover")
    name = F.lower(F.trim("line"))
    rank = F.coalesce(*[F.when(name == x, F.lit(k)) for k, x in enumerate(ranks)])
    row = sections(df).withColumn("rank", rank).filter("rank is not null").orderBy("rank", order).select(values.col(value)).first()
    return row[0] if row else None
