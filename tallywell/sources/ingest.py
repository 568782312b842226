"""Loose JSON answers to rows. One answer is a bounded document: it is read on the driver; columns of JSON text
go through Spark's own readers."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.functions import values
from tallywell.operators.report import flatten_document

# The names under which answers hold rows, columns, children and paging facts.
CONTAINERS = ("items", "rows", "data", "results", "records", "searchResults", "lines", "value", "result")
CHILDREN = ("children", "rows", "lines", "sections", "subRows", "items")
MORE = ("hasNextPage", "hasMore", "hasMoreResults")
TOTAL = ("totalResults", "totalRecords", "totalCount")
PAGES = ("numberOfPages", "totalPages")


@dataclass
class Extracted:
    rows: list[dict]
    columns: list[str]
    path: str = "$"
    paging: dict = field(default_factory=dict)
    report: list[dict] | None = None
    notes: list[str] = field(default_factory=list)


def decode(answer):
    """The JSON inside an answer: text, content blocks, and wrappers around either, to any depth."""
    while True:
        if isinstance(answer, (bytes, bytearray)):
            answer = answer.decode("utf-8", "replace")
        if isinstance(answer, str):
            try:
                inner = json.loads(answer)
            except ValueError:
                return answer
            if not isinstance(inner, (dict, list)):
                return inner
            answer = inner
        elif isinstance(answer, dict) and answer.get("structuredContent") is not None:
            answer = answer["structuredContent"]
        elif isinstance(answer, dict) and set(answer) <= {"content", "isError", "_meta"} and "content" in answer:
            answer = answer["content"]
        elif isinstance(answer, list) and answer and all(isinstance(x, dict) and x.get("type") == "text" and "text" in x for x in answer):
            answer = "".join(str(x["text"]) for x in answer) if len(answer) > 1 else answer[0]["text"]
        else:
            return answer


def spilled(spark: SparkSession, text: str, allowed: Sequence[str]) -> str | None:
    """The answer that a pointer text names a file of, if the file lies in an allowed folder; None if it does not."""
    m = re.search(r"(?:saved to|written to|file)[:\s]+(\S+\.(?:json|txt))", text, re.I)
    if not m or ".." in m[1] or not any(m[1].startswith(a.rstrip("/") + "/") for a in allowed):
        return None
    return spark.read.text(m[1], wholetext=True).first()[0]


def error_of(raw, data=None) -> str | None:
    """The message of an answer that reports a failure."""
    data = decode(raw) if data is None else data
    if isinstance(data, dict):
        if data.get("success") is False or data.get("error"):
            e = data.get("error") or data.get("message") or "failed"
            return str(e.get("message", e) if isinstance(e, dict) else e)
        if isinstance(data.get("status"), int) and data["status"] >= 400 and ("title" in data or "detail" in data):
            return str(data.get("detail") or data.get("title"))
    if isinstance(data, str) and len(data) < 5000 and re.match(r"\s*(error|exception|failed|invalid)\b", data, re.I):
        return data.strip()
    if isinstance(raw, dict) and raw.get("isError"):
        return data if isinstance(data, str) else json.dumps(data)
    return None


def flat(record: dict, prefix: str = "", depth: int = 0) -> dict:
    """Nested objects under dotted names, at most three dots deep; arrays as JSON text; links left out."""
    out = {}
    for k, v in record.items():
        if k == "links":
            continue
        name = f"{prefix}{k}"
        if isinstance(v, dict) and depth < 3:
            out |= flat(v, f"{name}.", depth + 1)
        elif isinstance(v, (list, dict)):
            out[name] = json.dumps(v, separators=(",", ":"), ensure_ascii=False) if v else ""
        else:
            out[name] = v
    return out


def _branches(record: dict) -> list | None:
    return next((record[k] for k in CHILDREN if isinstance(record.get(k), list) and record[k] and all(isinstance(x, dict) for x in record[k])), None)


def tree_rows(nodes: Sequence[dict], above: Sequence[str] = ()) -> list[dict]:
    """The rows of nested nodes, each with ``section``, the labels above it."""
    out, todo = [], [(n, tuple(above)) for n in reversed(nodes)]
    while todo:
        node, path = todo.pop()
        inner = _branches(node)
        own = {k: v for k, v in node.items() if not (k in CHILDREN and isinstance(v, list))}
        out.append({"section": " > ".join(path), **flat(own)})
        if inner:
            label = str(next((node[k] for k in ("label", "name", "title", "line") if node.get(k)), ""))
            todo += [(x, (*path, label) if label else path) for x in reversed(inner)]
    return out


def array_rows(items: Sequence) -> list[dict]:
    if items and all(isinstance(x, list) for x in items):
        return [{f"c{k}": v for k, v in enumerate(x)} for x in items]
    if any(isinstance(x, dict) and _branches(x) for x in items):
        return tree_rows([x for x in items if isinstance(x, dict)])
    return [flat(x) if isinstance(x, dict) else {"value": x} for x in items]


def matrix_rows(columns: Sequence, rows: Sequence[Sequence]) -> list[dict]:
    names = [str(c if not isinstance(c, dict) else next((c[k] for k in ("name", "label", "id") if c.get(k) is not None), f"c{n}")) for n, c in enumerate(columns)]
    return [dict(zip(names, r)) for r in rows]


def _largest(data, path: str = "$", depth: int = 0) -> tuple[list, str] | None:
    best = None
    if depth > 6:
        return None
    if isinstance(data, list):
        if data and all(isinstance(x, dict) for x in data):
            best = (data, path)
        inner = [(x, f"{path}[{k}]") for k, x in enumerate(data[:3])] if len(data) <= 3 else []
    else:
        inner = [(v, f"{path}.{k}") for k, v in data.items()] if isinstance(data, dict) else []
    for x, p in inner:
        if (found := _largest(x, p, depth + 1)) and (best is None or len(found[0]) > len(best[0])):
            best = found
    return best


def paging_of(data) -> dict:
    if not isinstance(data, dict):
        return {}
    pick = lambda names: next((data[k] for k in names if data.get(k) is not None), None)
    out = {"more": pick(MORE), "total": pick(TOTAL), "index": data.get("pageIndex"), "size": data.get("pageSize"), "pages": pick(PAGES)}
    return {k: v for k, v in out.items() if v is not None}


def extract(answer) -> Extracted:
    """Rows of any answer: an array, a report, a matrix, a named container, the largest array, or one object."""
    data, paging, report, notes = decode(answer), {}, None, []
    paging = paging_of(data)
    if isinstance(data, list):
        rows, path = array_rows(data), "$"
    elif not isinstance(data, dict):
        rows, path = ([] if data is None else [{"value": data}]), "$"
    elif isinstance(data.get("reportData"), (dict, list)):
        rows, report, notes = flatten_document(data)
        path = "$.reportData"
    else:
        heads = next((data[k] for k in ("columns", "headers") if isinstance(data.get(k), list)), None)
        body = next((k for k in ("rows", "data", "values") if isinstance(data.get(k), list) and data[k] and all(isinstance(x, list) for x in data[k])), None)
        named = next((k for k in CONTAINERS if isinstance(data.get(k), list)), None)
        if heads is not None and body:
            rows, path = matrix_rows(heads, data[body]), f"$.{body}"
        elif named:
            rows, path = array_rows(data[named]), f"$.{named}"
        elif found := _largest(data):
            rows, path = array_rows(found[0]), found[1]
        else:
            rows, path = [flat(data)], "$"
    columns = list(dict.fromkeys(k for r in rows for k in r))
    return Extracted(rows, columns, path, paging, report, notes)


def frame(spark: SparkSession, got: Extracted) -> DataFrame:
    """The rows with ``_ord``, their place; columns in the order they first appear; dates padded. Numbers where all
    values are numbers, truth values likewise, else text."""
    fields, types = [T.StructField("_ord", T.LongType(), False)], {}
    for c in got.columns:
        seen = [r[c] for r in got.rows if r.get(c) is not None]
        if seen and all(isinstance(v, bool) for v in seen):
            types[c] = T.BooleanType()
        elif seen and all(isinstance(v, int) and not isinstance(v, bool) for v in seen) and max(map(abs, seen)) < 2**63:
            types[c] = T.LongType()
        elif seen and all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in seen):
            types[c] = T.DoubleType()
        else:
            types[c] = T.StringType()
        fields.append(T.StructField(c, types[c]))

    def cell(v, t):
        if v is None:
            return None
        if isinstance(t, T.StringType):
            return v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)
        return float(v) if isinstance(t, T.DoubleType) else v

    df = spark.createDataFrame([(k, *[cell(r.get(c), types[c]) for c in got.columns]) for k, r in enumerate(got.rows)], T.StructType(fields))
    return normalise_dates(df)


def normalise_dates(df: DataFrame) -> DataFrame:
    """Text columns with loose ISO dates padded; columns of slash dates rewritten where their order is certain:
    some first part above twelve, or some second part, but not both. One aggregation decides for all columns."""
    texts = [c for c, t in df.dtypes if t == "string"]
    if not texts:
        return df
    tests = []
    for k, c in enumerate(texts):
        s = values.trimmed(values.col(c))
        part = lambda n, s=s: F.regexp_extract(s, values.SLASH_TIME, n).try_cast("int")
        tests += [F.bool_and(F.when(~values.is_blank(values.col(c)), s.rlike(values.SLASH_TIME))).alias(f"m{k}"), F.max(part(1)).alias(f"a{k}"), F.max(part(2)).alias(f"b{k}")]
    row = df.agg(*tests).first()
    orders = {}
    for k, c in enumerate(texts):
        a, b = row[f"a{k}"], row[f"b{k}"]
        if row[f"m{k}"] and a and b and (a <= 12) != (b <= 12):
            orders[c] = "md" if a <= 12 else "dm"
    if orders:  # a column with an impossible date stays as it is
        real = df.agg(*[F.bool_and(F.when(~values.is_blank(values.col(c)), slash_date(values.col(c), o).isNotNull())).alias(f"r{k}") for k, (c, o) in enumerate(orders.items())]).first()
        orders = {c: o for k, (c, o) in enumerate(orders.items()) if real[f"r{k}"]}
    out = {}
    for c in texts:
        x = values.col(c)
        if c in orders:
            out[c] = F.when(values.is_blank(x), x).otherwise(slash_date(x, orders[c]))
        else:
            out[c] = F.when(x.rlike(r"^\d{4}-") & (F.length(x) >= 8), values.normalised_date(x)).otherwise(x)
    return df.select(*[out[c].alias(c) if c in out else values.col(c) for c in df.columns])


def slash_date(c, order: str):
    """A slash date of a known order as ISO, with its time; null where it is no real date."""
    s = values.trimmed(c)
    part = lambda n: F.regexp_extract(s, values.SLASH_TIME, n)
    month, day = (part(1), part(2)) if order == "md" else (part(2), part(1))
    date = values.real_date(part(3), month, day)
    timed = values.normalised_date(F.concat_ws(" ", date, part(4)))
    return F.when(date.isNotNull(), F.when(part(4) == "", date).otherwise(F.when(timed.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}"), timed)))


def parse_column(df: DataFrame, column: str, schema: str) -> DataFrame:
    """A column of JSON text as typed, flattened columns: parsed inside Spark by a declared schema."""
    parsed = df.withColumn("__j", F.from_json(values.col(column), schema))

    def walk(kind: T.StructType, path: str, name: str, depth: int):
        for f in kind.fields:
            p, n = f"{path}.`{f.name}`", f"{name}{f.name}"
            if isinstance(f.dataType, T.StructType) and depth < 3:
                yield from walk(f.dataType, p, f"{n}.", depth + 1)
            else:
                yield (F.to_json(p) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(p)).alias(n)

    kind = parsed.schema["__j"].dataType
    return parsed.select(*[values.col(c) for c in df.columns if c != column], *walk(kind, "__j", "", 0))
