"""Commands over stored results and dialect queries: ``python -m tallywell.cli --store DIR results agg ID --by a --sum b``."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.functions import names
from tallywell.operators import concat, diff, pivot, profile, sorting
from tallywell.operators.aggregate import FUNCTIONS, Metric, aggregate
from tallywell.operators.predicate import filtered
from tallywell.plans import dialect
from tallywell.plans.lint import Context, lint
from tallywell.sources import files, ingest
from tallywell.sources.store import Store, truncation

MOST_ROWS = 60
MOST_CHANGES = 40
WIDTH = 40


def text_table(df: DataFrame, most: int = MOST_ROWS) -> str:
    """A plain table of the first rows; reasons stand in for the numbers that are not available."""
    rows = df.limit(most + 1).collect()
    reasons = {c: f"{c}_na" for c in df.columns if f"{c}_na" in df.columns}
    heads = [c for c in df.columns if c not in reasons.values() and c != "_ord"]

    def cell(r, c) -> str:
        v = r[c]
        if c in reasons and r[reasons[c]] is not None:
            return r[reasons[c]]
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return str(v) if names.is_id(c) else profile.render(v, names.is_rate(c))
        return "" if v is None else str(v).replace("\n", " ")

    cells = [heads] + [[cell(r, c) for c in heads] for r in rows[:most]]
    wide = [min(WIDTH, max(len(r[k]) for r in cells)) for k in range(len(heads))]
    lines = ["  ".join(x[: wide[k]].ljust(wide[k]) for k, x in enumerate(r)).rstrip() for r in cells]
    if len(rows) > most:
        lines.append(f"... {df.count() - most} more rows")
    return "\n".join(lines)


def metrics(a: argparse.Namespace) -> list[Metric]:
    out = [Metric(f, c) for f in FUNCTIONS for c in _list(getattr(a, f if f != "count" else "count_of", None))]
    return out + ([Metric("count")] if a.count or not out else [])


def _list(text: str | None) -> list[str]:
    return [x.strip() for x in (text or "").split(",") if x.strip()]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallywell", description=__doc__)
    top.add_argument("--store", default="results", help="folder of stored results")
    kinds = top.add_subparsers(dest="kind", required=True)
    results = kinds.add_parser("results").add_subparsers(dest="do", required=True)
    add = results.add_parser("add")
    add.add_argument("file", help="a JSON answer")
    add.add_argument("--query", default="")
    add.add_argument("--tool", default="")
    results.add_parser("list").add_argument("-n", type=int, default=20)
    clean = results.add_parser("clean")
    clean.add_argument("--days", type=int, default=7)
    for name in ("head", "filter", "agg", "pivot", "profile", "export", "raw"):
        p = results.add_parser(name)
        p.add_argument("id")
        p.add_argument("--where", action="append", default=[])
        p.add_argument("--max-rows", type=int, default=MOST_ROWS)
        p.add_argument("--cols")
        p.add_argument("--sort")
        p.add_argument("--asc", action="store_true")
        if name == "head":
            p.add_argument("-n", type=int, default=10)
        if name in ("agg", "pivot"):
            for f in FUNCTIONS:
                if f != "count":
                    p.add_argument(f"--{f}")
            p.add_argument("--count", action="store_true")
            p.add_argument("--count-of")
        if name == "agg":
            p.add_argument("--by")
            p.add_argument("--top", type=int)
        if name == "pivot":
            p.add_argument("--rows", required=True)
            p.add_argument("--columns", required=True)
        if name == "profile":
            p.add_argument("--approximate", action="store_true")
        if name == "export":
            p.add_argument("path")
            p.add_argument("--spreadsheet", action="store_true")
        if name == "raw":
            p.add_argument("--term")
    p = results.add_parser("diff")
    p.add_argument("a")
    p.add_argument("b")
    p.add_argument("--on", required=True)
    p.add_argument("--cols", required=True)
    p.add_argument("--tolerance", type=float, default=0.0)
    p.add_argument("--where", action="append", default=[])
    p.add_argument("--top", type=int, default=MOST_CHANGES)
    p = results.add_parser("concat")
    p.add_argument("ids", nargs="+")
    sql = kinds.add_parser("sql").add_subparsers(dest="do", required=True)
    p = sql.add_parser("lint")
    p.add_argument("text")
    p.add_argument("--lenient", action="store_true")
    p = sql.add_parser("run")
    p.add_argument("text")
    p.add_argument("--table", action="append", default=[], help="name=path of Parquet")
    return top


def _add(spark: SparkSession, store: Store, a: argparse.Namespace) -> str:
    answer = "\n".join(r[0] for r in spark.read.text(a.file, wholetext=True).collect())
    if problem := ingest.error_of(answer):
        raise ValueError(problem)
    got = ingest.extract(answer)
    meta = store.save(ingest.frame(spark, got), a.tool, a.query, truncated=truncation(len(got.rows), got.paging, dialect.row_cap(a.query)))
    return f"{meta.id}: {meta.rows} rows" + (f" ! {meta.truncated}" if meta.truncated else "")


def run(spark: SparkSession, argv: list[str]) -> str:
    a = parser().parse_args(argv)
    if a.kind == "sql":
        if a.do == "lint":
            r = lint(a.text, Context(strict=not a.lenient))
            lines = [f"error {e.rule}: {e.message}" for e in r.errors] + [f"warning {w.rule}: {w.message}" for w in r.warnings]
            return "\n".join(lines + ([f"fixed: {r.fixed}"] if r.fixed else [])) or "ok"
        for t in a.table:
            name, _, path = t.partition("=")
            spark.read.parquet(path).createOrReplaceTempView(name)
        return text_table(dialect.run(spark, a.text))
    store = Store(spark, a.store)
    if a.do == "add":
        return _add(spark, store, a)
    if a.do == "list":
        return text_table(store.listing(a.n).select("id", "created", "tool", "rows", "truncated", "query"))
    if a.do == "clean":
        return "\n".join(store.cleanup(days=a.days)) or "nothing to remove"
    if a.do == "concat":
        meta = [store.find(i) for i in a.ids]
        pages = [concat.Page(store.load(m.id), _query(m.query), m.tool, rows=m.rows, **_place(m.query)) for m in meta]
        joined = concat.concat(pages)
        saved = store.save(joined.df.drop("_page"), meta[0].tool, meta[0].query, truncated=joined.truncated)
        return "\n".join([f"{saved.id}: {saved.rows} rows", *joined.notes])
    if a.do == "diff":
        sides = [filtered(store.load(i), *a.where) for i in (a.a, a.b)]
        d = diff.diff(*sides, _list(a.on), _list(a.cols), a.tolerance)
        return "\n".join([text_table(d.changed().drop("_outcome"), a.top), json.dumps(d.counts()), *[f"! {w}" for w in d.warnings], *d.notes])
    df = filtered(store.load(a.id), *a.where)
    if df.isEmpty():
        return "No rows match."
    meta = store.find(a.id)
    tail = [f"! truncated: {meta.truncated}"] if meta and meta.truncated else []
    if a.do == "agg":
        r = aggregate(df, _list(a.by), metrics(a), a.sort, a.asc, a.top)
        total = [f"total: {text_table(r.totals)}"] if a.by else []
        return "\n".join([text_table(r.df, a.max_rows), *total, *[f"! {w}" for w in r.warnings], *tail])
    if a.do == "pivot":
        own = metrics(a)
        if len(own) != 1:
            raise ValueError("a pivot shows one metric")
        return "\n".join([text_table(pivot.pivot(df, a.rows, a.columns, own[0], order="_ord" if "_ord" in df.columns else None), a.max_rows), *tail])
    if a.do == "profile":
        return text_table(profile.profile(df, a.approximate))
    if a.sort:
        df = sorting.sort_rows(df, names.resolve_all([a.sort], df.columns)[0], None, a.asc, ["_ord"] if "_ord" in df.columns else [])
    elif "_ord" in df.columns:
        df = df.orderBy("_ord")
    if a.cols:
        df = df.select(*[names.quoted(c) for c in names.resolve_all(_list(a.cols), df.columns)])
    if a.do == "export":
        if a.path.endswith(".xlsx"):
            return f"{files.write_xlsx(df.drop('_ord'), a.path)} rows"
        (files.write_tsv if a.path.endswith(".tsv") else lambda x, p: files.write_csv(x, p, a.spreadsheet, single=True))(df.drop("_ord"), a.path)
        return f"{df.count()} rows"
    if a.do == "raw":
        rows = df.select(F.to_json(F.struct(*[names.quoted(c) for c in df.columns])).alias("x"))
        rows = rows.filter(F.contains(F.lower("x"), F.lit(a.term.lower()))) if a.term else rows
        return "\n".join(r[0][:300] for r in rows.limit(40).collect())
    return "\n".join([text_table(sorting.head(df, a.n) if a.do == "head" else df, a.max_rows), *tail])


def _query(text: str):
    try:
        got = json.loads(text)
        return got if isinstance(got, dict) else text
    except ValueError:
        return text


def _place(text: str) -> dict:
    q = _query(text)
    if not isinstance(q, dict):
        return {}
    return {k: q[n] for k, n in (("index", "pageIndex"), ("size", "pageSize"), ("start", "range_start")) if n in q}


def main() -> int:
    spark = SparkSession.builder.appName("tallywell").getOrCreate()
    try:
        print(run(spark, sys.argv[1:]))
    except ValueError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
