"""Account metadata as small tables: parsers, freshness, the account profile, templates and error classes."""

from __future__ import annotations

import random
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywell.functions import values

# Sections with their columns and the field names that may hold each, days that each stays fresh.
SECTIONS: dict[str, dict[str, tuple[str, ...]]] = {
    "reports": {"id": ("id", "reportId", "internalid"), "title": ("title", "name", "label"), "params": ("params",)},
    "searches": {"id": ("id", "searchId", "internalid"), "title": ("title", "name"), "recordtype": ("recordtype", "recordType", "type"), "public": ("public", "isPublic")},
    "subsidiaries": {"id": ("id", "internalid"), "name": ("name", "title"), "currency": ("currency",), "parent": ("parent",), "country": ("country",), "iselimination": ("iselimination", "isElimination")},
    "recordtypes": {"recordtype": ("recordtype", "recordType", "id", "name"), "label": ("label", "title")},
    "periods": {"id": ("id",), "periodname": ("periodname", "name"), "startdate": ("startdate", "startDate"), "enddate": ("enddate", "endDate"), "closed": ("closed",), "isyear": ("isyear",), "isquarter": ("isquarter",), "isadjust": ("isadjust",)},
}
FRESH_DAYS = {"searches": 1, "periods": 1, "reports": 7, "subsidiaries": 7}
FRESH_OTHERS = 30
MATERIALITY = ((1e6, 5e3), (1e7, 25e3), (1e8, 50e3), (1e9, 250e3))
MATERIALITY_ABOVE = 1e6
# Classes of error messages, the first that fits.
ERRORS = (
    ("rate-limit", r"rate.?limit|too many requests|\b429\b|concurrency"),
    ("auth", r"unauthor|invalid (login|token)|expired|\b401\b"),
    ("permission", r"permission|forbidden|\b403\b|not allowed"),
    ("timeout", r"time(d)?.?out|\b504\b"),
    ("field", r"unknown (identifier|column)|field .* (not found|not exposed)|invalid column"),
    ("table", r"record .* was not found|invalid table|unknown table|search type"),
    ("syntax", r"syntax|unexpected|parse|malformed"),
    ("not-found", r"not found|does not exist|\b404\b"),
    ("argument", r"invalid (argument|value|parameter)|missing required"),
    ("server", r"\b50[0-3]\b|internal error|unexpected error"),
)


def section(df: DataFrame, kind: str) -> DataFrame:
    """A section's columns as text, each from the first of its candidate fields that a row fills."""
    lower = {c.lower(): c for c in df.columns}

    def pick(names: Sequence[str]) -> Column:
        have = [values.col(lower[n.lower()]) for n in names if n.lower() in lower]
        filled = [F.when(~values.is_blank(c), values.trimmed(c)) for c in have]
        return F.coalesce(*filled) if filled else F.lit(None).cast("string")

    out = df.select(*[pick(names).alias(c) for c, names in SECTIONS[kind].items()])
    return out.filter(F.coalesce(*[F.col(c) for c in list(SECTIONS[kind])[:2]]).isNotNull())


def fields(spark: SparkSession, schema: dict) -> DataFrame:
    """A record's fields from a JSON Schema, bare or within metadata: field, type, label, nullable, join target."""
    body = schema.get("metadata", schema)
    rows = []
    for name, f in (body.get("properties") or {}).items():
        target = f.get("x-n:recordType") or f.get("joinTarget") or (f.get("$ref") or "").rpartition("/")[2] or None
        rows.append((name, f.get("format") or f.get("type") or "string", f.get("title") or name, bool(f.get("nullable", True)), target))
    return spark.createDataFrame(rows, "field string, type string, label string, nullable boolean, joinTarget string")


def may_replace(old: int, new: int) -> bool:
    """A refresh that lost everything, or over half of four or more rows, is refused."""
    return not (old and new == 0 or old >= 4 and new < old / 2)


def fresh(manifest: DataFrame, now: str) -> DataFrame:
    """manifest (kind, fetched, stale) with ``fresh``."""
    days = F.coalesce(*[F.when(F.col("kind") == k, F.lit(d)) for k, d in FRESH_DAYS.items()], F.lit(FRESH_OTHERS))
    age = F.datediff(F.lit(now).cast("date"), F.col("fetched").cast("date"))
    return manifest.withColumn("fresh", ~F.coalesce(F.col("stale"), F.lit(False)) & (age <= days))


def dominant_currency(rows: DataFrame, subsidiary: str = "subsidiary", currency: str = "currency", n: str = "n") -> DataFrame:
    """The currency with the highest count in each subsidiary (ties: the first by name), and its share."""
    sums = rows.groupBy(subsidiary, currency).agg(F.sum(n).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col(currency).alias("name")))["name"]
    return sums.groupBy(subsidiary).agg(best.alias("currency"), (F.max("n") / F.sum("n")).alias("share"))


def split_subsidiaries(subs: DataFrame) -> DataFrame:
    """``real``: neither an elimination subsidiary nor the consolidated view."""
    gone = F.lower(F.coalesce("iselimination", F.lit(""))).isin("t", "true") | (F.col("id").try_cast("int") < 0) | F.lower("name").rlike(r"\belimination")
    return subs.withColumn("real", ~gone)


def last_twelve_months(periods: DataFrame, today: str) -> DataFrame:
    """The last twelve complete months (one row for each start), if they span about a year."""
    months = periods.filter("isyear = 'F' and isquarter = 'F' and coalesce(isadjust, 'F') = 'F'")
    months = months.withColumn("start", F.try_to_date("startdate", "M/d/yyyy")).withColumn("end", F.try_to_date("enddate", "M/d/yyyy")).filter(F.col("end") < F.lit(today).cast("date"))
    first = F.row_number().over(Window.partitionBy("start").orderBy("id"))
    last = months.withColumn("k", first).filter("k = 1").drop("k").orderBy(F.col("start").desc()).limit(12)
    span = last.agg(F.datediff(F.max("end"), F.min("start")).alias("days"))
    return last.join(F.broadcast(span), F.col("days").between(330, 380)).drop("days")  # span is one row


def materiality(revenue: Column) -> Column:
    out = F
    for limit, amount in MATERIALITY:
        out = out.when(revenue < limit, F.lit(amount))
    return out.otherwise(F.lit(MATERIALITY_ABOVE))


def amount(text: str) -> float | None:
    """50k, 1.5m, 2b or a plain number."""
    m = re.fullmatch(r"\s*([\d,]*\.?\d+)\s*([kmb])?\s*", text, re.I)
    return float(m[1].replace(",", "")) * {"": 1, "k": 1e3, "m": 1e6, "b": 1e9}[(m[2] or "").lower()] if m else None


def classify(message: Column) -> Column:
    low = F.lower(message)
    return F.coalesce(*[F.when(low.rlike(p), F.lit(k)) for k, p in ERRORS], F.lit("other"))


def backoff(attempt: int, jitter: float | None = None) -> float:
    """Seconds to wait before try ``attempt`` + 1."""
    return 5 * 2 ** (attempt - 1) + (random.uniform(0, 3) if jitter is None else jitter)


# --- templates: the queries that profiles and answers are made of, over views of the account's tables

TEMPLATES = {
    "top_customers": "SELECT TOP {n} c.id, c.name, SUM(t.amount) AS amount FROM transaction t JOIN customer c ON c.id = t.entity WHERE t.trandate >= TO_DATE('{since}', 'YYYY-MM-DD') GROUP BY c.id, c.name ORDER BY SUM(t.amount) DESC, c.id",
    "account_detail": "SELECT t.id, t.trandate, l.account, l.amount FROM transaction t JOIN transactionline l ON l.transaction = t.id WHERE l.account = '{account}' ORDER BY t.trandate, t.id, l.id",
    "by_subsidiary": "SELECT t.subsidiary, t.currency, SUM(t.amount) AS amount, COUNT(*) AS n FROM transaction t GROUP BY t.subsidiary, t.currency ORDER BY t.subsidiary, t.currency",
    "budget_actual": "SELECT b.account, b.amount AS budget, a.amount AS actual FROM (SELECT account, SUM(amount) AS amount FROM budget GROUP BY account) b LEFT JOIN (SELECT account, SUM(amount) AS amount FROM transactionline GROUP BY account) a ON a.account = b.account ORDER BY b.account",
    "aging": "SELECT t.entity, SUM(CASE WHEN t.days <= 0 THEN t.open ELSE 0 END) AS current_due, SUM(CASE WHEN t.days BETWEEN 1 AND 30 THEN t.open ELSE 0 END) AS d1_30, SUM(CASE WHEN t.days BETWEEN 31 AND 60 THEN t.open ELSE 0 END) AS d31_60, SUM(CASE WHEN t.days BETWEEN 61 AND 90 THEN t.open ELSE 0 END) AS d61_90, SUM(CASE WHEN t.days > 90 THEN t.open ELSE 0 END) AS d91 FROM openitems t GROUP BY t.entity ORDER BY t.entity",
}
