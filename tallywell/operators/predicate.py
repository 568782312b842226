"""The where mini-language: ``a = 1 and b ~ x or c is null`` to a Column. ``and`` binds tighter; no brackets."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.functions import names, values

_OPERATOR = re.compile(r"\s*(!=|<>|>=|<=|!~|=|>|<|~)\s*")
_NULL = re.compile(r"\s+is\s+(not\s+)?null\s*$", re.I)
_DATE = re.compile(r"^(?:(\d{4})-(\d{1,2})-(\d{1,2})|(\d{1,2})/(\d{1,2})/(\d{4}))(?:[T ](\d{1,2}):(\d{2})(?::(\d{2}))?\s*([ap]m)?)?$", re.I)


def split_words(text: str, word: str) -> list[str]:
    """text cut at a word outside quotes."""
    parts, quote, start, i = [], "", 0, 0
    while i < len(text):
        c = text[i]
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        elif (m := re.match(rf"\s+{word}\s+", text[i:], re.I)) is not None:
            parts.append(text[start:i])
            i += m.end()
            start = i
            continue
        i += 1
    return [*parts, text[start:]]


def literal_date(text: str) -> str | None:
    """The sortable key of a date literal, or None."""
    import datetime

    if not (m := _DATE.match(text.strip())):
        return None
    y, mo, d = (m[1], m[2], m[3]) if m[1] else (m[6], m[4], m[5])
    try:
        day = datetime.date(int(y), int(mo), int(d)).isoformat()
    except ValueError:
        return None
    if not m[7]:
        return day
    h = int(m[7])
    if m[10]:
        if not 1 <= h <= 12:
            return None
        h = h % 12 + (12 if m[10].lower() == "pm" else 0)
    if h > 23 or int(m[8]) > 59:
        return None
    return f"{day} {h:02d}:{m[8]}" + (f":{m[9]}" if m[9] else "")


def _number(text: str) -> float | None:
    own = text.strip()
    return float(own.replace(",", "")) if re.match(r"^-?((\d{1,3}(,\d{3})+|\d+)(\.\d+)?|\.\d+)([eE][-+]?\d+)?$", own) else _money(own)


def _money(text: str) -> float | None:
    m = re.match(r"^([$€£¥]|[A-Z]{3}\s)?\s*(-?[\d,]*\.?\d+)\s*([$€£¥]|[A-Z]{3})?$", text)
    tags = [t.strip() for t in (m[1], m[3]) if t] if m else []
    if not tags or any(t not in "$€£¥" and t not in names.CURRENCIES for t in tags):
        return None
    return float(m[2].replace(",", ""))  # type: ignore[index]


def _bare(text: str) -> str:
    own = text.strip()
    return own[1:-1] if len(own) > 1 and own[0] == own[-1] and own[0] in "'\"" else own


def condition(text: str, df: DataFrame) -> Column:
    columns = df.columns
    if m := _NULL.search(text):
        name = names.resolve(text[: m.start()], columns)
        if name is None:
            raise ValueError(f"no such column: {text[: m.start()].strip()}; columns: {', '.join(columns)}")
        blank = values.is_blank(values.col(name))
        return ~blank if m[1] else blank
    found = None
    for m in _OPERATOR.finditer(text):
        if text[: m.start()].count('"') % 2 or text[: m.start()].count("`") % 2:
            continue
        found = m
        break
    if not found:
        raise ValueError(f"no comparison in: {text.strip()}")
    name, op, raw = names.resolve(text[: found.start()], columns), found[1], text[found.end() :].strip()
    if name is None:
        raise ValueError(f"no such column: {text[: found.start()].strip()}; columns: {', '.join(columns)}")
    if not raw or raw[0] in "=<>~":
        raise ValueError(f"a value is missing after {op} in: {text.strip()}")
    return compare(df, name, op, _bare(raw))


def compare(df: DataFrame, name: str, op: str, literal: str) -> Column:
    c, kind = values.col(name), values.type_of(df, name)
    text, blank = values.text_form(c, kind), values.is_blank(c)
    no = F.lit(False)
    if op in ("~", "!~"):
        has = F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lit(literal.lower()))
        return has if op == "~" else ~has
    if (key := literal_date(literal)) is not None:
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            # in the column's own type, so that the comparison reaches the scan
            wide = "timestamp" if isinstance(kind, T.TimestampType) else "timestamp_ntz"
            low = F.lit(key).cast(wide)
            high = F.lit(key).cast(wide) + F.expr("interval 1 day") if len(key) == 10 else low + F.expr("interval 1 microsecond")
            made = {"=": (c >= low) & (c < high), ">": c >= high, ">=": c >= low, "<": c < low, "<=": c < high}
            return F.coalesce(~made["="] if op in ("!=", "<>") else made[op], no)
        own = values.date_key(c)
        own = F.substring(own, 1, 10) if len(key) == 10 else own
        dated = values.is_date(c) & ~blank
        made = {"=": own == key, ">": own > key, ">=": own >= key, "<": own < key, "<=": own <= key}
        if op in ("!=", "<>"):
            return ~blank & ~F.coalesce(dated & made["="], no)
        return F.coalesce(dated & made[op], no)
    number, folded = values.to_number(c, kind), values.folded(text)
    value = _number(literal)
    made = {"=": folded == literal, ">": folded > literal, ">=": folded >= literal, "<": folded < literal, "<=": folded <= literal}
    if value is not None:
        if isinstance(kind, values.NUMERIC) and not isinstance(kind, (T.FloatType, T.DoubleType)) or isinstance(kind, (T.FloatType, T.DoubleType)):
            number = c  # the plain column, so that the comparison reaches the scan
            exact = F.lit(int(value) if value == int(value) and abs(value) < 2**31 and not isinstance(kind, (T.FloatType, T.DoubleType)) else value)
            made = {"=": c == exact, ">": c > exact, ">=": c >= exact, "<": c < exact, "<=": c <= exact}
            return F.coalesce(c != exact, no) if op in ("!=", "<>") else made[op]
        numeric = {"=": number == value, ">": number > value, ">=": number >= value, "<": number < value, "<=": number <= value}
        made = {k: F.when(number.isNotNull(), numeric[k]).otherwise(v) for k, v in made.items()}
    if op in ("!=", "<>"):
        return ~blank & ~F.coalesce(made["="], no)
    return F.coalesce(~blank & made[op], no)


def where(text: str, df: DataFrame) -> Column:
    return reduce(or_, [reduce(and_, [condition(c, df) for c in split_words(part, "and")]) for part in split_words(text, "or")])


def filtered(df: DataFrame, *texts: str) -> DataFrame:
    """Rows that meet every where text."""
    for t in texts:
        df = df.filter(where(t, df))
    return df


def search(df: DataFrame, terms: Sequence[str], name: str | None = None) -> DataFrame:
    """Rows in which every term occurs somewhere (``a|b``: either), the best first: a whole cell, then a cell's
    beginning, then any place; shorter names before longer."""
    text = F.lower(F.concat_ws(" ", *[values.col(c).cast("string") for c in df.columns]))
    cells = F.array(*[F.lower(F.coalesce(values.col(c).cast("string"), F.lit(""))) for c in df.columns])
    options = [[x.lower() for x in t.split("|") if x] for t in terms]
    hit = [reduce(or_, [F.contains(text, F.lit(x)) for x in own]) for own in options if own]
    every = [x for own in options for x in own]
    rank = F.least(*[F.when(F.array_contains(cells, x), 0).when(F.exists(cells, _starts(x)), 1).otherwise(2) for x in [*every, every[0]]]) if every else F.lit(2)
    first = values.col(name or df.columns[0]).cast("string")
    return df.filter(reduce(and_, hit) if hit else F.lit(True)).orderBy(rank, F.length(first), first)


def _starts(x: str):
    return lambda y: F.startswith(y, F.lit(x))
