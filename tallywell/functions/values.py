"""Cell values as Column expressions: blanks, numbers, dates, text forms and sort keys. No Python runs on rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.functions.names import CURRENCIES, quoted

# What counts as a number, a date or a truth value.
NUMBER = r"^-?((\d{1,3}(,\d{3})+|\d+)(\.\d+)?|\.\d+)([eE][-+]?\d+)?\z"
MONEY = r"^(-\s*)?(?:([$€£¥]|[A-Z]{3}(?![A-Za-z]))\s*)?(-\s*)?((?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?(?:[eE][-+]?\d+)?|\.\d+(?:[eE][-+]?\d+)?)(?:\s*([A-Z]{3}|[$€£¥]))?\z"
ISO_DATE = r"(?i)^\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*([ap]m|Z|[+-]\d{2}:?\d{2})?)?\z"
SLASH_DATE = r"^(\d{1,2})/(\d{1,2})/(\d{4})\z"
REAL_SLASH_DATE = r"^(0?[1-9]|1[0-2])/(0?[1-9]|[12]\d|3[01])/\d{4}\z"
TRUTH = r"(?i)^(t|f|true|false)\z"
LOOSE_TIME = r"(?i)^(\d{4})-(\d{1,2})-(\d{1,2})[ T](\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s*([ap])\.?m\.?)?\z"
SLASH_TIME = r"(?i)^(\d{1,2})/(\d{1,2})/(\d{4})(?:\s+(\d{1,2}:\d{2}(?::\d{2})?(?:\s*[ap]\.?m\.?)?))?\z"

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def col(name: str) -> Column:
    return F.col(quoted(name))


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


#: Unicode white space.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def trimmed(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.trim(c.cast("string"), F.lit(SPACES))


def is_blank(c: Column, kind: T.DataType | None = None) -> Column:
    if kind is not None and not isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        return c.isNull()
    return c.isNull() | (trimmed(c) == "")


def blank_in(df: DataFrame, name: str) -> Column:
    return is_blank(col(name), type_of(df, name))


def text_in(df: DataFrame, name: str) -> Column:
    """The cell's text without outer space; null for blanks. Only text columns pay for trimming."""
    c, kind = col(name), type_of(df, name)
    if not isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        return text_form(c, kind)
    return F.when(~is_blank(c), trimmed(c))


def to_number(c: Column, kind: T.DataType | None = None) -> Column:
    """The cell's number or null: plain, with thousands, or money with a symbol, a code or accounting brackets."""
    if isinstance(kind, NUMERIC):
        x = c.cast("double")
        return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)
    if isinstance(kind, (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(None).cast("double")
    s = trimmed(c)
    read = lambda x: F.expr("null").cast("double") if x is None else F.regexp_replace(x, ",", "").try_cast("double")
    bracketed = s.rlike(r"^\(.*\)\z")
    body = F.when(bracketed, trimmed(F.regexp_replace(s, r"^\(|\)\z", ""))).otherwise(s)
    part = lambda k: F.regexp_extract(body, MONEY, k)
    tag = lambda x: (x == "") | x.isin("$", "€", "£", "¥") | x.isin(*sorted(CURRENCIES))
    signs = bracketed.cast("int") + (part(1) != "").cast("int") + (part(3) != "").cast("int")
    marked = bracketed | (part(2) != "") | (part(5) != "")
    money = F.when(body.rlike(MONEY) & marked & tag(part(2)) & tag(part(5)) & (signs <= 1), F.when(signs == 1, -read(part(4))).otherwise(read(part(4))))
    return F.when(s.rlike(NUMBER), read(s)).when(s.rlike(r"\d") & s.rlike(r"[$€£¥A-Z()]"), money)


def text_form(c: Column, kind: T.DataType | None = None) -> Column:
    """The cell as text, whole numbers without a fraction."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        x = c.cast("double")
        return F.when((x == F.floor(x)) & (F.abs(x) < 1e15), x.cast("decimal(38,0)").cast("string")).otherwise(x.cast("string"))
    if isinstance(kind, T.DecimalType):
        return F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.\d*?)0+\z", "$1"), r"\.\z", "")
    return c.cast("string")


def date_key(c: Column) -> Column:
    """A sortable form of ISO (padded or not, its time kept) and M/D/YYYY dates; else the first ten characters."""
    s = trimmed(c)
    slash = lambda k: F.regexp_extract(s, SLASH_DATE, k)
    iso = r"^(\d{4})-(\d{1,2})-(\d{1,2})(.*)\z"
    part = lambda k: F.regexp_extract(s, iso, k)
    return (
        F.when(s.rlike(SLASH_DATE), F.concat_ws("-", slash(3), F.lpad(slash(1), 2, "0"), F.lpad(slash(2), 2, "0")))
        .when(s.rlike(iso), F.concat(part(1), F.lit("-"), F.lpad(part(2), 2, "0"), F.lit("-"), F.lpad(part(3), 2, "0"), F.regexp_replace(part(4), "^T", " ")))
        .otherwise(F.substring(s, 1, 10))
    )


def is_date(c: Column) -> Column:
    s = trimmed(c)
    return s.rlike(ISO_DATE) | s.rlike(REAL_SLASH_DATE)


def real_date(year: Column, month: Column, day: Column) -> Column:
    return F.date_format(F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd"), "yyyy-MM-dd")


def normalised_date(c: Column) -> Column:
    """A padded date or datetime, or the cell as it is where it is none or cannot be."""
    s = trimmed(c)
    part = lambda k: F.regexp_extract(s, LOOSE_TIME, k)
    hour, half = part(4).try_cast("int"), F.lower(part(7))
    hour = F.when(half == "", F.when(hour <= 23, hour)).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    second = part(6)
    good = (part(5).try_cast("int") <= 59) & ((second == "") | (second.try_cast("int") <= 59))
    day = real_date(part(1), part(2), part(3))
    time = F.concat(day, F.lit(" "), F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), part(5), F.when(second == "", "").otherwise(F.concat(F.lit(":"), second)))
    short = r"^(\d{4})-(\d{1,2})-(\d{1,2})\z"
    plain = lambda k: F.regexp_extract(s, short, k)
    return F.coalesce(F.when((F.length(c) < 10) & s.rlike(short), real_date(plain(1), plain(2), plain(3))).when((F.length(c) <= 24) & s.rlike(LOOSE_TIME) & good, time), c)


def natural_key(c: Column) -> Column:
    """Text order that ignores case and compares runs of digits by value."""
    s = F.lower(c.cast("string"))
    runs = F.regexp_extract_all(s, F.lit(r"(\D+|\d+)"), F.lit(1))

    def by_value(digits: Column) -> Column:  # shorter numbers first, then digit by digit
        own = F.regexp_replace(digits, "^0+(?=.)", "")
        return F.concat(F.lpad(F.length(own).cast("string"), 10, "0"), own)

    return F.concat_ws("", F.transform(runs, lambda x: F.when(x.rlike(r"^\d"), by_value(x)).otherwise(x)))


def folded(c: Column) -> Column:
    """Text compared without regard to case and accents."""
    return F.collate(c.cast("string"), "UNICODE_CI_AI")


def canonical(c: Column, kind: T.DataType | None = None) -> Column:
    """The text under which diff keys are equal: numbers by value, codes with leading zeros as they are."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.coalesce(c.cast("string"), F.lit(""))
    s = F.coalesce(trimmed(text_form(c, kind)), F.lit(""))
    plain = s.rlike(r"^-?(0|[1-9]\d*)(\.\d+)?\z")
    number = F.regexp_replace(F.regexp_replace(s, r"(\.\d*?)0+\z", "$1"), r"\.\z", "")
    return F.when(plain, F.when(number == "-0", "0").otherwise(number)).otherwise(s)


def exact_sum(x: Column) -> Column:
    """The sum of numbers, the same in any order: in decimals that hold every cell as it is (18 places, 20 digits
    before them), or in doubles where one does not fit."""
    d = x.try_cast("decimal(38,18)")
    fits = F.count(x) == F.count(F.when(d.cast("double") == x, 1))
    return F.when(fits, F.coalesce(F.try_sum(d).cast("double"), F.sum(x))).otherwise(F.sum(x))


def half_up(x: Column, places: int) -> Column:
    """Rounded half towards plus infinity."""
    return F.floor(x * 10**places + 0.5) / 10**places
