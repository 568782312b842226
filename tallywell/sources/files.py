"""Sinks and small sources: guarded CSV, workbooks, tab-separated indexes, audit logs, raw text."""

from __future__ import annotations

import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.functions import values


def spreadsheet_safe(df: DataFrame) -> DataFrame:
    """Text that a spreadsheet would run as a formula gets a quote in front, unless it is a plain number."""
    risky = lambda c: c.rlike(r"^[=+\-@\t\r]") & ~c.rlike(values.NUMBER)
    return df.select(*[(F.when(risky(values.col(c)), F.concat(F.lit("'"), values.col(c))).otherwise(values.col(c)).alias(c) if t == "string" else values.col(c)) for c, t in df.dtypes])


def write_csv(df: DataFrame, path: str, spreadsheet: bool = False, single: bool = False) -> None:
    out = spreadsheet_safe(df) if spreadsheet else df
    out = out.select(*[F.to_json(values.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else values.col(f.name) for f in out.schema])
    (out.coalesce(1) if single else out).write.mode("overwrite").option("escape", '"').option("quote", '"').csv(path, header=True)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).option("escape", '"').csv(path, header=True)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tabs and line ends in cells become spaces."""
    df.select(*[F.regexp_replace(values.col(c).cast("string"), r"[\t\r\n]+", " ").alias(c) for c in df.columns]).write.mode("overwrite").csv(path, sep="\t", header=True, quote="")


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, quote="")


def _letters(k: int) -> str:
    out = ""
    k += 1
    while k:
        k, r = divmod(k - 1, 26)
        out = chr(65 + r) + out
    return out


def write_xlsx(df: DataFrame, path: str, sheet: str = "Result") -> int:
    """One sheet, written row by row as partitions arrive at the driver: numbers as numbers, the rest as text."""
    numeric = [isinstance(f.dataType, values.NUMERIC) for f in df.schema]
    clean = lambda s: "".join(c for c in s if c in "\t\n\r" or ord(c) >= 32)

    def line(n: int, cells, kinds) -> str:
        out = []
        for k, (v, number) in enumerate(zip(cells, kinds)):
            if v is None:
                continue
            ref = f"{_letters(k)}{n}"
            if number and v == v and abs(v) != float("inf"):
                out.append(f'<c r="{ref}"><v>{v}</v></c>')
            else:
                out.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(clean(str(v)))}</t></is></c>')
        return f'<row r="{n}">{"".join(out)}</row>'

    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    n = 1
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{escape(sheet[:31])}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        with z.open("xl/worksheets/sheet1.xml", "w") as out:
            out.write(f'{head}<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'.encode())
            out.write(line(1, df.columns, [False] * len(df.columns)).encode())
            for row in df.toLocalIterator():
                n += 1
                out.write(line(n, row, numeric).encode())
            out.write(b"</sheetData></worksheet>")
    return n - 1


def audit(spark: SparkSession, path: str, session: str | None = None, days: int | None = None) -> DataFrame:
    """Audit entries, one JSON object a line, of a session and of the last so many days that have entries."""
    df = spark.read.schema("ts string, session string, tool string, decision string, note string, query string").json(path)
    df = df.withColumn("day", F.substring("ts", 1, 10))
    if session:
        df = df.filter(F.col("session") == session)
    if days:
        last = df.select("day").distinct().orderBy(F.col("day").desc()).limit(days)
        df = df.join(F.broadcast(last), "day")
    return df.orderBy("ts")


def denials(audit_rows: DataFrame, days: int = 7) -> DataFrame:
    """How often each rule denied a call, over the last active days."""
    rank = F.dense_rank().over(Window.partitionBy().orderBy(F.col("day").desc()))
    last = audit_rows.select("day").distinct().withColumn("rank", rank).filter(F.col("rank") <= days).select("day")
    rows = audit_rows.filter("decision = 'deny'").join(F.broadcast(last), "day")
    return rows.select(F.explode(F.split("note", r"\s*,\s*")).alias("rule")).filter("rule <> ''").groupBy("rule").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "rule")


def peek(spark: SparkSession, path: str, term: str | None = None, lines: int = 40) -> list[str]:
    """Chunks of a raw answer that hold a term, or its first ones: at line ends and between objects."""
    text = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", r"\n|(?<=\},)")).alias("x"))
    found = text.filter(F.contains(F.lower("x"), F.lit(term.lower()))) if term else text
    return [r[0][:300] for r in found.limit(lines).collect()]
