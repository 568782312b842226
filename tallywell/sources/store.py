"""Saved results: Parquet with logical types, one metadata line each, retention."""

from __future__ import annotations

import datetime
import json
import secrets
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.functions import names, values
from tallywell.operators.profile import logical_types, typed

INLINE_CHARS = 6000
RETENTION_DAYS = 7
_META = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "created", "session", "tool", "query", "columns", "truncated")] + [T.StructField("rows", T.LongType())])


@dataclass
class Meta:
    id: str
    created: str
    tool: str
    query: str
    rows: int
    columns: list[dict] = field(default_factory=list)
    session: str = ""
    truncated: str | None = None


class Store:
    """Results under a folder that Spark can write: data/<id> and meta/, a small table with a row for each result."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def save(self, df: DataFrame, tool: str = "", query: str = "", session: str = "", truncated: str | None = None, created: str | None = None) -> Meta:
        kinds = logical_types(df)
        out = typed(df, kinds)
        name = f"r_{secrets.token_hex(3)}"
        out.write.parquet(f"{self.folder}/data/{name}")
        meta = Meta(name, created or datetime.datetime.now(datetime.UTC).isoformat(), tool, query, self.load(name).count(), [{"name": c, "type": kinds[c]} for c in df.columns], session, truncated)
        row = asdict(meta) | {"columns": json.dumps(meta.columns)}
        self.spark.createDataFrame([tuple(row[f.name] for f in _META)], _META).write.mode("append").parquet(f"{self.folder}/meta")
        return meta

    def listing(self, n: int = 20) -> DataFrame:
        return self.spark.read.schema(_META).parquet(f"{self.folder}/meta").orderBy(F.col("created").desc(), "id").limit(n)

    def find(self, name: str) -> Meta | None:
        row = self.spark.read.schema(_META).parquet(f"{self.folder}/meta").filter(F.col("id").isin(name, f"r_{name}")).first()
        return Meta(**(row.asDict() | {"columns": json.loads(row["columns"])})) if row else None

    def load(self, name: str) -> DataFrame:
        """The rows; logical types ride in the columns' metadata."""
        return self.spark.read.parquet(f"{self.folder}/data/{name if name.startswith('r_') else f'r_{name}'}")

    def cleanup(self, now: str | None = None, days: int = RETENTION_DAYS) -> list[str]:
        """Removes results older than the limit and returns their ids. Folders go through Hadoop's file system, so
        any store that Spark writes to will do."""
        at = datetime.datetime.fromisoformat(now) if now else datetime.datetime.now(datetime.UTC)
        limit = (at - datetime.timedelta(days=days)).isoformat()
        meta = self.spark.read.schema(_META).parquet(f"{self.folder}/meta")
        old = [r["id"] for r in meta.filter(F.col("created") < limit).select("id").collect()]
        if not old:
            return []
        keep = [tuple(r) for r in meta.filter(F.col("created") >= limit).collect()]  # a row for each saved result
        jvm = self.spark._jvm
        path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        fs = path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        self.spark.createDataFrame(keep, _META).write.mode("overwrite").parquet(f"{self.folder}/meta.new")
        fs.delete(path(f"{self.folder}/meta"), True)
        fs.rename(path(f"{self.folder}/meta.new"), path(f"{self.folder}/meta"))
        for name in old:
            fs.delete(path(f"{self.folder}/data/{name}"), True)
        return old


def inline(df: DataFrame, limit: int = INLINE_CHARS) -> bool:
    """Whether a result is short enough to show whole."""
    size = df.select(F.sum(F.length(F.to_json(F.struct(*[values.col(c) for c in df.columns])))).alias("n")).first()["n"]
    return (size or 0) <= limit


def truncation(rows: int, paging: dict, sql_cap: int | None = None, range_end: int | None = None) -> str | None:
    """Why a result holds only part of its rows, or None."""
    if paging.get("total") is not None and paging["total"] > rows:
        return f"{rows} of {paging['total']} rows"
    if paging.get("more"):
        return f"{rows} rows, and more pages"
    if sql_cap is not None and rows >= sql_cap:
        return f"the query's own limit of {sql_cap} rows was reached"
    if range_end is not None and rows >= range_end:
        return f"the range ends at {range_end}"
    return None


def drop_ordinal(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(names.quoted(c)) for c in df.columns if c != "_ord"])
