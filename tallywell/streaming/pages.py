"""Pages that arrive over time: a stream of page files appended to a stored result, each page once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def append_pages(spark: SparkSession, source: str, schema: T.StructType | str, sink: str, checkpoint: str):
    """Starts a query that appends new page files (Parquet with a ``page`` column) to sink and ends when all that
    is there has been read. The stream's own checkpoint keeps a page from being appended twice."""
    pages = spark.readStream.schema(schema).parquet(source)
    return pages.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", sink).outputMode("append").trigger(availableNow=True).start()


def hourly(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Counts and sums an hour and event type, over a stream or a table of events with ts, event_type and value."""
    own = events.withWatermark("ts", late) if events.isStreaming else events
    return own.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("hour"), "event_type", "n", "total")
