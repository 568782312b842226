"""Sharding over fixed virtual slots, with DataFrame functions only.

Records hash into a fixed number of virtual slots; bytes are summed per slot, and a slot-to-shard map places slots
on shards. ``MapStore`` keeps the map's versions as Parquet in a shared folder; a version is written once and never
changed, so readers hold on to theirs while a new one is made. Rebalancing reads the newest version, edits it and
stores the next: ``rebalance`` moves slots off shards that have outgrown the mean, ``grow`` moves slots onto one new
shard only; every other slot stays where it is. ``place`` makes the first version: slots, the largest first, go to
the least loaded shard.

The map has one row per slot (8,192 by default) at every input size, so it is broadcast and one task may order it.
Null ids hash like any value, null texts count no bytes, an empty table gives a map of empty slots; repeated rows
share a slot and get places of their own. Slots of equal bytes go by their number, shards of equal load likewise.
Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywell.llm.common import remove, shared_folder

SLOTS = 8192
SHARDS = 24
OVERHEAD = 8  # bytes that a record takes besides its text
TOLERANCE = 0.02  # that a shard may exceed the mean before a rebalance moves its slots
STRIDE = 256  # slots that one fold lists


def vslot(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def records(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and vslot of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        vslot(F.col(id_col).cast("long"), slots).alias("vslot"),
    )


def slot_sums(recs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """vslot, bytes, rows of every slot: summed before the shuffle, so at most one row per slot and task moves."""
    sums = recs.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    every = recs.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot"))
    return every.join(sums, "vslot", "left").select("vslot", F.coalesce("bytes", F.lit(0).cast("long")).alias("bytes"), F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))


def _edited(rows: DataFrame, zero: Column, step, version: Column) -> DataFrame:
    """The map that a fold over all slots, the largest first, makes: step(state, slot) gives (state, shard). Slots are
    listed in blocks, since a fold copies what it has listed at every step."""

    def block(state: Column, xs: Column) -> Column:
        start = F.struct(state["now"].alias("now"), F.array().cast("array<int>").alias("at"))

        def one(inner: Column, x: Column) -> Column:
            now, shard = step(inner["now"], x)
            return F.struct(now.alias("now"), F.concat(inner["at"], F.array(shard.cast("int"))).alias("at"))

        done = F.get(F.transform(F.array(F.aggregate(xs, start, one)), lambda d: F.struct(d["now"].alias("now"), F.concat(state["at"], d["at"]).alias("at"))), F.lit(0))
        return done

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("list") - 1) / STRIDE).cast("int")), lambda k: F.slice("list", k * STRIDE + 1, F.lit(STRIDE)))
    at = F.aggregate(blocks, F.struct(zero.alias("now"), F.array().cast("array<int>").alias("at")), block)["at"]
    out = rows.filter(F.size("list") > 0).select(version.alias("version"), F.explode(F.arrays_zip(F.col("list"), at.alias("at"))).alias("x"))
    return out.select("version", F.col("x.list.vslot").alias("vslot"), F.col("x.at").alias("shard"), F.col("x.list.bytes").alias("bytes"), F.col("x.list.rows").alias("rows"))


def _listed(sums: DataFrame, *more: str) -> DataFrame:
    """One row with all slots, largest first; there are never more than the fixed number of slots."""
    return sums.agg(F.sort_array(F.collect_list(F.struct(F.col("bytes"), F.col("vslot"), F.col("rows"), *more)), asc=False).alias("list"))


def _added(load: Column, shard: Column, bytes_: Column) -> Column:
    return F.transform(load, lambda v, i: F.when(i == shard, v + bytes_).otherwise(v))


def _lightest(load: Column) -> Column:
    return F.array_position(load, F.array_min(load)).cast("int") - 1


def place(sums: DataFrame, shards: int = SHARDS, version: int = 1) -> DataFrame:
    """The map version, vslot, shard, bytes, rows: each slot, the largest first, goes to the shard with the
    fewest bytes so far (ties: the lowest shard)."""

    def step(load: Column, x: Column) -> tuple[Column, Column]:
        best = _lightest(load)
        return _added(load, best, x["bytes"]), best

    return _edited(_listed(sums), F.array_repeat(F.lit(0).cast("long"), shards), step, F.lit(version))


def _loads(shards: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda k: F.aggregate("list", F.lit(0).cast("long"), lambda a, x: a + F.when(x["shard"] == k, x["bytes"]).otherwise(0)))


def _total() -> Column:
    return F.aggregate("list", F.lit(0).cast("long"), lambda a, x: a + x["bytes"])


def grow(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version of a map over ``shards`` shards, with one more: slots, the largest first, move to the
    new shard from shards above the new mean while they fit under it; no other slot moves."""
    rows = _listed(slot_map, "shard", "version").select("list", (_total() / F.lit(shards + 1)).alias("mean"), F.concat(_loads(shards), F.array(F.lit(0).cast("long"))).alias("load"))

    def step(load: Column, x: Column) -> tuple[Column, Column]:
        moves = (F.get(load, x["shard"]) - x["bytes"] >= F.col("mean")) & (F.get(load, F.lit(shards)) + x["bytes"] <= F.col("mean")) & (x["bytes"] > 0)
        left = _added(_added(load, x["shard"], -x["bytes"]), F.lit(shards), x["bytes"])
        return F.when(moves, left).otherwise(load), F.when(moves, F.lit(shards)).otherwise(x["shard"])

    return _edited(rows, F.col("load"), step, F.get(F.col("list"), F.lit(0))["version"] + 1)


def rebalance(slot_map: DataFrame, sums: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """The next version of a map for the slots' present sums: slots, the largest first, move from shards that exceed
    the mean by more than the tolerance to the least loaded one, where that one stays within it; no other slot moves."""
    now = slot_map.select("vslot", "shard", "version").join(F.broadcast(sums), "vslot")
    rows = _listed(now, "shard", "version").select("list", (_total() / F.lit(shards) * (1 + tolerance)).alias("most"), _loads(shards).alias("load"))

    def step(load: Column, x: Column) -> tuple[Column, Column]:
        best = _lightest(load)
        moves = (F.get(load, x["shard"]) > F.col("most")) & (F.get(load, best) + x["bytes"] <= F.col("most")) & (x["bytes"] > 0)
        left = _added(_added(load, x["shard"], -x["bytes"]), best, x["bytes"])
        return F.when(moves, left).otherwise(load), F.when(moves, best).otherwise(x["shard"])

    return _edited(rows, F.col("load"), step, F.get(F.col("list"), F.lit(0))["version"] + 1)


class MapStore:
    """Versions of a map as Parquet in a folder that all executors share, one folder each, written once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, version: int) -> str:
        return f"{self.folder}/map-{version:010d}"

    def versions(self) -> list[int]:
        """The whole versions: a write that broke off leaves no mark and does not count."""
        jvm = self.spark._jvm
        marks = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/map-*/_SUCCESS")
        found = marks.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(marks)
        return sorted(int(x.getPath().getParent().getName()[4:]) for x in found or [])

    def write(self, slot_map: DataFrame, version: int) -> DataFrame:
        """Stores a map under a version that must be new, and reads it back."""
        if version in self.versions():
            raise ValueError(f"version {version} is stored already")
        remove(self.spark, self._path(version))  # what a broken write left
        slot_map.withColumn("version", F.lit(version)).coalesce(1).write.parquet(self._path(version))
        return self.read(version)

    def read(self, version: int | None = None) -> DataFrame:
        """A stored version, the newest by default."""
        known = self.versions()
        if not known or version is not None and version not in known:
            raise ValueError(f"no stored map {'' if version is None else version}")
        return self.spark.read.schema(_MAP).parquet(self._path(known[-1] if version is None else version))


_MAP = "version int, vslot int, shard int, bytes long, rows long"


def assign(recs: DataFrame, slot_map: DataFrame) -> DataFrame:
    """recs with shard and slot, the place in the shard, gapless from 0.

    A row's place is its slot's first place in the shard (a running sum over the map's few rows) and its rank
    within the virtual slot, so no task orders a whole shard.
    """
    first = F.sum("rows").over(Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1))
    starts = slot_map.select("version", "vslot", "shard", F.coalesce(first, F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size"))
    return recs.withColumn("rank", rank).join(F.broadcast(starts), "vslot").select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("rank") - 1).cast("long").alias("slot"), "vslot", "version")


def mapped(recs: DataFrame, store: MapStore, shards: int = SHARDS, slots: int = SLOTS, tolerance: float = TOLERANCE) -> DataFrame:
    """The store's newest map for these records: the first version is placed, a later one made by rebalancing where a
    shard has outgrown the mean; otherwise the stored shards stand, with the present sums."""
    sums = slot_sums(recs, slots)
    known = store.versions()
    if not known:
        return store.write(place(sums, shards), 1)
    now = store.read().select("version", "vslot", "shard").join(F.broadcast(sums), "vslot").select("version", "vslot", "shard", "bytes", "rows")
    load = now.groupBy("shard").agg(F.sum("bytes").alias("bytes")).agg(F.max("bytes").alias("most"), F.sum("bytes").alias("all")).first()
    if (load["most"] or 0) * shards <= (load["all"] or 0) * (1 + tolerance):
        return now
    return store.write(rebalance(store.read(), sums, shards, tolerance), known[-1] + 1)


def sharded(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, slots: int = SLOTS, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(the rows with their shard and slot, the stored map). folder: of the map's versions; by default a new one in
    the shared checkpoint folder."""
    spark = df.sparkSession
    recs = records(df, id_col, text_col, slots)
    slot_map = mapped(recs, MapStore(spark, folder or shared_folder(spark, "shards")), shards, slots)
    return assign(recs, slot_map), slot_map
