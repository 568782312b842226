"""What the training-data operators share: reading tables, cutting lineage, batches and hashes."""

from __future__ import annotations

import os
import tempfile
import uuid
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPO = str(Path(__file__).resolve().parents[2])

BATCH = 8 << 20
_MEMORY = {"MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 20), "ARROW_DEFAULT_MEMORY_POOL": "system"}
_LIMIT, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package, bound the batches they get, and have a checkpoint folder.

    Workers live on between stages, so large arrays are to go back to the system when they are freed. Batches of rows end at BATCH bytes unless the session says otherwise: ten thousand long texts would fill a
    worker. A cluster names its shared folder in spark.checkpoint.dir; only in a local run where that is unset a
    temporary one is made, as on a cluster no other machine could read it.
    """
    sc = spark.sparkContext
    paths = sc.environment.get("PYTHONPATH", "")
    if REPO not in paths.split(os.pathsep):
        sc.environment["PYTHONPATH"] = os.pathsep.join(x for x in (REPO, paths) if x)
    for name, value in _MEMORY.items():
        sc.environment.setdefault(name, value)
    if spark.conf.get(_LIMIT) == _DEFAULT:
        spark.conf.set(_LIMIT, str(BATCH))
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """The name of a new folder in the shared one."""
    ready(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4()}"


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """The rows of df, kept in the shared checkpoint folder, so that a lost executor costs no recomputation."""
    ready(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(df: DataFrame, name: str) -> str:
    """name, or a longer one that no column of df has."""
    while name in df.columns:
        name += "_"
    return name


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the columns an operator reads, so clashing extra columns do no harm; null texts become empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more)


def texts_of(batches, size: int = 1 << 18):
    """(ids, whole texts) of Arrow batches, in runs of about ``size`` bytes, so that a task's memory does not
    depend on the batch; a longer text is a run of its own."""
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield ids.slice(at, to - at).to_pylist(), texts.slice(at, to - at).to_pylist()
            at = to


def rows_to_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def id_crc(doc_id) -> int:
    """crc32 of the id as text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose result bits all depend on all bits (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))
