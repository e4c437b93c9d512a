"""Pieces that the corpus operators share: table access, the shared folder and chunked text batches."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read through Spark only, so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local master may fall back to a temporary one."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = os.path.join(tempfile.gettempdir(), "checkpoints")
    return found.rstrip("/")


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """While this holds, Arrow batches have at most so many rows: both sides of a Python worker's pipe hold one or two at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, min(int(was), rows) if int(was) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(key, was)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow, in a worker that gives its memory back when a task ends: an idle worker keeps no batch and no free heap."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps its free heap
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes df as Parquet to the shared folder and reads it back. The files go with the session."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes the files of a table that written() made and nothing will read again."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def crc_mod(id_col, n: int):
    """crc32 of an id as text, modulo n: the held-out folds are defined by it. A null id counts as an empty text."""
    from pyspark.sql import functions as F

    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def chunks(batch: pa.RecordBatch, text: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about `limit` bytes: numpy temporaries stay small. A longer text is a slice of its own."""
    col = batch.column(batch.schema.get_field_index(text))
    sizes = np.frombuffer(col.buffers()[1], dtype=np.int32, count=len(col) + 1 + col.offset)[col.offset :] if len(col) else np.zeros(1, np.int32)
    start = 0
    while start < len(col):
        end = int(np.searchsorted(sizes, int(sizes[start]) + limit, side="right")) - 1
        end = min(max(end, start + 1), len(col))
        yield batch.slice(start, end - start)
        start = end


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column and where each text starts (one more entry than texts). Null: empty."""
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], dtype=np.int32, count=len(col) + 1 + col.offset)[col.offset :].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]
