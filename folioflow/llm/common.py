"""Helpers that the operators of this subpackage share: tables, scratch storage, hot-group settings."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import sys
import tempfile
import types
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables of at most this many bytes (measured, never guessed) may be broadcast or held by one Python worker.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, by Spark's own reader so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. On a cluster the session must name it; only a session whose tasks run
    in the driver's own process gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='folioflow-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: Paths of scratch tables that exist, oldest first.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/folioflow/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    atexit.register(_remove, spark, path)
    return path


def kept_alone(spark: SparkSession, make, label: str) -> DataFrame:
    """make()'s result as a scratch table; all other scratch tables that making it wrote are deleted."""
    before = len(_SCRATCH)
    found = materialize(make(), label)
    for path in [p for p in _SCRATCH[before:] if p != found.scratch]:
        remove_path(spark, path)
    return found


def _remove(spark: SparkSession, path: str) -> None:
    try:
        remove_path(spark, path)
    except Exception:  # the JVM may be gone at exit
        pass


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    if path in _SCRATCH:
        _SCRATCH.remove(path)


def materialize(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage and survives lost executors.

    Before and after, the driver's garbage is collected, so that Spark removes shuffle files that nothing refers to.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    release(spark)
    df.write.option("compression", compression).parquet(path)
    release(spark)
    found = spark.read.schema(df.schema).parquet(path)
    found.scratch = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete what materialize() wrote for tables that are no longer read."""
    for t in tables:
        remove_path(t.sparkSession, t.scratch)


def broadcast_if_small(rows: DataFrame, row_bytes: int) -> DataFrame:
    """A materialized table of rows of about row_bytes, to be broadcast if its counted size allows."""
    return F.broadcast(rows) if rows.count() * row_bytes <= BROADCAST_BYTES else rows


def release(spark: SparkSession) -> None:
    gc.collect()
    spark._jvm.System.gc()


def give_back() -> None:
    """Return memory that this Python worker has freed to the system; idle workers share the executor's limit."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks; those of other names go."""
    module = sys.modules.setdefault("_folioflow_worker_store", types.ModuleType("_folioflow_worker_store"))
    held = module.__dict__
    for other in [k for k in held if not k.startswith("__") and k != name]:
        del held[other]
    return held.setdefault(name, {})


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under our names: further columns of the input never clash with ours.

    Every value is a pair "column type"; the column is cast to the type.
    """
    return df.select(*(F.col(f"`{spec.split()[0]}`").cast(spec.split()[1]).alias(name) for name, spec in columns.items()))


def identity(text: str) -> Column:
    """128 bits by which equal texts agree; null texts agree with each other."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def sql_ascii_lower(column: str) -> str:
    """DuckDB and Spark SQL for lower-casing A-Z alone."""
    return f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


UPPER = bytes(range(0x41, 0x5B))
LOWER = bytes(range(0x61, 0x7B))
#: Maps A-Z to a-z and keeps every other byte.
ASCII_LOWER = bytes.maketrans(UPPER, LOWER)
#: Maps A-Z to a-z and everything but 0-9, a-z and bytes from 0x80 on to a blank.
WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def utf8(column) -> list[bytes | None]:
    """An Arrow string column as bytes, without decoding."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist()


def slices(batch, column: int, most: int = 4 << 20) -> Iterator:
    """Pieces of an Arrow batch whose strings in a column have `most` bytes together, or one row: few are Python objects at once."""
    import pyarrow.compute as pc

    at = 0
    total = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).tolist()):
        if i > at and total + n > most:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += n
    if at < batch.num_rows:
        yield batch.slice(at)


def chunks(items: Iterable, weight, most: int) -> Iterator[list]:
    """Consecutive lists of items whose weights add up to most at most (single items may exceed it)."""
    held, total = [], 0
    for x in items:
        w = weight(x)
        if held and total + w > most:
            yield held
            held, total = [], 0
        held.append(x)
        total += w
    if held:
        yield held


def safe_name(text: str) -> str:
    return re.sub(r"\W+", "_", text)
