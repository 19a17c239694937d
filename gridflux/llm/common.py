"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see, named by the cluster in spark.checkpoint.dir.

    On a single machine (tests) a temporary folder is set where there is none; a cluster must name one.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='gridflux-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage, so a lost executor repeats none of the work before it, and lets several
    later steps read one result.
    """
    path = f"{shared_dir(df.sparkSession)}/gridflux/{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bytes_of(df: DataFrame) -> int:
    """Bytes that the rows hold, by the lengths of their arrays and strings."""
    sizes = []
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if kind.startswith("array"):  # eight bytes a number, in structs for each of their columns
            sizes.append((16 + 8 * kind.count(":")) * F.coalesce(F.size(field.name), F.lit(0)))
        else:
            sizes.append(F.coalesce(F.octet_length(field.name), F.lit(0)) if kind in ("string", "binary") else F.lit(8))
    return df.agg(F.sum(sum(sizes, F.lit(16)).cast("long"))).first()[0] or 0


def small(df: DataFrame, most: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast where its counted bytes allow, else left to an ordinary join; ``df`` should be cheap to read."""
    return F.broadcast(df) if bytes_of(df) <= most else df


def text_of(column: str | Column) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def crc_fold(column: str, modulus: int) -> Column:
    """crc32 of the id as decimal text, modulo ``modulus``; a null id gives null."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def release() -> None:
    """Give memory that a Python worker has freed back to the machine: workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def keep_freed() -> None:
    """Let a Python worker use freed arrays again within a task instead of mapping fresh pages for each
    slice; ``release`` gives them back at the end. The numbers are glibc's M_MMAP_THRESHOLD and M_TRIM_THRESHOLD."""
    if option := getattr(ctypes.CDLL(None), "mallopt", None):
        option(-3, 32 << 20)
        option(-1, 64 << 20)
