"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.session import ship

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, with null counting as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, everything else as it is; ``lower`` suffices where all is ASCII."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote, through the file system it was written with."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _give_back() -> None:
    """Returns the worker's freed memory to the system: a worker is kept for later tasks, and
    what its allocators hold meanwhile counts against the executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass  # not glibc


def releasing(function):
    """``function`` of Arrow batches, which gives its task's memory back at its end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            _give_back()
    return run


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(releasing(function), schema)
