"""Pieces that several operators use: checkpoints, bitmaps of bounded size, ranks without a single task."""

from __future__ import annotations

import ctypes
import functools
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skyledger.session import work_dir

#: Fixed size of a broadcast bitmap: 2**25 bits are 4 MB, whatever the input.
BITMAP_BITS = 25


def settled(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder and read from there: later steps never recompute it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_dir(spark, "checkpoints"))
    return df.checkpoint(eager=True)


def released(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints of frames that nothing refers to any more.

    It does so when the driver collects garbage; between the steps of an iterative job that has to be asked for, else
    they stay on disk until the driver's heap happens to fill. What the driver's Python has free goes back to the system as well.
    """
    gc.collect()
    give_back()
    spark.sparkContext._jvm.System.gc()


def tidy(f):
    """A task's function over batches that hands its free memory back to the system when the task ends.

    Executors keep idle Python workers, and a worker's allocators keep what its largest block needed; over the stages of a
    long job that adds up beside the heap.
    """

    @functools.wraps(f)
    def run(batches):
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Return memory that is free in this process to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def unused(df: DataFrame, wish: str) -> str:
    """A column name that the frame does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def bitmap(df: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bits set at the low ``bits`` bits of a long column: a filter that never misses, of fixed size.

    The words of the bitmap are made by an aggregation; at most 2**bits / 64 rows of 16 bytes reach the driver.
    """
    spot = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        df.where(F.col(column).isNotNull())
        .select(F.shiftrightunsigned(spot, 6).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast(`{column}` & 63 AS INT))").alias("bit"))
        .groupBy("at")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint64)


def within(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the bitmap may hold each 64-bit value."""
    spot = h & np.uint64(len(bits) * 64 - 1)
    return (bits[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) != 0


def ranked(df: DataFrame, group: list[str], spread: Column, name: str, buckets: int) -> DataFrame:
    """Row numbers from 0 without gaps in each group, though a group be a third of all rows.

    Rows are dealt to ``buckets`` by the ``spread`` hash; a bucket's rows follow those of the buckets before it.
    Counts per (group, bucket) are aggregated before their shuffle, and only a bucket is ever sorted in one task.
    """
    bucket, before = unused(df, "_bucket"), unused(df, "_before")
    df = df.withColumn(bucket, F.pmod(spread, F.lit(buckets)).cast("int"))
    counts = df.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_n"))
    other = {c: f"_of_{i}" for i, c in enumerate([*group, bucket])}
    offsets = counts.select(
        *[F.col(c).alias(o) for c, o in other.items()],
        (F.sum("_n").over(W.partitionBy(*group).orderBy(bucket)) - F.col("_n")).alias(before),
    )
    rest = [c for c in df.columns if c not in other]
    inner = F.row_number().over(W.partitionBy(*group, bucket).orderBy(spread, *rest[:3])).cast("long") - 1
    same = [F.col(c).eqNullSafe(F.col(o)) for c, o in other.items()]
    keep = [F.col(c) for c in df.columns if c != bucket]
    return df.withColumn(name, inner).join(offsets, on=same, how="inner").select(*keep, (F.col(name) + F.col(before)).alias(name))


def buckets_for(rows: int, per_bucket: int = 200_000) -> int:
    """So many buckets that each holds about ``per_bucket`` rows."""
    return max(16, -(-rows // per_bucket))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
