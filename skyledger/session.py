"""Session settings and the scratch folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive execution coalesces small shuffle partitions, splits skewed ones and
# turns a shuffled join into a broadcast once the real size is known.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Frames that cut lineage are written below spark.checkpoint.dir; their files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# HotSpot leaves methods of more bytes than this uncompiled; code that Spark generates for wide parsing stages is longer.
HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
COMPILED = "8000"
SETTINGS[HUGE_METHOD] = COMPILED

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, app: str = "skyledger", **extra: str) -> SparkSession:
    """A session with the library's settings; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def keep_compiled(spark: SparkSession) -> None:
    """Have wide stages run operator by operator where their generated method would be interpreted, also in a session that
    ``build_session`` did not make; a limit below Spark's default stays as it was set."""
    if int(spark.conf.get(HUGE_METHOD, "65535")) > int(COMPILED):
        spark.conf.set(HUGE_METHOD, COMPILED)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within this block Spark deletes the shuffle files of each statement when it ends; else they stay on disk until the driver's heap
    happens to be collected, and those of all steps of a long job lie there together."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor must be able to reach.

    Only a local session may go without the setting; a cluster session raises, because a
    machine-local folder would be lost with the machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="skyledger-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def drop_work(spark: SparkSession, path: str) -> None:
    """Remove a folder made by ``work_dir`` once nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
