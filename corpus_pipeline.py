"""The corpus pipeline: rejected languages, near duplicates and contaminated documents go, sources are mixed, rows are sharded.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of ``docs``. A stage's
result is written as Parquet and read again before the next one. ``documents`` may have extra columns, which stay.
Null, empty and wordless texts are rejected by the first stage; repeated ids keep one row in the second; an empty table
passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm import decontaminate, langid, mixing, neardup, resharding
from skyledger.llm.shared import released, table, unused
from skyledger.session import drop_work, work_dir

#: Words of a shingle and least similarity, in percent, of near duplicates.
SHINGLE, SHARE = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model is fitted on a bounded sample of the labelled ones."""
    names = {k: unused(docs, f"_{k}") for k in ("lang_pred", "score", "rejected")}
    judged = langid.identify(docs, langid.train(docs), **names)
    return judged.where(~F.col(names["rejected"])).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return neardup.deduplicated(docs, k=SHINGLE, share=SHARE)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, written to the files of their shards and read from there, with the shard that each came from."""
    out, shard, old = (unused(docs, name) for name in ("_placed", "shard", "old_shard"))
    path = work_dir(spark, "shards")
    resharding.rewrite(resharding.reshard(docs, out=out).withColumn(old, F.col(f"{out}.old")), path, out=out, shard=shard)
    return spark.read.schema(T.StructType([*docs.schema.fields, T.StructField(old, T.IntegerType()), T.StructField(shard, T.IntegerType())])).parquet(path)


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixed),
    ("sharding", sharded),
]

#: Trained and random stages are not expressed in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        path = work_dir(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            drop_work(spark, last)
        released(spark)  # a stage's training data, broadcasts and plans go before the next begins
        docs, last = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
