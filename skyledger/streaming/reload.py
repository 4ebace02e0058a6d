"""The scheduled re-load as a stream of dropped files: each run takes what arrived since the last."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from skyledger.sources.ingest import load, settle_token

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def reload_new_files(
    spark: SparkSession, root: str, source: str, drop_dir: str, checkpoint: str, mode: str = "replace-years",
    files_per_batch: int = 1000,
) -> None:
    """Load every file not seen before and stop, each exactly once in every mode.

    The stream only carries file names. The log holds the number of each micro-batch; one that is replayed is skipped if its
    load was closed, and if it broke off in between, what it had put in place is taken out first.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(drop_dir)
        .select("path", "modificationTime")
    )

    def land(batch: DataFrame, number: int) -> None:
        spark, token = batch.sparkSession, f"{checkpoint}#{number}"
        if settle_token(spark, root, token):
            return
        # In the order of arrival, so that a corrected file replaces the one before it, whatever their names.
        paths = [unquote(r.path) for r in batch.orderBy("modificationTime", "path").collect()]
        if paths:
            load(spark, root, source, paths, mode, keep_going=True, token=token)

    stream = (
        arrivals.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
