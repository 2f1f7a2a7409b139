"""Incremental ingest: each file is taken once, however often the job runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.sources import bucket_store


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    max_files_per_batch: int | None = None,
) -> None:
    """Read the files that appeared since the last run, append them to ``target`` and stop.

    Which files are done is kept in ``checkpoint``; file sink commits make a restart after a
    failure repeat nothing.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    query = (
        transform(reader.parquet(source))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()


def upsert_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    store: str,
    key: str,
    checkpoint: str,
    order: str | None = None,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    max_files_per_batch: int | None = None,
) -> None:
    """Put the files that appeared since the last run on top of a store of ``bucket_store`` and stop.

    Of a key repeated in a batch the last row by ``order`` counts, and a later batch counts before an earlier one.  The numbers
    of the batches that the store has taken are kept beside ``checkpoint``: a batch that is run again after a failure is left
    out, or, if the failure came while the store was written, put on top again, which gives the same store.
    """
    taken = f"{checkpoint.rstrip('/')}-taken"
    spark.createDataFrame([], "batch long").write.mode("ignore").parquet(taken)

    def take(df: DataFrame, batch: int) -> None:
        session = df.sparkSession
        if session.read.schema("batch long").parquet(taken).where(F.col("batch") == batch).isEmpty():
            bucket_store.upsert(session, store, transform(df), key, order)
            session.createDataFrame([(batch,)], "batch long").coalesce(1).write.mode("append").parquet(taken)

    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    query = reader.parquet(source).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
