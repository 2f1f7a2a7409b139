"""A keyed table in Parquet whose upserts rewrite the buckets they touch, and no others.

A key's hash names its bucket, which is a partition folder, so the base of an upsert is read and written only where updates
fall; a folder without updates keeps its files.  The number of buckets is fixed when the store is created and is kept with the
key's column.  New bucket contents are written in full before the old ones go, and an upsert that is repeated after a failure
gives the same store.  A null key is a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgraph.session import Scratch
from flowgraph.sources.vector_store import last_per_key

BUCKET = "bucket"
_BUCKETS = "buckets"


def buckets_for(input_bytes: int, bucket_bytes: int = 128 * 1024 * 1024) -> int:
    """Buckets of about ``bucket_bytes``, the least that an upsert of one key writes; a task writes one."""
    return max(1, -(-input_bytes // bucket_bytes))


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def create(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write ``df`` (one row a key) as a new store."""
    if BUCKET in df.columns:
        raise ValueError(f"a column is called {BUCKET}")
    named = df.select(*(F.col(c).alias(c, metadata={_BUCKETS: buckets}) if c == key else F.col(c) for c in df.columns))
    named = named.withColumn(BUCKET, _bucket(key, buckets))
    named.repartition(BUCKET).write.partitionBy(BUCKET).mode("errorifexists").parquet(path)


def _stored(spark: SparkSession, path: str, key: str) -> tuple[DataFrame, int]:
    table = spark.read.parquet(path)
    buckets = table.schema[key].metadata.get(_BUCKETS)
    if buckets is None:
        raise ValueError(f"{path} is no store with the key {key}")
    return table, buckets


def read(spark: SparkSession, path: str, key: str) -> DataFrame:
    return _stored(spark, path, key)[0].drop(BUCKET)


def touched(spark: SparkSession, path: str, key: str, updates: DataFrame) -> DataFrame:
    """The stored rows in the buckets of ``updates``; other folders are not opened."""
    table, buckets = _stored(spark, path, key)
    found = [r[BUCKET] for r in updates.select(_bucket(key, buckets).alias(BUCKET)).distinct().collect()]
    return table.where(F.col(BUCKET).isin(found)).drop(BUCKET)


def upsert(spark: SparkSession, path: str, updates: DataFrame, key: str, order: str | None = None) -> int:
    """Put ``updates`` on top of the store; of a key repeated in them the last row by ``order`` counts.

    Returns the number of buckets rewritten, at most all of them however many updates there are.
    """
    table, buckets = _stored(spark, path, key)
    columns = [c for c in table.columns if c != BUCKET]
    scratch = Scratch(spark)
    latest = last_per_key(updates, key, order) if order else updates.dropDuplicates([key])
    latest = scratch.write(latest.select(*columns).withColumn(BUCKET, _bucket(key, buckets)), "updates")
    found = [r[BUCKET] for r in latest.select(BUCKET).distinct().collect()]
    if found:
        base = table.where(F.col(BUCKET).isin(found))
        keys = latest.select(F.col(key).alias("__key"), F.col(BUCKET).alias("__bucket"))
        same = (base[BUCKET] == F.col("__bucket")) & base[key].eqNullSafe(F.col("__key"))
        kept = base.join(keys, same, "left_anti").select(*columns, BUCKET)
        merged = kept.unionByName(latest.select(*(F.col(c).cast(table.schema[c].dataType) for c in columns), BUCKET))
        merged = scratch.write(merged, "buckets")
        named = merged.select(*(F.col(c).alias(c, metadata={_BUCKETS: buckets}) if c == key else F.col(c) for c in merged.columns))
        named.repartition(BUCKET).write.partitionBy(BUCKET).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    scratch.drop_all()
    return len(found)
