"""Writers: shards, published tables, exports."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgraph.operators.quality import Watch, require_rows
from flowgraph.session import delete_path


def write_shards(df: DataFrame, path: str, by: str = "shard") -> str:
    """Replace the snappy shard folders under ``path``.

    Rows stay in the tasks that read them: a shard is a folder, not one task.
    """
    df.write.mode("overwrite").partitionBy(by).option("compression", "snappy").parquet(path)
    return path


def cluster_by_range(df: DataFrame, keys, partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by ``keys``, so that row-group statistics skip on them.

    All keys take part in the ranges: one hot ip pair is spread by the next key.
    """
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def publish(df: DataFrame, name: str, sort_keys=None, location: str | None = None, keep_old: int = 1) -> DataFrame:
    """Write a new version, refuse it when empty, then point table ``name`` at it in one step.

    Versions are folders in the table's own place in its database.  Readers see the old version until the switch, and
    those that have planned on it can finish: the last ``keep_old`` replaced versions stay, older ones are deleted.
    """
    path = write_version(df, name, sort_keys, location=location)
    return switch(df.sparkSession, name, path, None if location else keep_old)


def write_version(df: DataFrame, name: str, sort_keys=None, watch: Watch | None = None, location: str | None = None) -> str:
    """Write a new version of ``name``, observed by ``watch``, that no reader sees yet; its path."""
    spark = df.sparkSession
    path = location or f"{_home(spark, name)}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    ready = cluster_by_range(df, sort_keys) if sort_keys else df
    (watch.on(ready) if watch else ready).write.mode("errorifexists").parquet(path)
    return path


def switch(spark: SparkSession, name: str, path: str, keep_old: int | None = 1) -> DataFrame:
    """Point table ``name`` at a written version, unless that is empty, and delete what is older than ``keep_old`` versions."""
    require_rows(spark.read.parquet(path), name)
    if spark.catalog.tableExists(name):
        current, new = spark.table(name).schema, spark.read.parquet(path).schema
        if [(f.name, f.dataType) for f in current] != [(f.name, f.dataType) for f in new]:
            raise ValueError(f"schema of {name} has changed; publish it under a new name")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path, source="parquet")
    if keep_old is not None:
        for old in _versions(spark, _home(spark, name))[: -1 - keep_old]:
            delete_path(spark, old)
    return spark.table(name)


def _home(spark: SparkSession, name: str) -> str:
    """Folder of a table's versions: beside the tables of its database."""
    database, _, table = name.rpartition(".")
    place = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{place.rstrip('/')}/{table}.versions"


def _versions(spark: SparkSession, home: str) -> list[str]:
    """Version folders from the oldest to the newest."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(home)
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    return sorted(f.getPath().toString() for f in found if f.getPath().getName().startswith("v"))


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").filter(F.col("col_name") == "Location").collect()
    return rows[0]["data_type"]


def replace_all(df: DataFrame, path: str) -> str:
    """Full refresh: delete everything, then write."""
    df.write.mode("overwrite").parquet(path)
    return path


def export(records: DataFrame, path: str, fmt: str) -> str:
    """Analysis records as JSON lines, or as CSV with array columns in JSON text."""
    if fmt == "json":
        records.write.mode("overwrite").json(path)
    elif fmt == "csv":
        flat = [
            F.to_json(f.name).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name) for f in records.schema
        ]
        records.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        raise ValueError(f"unknown export format: {fmt}")
    return path


def export_summary(triad: DataFrame, path: str) -> str:
    """One-row metric summary as nested JSON: {measure: {mean, std}, ...}."""
    nested = [m[: -len("_mean")] for m in triad.columns if m.endswith("_mean")]
    flat = [c for c in triad.columns if not c.endswith(("_mean", "_std"))]
    triad.select(
        *flat, *[F.struct(F.col(f"{m}_mean").alias("mean"), F.col(f"{m}_std").alias("std")).alias(m) for m in nested]
    ).write.mode("overwrite").json(path)
    return path
