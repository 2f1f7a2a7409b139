"""Pair aggregates kept for each period, so that a new period is merged without reading the old ones again.

A store holds ``states``, one mergeable row per version, period and ip pair, and a ``manifest``, one row per period: what its
files were (number, bytes, a mark over names, sizes and times), how many rows they had, and the version of its states.  A period
is computed anew if its files differ from the manifest, and one whose files are gone leaves the manifest.  States of a new version
are written beside the old ones and count once a manifest names them; a manifest is one file, so a run that fails anywhere leaves
the store as it was, and the last complete manifest counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgraph.session import Scratch, delete_path

PERIOD, VERSION = "period", "version"
_RUN, _PART = "run", "part"
_MANIFEST = f"{PERIOD} string, files long, bytes long, mark long, rows long, {VERSION} string"


def create(spark: SparkSession, path: str) -> None:
    """An empty store; one that exists is left as it is."""
    spark.createDataFrame([], f"{_MANIFEST}, {_RUN} long").write.mode("ignore").partitionBy(_RUN).parquet(f"{path}/manifest")


def _manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{_MANIFEST}, {_RUN} long").parquet(f"{path}/manifest")


def _last_run(spark: SparkSession, path: str) -> int:
    return _manifests(spark, path).agg(F.max(_RUN)).first()[0] or 0


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return _manifests(spark, path).where(F.col(_RUN) == _last_run(spark, path)).drop(_RUN)


def listed(files: DataFrame) -> DataFrame:
    """One row per period of ``files`` (period, path, size, modified)."""
    return files.groupBy(PERIOD).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.bit_xor(F.xxhash64("path", "size", "modified")).alias("mark")
    )


def changed(now: DataFrame, known: DataFrame) -> DataFrame:
    """Periods of ``now`` that ``known`` lacks or has with other files."""
    return now.join(known.select(now.columns), now.columns, "left_anti").select(PERIOD)


def put(spark: SparkSession, path: str, now: DataFrame, rows: DataFrame, states: DataFrame | None) -> None:
    """Take the ``states`` of the periods in ``rows`` (period, rows) into the store, whose periods are then those of ``now``."""
    version, last = f"v{uuid.uuid4().hex[:12]}", _last_run(spark, path)
    if states is not None:
        placed = states.withColumns({VERSION: F.lit(version), _PART: _part(F.col(PERIOD))})
        placed.hint("rebalance", F.col(_PART)).write.partitionBy(VERSION, _PART).mode("append").parquet(f"{path}/states")
    scratch = Scratch(spark)
    known = scratch.write(manifest(spark, path), "known")
    kept = now.join(known.select(PERIOD, "rows", VERSION), PERIOD).join(rows.select(PERIOD), PERIOD, "left_anti")
    fresh = now.join(rows, PERIOD).withColumn(VERSION, F.lit(version))
    named = scratch.write(kept.unionByName(fresh).select(known.columns), "named")
    named.withColumn(_RUN, F.lit(last + 1)).coalesce(1).write.partitionBy(_RUN).mode("append").parquet(f"{path}/manifest")
    gone = known.join(named, [PERIOD, VERSION], "left_anti").select(VERSION, _part(F.col(PERIOD)).alias(_PART))
    for old in gone.collect():
        delete_path(spark, f"{path}/states/{VERSION}={old[VERSION]}/{_PART}={old[_PART]}")
    delete_path(spark, f"{path}/manifest/{_RUN}={last}")
    scratch.drop_all()


def _part(period):
    """Folder name of a period: free of characters that are escaped, and never read as a number."""
    return F.concat(F.lit("p"), F.md5(period))


def states(spark: SparkSession, path: str) -> DataFrame:
    """The states that the manifest names."""
    known = manifest(spark, path).select(VERSION, _part(F.col(PERIOD)).alias(_PART))
    if known.isEmpty():
        raise ValueError(f"{path} holds no period")
    return spark.read.parquet(f"{path}/states").join(known, [VERSION, _PART]).drop(VERSION, _PART)
