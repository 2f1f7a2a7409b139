"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Only settings that every job here relies on.  Executor sizes, partition counts and the
# shared folder belong to the cluster and are left alone.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "flowgraph", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_for(input_bytes: int, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a job that shuffles about ``input_bytes``.

    Enough shuffle partitions that one fits an executor's memory; adaptive execution merges
    those that turn out small.  100 TB give 400,000 partitions of 256 MB to start from.
    """
    partitions = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
    }


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    A machine-local folder is used only where no cluster is involved (local master).
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(path)
        return path
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="flowgraph-"))
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


#: Drops the shuffle files of an execution when it ends; a written table is never computed again.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def _write(df: DataFrame, path: str, compression: str | None) -> DataFrame:
    spark = df.sparkSession
    with _shuffles_dropped(spark):
        (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used where a plan must see the same rows twice, and between the layers of an iterative
    job.  The copy survives the loss of any executor, later steps read only the columns they
    need, and the planner knows its size.
    """
    return _write(df, new_path(df.sparkSession, name), None)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever filesystem it is; nothing happens if there is none."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Intermediate tables of one run, each dropped after its last reader."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._tables: list[tuple[DataFrame, str]] = []
        self._bucketed: dict[str, str] = {}

    def write(self, df: DataFrame, name: str = "step") -> DataFrame:
        """As :func:`materialize`, compressed with zstd and known to :meth:`drop`."""
        path = new_path(self.spark, name)
        out = _write(df, path, "zstd")
        self._tables.append((out, path))
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete these tables of the run; what is none of them is left alone."""
        for table in tables:
            for known, path in [entry for entry in self._tables if entry[0] is table]:
                if path in self._bucketed:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self._bucketed.pop(path)}")
                delete_path(self.spark, path)
                self._tables.remove((known, path))

    def bucketed(self, df: DataFrame, key: str, buckets: int, name: str = "step", *, onto: DataFrame | None = None) -> DataFrame:
        """As :meth:`write`, in buckets of ``key``: tables in as many buckets meet by it without a shuffle.

        The rows are added to the table ``onto`` if that is given; only the table returned is to be read then.
        """
        old = next((path for known, path in self._tables if known is onto), None) if onto is not None else None
        path = old or new_path(self.spark, name)
        table = self._bucketed.setdefault(path, f"scratch_{uuid.uuid4().hex}")
        writer = df.repartition(buckets, key).write.mode("append" if old else "errorifexists").option("compression", "zstd")
        with _shuffles_dropped(self.spark):
            writer.option("path", path).bucketBy(buckets, key).saveAsTable(table)
        out = self.spark.table(table)
        self._tables = [entry for entry in self._tables if entry[1] != path] + [(out, path)]
        return out

    def tables(self) -> list[DataFrame]:
        return [table for table, _ in self._tables]

    def drop_all(self, but: DataFrame | None = None) -> None:
        self.drop(*(table for table in self.tables() if table is not but))
