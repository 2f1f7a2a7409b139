"""Vector records in Parquet: keyed upsert, full refresh, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgraph.operators.joins import top_k_per_group
from flowgraph.session import materialize


def last_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the highest ``order`` of every key.

    The rank filter keeps one row per key and task before the shuffle, so many copies of one
    key cost nothing there.
    """
    return top_k_per_group(df, key, [F.desc(order)], 1, "__rank").drop("__rank")


def upsert(base: DataFrame, updates: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Base rows with updates on top; of a key repeated in the updates the last row (by ``order``) counts.

    The base has one row a key, as upserts leave it.  Only the updates are ranked, and written once, so that the planner
    knows their size: the base loses the keys they have by an anti-join that does not move it while they are few.
    """
    latest = materialize(last_per_key(updates, key, order) if order else updates.dropDuplicates([key]), "updates")
    return base.join(latest.select(key), key, "left_anti").select(base.columns).unionByName(latest)


def index_stats(vectors: DataFrame) -> DataFrame:
    """Stored vectors and their dimension range."""
    return vectors.agg(
        F.count(F.lit(1)).alias("total_vector_count"),
        F.min(F.size("values")).alias("min_dimension"),
        F.max(F.size("values")).alias("max_dimension"),
    )
