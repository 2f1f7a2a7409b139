"""Join helpers for keys that may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def hot_keys(facts: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the number of pieces each is cut into.

    At most ``rows / hot_rows`` keys qualify, which bounds the table.
    """
    return (
        facts.groupBy(key)
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") > hot_rows)
        .select(key, F.ceil(F.col("__n") / hot_rows).cast("int").alias("__pieces"))
    )


def salted_join(
    facts: DataFrame, dim: DataFrame, key: str, spread_by: str, hot_rows: int = HOT_ROWS, keep_salt: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Inner many-to-one join on ``key``; rows of a hot key are spread over several tasks.

    Only hot keys are cut, and only their dimension rows are repeated.  ``keep_salt`` leaves
    ``__salt`` in the result so that a following aggregation can merge per piece first.  ``hot`` gives the hot keys where
    they have been found on a table that is cheaper to read than ``facts``.
    """
    hot = F.broadcast(hot_keys(facts, key, hot_rows) if hot is None else hot)
    pieces = F.coalesce("__pieces", F.lit(1))
    left = (
        facts.join(hot, key, "left")
        .withColumn("__salt", F.pmod(F.xxhash64(spread_by), pieces).cast("int"))
        .drop("__pieces")
    )
    right = (
        dim.join(hot, key, "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop("__pieces")
    )
    out = left.join(right, [key, "__salt"])
    return out if keep_salt else out.drop("__salt")


def missing_from(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing`` yet: repeated runs add nothing twice."""
    return new.join(existing.select(key).distinct(), key, "left_anti")


def top_k_per_group(df: DataFrame, group, order_cols, k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of every group.

    The rank filter on ``row_number`` lets Spark cut each group to ``k`` rows in every task
    before the shuffle, so a group holding a third of the table stays small.
    """
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*order_cols)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
