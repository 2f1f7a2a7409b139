"""Global numbering and running totals without moving a table into one partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgraph.session import materialize

_MID, _PID = "__mid", "__pid"


def _order(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _sorted_once(df: DataFrame, order_cols) -> DataFrame:
    """Range-sort ``df`` and pin the result.

    Range bounds come from a sample, so a second evaluation could cut the table elsewhere; the
    written copy makes both later passes see the same partitions.  The row's partition and its
    position inside it are both held by ``monotonically_increasing_id``.
    """
    return materialize(df.orderBy(*_order(order_cols)).withColumn(_MID, F.monotonically_increasing_id())).withColumn(
        _PID, F.shiftright(_MID, 33)
    )


def _offsets(parts: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Sum of ``totals`` over all earlier partitions: one row per partition, so small by construction."""
    names = list(totals)
    rows = parts.groupBy(_PID).agg(*[c.alias(n) for n, c in totals.items()]).collect()
    seen = dict.fromkeys(names, 0)
    out = []
    for row in sorted(rows, key=lambda r: r[_PID]):
        out.append((row[_PID], *[seen[n] for n in names]))
        for n in names:
            seen[n] += row[n] or 0
    schema = f"{_PID} long, " + ", ".join(f"`{n}` long" for n in names)
    return F.broadcast(parts.sparkSession.createDataFrame(out, schema))


def global_row_number(df: DataFrame, order_cols, start: int = 1, name: str = "row_number") -> DataFrame:
    """Number the rows of ``df`` densely from ``start`` in the order of ``order_cols``.

    ``order_cols`` must identify a row for the numbers to be reproducible.
    """
    parts = _sorted_once(df, order_cols)
    offsets = _offsets(parts, {"__before": F.count(F.lit(1))})
    position = F.col(_MID).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        parts.join(offsets, _PID)
        .withColumn(name, F.col("__before") + position + F.lit(start).cast("long"))
        .drop(_MID, _PID, "__before")
    )


def running_sums(df: DataFrame, order_cols, sums: dict[str, str]) -> DataFrame:
    """Add inclusive running totals ``{new column: summed integer column}`` in the given order."""
    parts = _sorted_once(df, order_cols)
    offsets = _offsets(parts, {f"__before_{n}": F.sum(c) for n, c in sums.items()})
    frame = Window.partitionBy(_PID).orderBy(_MID).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = parts.join(offsets, _PID)
    for n, c in sums.items():
        out = out.withColumn(n, F.col(f"__before_{n}") + F.sum(c).over(frame))
    return out.drop(_MID, _PID, *[f"__before_{n}" for n in sums])


def assign_shards(files: DataFrame, k: int, order_cols=("path",), name: str = "shard") -> DataFrame:
    """Deal the sorted rows round-robin onto ``k`` shards."""
    return global_row_number(files, order_cols, start=0, name="__idx").withColumn(name, F.pmod("__idx", F.lit(k))).drop(
        "__idx"
    )
