"""Data checks that return their violations, and run counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from flowgraph.schemas import REQUIRED_COLUMNS

# --- fixed values: the checks declared for the five models -----------------------------------
NOT_NULL = {
    "stg_network_logs": ["uid", "src_ip_zeek", "dest_ip_zeek", "proto", "final_target"],
    "int_network_clean": ["src_ip_zeek", "dest_ip_zeek", "label"],
    "mart_node_mapping": ["ip", "node_id"],
    "mart_super_edges": ["source_idx", "target_idx", "connection_count"],
    "mart_gnn_ready": ["source_idx", "target_idx", "split_mask"],
}
UNIQUE = {"mart_node_mapping": ["ip", "node_id"]}
ACCEPTED = {
    "stg_network_logs": {"proto": ["tcp", "udp", "icmp"], "final_target": ["Attack", "Normal"]},
    "int_network_clean": {"label": [0, 1]},
    "mart_gnn_ready": {"split_mask": ["train", "test"]},
}


class CheckFailed(Exception):
    """A gate of the batch did not hold."""


def _lines(totals: DataFrame, table: str, names: list[tuple[str, str, str]]) -> DataFrame:
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(table).alias("table_name"),
                        F.lit(column).alias("column_name"),
                        F.lit(check).alias("check_name"),
                        F.coalesce(F.col(alias), F.lit(0)).alias("violations"),
                    )
                    for alias, column, check in names
                ]
            )
        )
    )


def column_checks(df: DataFrame, table: str, not_null=(), accepted: dict | None = None) -> DataFrame:
    """All not-null and accepted-values checks of a table in one aggregation; NULL is an accepted value."""
    counts, names = [], []
    for i, c in enumerate(not_null):
        counts.append(F.count_if(F.col(c).isNull()).alias(f"n{i}"))
        names.append((f"n{i}", c, "not_null"))
    for i, (c, values) in enumerate((accepted or {}).items()):
        counts.append(F.count_if(~F.col(c).isin(values)).alias(f"a{i}"))
        names.append((f"a{i}", c, "accepted_values"))
    return _lines(df.agg(*counts), table, names)


def unique_checks(df: DataFrame, table: str, columns) -> DataFrame:
    """Number of values that occur more than once, per column; partial counts merge before the shuffle."""
    out = None
    for c in columns:
        repeated = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        line = _lines(repeated.agg(F.count(F.lit(1)).alias("v")), table, [("v", c, "unique")])
        out = line if out is None else out.unionByName(line)
    return out


KINDS = ("not_null", "unique", "accepted_values")
#: Tables that have declared checks.
CHECKED = {*NOT_NULL, *UNIQUE, *ACCEPTED}


def model_checks(models: dict[str, DataFrame], kinds=KINDS) -> DataFrame:
    """The declared checks of the given models: one row per check, one aggregation per model."""
    parts = []
    for table, df in models.items():
        not_null = NOT_NULL.get(table, []) if "not_null" in kinds else []
        accepted = ACCEPTED.get(table, {}) if "accepted_values" in kinds else {}
        if not_null or accepted:
            parts.append(column_checks(df, table, not_null, accepted))
        if table in UNIQUE and "unique" in kinds:
            parts.append(unique_checks(df, table, UNIQUE[table]))
    return reduce(DataFrame.unionByName, parts)


class Watch:
    """The declared not-null and accepted-values checks of a table, its rows and further counts, taken while it is written.

    The counts belong to the first action on the observed table.  They are put above the last shuffle (a range sort looks
    at its input twice), so that each row is counted once.
    """

    def __init__(self, table: str, counts: dict[str, str] | None = None):
        self.table, self.more = table, counts or {}
        self.checks = [(f"n{i}", c, "not_null") for i, c in enumerate(NOT_NULL.get(table, []))]
        self.checks += [(f"a{i}", c, "accepted_values") for i, c in enumerate(ACCEPTED.get(table, {}))]
        self.observation = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        broken = {"not_null": lambda c: F.col(c).isNull(), "accepted_values": lambda c: ~F.col(c).isin(ACCEPTED[self.table][c])}
        counts = [F.count_if(broken[kind](c)).alias(name) for name, c, kind in self.checks]
        counts += [F.count_if(F.expr(condition)).alias(name) for name, condition in self.more.items()]
        return df.observe(self.observation, F.count(F.lit(1)).alias("rows"), *counts)

    def counts(self) -> dict[str, int]:
        return self.observation.get

    def lines(self) -> list[Row]:
        """One row for each check, as of ``model_checks``."""
        found = self.counts()
        return [Row(table_name=self.table, column_name=c, check_name=kind, violations=found[name]) for name, c, kind in self.checks]


def require_lines(lines: list[Row]) -> None:
    """Fail, naming them, if some of these checks found violations."""
    broken = [r for r in lines if r["violations"]]
    if broken:
        raise CheckFailed("; ".join(f"{r['table_name']}.{r['column_name']} {r['check_name']}: {r['violations']}" for r in broken))


def require_checks(models: dict[str, DataFrame]) -> None:
    """Fail, naming them, if declared checks of the given models do not hold."""
    require_lines(model_checks(models).collect())


def missing_columns(df: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """Required columns the table lacks."""
    rows = [(c,) for c in sorted(set(required) - set(df.columns))]
    return df.sparkSession.createDataFrame(rows, "column_name string")


def require_columns(df: DataFrame, required=REQUIRED_COLUMNS) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise CheckFailed(f"missing columns: {missing}")


def require_rows(df: DataFrame, name: str) -> None:
    if df.isEmpty():
        raise CheckFailed(f"{name} is empty")


def expect_count(actual: int, expected: int, what: str, skip_if: bool = False) -> bool:
    """Exact count, unless the input was capped.  True when the check was made."""
    if skip_if:
        return False
    if actual != expected:
        raise CheckFailed(f"{what}: expected {expected}, got {actual}")
    return True


def _count_of(df: DataFrame):
    """Row count as a scalar subquery."""
    return df.agg(F.count(F.lit(1))).scalar()


def mart_counts(node_map: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes, edges, train and test rows in one row."""
    return edges.agg(
        F.count(F.lit(1)).alias("edges"),
        F.count_if(F.col("split_mask") == "train").alias("train"),
        F.count_if(F.col("split_mask") == "test").alias("test"),
    ).select(_count_of(node_map).alias("nodes"), "edges", "train", "test")


def run_summary(raw: DataFrame, node_map: DataFrame, edges: DataFrame) -> DataFrame:
    """The counters a run reports."""
    share = F.try_divide(F.col("train").cast("double"), F.col("edges").cast("double"))
    return mart_counts(node_map, edges).select(
        _count_of(raw).alias("raw_rows"), "*", F.coalesce(share, F.lit(0.0)).alias("train_share")
    )


def summary_of(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """``run_summary`` from counts that were observed."""
    share = counts["train"] / counts["edges"] if counts["edges"] else 0.0
    schema = "raw_rows long, nodes long, edges long, train long, test long, train_share double"
    return spark.createDataFrame([(*(counts[c] for c in ("raw_rows", "nodes", "edges", "train", "test")), share)], schema)


def dataset_summary(edges: DataFrame, nodes: DataFrame, cves: DataFrame) -> DataFrame:
    """Edges, attack share, masks, nodes and known techniques in one row."""
    return edges.agg(
        F.count(F.lit(1)).alias("edges"),
        F.coalesce(F.avg("y"), F.lit(0.0)).alias("attack_rate"),
        F.count_if(F.col("mask") == "train").alias("train"),
        F.count_if(F.col("mask") == "test").alias("test"),
    ).select(
        "*",
        _count_of(nodes).alias("nodes"),
        cves.agg(F.count_distinct("matched_mitre_id")).scalar().alias("techniques"),
    )


def row_gates(models: dict[str, DataFrame]) -> DataFrame:
    """Rows of every table and whether it is filled."""
    out = None
    for name, df in models.items():
        line = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", (F.col("n_rows") > 0).alias("ok")
        )
        out = line if out is None else out.unionByName(line)
    return out


def count_gate(df: DataFrame, expected: int, truncated: bool = False) -> DataFrame:
    """The exact-count check as a row: what was found, whether it was checked, whether it holds."""
    found = df.agg(F.count(F.lit(1)).alias("found"))
    return found.select(
        "found",
        F.lit(expected).cast("long").alias("expected"),
        F.lit(not truncated).alias("checked"),
        (F.lit(truncated) | (F.col("found") == expected)).alias("ok"),
    )
