"""Raw flows to staged rows and model features: projections and filters only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgraph.schemas import PROTOCOLS, SERVICES

# Plain decimal text.  The cast alone would also take "1f", "NaN" and "Infinity".
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def vlan_label(vlan: Column) -> Column:
    """``none`` for a missing VLAN, otherwise the number rounded half-even; unreadable text is ``0``."""
    missing = vlan.isNull() | vlan.isin("unknown", "NaN")
    number = F.when(vlan.rlike(_NUMBER), vlan.try_cast("float"))
    rounded = F.coalesce(F.rint(number).try_cast("int"), F.lit(0))
    return F.when(missing, F.lit("none")).otherwise(rounded.cast("string"))


def final_target(tactic: Column) -> Column:
    return F.when(tactic.isNotNull() & (tactic != "none"), F.lit("Attack")).otherwise(F.lit("Normal"))


def not_duplicate(label: Column) -> Column:
    """Plain SQL comparison: a NULL label is dropped too."""
    return label != "Duplicate"


def stage_flows(raw: DataFrame) -> DataFrame:
    """Staged flows: duplicates out, defaults in, target derived."""
    col = F.col
    return raw.filter(not_duplicate(col("label_binary"))).select(
        "uid",
        "src_ip_zeek",
        "dest_ip_zeek",
        "src_port_zeek",
        "dest_port_zeek",
        "proto",
        "service",
        F.coalesce(col("duration"), F.lit(0.0)).alias("duration"),
        F.coalesce(col("orig_bytes"), F.lit(0)).alias("orig_bytes"),
        F.coalesce(col("resp_bytes"), F.lit(0)).alias("resp_bytes"),
        "orig_pkts",
        "resp_pkts",
        "orig_ip_bytes",
        "resp_ip_bytes",
        "missed_bytes",
        "conn_state",
        F.coalesce(col("history"), F.lit("-")).alias("history"),
        vlan_label(col("vlan")).alias("vlan"),
        "label_tactic",
        "label_technique",
        "source_period",
        "datetime",
        "ts",
        final_target(col("label_tactic")).alias("final_target"),
    )


def one_hot(c: Column, values, prefix: str) -> list[Column]:
    """One 0/1 column per value; NULL is 0 everywhere."""
    return [F.coalesce((c == v).cast("int"), F.lit(0)).alias(f"{prefix}{v}") for v in values]


def clean_features(staged: DataFrame, keep=()) -> DataFrame:
    """Log-scaled measures, one-hot protocol and service, 0/1 label; the columns ``keep`` stay as they are."""
    measures = ["duration", "orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts"]
    return staged.select(
        "src_ip_zeek",
        "dest_ip_zeek",
        *[F.ln(F.lit(1) + F.col(m)).alias(f"log_{m}") for m in measures],
        *one_hot(F.col("proto"), PROTOCOLS, "proto_"),
        *one_hot(F.col("service"), SERVICES, "srv_"),
        F.when(F.col("final_target") == "Attack", 1).otherwise(0).alias("label"),
        "label_tactic",
        "label_technique",
        "final_target",
        *keep,
    )


def top_k_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent non-null values; ties go to the smaller value."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("value"))
        .limit(k)
    )
