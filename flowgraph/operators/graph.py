"""Flows to a directed host graph: pair aggregates, node ids, super-edges, split, edge vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgraph.operators.numbering import global_row_number

EDGE_COLUMNS = [
    "source_idx", "target_idx", "connection_count", "mean_log_duration", "std_log_duration",
    "mean_log_orig_bytes", "mean_log_resp_bytes", "tcp_count", "udp_count", "icmp_count", "label",
]


def pair_stats(clean: DataFrame) -> DataFrame:
    """One row per (source ip, destination ip): the only pass over the flows.

    All aggregates merge, so a pair that holds a third of the table is reduced before the
    shuffle.  ip and node id are one-to-one, hence grouping by ip and looking the ids up
    afterwards gives the same edges as joining first, on far fewer rows.
    """
    return clean.groupBy("src_ip_zeek", "dest_ip_zeek").agg(
        F.count(F.lit(1)).alias("connection_count"),
        F.avg("log_duration").alias("mean_log_duration"),
        F.stddev_samp("log_duration").alias("std_log_duration"),
        F.avg("log_orig_bytes").alias("mean_log_orig_bytes"),
        F.avg("log_resp_bytes").alias("mean_log_resp_bytes"),
        F.sum("proto_tcp").alias("tcp_count"),
        F.sum("proto_udp").alias("udp_count"),
        F.sum("proto_icmp").alias("icmp_count"),
        F.sum("srv_http").alias("http_count"),
        F.sum("srv_dns").alias("dns_count"),
        F.max("label").alias("label"),
    )


_AVERAGED = ["log_duration", "log_orig_bytes", "log_resp_bytes"]
_SUMMED = {"tcp_count": "proto_tcp", "udp_count": "proto_udp", "icmp_count": "proto_icmp", "http_count": "srv_http", "dns_count": "srv_dns"}


def pair_states(clean: DataFrame, period: str = "period") -> DataFrame:
    """One mergeable row per (period, source ip, destination ip): counts, means and the sum of squared deviations."""
    return clean.groupBy(period, "src_ip_zeek", "dest_ip_zeek").agg(
        F.count(F.lit(1)).alias("connection_count"),
        *[F.count(c).alias(f"n_{c}") for c in _AVERAGED],
        *[F.avg(c).alias(f"mean_{c}") for c in _AVERAGED],
        (F.var_pop("log_duration") * F.count("log_duration")).alias("dev_log_duration"),
        *[F.sum(c).alias(name) for name, c in _SUMMED.items()],
        F.max("label").alias("label"),
    )


def merged_pairs(states: DataFrame) -> DataFrame:
    """``pair_stats`` of all flows from the states of their periods.

    Deviations are taken around the pair's overall mean, so no large squares are subtracted from each other.  A pair has one
    state a period, which bounds its window; the aggregation that follows needs no further shuffle.
    """
    pair = ["src_ip_zeek", "dest_ip_zeek"]
    whole = Window.partitionBy(*pair)
    weighed = F.col("mean_log_duration") * F.col("n_log_duration")
    overall = F.try_divide(F.sum(weighed).over(whole), F.sum("n_log_duration").over(whole))
    apart = F.col("mean_log_duration") - overall
    total, dev = F.sum("n_log_duration"), F.sum("dev_log_duration")
    return (
        states.withColumn("dev_log_duration", F.col("dev_log_duration") + F.col("n_log_duration") * apart * apart)
        .groupBy(*pair)
        .agg(
            F.sum("connection_count").alias("connection_count"),
            *[F.try_divide(F.sum(F.col(f"mean_{c}") * F.col(f"n_{c}")), F.sum(f"n_{c}")).alias(f"mean_{c}") for c in _AVERAGED],
            F.when(total > 1, F.sqrt(dev / (total - 1))).alias("std_log_duration"),
            *[F.sum(name).alias(name) for name in _SUMMED],
            F.max("label").alias("label"),
        )
    )


def unique_ips(pairs: DataFrame) -> DataFrame:
    """Distinct source and destination ips; works on flows and, cheaper, on ``pair_stats``."""
    return (
        pairs.select(F.col("src_ip_zeek").alias("ip"))
        .union(pairs.select(F.col("dest_ip_zeek").alias("ip")))
        .filter(F.col("ip").isNotNull())
        .distinct()
    )


def node_mapping(pairs: DataFrame) -> DataFrame:
    """ip to dense node id from 0, in byte order of the ip text."""
    return global_row_number(unique_ips(pairs), ["ip"], start=0, name="node_id").select("ip", "node_id")


def lookup_node_ids(pairs: DataFrame, node_map: DataFrame) -> DataFrame:
    """Replace both ips by node ids.

    The node map grows with the data, so no broadcast is forced: the planner chooses from
    run-time sizes and splits a hub ip's partition (adaptive skew join).
    """
    source = node_map.select(F.col("ip").alias("src_ip_zeek"), F.col("node_id").alias("source_idx"))
    target = node_map.select(F.col("ip").alias("dest_ip_zeek"), F.col("node_id").alias("target_idx"))
    return pairs.join(source, "src_ip_zeek").join(target, "dest_ip_zeek").drop("src_ip_zeek", "dest_ip_zeek")


def super_edges(pairs: DataFrame, node_map: DataFrame) -> DataFrame:
    """One row per directed ip pair, keyed by node ids."""
    return lookup_node_ids(pairs, node_map).select(*EDGE_COLUMNS)


def split_mask(edges: DataFrame, order_cols=("source_idx", "target_idx"), n: int = 5) -> DataFrame:
    """Every ``n``-th edge in order is ``test``, the others ``train``."""
    numbered = global_row_number(edges, list(order_cols), start=1, name="__rn")
    return numbered.withColumn(
        "split_mask", F.when(F.pmod("__rn", F.lit(n)) == 0, F.lit("test")).otherwise(F.lit("train"))
    ).drop("__rn")


# Edge vector layout.  Fixed values: positions 1-7 are what the technique rules read.
ATTR = ["connection_count", "duration", "orig_bytes", "resp_bytes", "tcp", "udp", "http", "dns"]
_SCALED = {"duration": "mean_log_duration", "orig_bytes": "mean_log_orig_bytes", "resp_bytes": "mean_log_resp_bytes"}


def edge_scale(pairs: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of the three scaled measures: one row to the driver."""
    row = pairs.agg(
        *[F.avg(src).alias(f"m_{n}") for n, src in _SCALED.items()],
        *[F.stddev_pop(src).alias(f"s_{n}") for n, src in _SCALED.items()],
    ).first()
    return {n: (row[f"m_{n}"] or 0.0, row[f"s_{n}"] or 0.0) for n in _SCALED}


def edge_features(pairs: DataFrame, node_map: DataFrame, n_split: int = 5) -> DataFrame:
    """Edges with an 8-value vector: count, three z-scored log means, four traffic shares.

    ``edge_idx`` follows (source, target) order from 0 and ``mask`` is the split of that order.
    """
    linked = pairs.filter(F.col("src_ip_zeek").isNotNull() & F.col("dest_ip_zeek").isNotNull())
    scale = edge_scale(linked)
    count = F.col("connection_count").cast("double")

    def scaled(name):
        mean, dev = scale[name]
        centred = F.col(_SCALED[name]) - F.lit(mean)
        return centred / F.lit(dev) if dev > 0 else F.lit(0.0)

    attr = F.array(
        count,
        scaled("duration"),
        scaled("orig_bytes"),
        scaled("resp_bytes"),
        F.col("tcp_count") / count,
        F.col("udp_count") / count,
        F.col("http_count") / count,
        F.col("dns_count") / count,
    )
    numbered = global_row_number(
        lookup_node_ids(linked, node_map), ["source_idx", "target_idx"], start=0, name="edge_idx"
    )
    return numbered.select(
        "edge_idx",
        F.col("source_idx").alias("src"),
        F.col("target_idx").alias("dst"),
        attr.alias("attr"),
        F.col("label").alias("y"),
        F.when(F.pmod(F.col("edge_idx") + 1, F.lit(n_split)) == 0, F.lit("test")).otherwise(F.lit("train")).alias("mask"),
    )


def require_vectors(edges: DataFrame, nodes: DataFrame) -> None:
    """Fail, with their number, if edges have end points without a node vector."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node_id")).distinct()
    missing = ends.join(nodes.select("node_id"), "node_id", "left_anti").count()
    if missing:
        raise ValueError(f"{missing} node(s) of the edges have no vector")


def edge_inputs(edges: DataFrame, nodes: DataFrame, name: str = "features") -> DataFrame:
    """Source vector, destination vector and edge vector of every edge, concatenated."""
    require_vectors(edges, nodes)
    source = nodes.select(F.col("node_id").alias("src"), F.col("x").alias("__x_src"))
    target = nodes.select(F.col("node_id").alias("dst"), F.col("x").alias("__x_dst"))
    return (
        edges.join(source, "src")
        .join(target, "dst")
        .withColumn(name, F.concat("__x_src", "__x_dst", "attr"))
        .drop("__x_src", "__x_dst")
    )
