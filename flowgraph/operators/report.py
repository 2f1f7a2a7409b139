"""Edge selection and the analysis record of every edge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgraph.functions import rules
from flowgraph.operators.knn import knn
from flowgraph.operators.retrieval import metadata_filter, technique_index
from flowgraph.schemas import DECISION_THRESHOLD, MIN_CVE_SEVERITY, SEED, TOP_K_CONTEXT


# --- selection --------------------------------------------------------------------------------


def first_edges(edges: DataFrame, label: int, n: int = 30) -> DataFrame:
    return edges.filter(F.col("y") == label).orderBy("edge_idx").limit(n)


def edge_by_id(edges: DataFrame, edge_idx: int) -> DataFrame:
    return edges.filter(F.col("edge_idx") == edge_idx)


def _drawn(seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("edge_idx").cast("string")))


def random_edge(edges: DataFrame, seed: int = SEED) -> DataFrame:
    return edges.orderBy(_drawn(seed), "edge_idx").limit(1)


def sample_attack_edges(edges: DataFrame, n: int = 100, seed: int = SEED, mask: str = "test") -> DataFrame:
    """Up to ``n`` attack edges of the mask, in a reproducible random order."""
    return edges.filter((F.col("y") == 1) & (F.col("mask") == mask)).orderBy(_drawn(seed), "edge_idx").limit(n)


# --- analysis ---------------------------------------------------------------------------------


def related_cves(assigned: DataFrame, cves: DataFrame, k: int = 5) -> DataFrame:
    """``assigned`` edges with ``mitre_id`` get the ids of that technique's ``k`` most severe records.

    Every technique of the records is indexed, one row of at most ``k`` ids each; Spark broadcasts the index when it
    is small.
    """
    best = (
        technique_index(cves, k)
        .groupBy("mitre_id")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "cve_id"))).alias("__best"))
        .select("mitre_id", F.transform("__best", lambda b: b["cve_id"]).alias("cve_ids"))
    )
    return assigned.join(best, "mitre_id", "left").withColumn(
        "cve_ids", F.coalesce("cve_ids", F.array().cast("array<string>"))
    )


def analyze_edges(
    scored: DataFrame, cves: DataFrame, threshold: float = DECISION_THRESHOLD, k: int = 5, variant: str = "full"
) -> DataFrame:
    """Full record of every scored edge ``(edge_idx, src, dst, attr, y, score)``."""
    attack = F.col("prediction") == "ATTACK"
    technique = rules.assign_technique(F.col("attr"), variant)
    assigned = (
        scored.withColumn("prediction", rules.prediction(F.col("score"), threshold))
        .withColumn("__technique", F.when(attack, technique))
        .withColumns(
            {
                "mitre_id": F.col("__technique.id"),
                "mitre_name": F.col("__technique.name"),
                "mitre_desc": F.col("__technique.description"),
                "src_ip": rules.node_ip(F.col("src")),
                "dst_ip": rules.node_ip(F.col("dst")),
                "protocol": rules.protocol_label(F.col("attr")),
                "actual_label": rules.label_name(F.col("y")),
            }
        )
        .withColumn("match", F.col("prediction") == F.col("actual_label"))
        .drop("__technique")
    )
    return related_cves(assigned, cves, k).withColumn("cves_found", F.size("cve_ids"))


def export_records(analysis: DataFrame) -> DataFrame:
    """The fields of an exported analysis."""
    return analysis.select(
        F.current_timestamp().alias("timestamp"),
        F.col("edge_idx").alias("edge_id"),
        "prediction",
        F.format_string("%.2f%%", F.col("score") * 100).alias("confidence"),
        "actual_label",
        "match",
        F.col("src_ip").alias("source_ip"),
        F.col("dst_ip").alias("destination_ip"),
        "protocol",
        F.coalesce("mitre_id", F.lit("N/A")).alias("mitre_technique"),
        F.coalesce("mitre_name", F.lit("N/A")).alias("mitre_name"),
        "cves_found",
        "cve_ids",
    )


def hybrid_inference(
    scored: DataFrame,
    query_vectors: DataFrame,
    corpus: DataFrame,
    encoded: DataFrame | None = None,
    threshold: float = DECISION_THRESHOLD,
    k: int = TOP_K_CONTEXT,
    min_similarity: float = 0.5,
    min_severity: float | None = MIN_CVE_SEVERITY,
) -> DataFrame:
    """Prediction, retrieved records and threat level of every edge.

    ``query_vectors(edge_idx, query_vec)`` are the encoded query texts; or, with ``encoded(text, query_vec)``, they are
    ``(edge_idx, text)`` and each text is searched once.  Only attacks are searched; an edge without hits has none.
    """
    predicted = scored.withColumn("prediction", rules.prediction(F.col("score"), threshold))
    attacks = predicted.filter(F.col("prediction") == "ATTACK").select("edge_idx")
    asked = query_vectors.join(attacks, "edge_idx", "left_semi")
    wanted = encoded if encoded is not None else asked
    wanted = wanted.select(F.col("edge_idx" if encoded is None else "text").alias("query_id"), "query_vec")
    chosen = metadata_filter(corpus, min_severity)
    hits = knn(wanted, chosen.select(F.col("cve_id").alias("id"), "values"), k, min_similarity)
    found = (
        hits.groupBy(F.col("query_id").alias("edge_idx" if encoded is None else "text"))
        .agg(F.sort_array(F.collect_list(F.struct("rank", F.col("id").alias("cve_id"), "similarity"))).alias("hits"))
    )
    if encoded is not None:
        found = asked.join(found, "text").select("edge_idx", "hits")
    return (
        predicted.join(found, "edge_idx", "left")
        .withColumn("n_hits", F.when(F.col("hits").isNull(), 0).otherwise(F.size("hits")))
        .withColumn("threat_level", rules.threat_level(F.col("score"), F.col("prediction"), F.col("n_hits")))
    )
