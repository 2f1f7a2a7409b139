"""The given tables reshaped into the inputs the library works on (see FIXTURES.md).

Every view covers its whole source table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TECHNIQUE_BY_LABEL = ["T1041", "T1046", "T1190", "T1071", "T1568", "T1110", "T1021", "T1595", None, "T1059"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Network flows in the raw table's 28 columns, from ``lineitem``."""
    li = table(spark, sf_dir, "lineitem")
    orig_bytes = "CAST(floor(l_extendedprice) AS BIGINT)"
    resp_bytes = "CAST(floor(NULLIF(l_extendedprice * l_discount, 0)) AS BIGINT)"
    orig_pkts = "CAST(l_quantity AS BIGINT)"
    resp_pkts = "CAST(l_linenumber * l_quantity AS BIGINT)"
    tactic = (
        "CASE WHEN l_discount < 0.005 THEN NULL "
        "WHEN l_suppkey % 10 < 3 AND l_discount > 0.095 THEN 'Reconnaissance' "
        "WHEN l_suppkey % 10 < 3 AND l_discount > 0.085 AND l_returnflag = 'A' THEN 'Credential Access' "
        "ELSE 'none' END"
    )
    return li.selectExpr(
        f"{resp_pkts} AS resp_pkts",
        "CASE l_linenumber WHEN 1 THEN 'http' WHEN 2 THEN 'dns' WHEN 3 THEN 'ssl' WHEN 4 THEN 'ssh' "
        "WHEN 5 THEN 'unknown' WHEN 6 THEN 'ftp' END AS service",
        f"{orig_bytes} + 40 * {orig_pkts} AS orig_ip_bytes",
        "l_linestatus = 'O' AS local_resp",
        "CAST(0 AS BIGINT) AS missed_bytes",
        "CASE l_returnflag WHEN 'A' THEN 'tcp' WHEN 'N' THEN 'udp' WHEN 'R' THEN 'icmp' END AS proto",
        "NULLIF(l_tax, 0) * 100 AS duration",
        "CASE WHEN l_linestatus = 'F' THEN 'SF' ELSE 'S0' END AS conn_state",
        "concat('10.0.0.', l_partkey % 40) AS dest_ip_zeek",
        f"{orig_pkts} AS orig_pkts",
        "concat('1:', l_partkey) AS community_id",
        f"coalesce({resp_bytes}, 0) + 40 * {resp_pkts} AS resp_ip_bytes",
        "CASE l_linenumber WHEN 1 THEN 80 WHEN 2 THEN 53 WHEN 3 THEN 443 WHEN 4 THEN 22 ELSE 0 END AS dest_port_zeek",
        f"{orig_bytes} AS orig_bytes",
        "l_linestatus = 'F' AS local_orig",
        "l_shipdate AS datetime",
        "CASE WHEN l_linestatus = 'F' THEN 'ShADadFf' END AS history",
        f"{resp_bytes} AS resp_bytes",
        "concat('C', l_orderkey, '-', l_linenumber) AS uid",
        "CAST(1024 + l_orderkey % 60000 AS INT) AS src_port_zeek",
        "datediff(l_shipdate, DATE '1970-01-01') * 86400.0D AS ts",
        "concat('10.0.', CAST((l_suppkey - l_suppkey % 256) / 256 AS INT), '.', l_suppkey % 256) AS src_ip_zeek",
        f"{tactic} AS label_tactic",
        "concat('p', year(l_shipdate)) AS source_period",
        f"CASE {tactic} WHEN 'Reconnaissance' THEN 'T1595' WHEN 'Credential Access' THEN 'T1110' ELSE 'none' END "
        "AS label_technique",
        "'unknown' AS label_cve",
        "CASE WHEN l_orderkey % 20 = 0 THEN 'Duplicate' WHEN l_orderkey % 20 = 1 THEN NULL ELSE 'False' END "
        "AS label_binary",
        "CASE l_orderkey % 8 WHEN 0 THEN 'unknown' WHEN 1 THEN 'NaN' WHEN 3 THEN '1.0' WHEN 4 THEN '2.5' "
        "WHEN 5 THEN '3.5' WHEN 6 THEN 'abc' WHEN 7 THEN '' END AS vlan",
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node vectors, from ``embeddings``."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("node_id"), F.col("embedding").cast("array<double>").alias("x")
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored edges with labels, from ``events``: logits overlap between classes and repeat."""
    return (
        table(spark, sf_dir, "events")
        .select(
            F.col("event_id").alias("edge_idx"),
            (F.col("event_type") == "error").cast("int").alias("y"),
        )
        .withColumn(
            "logit",
            # whole numbers until the last step, so that equal logits are equal to the last bit
            F.expr("(CASE WHEN y = 1 THEN 250 ELSE -125 END + (edge_idx * 7919) % 1000 - 500) / 250.0D"),
        )
    )


def cves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CVE records with vectors and with gaps, from ``embeddings`` and ``documents``."""
    emb = table(spark, sf_dir, "embeddings")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    technique = F.element_at(F.array(*[F.lit(t) for t in TECHNIQUE_BY_LABEL]), F.col("label") + 1)
    return emb.join(docs, "vec_id", "left").select(
        "vec_id",
        F.expr("concat('CVE-', 2015 + vec_id % 11, '-', 1000 + vec_id)").alias("cve_id"),
        F.col("text").alias("description"),
        technique.alias("matched_mitre_id"),
        F.expr("CASE WHEN vec_id % 17 <> 0 THEN ((vec_id * 37) % 101) / 10.0D END").alias("severity_score"),
        F.expr("CASE WHEN vec_id % 13 <> 0 THEN CAST(2015 + vec_id % 11 AS INT) END").alias("year"),
        F.col("embedding").alias("values"),
    )


def techniques(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vector per technique: the lowest id of each label."""
    technique = F.element_at(F.array(*[F.lit(t) for t in TECHNIQUE_BY_LABEL]), F.col("label") + 1)
    return (
        table(spark, sf_dir, "embeddings")
        .groupBy("label")
        .agg(F.min_by("embedding", "vec_id").alias("values"))
        .select(technique.alias("mitre_id"), F.concat(F.lit("technique "), "label").alias("name"), "values")
        .filter(F.col("mitre_id").isNotNull())
    )


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query vector per embedding, read backwards so that no query is its own best hit."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.reverse("embedding").alias("query_vec")
    )


def frontier_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored listing pages: the given html with directory-listing anchors appended."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.expr(
            "concat(regexp_extract(url, '^[^?#]*', 0), CASE WHEN page_id % 2 = 0 THEN '/parquet/' ELSE '/' END)"
        ).alias("url"),
        F.expr(
            "concat(html, '<a href=\"../\">up</a><a href=\"_SUCCESS\">ok</a><a href=\"?C=N\">sort</a><a href=\"sub',"
            " page_id, '/\">dir</a><a href=\"csv_x/\">csv</a><a href=\"part-0000', page_id % 3, '.parquet\">part</a>')"
        ).alias("html"),
    )


def bundle_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One technique-bundle JSON text per document."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.to_json(
            F.struct(
                F.array(
                    F.struct(
                        F.expr("CASE WHEN lang = 'en' THEN 'attack-pattern' ELSE 'malware' END").alias("type"),
                        F.expr("doc_id % 7 = 0").alias("x_mitre_deprecated"),
                        F.concat(F.lit("technique "), "doc_id").alias("name"),
                        F.col("text").alias("description"),
                        F.expr(
                            "filter(array("
                            " named_struct('source_name', 'capec', 'external_id', concat('C', doc_id)),"
                            " CASE WHEN doc_id % 3 >= 1 THEN"
                            "  named_struct('source_name', 'mitre-attack', 'external_id', concat('T', 1000 + doc_id)) END,"
                            " CASE WHEN doc_id % 3 = 2 THEN named_struct('source_name', 'mitre-attack', 'external_id',"
                            "  CASE WHEN doc_id % 6 <> 2 THEN concat('T', 1000 + doc_id, '.001') END) END"
                            "), r -> r IS NOT NULL)"
                        ).alias("external_references"),
                    )
                ).alias("objects")
            )
        ).alias("json"),
    )
