"""Knowledge-base sources: CVE records and the ATT&CK bundle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgraph.functions.normalize import metadata_text
from flowgraph.operators.embedding import text_hash
from flowgraph.schemas import BUNDLE, CVE


def read_cves(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CVE records.  ``multi_line`` files may hold quoted line breaks and are read by one task each; files known to
    have one record a line can be split."""
    return spark.read.schema(CVE).option("header", True).option("multiLine", multi_line).option("escape", '"').csv(path)


def with_position(scan: DataFrame, name: str = "position") -> DataFrame:
    """Rows of a file scan with their place in the input: (file, start of the split, order within it).

    Call it directly on the scan.  Files follow each other by path.
    """
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"))
    return scan.withColumn(name, at)


def read_bundle(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per object of the bundle files, with its ``position``; unused parts are never materialised.

    A ``multi_line`` bundle is one JSON value a file, read by one task; many large files belong in JSON lines.
    """
    bundle = spark.read.schema(BUNDLE).option("multiLine", multi_line).json(path)
    placed = with_position(bundle).select("position", F.posexplode("objects").alias("place", "object"))
    return placed.select(F.struct("position.*", "place").alias("position"), "object")


def parse_bundle(json_text: Column) -> Column:
    return F.from_json(json_text, BUNDLE)["objects"]


def extract_techniques(objects: DataFrame, column: str = "object") -> DataFrame:
    """(mitre_id, name, description, full_text, and position if given) of the attack patterns in force.

    The last reference of the catalogue decides the id; if it has none, the record is dropped.
    Deprecated records go, revoked ones stay.
    """
    o = F.col(column)
    own = F.filter(o["external_references"], lambda r: r["source_name"] == "mitre-attack")
    mitre_id = F.coalesce(F.try_element_at(own, F.lit(-1))["external_id"], F.lit(""))
    name = F.coalesce(o["name"], F.lit(""))
    description = F.coalesce(o["description"], F.lit(""))
    return (
        objects.filter((o["type"] == "attack-pattern") & ~F.coalesce(o["x_mitre_deprecated"], F.lit(False)))
        .select(
            mitre_id.alias("mitre_id"),
            name.alias("name"),
            description.alias("description"),
            F.concat(F.lit("Technique Name: "), name, F.lit(". Description: "), description).alias("full_text"),
            *(F.col(c) for c in ("position",) if c in objects.columns),
        )
        .filter(F.col("mitre_id") != "")
    )


def technique_payload(embedded: DataFrame) -> DataFrame:
    """Vector records of techniques: whole texts, and the description's short form for display."""
    return embedded.select(
        F.col("mitre_id").alias("id"),
        "values",
        "mitre_id",
        "name",
        "description",
        "full_text",
        metadata_text(F.col("description"), 500).alias("description_short"),
    )


def cve_payload(embedded: DataFrame) -> DataFrame:
    """Vector records of CVEs: the whole description, its short form, and the hash of what was encoded."""
    return embedded.select(
        F.col("cve_id").alias("id"),
        "values",
        "matched_mitre_id",
        "year",
        "severity_score",
        "description",
        metadata_text(F.col("description"), 500).alias("description_short"),
        text_hash(F.col("description")).alias("text_hash"),
    )
