"""Filtered text retrieval on top of the vector join, and measures of what was retrieved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgraph.operators.joins import top_k_per_group
from flowgraph.operators import sparse
from flowgraph.operators.knn import knn
from flowgraph.operators.sparse import SparseTextEncoder
from flowgraph.schemas import SIMILARITY_THRESHOLD, TOP_K_CVES, TOP_K_TECHNIQUES
from flowgraph.session import materialize


def metadata_filter(
    corpus: DataFrame, min_severity: float | None = None, year: int | None = None, mitre_id: str | None = None
) -> DataFrame:
    """Plain predicates, written before the search so that they reach the scan.  0 filters, None does not."""
    if min_severity is not None:
        corpus = corpus.filter(F.col("severity_score") >= min_severity)
    if year is not None:
        corpus = corpus.filter(F.col("year") == year)
    if mitre_id is not None:
        corpus = corpus.filter(F.col("matched_mitre_id") == mitre_id)
    return corpus


def search_cves(
    queries: DataFrame,
    corpus: DataFrame,
    top_k: int = TOP_K_CVES,
    min_severity: float | None = None,
    year: int | None = None,
    mitre_id: str | None = None,
    threshold: float = SIMILARITY_THRESHOLD,
) -> DataFrame:
    """Related CVE records of every query vector.

    ``corpus`` holds cleaned records with ``values``.  The search itself reads ids and vectors
    only; the texts are joined to the few hits.  Records that share an id are hits of their own.
    """
    chosen = _keyed(metadata_filter(corpus, min_severity, year, mitre_id), "cve_id")
    hits = knn(queries, chosen.select(F.col("__row").alias("id"), "values"), top_k, threshold)
    return (
        hits.withColumnRenamed("id", "__row")
        .join(chosen.drop("values"), "__row")
        .select(
            "query_id", "rank", "cve_id", "similarity", "matched_mitre_id", "year", "severity_score", "description"
        )
    )


def _keyed(records: DataFrame, key: str) -> DataFrame:
    """``records`` with ``__row``, which names a row and sorts like its ``key``.

    That is the key itself where no two rows share one; else the rows are written once with a number behind it.
    """
    rows = records.agg(F.count(key).alias("n"), F.count_distinct(key).alias("keys")).first()
    if rows["n"] == rows["keys"]:
        return records.withColumn("__row", F.col(key))
    number = F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")
    return materialize(records.withColumn("__row", F.concat(F.col(key).cast("string"), F.lit("\x01"), number)), "records")


def search_texts(
    queries: DataFrame,
    corpus: DataFrame,
    top_k: int = TOP_K_CVES,
    min_severity: float | None = None,
    year: int | None = None,
    mitre_id: str | None = None,
    threshold: float = SIMILARITY_THRESHOLD,
    encoder: SparseTextEncoder | None = None,
) -> DataFrame:
    """Related CVE records of every ``queries(query_id, text)`` by the words they share; no dense vectors are made or kept.

    The encoder is fitted on the descriptions of all records, whatever the filters, unless one is given.
    """
    encoder = encoder or SparseTextEncoder().fit(corpus, "description")
    chosen = _keyed(metadata_filter(corpus, min_severity, year, mitre_id), "cve_id")
    terms = encoder(chosen.select(F.col("__row").alias("id"), "description"), "id", "description")
    hits = sparse.search(encoder(queries, "query_id"), terms, top_k, threshold)
    found = hits.withColumnRenamed("id", "__row").join(chosen, "__row")
    return round_similarity(
        found.select("query_id", "rank", "cve_id", "similarity", "matched_mitre_id", "year", "severity_score", "description")
    )


def query_cve_by_text(queries: DataFrame, corpus: DataFrame, encode, **options) -> DataFrame:
    """``queries(query_id, text)``: encode, search, round the score to 4 digits."""
    vectors = encode(queries).select("query_id", F.col("values").alias("query_vec"))
    return round_similarity(search_cves(vectors, corpus, **options))


def search_techniques(
    queries: DataFrame, techniques: DataFrame, top_k: int = TOP_K_TECHNIQUES, threshold: float = SIMILARITY_THRESHOLD
) -> DataFrame:
    """Matching techniques of every query vector; techniques that share an id are hits of their own."""
    keyed = _keyed(techniques, "mitre_id")
    hits = knn(queries, keyed.select(F.col("__row").alias("id"), "values"), top_k, threshold)
    return hits.withColumnRenamed("id", "__row").join(keyed.drop("values"), "__row").drop("__row")


def query_mitre_for_cve(cves: DataFrame, techniques: DataFrame, encode, **options) -> DataFrame:
    """``cves(query_id, text)``: CVE descriptions to techniques."""
    vectors = encode(cves).select("query_id", F.col("values").alias("query_vec"))
    return round_similarity(search_techniques(vectors, techniques, **options))


def round_similarity(hits: DataFrame, digits: int = 4) -> DataFrame:
    return hits.withColumn("similarity_score", F.round("similarity", digits)).drop("similarity")


def technique_index(cves: DataFrame, k: int) -> DataFrame:
    """Per technique its ``k`` most severe records in order; records without technique are left out."""
    ranked = top_k_per_group(
        cves.filter(F.col("matched_mitre_id").isNotNull()),
        "matched_mitre_id",
        [F.desc_nulls_last("severity_score"), F.asc("cve_id")],
        k,
    )
    return ranked.select(F.col("matched_mitre_id").alias("mitre_id"), "rank", "cve_id", "severity_score", "year")


def sort_by_severity(cves: DataFrame) -> DataFrame:
    return cves.orderBy(F.desc_nulls_last("severity_score"), F.asc("cve_id"))


# --- quality of retrieved context ------------------------------------------------------------


def triad_per_query(retrieved: DataFrame, top_similarity: float) -> DataFrame:
    """Context relevance, groundedness and answer relevance of every query with hits.

    ``retrieved(query_id, similarity, mitre_id, severity, year, score)``.
    """
    top = F.max("similarity")
    relevant = top > top_similarity
    # A missing technique counts as one more value, as it does in a set.
    diverse = (F.count_distinct("mitre_id") + F.max(F.col("mitre_id").isNull().cast("int"))) >= 2

    def share(flags: list[Column]) -> Column:
        return sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags), F.lit(0)) / float(len(flags))

    return retrieved.groupBy("query_id").agg(
        F.avg("similarity").alias("context_relevance"),
        share([F.count(F.lit(1)) >= 3, diverse, relevant, F.max("severity") >= 9.0]).alias("groundedness"),
        share(
            [relevant, diverse, F.max("year") >= 2020, F.max("severity") >= 8.0, (F.max("score") > 0.7) & relevant]
        ).alias("answer_relevance"),
    )


def triad_summary(queries: DataFrame, retrieved: DataFrame, top_similarity: float) -> DataFrame:
    """One row: success rate, mean and population deviation of the three measures, context figures."""
    names = ["context_relevance", "groundedness", "answer_relevance"]
    asked = queries.select("query_id").distinct().agg(F.count(F.lit(1)).cast("double"))
    context = retrieved.agg(
        (F.count_distinct("mitre_id") + F.coalesce(F.max(F.col("mitre_id").isNull().cast("int")), F.lit(0))).alias(
            "unique_mitre_ids"
        ),
        F.coalesce(F.avg("similarity"), F.lit(0.0)).alias("avg_similarity"),
        F.coalesce(F.avg("severity"), F.lit(0.0)).alias("avg_severity"),
    )
    measures = triad_per_query(retrieved, top_similarity).agg(
        F.count(F.lit(1)).cast("double").alias("answered"),
        *[F.coalesce(F.avg(m), F.lit(0.0)).alias(f"{m}_mean") for m in names],
        *[F.coalesce(F.stddev_pop(m), F.lit(0.0)).alias(f"{m}_std") for m in names],
    )
    return measures.select(
        F.coalesce(F.try_divide(F.col("answered"), asked.scalar()), F.lit(0.0)).alias("retrieval_rate"),
        *[c for m in names for c in (f"{m}_mean", f"{m}_std")],
        *[context.select(c).scalar().alias(c) for c in ("unique_mitre_ids", "avg_similarity", "avg_severity")],
    )


def technique_coverage(retrieved: DataFrame) -> DataFrame:
    """Distinct techniques found, in order."""
    return retrieved.filter(F.col("mitre_id").isNotNull()).select("mitre_id").distinct().orderBy("mitre_id")


def retrieval_diagnostic(
    queries: DataFrame, corpus: DataFrame, thresholds, k: int = 5, min_severity: float = 7.0
) -> DataFrame:
    """Mean number of hits (at most ``k``) per similarity threshold, with and without the severity filter.

    Of the k best hits those above a threshold are exactly the hits at that threshold, so one
    search at the lowest threshold serves all of them.
    """
    low = min(thresholds)
    asked = queries.select("query_id").distinct().count()
    lines = []
    for name, part in (("all", corpus), ("severe", metadata_filter(corpus, min_severity))):
        hits = knn(queries, part.select(F.col("cve_id").alias("id"), "values"), k, low)
        counts = hits.agg(*[F.count_if(F.col("similarity") >= t).alias(f"t{i}") for i, t in enumerate(thresholds)])
        lines.append(
            counts.select(
                F.inline(
                    F.array(
                        *[
                            F.struct(
                                F.lit(name).alias("records"),
                                F.lit(float(t)).alias("threshold"),
                                F.col(f"t{i}").alias("hits"),
                                F.coalesce(F.try_divide(F.col(f"t{i}").cast("double"), F.lit(float(asked))), F.lit(0.0)).alias("mean_hits"),
                            )
                            for i, t in enumerate(thresholds)
                        ]
                    )
                )
            )
        )
    return lines[0].unionByName(lines[1])

