"""Checked queries on vectors and texts: stores, search, retrieval quality, encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs
from checks.catalog_scores import scored, scored_edges
from checks.registry import ORACLES, query, rounded
from flowgraph.functions import vector
from flowgraph.functions.normalize import clean_cves
from flowgraph.operators import report, retrieval
from flowgraph.operators.embedding import HashedTextEncoder, embed, embed_missing, text_hash
from flowgraph.operators.knn import knn
from flowgraph.operators.sparse import SLOTS, SparseTextEncoder
from flowgraph.plans import batch
from flowgraph.schemas import SEED
from flowgraph.session import materialize, new_path
from flowgraph.sources import bucket_store, knowledge, sinks, vector_store
from flowgraph.streaming.frontier import upsert_new_files

LOW = 0.3  # the given vectors are far apart; the library's defaults would find almost nothing


def corpus(spark, sf):
    return clean_cves(inputs.cves(spark, sf)).drop("vec_id")


# --- sources and stores -------------------------------------------------------------------------

_CVE = "cve_id, description, matched_mitre_id, severity_score, year"


@query("s12_read_cves", "cves", f"SELECT {_CVE} FROM cves")
def _(spark, sf):
    path = new_path(spark, "cve_csv")
    inputs.cves(spark, sf).select(*_CVE.split(", ")).write.option("header", True).option("quoteAll", True).option(
        "escape", '"'
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return knowledge.read_cves(spark, path)


_TECHNIQUES_SQL = """SELECT mitre_id, 'technique ' || doc_id AS name, text AS description,
  concat('Technique Name: technique ', doc_id, '. Description: ', text) AS full_text
FROM (SELECT doc_id, text, CASE doc_id % 3 WHEN 1 THEN concat('T', 1000 + doc_id)
    WHEN 2 THEN CASE WHEN doc_id % 6 <> 2 THEN concat('T', 1000 + doc_id, '.001') END END AS mitre_id
  FROM documents WHERE lang = 'en' AND doc_id % 7 <> 0) WHERE mitre_id IS NOT NULL"""


@query("s13_bundle_files", "", _TECHNIQUES_SQL)
def _(spark, sf):
    path = new_path(spark, "bundle")
    inputs.bundle_json(spark, sf).select("json").write.text(path)
    return knowledge.extract_techniques(knowledge.read_bundle(spark, path, multi_line=False)).drop("position")


def bundle_objects(spark, sf):
    return inputs.bundle_json(spark, sf).select(F.explode(knowledge.parse_bundle(F.col("json"))).alias("object"))


@query("x15_extract_techniques", "", _TECHNIQUES_SQL)
def _(spark, sf):
    return knowledge.extract_techniques(bundle_objects(spark, sf))


_CVE_ID = "concat('CVE-', 2015 + doc_id % 11, '-', 1000 + doc_id)"


ORACLE_UPSERT = f"""SELECT id, severity, text FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY t DESC, pos DESC) AS rn FROM (
    SELECT cve_id AS id, severity_score AS severity, description AS text, 0 AS t, vec_id AS pos FROM cves
    UNION ALL SELECT {_CVE_ID}, 9.9e0, text, 1, doc_id FROM documents
    UNION ALL SELECT {_CVE_ID}, 1.5e0, lang, 1, doc_id + 1000000000 FROM documents WHERE lang <> 'en'))
WHERE rn = 1"""


def upsert_inputs(spark, sf):
    base = inputs.cves(spark, sf).selectExpr("cve_id AS id", "severity_score AS severity", "description AS text", "vec_id AS pos")
    docs = inputs.table(spark, sf, "documents")
    first = docs.selectExpr(f"{_CVE_ID} AS id", "9.9D AS severity", "text", "doc_id AS pos")
    again = docs.filter("lang <> 'en'").selectExpr(f"{_CVE_ID} AS id", "1.5D AS severity", "lang AS text", "doc_id + 1000000000 AS pos")
    return base, first, again


@query("s14_upsert", "cves", ORACLE_UPSERT)
def _(spark, sf):
    base, first, again = upsert_inputs(spark, sf)
    return vector_store.upsert(base, first.unionByName(again), "id", "pos").drop("pos")


@query("s14_upsert_buckets", "cves", ORACLE_UPSERT)
def _(spark, sf):
    base, first, again = upsert_inputs(spark, sf)
    path = new_path(spark, "store")
    bucket_store.create(base.drop("pos"), path, "id", 16)
    for updates in (first, again):
        bucket_store.upsert(spark, path, updates, "id", "pos")
    return bucket_store.read(spark, path, "id")


@query("s21_stream_upsert", "cves", ORACLE_UPSERT)
def _(spark, sf):
    """Updates arrive as files in two runs, then a run that finds nothing new."""
    base, first, again = upsert_inputs(spark, sf)
    path, inbox, state = (new_path(spark, n) for n in ("store", "inbox", "state"))
    bucket_store.create(base.drop("pos"), path, "id", 16)
    for updates in (first, again, None):
        if updates is not None:
            updates.write.mode("append").parquet(inbox)
        upsert_new_files(spark, inbox, base.schema, path, "id", state, "pos")
    return bucket_store.read(spark, path, "id")


@query("s15_full_refresh", "", _TECHNIQUES_SQL)
def _(spark, sf):
    path = new_path(spark, "techniques")
    sinks.replace_all(inputs.table(spark, sf, "documents"), path)
    sinks.replace_all(knowledge.extract_techniques(bundle_objects(spark, sf)), path)
    return spark.read.parquet(path)


@query(
    "s16_index_stats",
    "",
    "SELECT count(*) AS total_vector_count, CAST(min(len(embedding)) AS INTEGER) AS min_dimension,"
    " CAST(max(len(embedding)) AS INTEGER) AS max_dimension FROM embeddings",
)
def _(spark, sf):
    return vector_store.index_stats(inputs.table(spark, sf, "embeddings").withColumnRenamed("embedding", "values"))


@query(
    "s17_cached_embeddings",
    "",
    """SELECT doc_id, CAST(64 AS INTEGER) AS dimension, vec_id IS NOT NULL AS reused
FROM documents LEFT JOIN embeddings ON vec_id = doc_id""",
)
def _(spark, sf):
    docs = inputs.table(spark, sf, "documents").select("doc_id", "text")
    stored = inputs.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("values"))
    encoder = HashedTextEncoder(64).fit(docs)
    out = embed_missing(docs, stored, "doc_id", lambda df: encoder(df).select("doc_id", "values"))
    before = stored.select("doc_id", F.col("values").alias("before"))
    return out.join(before, "doc_id", "left").select(
        "doc_id", F.size("values").alias("dimension"), F.coalesce(F.col("values") == F.col("before"), F.lit(False)).alias("reused")
    )


@query(
    "n8_clean_cves",
    "cves",
    """SELECT cve_id, coalesce(severity_score, 0) AS severity_score, coalesce(year, 2026) AS year,
  coalesce(description, '') AS description FROM cves""",
)
def _(spark, sf):
    return clean_cves(inputs.cves(spark, sf)).select("cve_id", "severity_score", "year", "description")


@query(
    "n9_metadata_text",
    "",
    "SELECT doc_id, text AS description, text[1:500] AS description_short FROM documents",
)
def _(spark, sf):
    docs = inputs.table(spark, sf, "documents").select(
        F.col("doc_id").alias("cve_id"), F.lit(None).cast("array<float>").alias("values"), F.lit("").alias("matched_mitre_id"),
        F.lit(0).alias("year"), F.lit(0.0).alias("severity_score"), F.col("text").alias("description"),
    )
    return knowledge.cve_payload(docs).select(F.col("id").alias("doc_id"), "description", "description_short")


# --- search ---------------------------------------------------------------------------------------


@query(
    "x17_unit_vectors",
    "",
    """SELECT vec_id, round(sqrt(list_sum(list_transform(v, lambda x: (3 * x) * (3 * x)))), 6) AS norm,
  round(list_cosine_similarity(v, list_reverse(v)), 6) + 0e0 AS cosine, round(v[1] / sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) + 0e0 AS first
FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)""",
)
def _(spark, sf):
    v = F.col("embedding").cast("array<double>")
    tripled = F.transform(v, lambda x: x * 3)
    out = inputs.table(spark, sf, "embeddings").select(
        "vec_id",
        vector.norm(tripled).alias("norm"),
        vector.cosine(v, F.reverse(tripled)).alias("cosine"),
        vector.l2_normalize(tripled)[0].alias("first"),
    )
    return rounded(out, ["norm", "cosine", "first"])


_TOP = """SELECT query_id, rank, cve_id, round(similarity, 6) + 0e0 AS similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, cve_id) AS rank FROM sims {where})
WHERE rank <= {k}"""


@query("j4_knn", "sims", _TOP.format(where="", k=5))
def _(spark, sf):
    hits = knn(inputs.query_vectors(spark, sf), corpus(spark, sf).select(F.col("cve_id").alias("id"), "values"), 5)
    return rounded(hits.withColumnRenamed("id", "cve_id"), ["similarity"])


@query("j4_knn_blocks", "sims", _TOP.format(where="WHERE similarity >= 0.3", k=5))
def _(spark, sf):
    """The same search with the size limits set so low that both sides count as large."""
    hits = knn(
        inputs.query_vectors(spark, sf),
        corpus(spark, sf).select(F.col("cve_id").alias("id"), "values"),
        5,
        LOW,
        broadcast_rows=100,
        block_rows=200,
        pivots=4,
    )
    return rounded(hits.withColumnRenamed("id", "cve_id"), ["similarity"])


@query("j4_knn_batches", "sims", _TOP.format(where="", k=5))
def _(spark, sf):
    """Both sides large and searched in turns: 300 queries are broadcast at a time."""
    hits = knn(
        inputs.query_vectors(spark, sf), corpus(spark, sf).select(F.col("cve_id").alias("id"), "values"), 5,
        broadcast_rows=300, block_rows=400, pivots=4, rotate=True,
    )
    return rounded(hits.withColumnRenamed("id", "cve_id"), ["similarity"])


@query(
    "j5_search_cves",
    "sims",
    """SELECT query_id, rank, cve_id, round(similarity, 4) AS similarity_score, matched_mitre_id,
  year, severity_score, description FROM (
  SELECT query_id, cve_id, similarity, matched_mitre_id, coalesce(year, 2026) AS year, severity_score,
    coalesce(description, '') AS description, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, cve_id) AS rank
  FROM sims WHERE similarity >= 0.2 AND severity_score >= 5) WHERE rank <= 10""",
)
def _(spark, sf):
    hits = retrieval.search_cves(inputs.query_vectors(spark, sf), corpus(spark, sf), 10, min_severity=5.0, threshold=0.2)
    return retrieval.round_similarity(hits)


@query(
    "j5_search_cves_filtered",
    "sims",
    """SELECT query_id, rank, cve_id, round(similarity, 4) AS similarity_score FROM (
  SELECT query_id, cve_id, similarity, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, cve_id) AS rank
  FROM sims WHERE similarity >= 0.05 AND year = 2020 AND matched_mitre_id = 'T1190') WHERE rank <= 10""",
)
def _(spark, sf):
    hits = retrieval.search_cves(
        inputs.query_vectors(spark, sf), corpus(spark, sf), year=2020, mitre_id="T1190", threshold=0.05
    )
    return retrieval.round_similarity(hits).select("query_id", "rank", "cve_id", "similarity_score")


@query(
    "j6_search_techniques",
    "cves techniques",
    """SELECT query_id, rank, mitre_id, name, round(similarity, 6) AS similarity FROM (
  SELECT cve_id AS query_id, t.mitre_id, t.name, round(list_cosine_similarity(c.vec, t.vec), 12) AS similarity,
    row_number() OVER (PARTITION BY cve_id ORDER BY round(list_cosine_similarity(c.vec, t.vec), 12) DESC, t.mitre_id) AS rank
  FROM cves c, techniques t WHERE round(list_cosine_similarity(c.vec, t.vec), 12) >= 0.1) WHERE rank <= 5""",
)
def _(spark, sf):
    queries = inputs.cves(spark, sf).select(F.col("cve_id").alias("query_id"), F.col("values").alias("query_vec"))
    return rounded(retrieval.search_techniques(queries, inputs.techniques(spark, sf), 5, 0.1), ["similarity"])


@query(
    "j7_hybrid_inference",
    "scored sims",
    """, h AS (SELECT query_id, string_agg(cve_id, ',' ORDER BY rank) AS cve_ids, count(*) AS n FROM (
  SELECT query_id, cve_id, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, cve_id) AS rank
  FROM sims WHERE similarity >= 0.2 AND coalesce(severity_score, 0) >= 7) WHERE rank <= 5 GROUP BY 1)
SELECT edge_idx, CASE WHEN score >= 0.5 THEN 'ATTACK' ELSE 'NORMAL' END AS prediction,
  CASE WHEN score >= 0.5 THEN coalesce(cve_ids, '') ELSE '' END AS cve_ids,
  CASE WHEN score >= 0.5 AND n > 0 THEN CASE WHEN score > 0.8 THEN 'HIGH' ELSE 'MEDIUM' END ELSE 'LOW' END AS threat_level
FROM scored LEFT JOIN h ON query_id = edge_idx""",
)
def _(spark, sf):
    vectors = inputs.query_vectors(spark, sf).withColumnRenamed("query_id", "edge_idx")
    out = report.hybrid_inference(scored(spark, sf), vectors, corpus(spark, sf), min_similarity=0.2)
    ids = F.coalesce(F.array_join(F.transform("hits", lambda h: h["cve_id"]), ","), F.lit(""))
    return out.select("edge_idx", "prediction", ids.alias("cve_ids"), "threat_level")


@query(
    "w4_top_per_technique",
    "cves",
    """SELECT matched_mitre_id AS mitre_id, rank, cve_id, severity_score, year FROM (
  SELECT *, row_number() OVER (PARTITION BY matched_mitre_id ORDER BY severity_score DESC NULLS LAST, cve_id) AS rank
  FROM cves WHERE matched_mitre_id IS NOT NULL) WHERE rank <= 5""",
)
def _(spark, sf):
    return retrieval.technique_index(inputs.cves(spark, sf), 5)


@query(
    "l1_sort_by_severity",
    "cves",
    "SELECT cve_id, severity_score, CAST(row_number() OVER (ORDER BY severity_score DESC NULLS LAST, cve_id) AS INTEGER) AS place FROM cves",
)
def _(spark, sf):
    """With the place that each row has in the sorted result."""
    placed = retrieval.sort_by_severity(inputs.cves(spark, sf).select("cve_id", "severity_score"))
    placed = materialize(placed.withColumn("at", F.monotonically_increasing_id())).withColumn("part", F.shiftright("at", 33))
    sizes = sorted((r["part"], r["count"]) for r in placed.groupBy("part").count().collect())
    starts = [(part, sum(n for _, n in sizes[:i])) for i, (part, _) in enumerate(sizes)]
    starts = spark.createDataFrame(starts, "part long, start long")
    place = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(F.broadcast(starts), "part").withColumn("place", place.cast("int")).drop("at", "part", "start")


# --- retrieval quality ------------------------------------------------------------------------------


def retrieved(spark, sf):
    """Five best records per query at similarity 0.3, with the score of the edge asked about."""
    c = corpus(spark, sf)
    hits = knn(inputs.query_vectors(spark, sf), c.select(F.col("cve_id").alias("id"), "values"), 5, LOW)
    meta = c.select(
        F.col("cve_id").alias("id"),
        F.col("matched_mitre_id").alias("mitre_id"),
        F.col("severity_score").alias("severity"),
        "year",
    )
    return materialize(
        hits.join(meta, "id").join(scored(spark, sf).select(F.col("edge_idx").alias("query_id"), "score"), "query_id")
    )


_FLAGS = """, triad AS (SELECT query_id, avg(similarity) AS context_relevance,
  (CAST(count(*) >= 3 AS INTEGER) + CAST(count(DISTINCT coalesce(mitre_id, '')) >= 2 AS INTEGER)
    + CAST(max(similarity) > 0.35 AS INTEGER) + CAST(max(severity) >= 9 AS INTEGER)) / 4e0 AS groundedness,
  (CAST(max(similarity) > 0.35 AS INTEGER) + CAST(count(DISTINCT coalesce(mitre_id, '')) >= 2 AS INTEGER)
    + CAST(max(year) >= 2020 AS INTEGER) + CAST(max(severity) >= 8 AS INTEGER)
    + CAST(max(score) > 0.7 AND max(similarity) > 0.35 AS INTEGER)) / 5e0 AS answer_relevance
  FROM retrieved GROUP BY query_id)
"""


def _triad(spark, sf, measure):
    return rounded(retrieval.triad_per_query(retrieved(spark, sf), 0.35).select("query_id", measure), [measure])


for _id, _measure in (("a13", "context_relevance"), ("a14", "groundedness"), ("a15", "answer_relevance")):
    query(f"{_id}_{_measure}", "retrieved", _FLAGS + f"SELECT query_id, round({_measure}, 6) AS {_measure} FROM triad")(
        lambda spark, sf, m=_measure: _triad(spark, sf, m)
    )

_SUMMARY = [
    f"{m}_{s}" for m in ("context_relevance", "groundedness", "answer_relevance") for s in ("mean", "std")
]
_SUMMARY_SQL = (
    _FLAGS
    + "SELECT round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM embeddings), 6) AS retrieval_rate, "
    + ", ".join(
        f"round(avg({m}), 6) AS {m}_mean, round(stddev_pop({m}), 6) AS {m}_std"
        for m in ("context_relevance", "groundedness", "answer_relevance")
    )
    + """, (SELECT count(DISTINCT coalesce(mitre_id, '')) FROM retrieved) AS unique_mitre_ids,
  (SELECT round(avg(similarity), 6) FROM retrieved) AS avg_similarity,
  (SELECT round(avg(severity), 6) FROM retrieved) AS avg_severity FROM triad"""
)


def summary(spark, sf):
    return retrieval.triad_summary(inputs.query_vectors(spark, sf), retrieved(spark, sf), 0.35)


@query("a16_triad_summary", "retrieved", _SUMMARY_SQL)
def _(spark, sf):
    return rounded(summary(spark, sf), ["retrieval_rate", *_SUMMARY, "avg_similarity", "avg_severity"])


@query("s19_export_summary", "retrieved", _SUMMARY_SQL)
def _(spark, sf):
    path = sinks.export_summary(summary(spark, sf), new_path(spark, "summary"))
    back = spark.read.json(path).select(
        "retrieval_rate",
        *[F.col(f"{c.rsplit('_', 1)[0]}.{c.rsplit('_', 1)[1]}").alias(c) for c in _SUMMARY],
        "unique_mitre_ids",
        "avg_similarity",
        "avg_severity",
    )
    return rounded(back, ["retrieval_rate", *_SUMMARY, "avg_similarity", "avg_severity"])


@query("a17_technique_coverage", "retrieved", "SELECT DISTINCT mitre_id FROM retrieved WHERE mitre_id IS NOT NULL")
def _(spark, sf):
    return retrieval.technique_coverage(retrieved(spark, sf))


@query(
    "a18_retrieval_diagnostic",
    "sims",
    """, top AS (SELECT 'all' AS records, query_id, similarity, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC) AS r FROM sims
  UNION ALL SELECT 'severe', query_id, similarity, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC) FROM sims
    WHERE coalesce(severity_score, 0) >= 7)
SELECT records, threshold, count_if(similarity >= threshold AND r <= 5) AS hits,
  round(count_if(similarity >= threshold AND r <= 5) / (SELECT CAST(count(*) AS DOUBLE) FROM embeddings), 6) AS mean_hits
FROM top, (VALUES (0.1e0), (0.2e0), (0.25e0), (0.3e0), (0.35e0)) t(threshold) GROUP BY 1, 2""",
)
def _(spark, sf):
    out = retrieval.retrieval_diagnostic(
        inputs.query_vectors(spark, sf), corpus(spark, sf), [0.1, 0.2, 0.25, 0.3, 0.35]
    )
    return rounded(out, ["mean_hits"])


@query(
    "x16_round_similarity",
    "retrieved",
    "SELECT query_id, cve_id AS id, round(similarity, 4) AS similarity_score FROM retrieved",
)
def _(spark, sf):
    return retrieval.round_similarity(retrieved(spark, sf)).select("query_id", "id", "similarity_score")


# --- encoding ---------------------------------------------------------------------------------------


def hashed_sql(name: str, source: str, id: str, text: str, slots: int, fitted: str = "", unit: str = "DOUBLE") -> str:
    """CTEs of texts hashed by word: ``{name}_h`` (id, slot, n) and the unit vectors' entries ``{name}_u`` (id, slot, v).

    Document frequencies are those of ``fitted``, another such name whose CTEs came before, or of the texts themselves.
    """
    of = fitted or name
    rows = f"{name}_f AS (SELECT slot, ln(((SELECT count(*) FROM {source}) + 1) / (count(*) + 1e0)) AS idf FROM {name}_h GROUP BY slot)," \
           f" {name}_n AS (SELECT ln((SELECT count(*) FROM {source}) + 1e0) AS idf)," if not fitted else ""
    return f"""{name}_h AS (SELECT id, CAST('0x' || md5(w)[1:8] AS BIGINT) % {slots} AS slot, count(*) AS n FROM (
  SELECT {id} AS id, unnest(regexp_split_to_array(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}]+')) AS w FROM {source})
  WHERE w <> '' GROUP BY ALL), {rows}
{name}_w AS (SELECT id, h.slot, h.n * coalesce(f.idf, (SELECT idf FROM {of}_n)) AS w FROM {name}_h h LEFT JOIN {of}_f f ON f.slot = h.slot),
{name}_u AS (SELECT id, slot, CAST(CAST(w / sqrt(list_sum(list(w * w ORDER BY slot) OVER (PARTITION BY id))) AS {unit}) AS DOUBLE) AS v
  FROM {name}_w WHERE w > 0)"""


def dense_sql(name: str, slots: int) -> str:
    """CTE ``{name}_v`` (id, vec) of the entries as whole lists, without zero vectors."""
    return f"""{name}_v AS (SELECT k.id, list(coalesce(u.v, 0e0) ORDER BY r.range) AS vec FROM (SELECT DISTINCT id FROM {name}_u) k
  CROSS JOIN range({slots}) r LEFT JOIN {name}_u u ON u.id = k.id AND u.slot = r.range GROUP BY k.id)"""


@query(
    "m7_embed_texts",
    "",
    "WITH " + hashed_sql("d", "documents", "doc_id", "text", 384, unit="FLOAT")
    + " SELECT id AS doc_id, CAST(384 AS INTEGER) AS dimension, slot, round(v, 6) AS value FROM d_u",
)
def _(spark, sf):
    """Every number of every vector that is not 0."""
    docs = inputs.table(spark, sf, "documents").select("doc_id", "text")
    dense = HashedTextEncoder().fit_encode(docs).select("doc_id", F.size("values").alias("dimension"), F.posexplode("values").alias("slot", "value"))
    return rounded(dense.where("value <> 0").withColumn("value", F.col("value").cast("double")).withColumn("slot", F.col("slot").cast("long")), ["value"])


@query(
    "s17_changed_texts",
    "",
    "WITH " + hashed_sql("d", "documents", "doc_id", "text", 128, unit="FLOAT")
    + " SELECT id AS doc_id, slot, round(CASE WHEN id % 3 = 1 THEN -v ELSE v END, 6) + 0e0 AS value FROM d_u",
)
def _(spark, sf):
    """A third has the vector of another text, a third one of its own text (negated, so that its reuse shows), a third none."""
    docs = inputs.table(spark, sf, "documents").select("doc_id", "text")
    encoder = HashedTextEncoder(128).fit(docs)
    turn = F.pmod("doc_id", F.lit(3))
    before = docs.where(turn < 2).withColumn("text", F.when(turn == 0, F.concat_ws(" ", F.lit("before"), "text")).otherwise(F.col("text")))
    stored = encoder(before).select("doc_id", F.transform("values", lambda v: -v).alias("values"), text_hash(F.col("text")).alias("text_hash"))
    out = embed_missing(docs, materialize(stored), "doc_id", lambda df: encoder(df).select("doc_id", "values"), "text")
    dense = out.select("doc_id", F.posexplode("values").alias("slot", "value")).where("value <> 0")
    return rounded(dense.withColumn("value", F.col("value").cast("double")).withColumn("slot", F.col("slot").cast("long")), ["value"])


@query(
    "m7_sparse_texts",
    "",
    "WITH " + hashed_sql("d", "documents", "doc_id", "text", SLOTS) + " SELECT id AS doc_id, slot, round(v, 6) AS value FROM d_u",
)
def _(spark, sf):
    docs = inputs.table(spark, sf, "documents")
    terms = SparseTextEncoder().fit(docs)(docs, "doc_id").select("doc_id", F.inline("terms"))
    return rounded(terms.withColumnRenamed("weight", "value"), ["value"])


@query(
    "m7_embed_plugged",
    "",
    """SELECT doc_id, CASE WHEN (length(text) - length(replace(text, 'e', ''))) % 2 = 0 THEN 0.6e0 ELSE 0.8e0 END AS v0,
  CASE WHEN (length(text) - length(replace(text, 'e', ''))) % 2 = 0 THEN 0.8e0 ELSE 0.6e0 END AS v1 FROM documents""",
)
def _(spark, sf):
    """A plugged-in model that looks at the whole text; its vectors come back with unit length."""

    def model():
        return lambda texts: [[3, 4] if t.count("e") % 2 == 0 else [4, 3] for t in texts]

    out = embed(inputs.table(spark, sf, "documents").select("doc_id", "text"), "text", model, dim=2)
    v = F.col("values").cast("array<double>")
    return rounded(out.select("doc_id", v[0].alias("v0"), v[1].alias("v1")), ["v0", "v1"], 4)


# --- text in, records out ---------------------------------------------------------------------------

_HELD = hashed_sql("c", "cves", "cve_id", "description", 128, unit="FLOAT")
_TURN = "concat(conv_id, '-', turn)"


def turns(spark, sf):
    return inputs.table(spark, sf, "conversations").selectExpr(f"{_TURN} AS query_id", "text")


def encoded_corpus(spark, sf):
    """CVE records with vectors of their descriptions, and the encoder that made them."""
    encoder = HashedTextEncoder(128)
    vectors = encoder.fit_encode(corpus(spark, sf).drop("values"), "description")
    return materialize(vectors), encoder


_FOUND = """, found AS (SELECT query_id, cve_id, similarity, matched_mitre_id, coalesce(year, 2026) AS year, severity_score,
    coalesce(description, '') AS description, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, cve_id) AS rank
  FROM met JOIN (SELECT * REPLACE (coalesce(severity_score, 0) AS severity_score) FROM cves) USING (cve_id)
  WHERE similarity >= 0.2 AND severity_score >= 1)
SELECT query_id, rank, cve_id, matched_mitre_id, year, severity_score, description, round(similarity, 4) AS similarity_score FROM found WHERE rank <= 10"""


@query(
    "j5_query_cve_by_text",
    "cves",
    f", {_HELD}, {dense_sql('c', 128)}, {hashed_sql('t', 'conversations', _TURN, 'text', 128, 'c', 'FLOAT')}, {dense_sql('t', 128)}"
    ", met AS (SELECT t_v.id AS query_id, c_v.id AS cve_id, round(list_cosine_similarity(t_v.vec, c_v.vec), 12) AS similarity FROM t_v, c_v)" + _FOUND,
)
def _(spark, sf):
    records, encoder = encoded_corpus(spark, sf)
    return retrieval.query_cve_by_text(turns(spark, sf), records, encoder, min_severity=1.0, threshold=0.2)


@query(
    "j5_search_texts",
    "cves",
    f", {hashed_sql('c', 'cves', 'cve_id', 'description', SLOTS)}, {hashed_sql('t', 'conversations', _TURN, 'text', SLOTS, 'c')}"
    """, met AS (SELECT t.id AS query_id, c.id AS cve_id, round(list_sum(list(t.v * c.v ORDER BY t.slot)), 12) AS similarity
  FROM t_u t JOIN c_u c ON t.slot = c.slot GROUP BY ALL)""" + _FOUND,
)
def _(spark, sf):
    """The same question by shared words alone."""
    return retrieval.search_texts(turns(spark, sf), corpus(spark, sf).drop("values"), min_severity=1.0, threshold=0.2)


@query(
    "j6_query_mitre_for_cve",
    "cves",
    f", {_HELD}, {dense_sql('c', 128)}, known AS ({_TECHNIQUES_SQL}), {hashed_sql('k', 'known', 'mitre_id', 'full_text', 128, 'c', 'FLOAT')}, {dense_sql('k', 128)}"
    """, met AS (SELECT c_v.id AS query_id, k_v.id AS mitre_id, round(list_cosine_similarity(c_v.vec, k_v.vec), 12) AS similarity FROM c_v, k_v)
SELECT query_id, rank, mitre_id, name, description, round(similarity, 4) AS similarity_score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, mitre_id) AS rank FROM met JOIN known USING (mitre_id) WHERE similarity >= 0.2)
WHERE rank <= 5""",
)
def _(spark, sf):
    records, encoder = encoded_corpus(spark, sf)
    found = encoder(knowledge.extract_techniques(bundle_objects(spark, sf)), "full_text")
    queries = records.select(F.col("cve_id").alias("query_id"), F.col("description").alias("text"))
    return retrieval.query_mitre_for_cve(queries, found.drop("full_text"), encoder, threshold=0.2)


@query(
    "j7_explain_edges",
    "edges scored cves",
    f""", asked AS (SELECT q.edge_idx, q.text FROM ({ORACLES['x9_query_text_2']}) q JOIN scored USING (edge_idx) WHERE score >= 0.5),
texts AS (SELECT DISTINCT text FROM asked), {_HELD}, {dense_sql('c', 128)}, {hashed_sql('t', 'texts', 'text', 'text', 128, 'c', 'FLOAT')}, {dense_sql('t', 128)}"""
    """, hits AS (SELECT text, least(count(*), 5) AS n FROM (
  SELECT t_v.id AS text, round(list_cosine_similarity(t_v.vec, c_v.vec), 12) AS similarity FROM t_v, c_v JOIN cves ON cve_id = c_v.id WHERE severity_score >= 7)
  WHERE similarity >= 0.05 GROUP BY text)
SELECT edge_idx, CASE WHEN score >= 0.5 THEN 'ATTACK' ELSE 'NORMAL' END AS prediction, CAST(coalesce(n, 0) AS INTEGER) AS n_hits,
  CASE WHEN score >= 0.5 AND n > 0 THEN CASE WHEN score > 0.8 THEN 'HIGH' ELSE 'MEDIUM' END ELSE 'LOW' END AS threat_level
FROM edges JOIN scored USING (edge_idx) LEFT JOIN asked USING (edge_idx) LEFT JOIN hits USING (text)""",
)
def _(spark, sf):
    records, encoder = encoded_corpus(spark, sf)
    out = batch.explain_edges(scored_edges(spark, sf).drop("score"), records, encoder, min_similarity=0.05)
    return out.select("edge_idx", "prediction", "n_hits", "threat_level")


@query(
    "a16_evaluate_retrieval",
    "edges scored cves",
    f""", sampled AS (SELECT edge_idx FROM edges WHERE y = 1 AND mask = 'test' ORDER BY md5(concat_ws('|', '{SEED}', edge_idx)), edge_idx LIMIT 100),
asked AS (SELECT q.edge_idx, q.text, score FROM ({ORACLES['x9_query_text_2']}) q JOIN scored USING (edge_idx) JOIN sampled USING (edge_idx)
  WHERE score >= 0.5), texts AS (SELECT DISTINCT text FROM asked),
{_HELD}, {dense_sql('c', 128)}, {hashed_sql('t', 'texts', 'text', 'text', 128, 'c', 'FLOAT')}, {dense_sql('t', 128)}"""
    """, hits AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY similarity DESC, cve_id) AS rank FROM (
  SELECT t_v.id AS text, cve_id, matched_mitre_id AS mitre_id, severity_score AS severity, coalesce(year, 2026) AS year,
    round(list_cosine_similarity(t_v.vec, c_v.vec), 12) AS similarity FROM t_v, c_v JOIN cves ON cve_id = c_v.id WHERE severity_score >= 7)
  WHERE similarity >= 0.05),
retrieved AS (SELECT edge_idx AS query_id, score, hits.* FROM asked JOIN hits USING (text) WHERE rank <= 5)"""
    + _SUMMARY_SQL.replace("FROM embeddings", "FROM sampled")
    .replace("FROM triad", ", (SELECT string_agg(DISTINCT mitre_id, ' ' ORDER BY mitre_id) FROM retrieved) AS techniques FROM triad"),
)
def _(spark, sf):
    """Sampled, explained, rated and exported; the measures are read back from the export."""
    records, encoder = encoded_corpus(spark, sf)
    path = new_path(spark, "evaluation")
    batch.evaluate_retrieval(scored_edges(spark, sf).drop("score"), records, encoder, path, top_similarity=0.35, min_similarity=0.05)
    back = spark.read.json(path).select(
        "retrieval_rate",
        *[F.col(f"{c.rsplit('_', 1)[0]}.{c.rsplit('_', 1)[1]}").alias(c) for c in _SUMMARY],
        "unique_mitre_ids", "avg_similarity", "avg_severity", F.array_join("techniques", " ").alias("techniques"),
    )
    return rounded(back, ["retrieval_rate", *_SUMMARY, "avg_similarity", "avg_severity"])
