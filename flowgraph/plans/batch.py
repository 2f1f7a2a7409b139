"""The entries: flows to graph tables, texts to a vector store, edges to scores and analysis records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flowgraph.functions.normalize import clean_cves, load_normalize
from flowgraph.functions.rules import prediction as rules_prediction
from flowgraph.functions.rules import query_text_2, sigmoid
from flowgraph.operators import attention, evaluation, graph, quality, report, retrieval, staging
from flowgraph.operators.embedding import embed_missing
from flowgraph.schemas import DECISION_THRESHOLD, SHARDS, SORT_KEYS
from flowgraph.session import Scratch, delete_path, materialize, new_path
from flowgraph.sources import bucket_store, knowledge, pair_store
from flowgraph.sources import files as file_source
from flowgraph.sources import sinks, vector_store


@dataclass
class GraphTables:
    staged: DataFrame
    clean: DataFrame
    pairs: DataFrame
    node_map: DataFrame
    super_edges: DataFrame
    gnn_ready: DataFrame


def graph_tables(raw: DataFrame) -> GraphTables:
    """Raw flows to the five models.

    Staging and features stay lazy and are read once, by the pair aggregation; node ids and
    edges are derived from its small result.
    """
    staged = staging.stage_flows(raw)
    clean = staging.clean_features(staged)
    pairs = materialize(graph.pair_stats(clean))
    node_map = graph.node_mapping(pairs)
    edges = graph.super_edges(pairs, node_map)
    gnn = graph.split_mask(edges)
    return GraphTables(staged, clean, pairs, node_map, gnn.drop("split_mask"), gnn)


def flows_to_graph(
    spark: SparkSession,
    root: str,
    database: str = "default",
    cap: int | None = None,
    require_ack: bool = False,
    null_text: str | None = None,
    expected_nodes: int | None = None,
) -> DataFrame:
    """Period files to published tables; returns the run summary with the counts of files found and used.

    All files are read unless ``cap`` asks for the first so many; ``truncated`` then says whether that left any out.
    The declared checks run on the new tables before any of the marts is switched, and a failing one stops the run.
    """
    found = file_source.list_files(spark, root)
    n_found = found.count()
    chosen, truncated = file_source.cap_files(found, cap, require_ack) if cap is not None else (found, False)
    n_used = min(n_found, cap) if truncated else n_found
    united = file_source.read_periods(spark, chosen, SHARDS)
    shards = sinks.write_shards(united, new_path(spark, "shards"))
    raw = load_normalize(spark.read.parquet(shards).drop("shard"), null_text)
    raw = sinks.publish(raw, f"{database}.network_logs", SORT_KEYS)
    delete_path(spark, shards)
    quality.require_columns(raw)

    counted = publish_models(raw, database)
    if expected_nodes is not None:
        quality.expect_count(counted["nodes"], expected_nodes, "nodes", skip_if=truncated)
    return quality.summary_of(spark, counted).select(
        "*", F.lit(n_found).cast("long").alias("files_found"), F.lit(n_used).cast("long").alias("files_used"), F.lit(truncated).alias("truncated")
    )


def publish_models(raw: DataFrame, database: str) -> dict[str, int]:
    """The marts of ``raw``, published together, and their counts; the flows are read once.

    Every model's new version is written with its checks and counts observed on the way; only when all checks hold are the
    tables switched to them, else the new versions are deleted and the old ones stay.
    """
    spark = raw.sparkSession
    loaded = Observation()
    staged = quality.Watch("stg_network_logs")
    clean_watch = quality.Watch("int_network_clean")
    counted = raw.observe(loaded, F.count(F.lit(1)).alias("rows"))
    clean = clean_watch.on(staging.clean_features(staged.on(staging.stage_flows(counted))))
    path = sinks.write_version(clean, f"{database}.int_network_clean")
    counts = _publish_edges(graph.pair_stats(spark.read.parquet(path)), database, {"int_network_clean": path}, [staged, clean_watch])
    return {"raw_rows": loaded.get["rows"], **counts}


def update_graph(spark: SparkSession, root: str, store: str, database: str = "default", null_text: str | None = None) -> DataFrame:
    """Period files to the three marts by way of a ``pair_store``, and the run summary; only new or changed periods are opened.

    Periods whose files are as they were keep their states, and those whose files are gone count no more.  The declared checks
    of the marts run as in :func:`publish_models`; those of single flows are not part of this way.
    """
    update_pair_states(spark, root, store, null_text)
    counts = _publish_edges(graph.merged_pairs(pair_store.states(spark, store)), database, {}, [])
    rows = pair_store.manifest(spark, store).agg(F.sum("rows")).first()[0]
    return quality.summary_of(spark, {"raw_rows": rows, **counts})


def update_pair_states(spark: SparkSession, root: str, store: str, null_text: str | None = None) -> int:
    """Bring a ``pair_store`` up to date with the period files below ``root``; returns the number of periods computed."""
    scratch = Scratch(spark)
    pair_store.create(spark, store)
    folder = F.element_at(F.split("path", "/"), -2)
    found = scratch.write(file_source.list_files(spark, root, times=True).withColumn("period", folder), "found")
    now = scratch.write(pair_store.listed(found), "now")
    chosen = scratch.write(found.join(pair_store.changed(now, pair_store.manifest(spark, store)), "period"), "chosen")
    probed = file_source.probe_footers(chosen).withColumn("period", folder)
    rows = scratch.write(probed.groupBy("period").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")), "rows")
    n = rows.count()
    states = None
    if n:
        raw = load_normalize(file_source.read_periods(spark, chosen.select("path", "size"), None), null_text)
        staged = staging.stage_flows(raw).withColumnRenamed("source_period", "period")
        states = graph.pair_states(staging.clean_features(staged, keep=["period"]))
    pair_store.put(spark, store, now, rows, states)
    scratch.drop_all()
    return n


def _publish_edges(pairs: DataFrame, database: str, paths: dict[str, str], watches: list[quality.Watch]) -> dict[str, int]:
    """Node map, edges and split of ``pairs``, published together with the versions already in ``paths`` if all checks hold."""
    spark, scratch = pairs.sparkSession, Scratch(pairs.sparkSession)
    names = {m: f"{database}.{m}" for m in (*paths, "mart_node_mapping", "mart_super_edges", "mart_gnn_ready")}
    before = len(watches)
    try:
        pairs = scratch.write(pairs, "pairs")
        node_map = scratch.write(graph.node_mapping(pairs), "nodes")
        gnn = scratch.write(graph.split_mask(graph.super_edges(pairs, node_map)), "edges")
        models = {"mart_node_mapping": (node_map, ["node_id"]), "mart_super_edges": (gnn.drop("split_mask"), ["source_idx", "target_idx"]),
                  "mart_gnn_ready": (gnn, ["source_idx", "target_idx"])}
        for model, (df, keys) in models.items():
            watch = quality.Watch(model, {"train": "split_mask = 'train'", "test": "split_mask = 'test'"} if model == "mart_gnn_ready" else {})
            paths[model] = sinks.write_version(df, names[model], keys, watch)
            watches = [*watches, watch]
        repeated = quality.model_checks({"mart_node_mapping": node_map}, ("unique",))
        quality.require_lines([line for watch in watches for line in watch.lines()] + repeated.collect())
    except BaseException:
        for path in paths.values():
            delete_path(spark, path)
        raise
    finally:
        scratch.drop_all()
    for model, path in paths.items():
        sinks.switch(spark, names[model], path)
    gnn_counts = watches[-1].counts()
    return {"nodes": watches[before].counts()["rows"], "edges": gnn_counts["rows"], "train": gnn_counts["train"], "test": gnn_counts["test"]}

def refresh_techniques(spark: SparkSession, bundle_path: str, encode, store: str) -> DataFrame:
    """Technique bundle to vector records, the last one of each id, replacing the store."""
    records = knowledge.extract_techniques(knowledge.read_bundle(spark, bundle_path))
    unique = records.groupBy("mitre_id").agg(
        *[F.max_by(c, "position").alias(c) for c in ("name", "description", "full_text")]
    )
    sinks.replace_all(knowledge.technique_payload(encode(unique, "full_text")), store)
    return spark.read.parquet(store)


def ingest_cves(spark: SparkSession, csv_path: str, encode, store: str | None, target: str) -> DataFrame:
    """CVE files to vector records: clean, last row per id, encode what is new or changed, upsert, write ``target``."""
    numbered = knowledge.with_position(knowledge.read_cves(spark, csv_path), "__line")
    records = materialize(vector_store.last_per_key(clean_cves(numbered), "cve_id", "__line").drop("__line"), "cves")
    if store is None:
        merged = knowledge.cve_payload(encode(records, "description"))
    else:
        base = spark.read.parquet(store)
        stored = base.select(F.col("id").alias("cve_id"), "values", "text_hash")
        vectors = embed_missing(records, stored, "cve_id", lambda df: encode(df, "description"), "description")
        merged = vector_store.upsert(base, knowledge.cve_payload(records.join(vectors, "cve_id")), "id")
    sinks.replace_all(merged, target)
    return spark.read.parquet(target)


def update_cves(spark: SparkSession, csv_path: str, encode, store: str) -> int:
    """CVE files into a bucketed store, in place: only buckets with a new or changed record are read and written.

    Returns the number of buckets rewritten.  The store is that of ``bucket_store.create`` with the key ``id``.
    """
    scratch = Scratch(spark)
    numbered = knowledge.with_position(knowledge.read_cves(spark, csv_path), "__line")
    records = scratch.write(vector_store.last_per_key(clean_cves(numbered), "cve_id", "__line").drop("__line"), "cves")
    base = bucket_store.touched(spark, store, "id", records.select(F.col("cve_id").alias("id")))
    stored = base.select(F.col("id").alias("cve_id"), "values", "text_hash")
    vectors = embed_missing(records, stored, "cve_id", lambda df: encode(df, "description"), "description")
    payload = scratch.write(knowledge.cve_payload(records.join(vectors, "cve_id")), "payload")
    changed = payload.join(base.select(payload.columns), [payload[c].eqNullSafe(base[c]) for c in payload.columns], "left_anti")
    rewritten = bucket_store.upsert(spark, store, changed, "id")
    scratch.drop_all()
    return rewritten


def analyze(scored: DataFrame, cves: DataFrame, path: str | None = None, fmt: str = "json", **options) -> DataFrame:
    """Scored edges ``(…, logit)`` to analysis records, exported when ``path`` is given."""
    analysis = report.analyze_edges(scored.withColumn("score", sigmoid(F.col("logit"))), cves, **options)
    if path:
        sinks.export(report.export_records(analysis), path, fmt)
    return analysis


def score_and_analyze(
    edges: DataFrame, nodes: DataFrame, weights: DataFrame, cves: DataFrame, path: str | None = None, fmt: str = "json",
    threshold: float | None = None, held_out: str = "test", **options,
) -> DataFrame:
    """Edges, node vectors and a table of weights to analysis records, with the ``threshold`` they were decided by.

    The threshold is the one of the highest F1 among the edges whose mask is ``held_out``, unless one is given; without a
    single hit there it is the default.  Edges are scored once, and the written scores serve the choice and the records.
    """
    layers, classifier = attention.load_network(weights)
    scored = materialize(attention.score_graph(edges, nodes, layers, classifier), "scored")
    if threshold is None:
        judged = scored.where(F.col("mask") == held_out).select("y", sigmoid(F.col("logit")).alias("score"))
        threshold = evaluation.best_threshold(evaluation.threshold_sweep(judged)).first()["threshold"]
    return analyze(scored, cves, path, fmt, threshold=threshold, **options).withColumn("threshold", F.lit(float(threshold)))


def explain_edges(scored: DataFrame, corpus: DataFrame, encode, **options) -> DataFrame:
    """Hybrid inference over all scored edges: a query text for each attack, encoded, searched, rated.

    Query texts are built of few phrases, so each distinct text is encoded and searched once; the cost of both does not
    grow with the edges.
    """
    scored = scored.withColumn("score", sigmoid(F.col("logit")))
    attack = rules_prediction(F.col("score"), options.get("threshold", DECISION_THRESHOLD)) == "ATTACK"
    texts = scored.filter(attack).select("edge_idx", query_text_2(F.col("edge_idx"), F.col("attr")).alias("text"))
    encoded = materialize(encode(texts.select("text").distinct()).select("text", F.col("values").alias("query_vec")), "query-texts")
    return report.hybrid_inference(scored, texts, corpus, encoded, **options)


def evaluate_retrieval(
    scored: DataFrame, corpus: DataFrame, encode, path: str | None = None, n: int = 100, top_similarity: float = 0.7, **options
) -> DataFrame:
    """Retrieval quality in one row: a sample of attack edges explained, the measures of what was found, techniques covered.

    ``scored`` are edges with y, mask and logit; ``corpus`` has one record an id.  Up to ``n`` attack edges of the test mask are
    drawn; those that are not predicted as attacks find nothing and count as failures.  The row is exported as JSON when ``path``
    is given.  Without any attack edge all measures are 0.
    """
    scratch = Scratch(scored.sparkSession)
    sample = scratch.write(report.sample_attack_edges(scored, n), "sample")
    hits = explain_edges(sample, corpus, encode, **options).select(
        F.col("edge_idx").alias("query_id"), "score", F.explode("hits").alias("hit")
    )
    records = corpus.select("cve_id", F.col("matched_mitre_id").alias("mitre_id"), F.col("severity_score").alias("severity"), "year")
    found = hits.select("query_id", "score", "hit.cve_id", "hit.similarity").join(records, "cve_id")
    retrieved = scratch.write(found, "retrieved")
    summary = retrieval.triad_summary(sample.select(F.col("edge_idx").alias("query_id")), retrieved, top_similarity)
    covered = retrieval.technique_coverage(retrieved).agg(F.sort_array(F.collect_set("mitre_id")))
    out = materialize(summary.select("*", covered.scalar().alias("techniques")), "evaluation")
    scratch.drop_all()
    if path:
        sinks.export_summary(out, path)
    return out
