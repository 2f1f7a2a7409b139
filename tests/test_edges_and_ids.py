"""Scores that are no number, edges without vectors, repeated ids, techniques outside the rules, repeated query texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowgraph.functions import rules
from flowgraph.operators import attention, evaluation, graph, report, retrieval
from flowgraph.plans import batch
from flowgraph.sources.vector_store import upsert


def test_a_score_that_is_no_number_is_no_hit(spark):
    scored = spark.createDataFrame([(0, float("nan")), (1, float("nan")), (1, 0.9), (0, 0.1)], "y int, score double")
    assert evaluation.confusion(scored).first().asDict() == {"tn": 2, "fp": 0, "fn": 1, "tp": 1}
    line = evaluation.threshold_sweep(scored, [0.5]).first()
    assert (line["recall"], line["precision"], line["fp_rate"]) == (0.5, 1.0, 0.0)
    assert scored.select(rules.prediction(F.col("score")).alias("p")).filter("p = 'ATTACK'").count() == 1


def test_edges_without_node_vectors_fail_with_their_number(spark):
    edges = spark.createDataFrame([(0, 1, 2, [0.5]), (1, 1, 9, [0.5]), (2, 8, 9, [0.5])], "edge_idx int, src int, dst int, attr array<double>")
    nodes = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "node_id int, x array<double>")
    with pytest.raises(ValueError, match="2 node"):
        graph.edge_inputs(edges, nodes)
    assert graph.edge_inputs(edges.limit(1), nodes).first()["features"] == [1.0, 2.0, 0.5]


def test_records_that_share_an_id_are_hits_of_their_own(spark):
    cves = spark.createDataFrame(
        [("A", [1.0, 0.0], "T1", 2020, 9.0, "one"), ("A", [0.9, 0.1], "T1", 2020, 8.0, "two"), ("B", [0.0, 1.0], "T2", 2020, 9.0, "other")],
        "cve_id string, values array<double>, matched_mitre_id string, year int, severity_score double, description string",
    )
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, query_vec array<double>")
    found = retrieval.search_cves(queries, cves, 2, threshold=0.5).orderBy("rank").collect()
    assert [(r["rank"], r["cve_id"], r["description"]) for r in found] == [(1, "A", "one"), (2, "A", "two")]
    techniques = cves.selectExpr("cve_id AS mitre_id", "values", "description AS name")
    found = retrieval.search_techniques(queries, techniques, 2, 0.5).orderBy("rank").collect()
    assert [(r["rank"], r["mitre_id"], r["name"]) for r in found] == [(1, "A", "one"), (2, "A", "two")]


def test_related_records_of_any_technique(spark):
    cves = spark.createDataFrame([("A", "T1059", 9.0, 2020), ("B", "T1059", 9.5, 2020), ("C", None, 9.9, 2020)], "cve_id string, matched_mitre_id string, severity_score double, year int")
    assigned = spark.createDataFrame([(0, "T1059"), (1, "T0"), (2, None)], "edge_idx int, mitre_id string")
    found = {r["edge_idx"]: r["cve_ids"] for r in report.related_cves(assigned, cves).collect()}
    assert found == {0: ["B", "A"], 1: [], 2: []}


def test_only_distinct_texts_of_attacks_are_encoded(spark):
    attr = [1.0, 5.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0]
    scored = spark.createDataFrame([(i, 1, 2, attr, 1, 5.0 if i % 2 else -5.0) for i in range(400)], "edge_idx int, src int, dst int, attr array<double>, y int, logit double")
    corpus = spark.createDataFrame([("A", [1.0, 0.0], 9.5)], "cve_id string, values array<double>, severity_score double")
    encoded = []

    def encode(df):
        encoded.append(df.count())
        return df.withColumn("values", F.array(F.lit(1.0), F.lit(0.0)))

    found = batch.explain_edges(scored, corpus, encode).collect()
    texts = scored.filter("logit > 0").select(rules.query_text_2(F.col("edge_idx"), F.col("attr"))).distinct().count()
    assert encoded == [texts] and texts < 200 and len(found) == 400
    assert all((r["n_hits"] == 1) == (r["prediction"] == "ATTACK") for r in found)


def test_upsert_leaves_the_base_in_place(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id AS v").write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))
    updates = spark.createDataFrame([(5, -1, 1), (5, -2, 2), (2000, 7, 1)], "id long, v long, at int")
    out = upsert(base.withColumn("at", F.lit(0)), updates, "id", "at")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan
    rows = {r["id"]: r["v"] for r in out.collect()}
    assert len(rows) == 1001 and rows[5] == -2 and rows[2000] == 7 and rows[6] == 6


# --- scoring from a table of weights -----------------------------------------------------------


def test_network_survives_its_table_and_scores_the_same(spark, tmp_path):
    rng = np.random.default_rng(5)

    def layer(heads, units, inputs, **more):
        weights = attention.AttentionWeights(rng.normal(size=(inputs, heads * units)), rng.normal(size=(heads, units)), rng.normal(size=(heads, units)), **more)
        norm = {"mean": rng.normal(size=heads * units), "var": np.ones(heads * units), "weight": np.ones(heads * units), "bias": np.zeros(heads * units)}
        return {"attention": weights, "norm": norm}

    layers = [layer(2, 3, 4, bias=rng.normal(size=6)), layer(1, 2, 6) | {"concat": False}]
    classifier = {"w1": rng.normal(size=(6, 3)), "b1": rng.normal(size=3), "w2": rng.normal(size=(3, 1)), "b2": [0.2]}
    attention.network_table(spark, layers, classifier).write.parquet(str(tmp_path / "weights"))
    table = spark.read.parquet(str(tmp_path / "weights"))
    back, same = attention.load_network(table)
    assert [x["concat"] for x in back] == [True, False] and back[0]["attention"].heads == 2 and back[1]["attention"].bias is None
    assert np.array_equal(same["b1"], classifier["b1"]) and np.array_equal(same["w2"], classifier["w2"])

    nodes = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(6)], "node_id long, x array<double>")
    rows = [(i, i % 6, (i * 5 + 1) % 6, rng.random(8).tolist()[:2] + [0.0] * 6, i % 2, "test" if i % 5 == 4 else "train") for i in range(20)]
    edges = spark.createDataFrame(rows, "edge_idx long, src long, dst long, attr array<double>, y int, mask string")
    classifier["w1"] = rng.normal(size=(12, 3))
    cves = spark.createDataFrame([], "cve_id string, matched_mitre_id string, severity_score double, year int")
    weights = attention.network_table(spark, layers, classifier)
    want = {r["edge_idx"]: 1 / (1 + np.exp(-r["logit"])) for r in attention.score_graph(edges, nodes, layers, classifier).collect()}

    out = batch.score_and_analyze(edges, nodes, weights, cves, str(tmp_path / "records")).collect()
    assert {r["edge_idx"]: pytest.approx(r["score"]) for r in out} == want
    judged = [(y, want[i]) for i, _, _, _, y, mask in rows if mask == "test"]

    def f1(t):
        tp = sum(y == 1 and s >= t for y, s in judged)
        return 2 * tp / max(1, sum(y == 1 for y, _ in judged) + sum(s >= t for _, s in judged))

    best = max((f1(t), t) for t in (0.3, 0.4, 0.5, 0.6, 0.7))
    assert {r["threshold"] for r in out} == {best[1] if best[0] > 0 else 0.5}
    assert all((r["prediction"] == "ATTACK") == (r["score"] >= r["threshold"]) for r in out)
    assert spark.read.json(str(tmp_path / "records")).count() == 20
    given = batch.score_and_analyze(edges, nodes, weights, cves, threshold=0.0).collect()
    assert {r["prediction"] for r in given} == {"ATTACK"}
    with pytest.raises(ValueError):
        attention.load_network(weights.where("layer <> 'classifier'"))
