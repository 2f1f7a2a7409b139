"""Results under skew, the three search paths, and the shape of plans."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks import catalog_flows, inputs
from flowgraph.operators import attention, graph, numbering
from flowgraph.operators.joins import hot_keys, missing_from, salted_join, top_k_per_group
from flowgraph.operators.knn import knn
from flowgraph.sources.vector_store import upsert


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- numbering --------------------------------------------------------------------------------


def test_numbering_is_dense_over_many_partitions(spark):
    df = spark.range(0, 10_000, 1, 16).select((F.col("id") * 7919 % 10_007).alias("k"))
    got = numbering.global_row_number(df, ["k"], start=0, name="n").collect()
    assert [r["n"] for r in sorted(got, key=lambda r: r["k"])] == list(range(10_000))


def test_numbering_of_nothing(spark):
    assert numbering.global_row_number(spark.range(0), ["id"]).collect() == []


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 50), max_size=60, unique=True))
def test_running_sums(spark, keys):
    df = spark.createDataFrame([(k, k % 3) for k in keys], "k long, v long").repartition(4)
    got = {r["k"]: r["s"] for r in numbering.running_sums(df, [F.desc("k")], {"s": "v"}).collect()}
    assert got == {k: sum(j % 3 for j in keys if j >= k) for k in keys}


def test_numbering_plans_use_no_single_partition(spark, sf):
    gnn = graph.split_mask(graph.super_edges(*_pairs_and_ids(spark, sf)))
    assert "SinglePartition" not in plan(gnn)


def _pairs_and_ids(spark, sf):
    p = catalog_flows.pairs(spark, sf)
    return p, graph.node_mapping(p)


# --- plans --------------------------------------------------------------------------------------


def test_pair_aggregation_is_the_only_shuffle_of_flows_and_merges_first(spark, sf):
    text = plan(graph.pair_stats(catalog_flows.clean(spark, sf)))
    assert text.count("Exchange ") == 1 and "partial_count" in text
    assert "ReadSchema" in text and "l_shipdate" not in text.split("ReadSchema")[1]


def test_staging_is_a_projection(spark, sf):
    assert "Exchange" not in plan(catalog_flows.clean(spark, sf))


def test_metadata_filter_reaches_the_scan(spark, tmp_path):
    from flowgraph.operators.retrieval import metadata_filter

    rows = [("a", "T1", 5.0, 2020, [1.0])]
    spark.createDataFrame(rows, "cve_id string, matched_mitre_id string, severity_score double, year int, values array<double>").write.parquet(str(tmp_path / "c"))
    text = plan(metadata_filter(spark.read.parquet(str(tmp_path / "c")), 7.0, 2020, "T1").select("cve_id"))
    pushed = text.split("PushedFilters")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(severity_score,7.0)" in pushed and "EqualTo(year,2020)" in pushed
    assert "values" not in text.split("ReadSchema")[1]


def test_top_k_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    text = plan(top_k_per_group(df, "g", [F.desc("id")], 3))
    before_shuffle = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle


def test_no_cartesian_products(spark, sf):
    from checks import catalog

    for name in ("w3_split_mask", "a2_edge_features", "j4_knn", "j5_search_cves", "j6_search_techniques", "a16_triad_summary",
                 "a20_run_summary", "a21_dataset_summary", "a18_retrieval_diagnostic", "x14_analysis_record", "a7_threshold_sweep"):
        text = plan(catalog.QUERIES[name](spark, sf))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


# --- skew ---------------------------------------------------------------------------------------


def test_salted_join_equals_plain_join(spark):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    dim = spark.range(45).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert [tuple(r) for r in hot_keys(facts, "k", 500).collect()] == [(0, 3)]
    got = salted_join(facts, dim, "k", "id", hot_rows=500)
    want = facts.join(dim, "k")
    assert got.count() == want.count()
    assert got.select("id", "k", "v").exceptAll(want.select("id", "k", "v")).isEmpty()
    salts = salted_join(facts, dim, "k", "id", hot_rows=500, keep_salt=True).filter("k = 0").select("__salt").distinct().count()
    assert salts == 3


def test_softmax_with_a_hub(spark):
    rng = np.random.default_rng(0)
    rows = [(i, 0 if i % 3 == 0 else i % 17, float(rng.normal() * 300)) for i in range(900)]
    edges = spark.createDataFrame(rows, "edge_idx long, dst long, logit double")
    got = {r["edge_idx"]: r["alpha"] for r in attention.edge_softmax(edges, hot_rows=50).collect()}
    by_dst = {}
    for i, d, l in rows:
        by_dst.setdefault(d, []).append((i, l))
    for group in by_dst.values():
        top = max(l for _, l in group)
        total = sum(np.exp(l - top) for _, l in group)
        for i, l in group:
            assert got[i] == pytest.approx(np.exp(l - top) / total, abs=1e-12)


def test_anti_join_and_upsert_with_many_copies(spark):
    new = spark.range(1000).select((F.col("id") % 4).alias("k"))
    old = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(2).alias("k"))
    assert sorted({r["k"] for r in missing_from(new, old, "k").collect()}) == [0, 3]
    base = spark.createDataFrame([("a", 1, 0), ("b", 1, 1)], "id string, v int, pos int")
    updates = spark.range(500).select(F.lit("a").alias("id"), F.col("id").cast("int").alias("v"), F.col("id").cast("int").alias("pos"))
    got = {r["id"]: r["v"] for r in upsert(base, updates, "id", "pos").collect()}
    assert got == {"a": 499, "b": 1}


# --- search -------------------------------------------------------------------------------------


def brute(queries, corpus, k, floor):
    out = set()
    for qid, q in queries:
        sims = []
        for cid, c in corpus:
            n = np.linalg.norm(q) * np.linalg.norm(c)
            sims.append((-round(float(np.dot(q, c) / n) if n else 0.0, 12), cid))
        sims.sort()
        for rank, (s, cid) in enumerate([x for x in sims if floor is None or -x[0] >= floor][:k], 1):
            out.add((qid, cid, round(-s, 9), rank))
    return out


def vectors(seed, n, copies=0, zero=True):
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=6) for _ in range(n)] + [np.arange(1.0, 7.0)] * copies + ([np.zeros(6)] if zero else [])
    return rows


@pytest.mark.parametrize("floor", [None, 0.0, 0.3, 0.9])
@pytest.mark.parametrize("path", ["small corpus", "small queries", "sampled bounds", "blocks", "rotation"])
def test_search_paths_equal_brute_force(spark, path, floor):
    queries = [(i, v) for i, v in enumerate(vectors(1, 30))] + [(99, np.arange(1.0, 7.0))]
    # A third of the corpus are copies of one vector.
    corpus = [(f"c{i:03d}", v) for i, v in enumerate(vectors(2, 120, copies=60))]
    q = spark.createDataFrame([(i, v.tolist()) for i, v in queries], "query_id long, query_vec array<double>").repartition(3)
    c = spark.createDataFrame([(i, v.tolist()) for i, v in corpus], "id string, values array<double>").repartition(4)
    options = {
        "small corpus": {},
        "small queries": {"broadcast_rows": 50},
        "sampled bounds": {"broadcast_rows": 50, "sampled_from": 1},
        "blocks": {"broadcast_rows": 5, "block_rows": 16, "pivots": 5, "rotate": False},
        "rotation": {"broadcast_rows": 5, "block_rows": 16, "pivots": 5, "rotate": True},
    }[path]
    got = {(r["query_id"], r["id"], round(r["similarity"], 9), r["rank"]) for r in knn(q, c, 4, floor, **options).collect()}
    assert got == brute(queries, corpus, 4, floor)


def test_search_in_an_empty_corpus(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, query_vec array<double>")
    empty = spark.createDataFrame([], "id string, values array<double>")
    assert knn(q, empty, 3).collect() == []
    assert knn(empty.selectExpr("id AS query_id", "values AS query_vec"), q.selectExpr("query_id AS id", "query_vec AS values"), 3).collect() == []


def test_block_search_prunes(spark):
    """Far-apart clusters: with a high threshold a query block is not sent to the other clusters."""
    rng = np.random.default_rng(3)
    rows = [(i, (np.eye(8)[i % 4] * 10 + rng.normal(size=8) * 0.1).tolist()) for i in range(400)]
    c = spark.createDataFrame(rows, "id long, values array<double>")
    q = c.selectExpr("id AS query_id", "values AS query_vec")
    got = knn(q, c, 2, 0.9, broadcast_rows=10, block_rows=1000, pivots=16)
    want = knn(q, c, 2, 0.9)
    assert got.select("query_id", "id", "rank").exceptAll(want.select("query_id", "id", "rank")).isEmpty()
    assert got.count() == want.count() == 800


@pytest.mark.parametrize("floor", [None, 0.9])
def test_block_search_copies_few_queries(spark, monkeypatch, floor):
    """The k-th best hit nearby bounds the reach, with a threshold and without one."""
    from flowgraph.operators import knn as module

    rng = np.random.default_rng(4)
    rows = [(i, (np.eye(8)[i % 8] * 10 + rng.normal(size=8) * 0.2).tolist()) for i in range(800)]
    c = spark.createDataFrame(rows, "id long, values array<double>")
    q = c.selectExpr("id AS query_id", "values AS query_vec")
    routed, kept = [], module.materialize

    def counting(df, name="step"):
        out = kept(df, name)
        if name == "routed":
            routed.append(out.selectExpr("sum(size(blocks)) AS n", "max(array_max(blocks)) + 1 AS blocks").first())
        return out

    monkeypatch.setattr(module, "materialize", counting)
    got = knn(q, c, 2, floor, broadcast_rows=10, block_rows=40, pivots=16)
    want = knn(q, c, 2, floor)
    assert got.select("query_id", "id", "rank").exceptAll(want.select("query_id", "id", "rank")).isEmpty() and got.count() == 1600
    assert routed[0]["n"] == 800 and routed[1]["n"] < 800 * routed[1]["blocks"] / 3


def _searches_of_random_vectors(spark, monkeypatch, n, **options):
    """(rows of the routes written, hits that tasks sent on) of a search where angles rule nothing out."""
    from flowgraph.operators import knn as module

    rng = np.random.default_rng(n)
    c = spark.createDataFrame([(i, rng.normal(size=64).tolist()) for i in range(n)], "id long, values array<double>").repartition(4)
    q = spark.createDataFrame([(i, rng.normal(size=64).tolist()) for i in range(120)], "query_id long, query_vec array<double>")
    routed, kept, turns, rotation = [], module.materialize, [], module._rotation

    def counting(df, name="step"):
        out = kept(df, name)
        if name == "routed":
            routed.append(out.selectExpr("sum(size(blocks)) AS n").first()["n"])
        return out

    def turning(*args):
        turns.append(args[-1])
        return rotation(*args)

    monkeypatch.setattr(module, "materialize", counting)
    monkeypatch.setattr(module, "_rotation", turning)
    got = module.knn(q, c, 3, broadcast_rows=60, block_rows=20, pivots=8, **options)
    want = module.knn(q, c, 3)
    assert got.select("query_id", "id", "rank").exceptAll(want.select("query_id", "id", "rank")).isEmpty() and got.count() == 360
    monkeypatch.undo()
    return routed, turns


def test_random_vectors_are_searched_in_turns_without_copies(spark, monkeypatch):
    """In 64 dimensions rings prune nothing: queries take turns, and their copies do not grow with the corpus."""
    copies = {}
    for n in (300, 1200):
        routed, turns = _searches_of_random_vectors(spark, monkeypatch, n, rotate=True)
        copies[n] = sum(routed)
        assert turns == [2]
    assert copies[300] == copies[1200] == 120  # the one ring that bounds each query
    routed, turns = _searches_of_random_vectors(spark, monkeypatch, 300)
    assert turns == ([2] if routed[1] > 2 * 300 else [])  # the cheaper of the two


def test_bounds_of_a_sample_cut_what_tasks_send(spark):
    from flowgraph.operators import knn as module

    rng = np.random.default_rng(8)
    c = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(4000)], "id long, values array<double>").repartition(64)
    q = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(30)], "query_id long, query_vec array<double>").toArrow()
    schema = spark.createDataFrame([], "query_id long, id long, similarity double").schema
    assert module._sample_bounds(q, c, 5, None, schema, 65) is None
    bounds = module._sample_bounds(q, c, 5, None, schema, 64)
    assert module._stream_corpus(q, c, 5, None, schema).count() == 64 * 30 * 5
    assert module._stream_corpus(q, c, 5, None, schema, bounds).count() < 64 * 30 * 5 / 4


def test_broadcast_limit_counts_every_vector_and_id(spark, monkeypatch):
    from flowgraph.operators import knn as module

    monkeypatch.setattr(module, "BROADCAST_BYTES", 4000)
    short_first = spark.createDataFrame([("a", [1.0])] + [(str(i), [1.0] * 20) for i in range(30)], "id string, values array<double>").coalesce(1)
    assert module._if_small(short_first, "id", "values", None) is None
    long_ids = spark.createDataFrame([("x" * 500 + str(i), [1.0]) for i in range(10)], "id string, values array<double>")
    assert module._if_small(long_ids, "id", "values", None) is None
    assert module._if_small(spark.createDataFrame([("a", [1.0])], "id string, values array<double>"), "id", "values", None).num_rows == 1


# --- graph attention ------------------------------------------------------------------------------


def dense_layer(x, edges, attr, w, concat, self_loops):
    """The layer as dense numpy over one small graph."""
    h, c = w.heads, w.units
    n = len(x)
    pairs, vectors_ = [tuple(e) for e in edges], list(attr)
    if self_loops:
        keep = [i for i, (s, d) in enumerate(pairs) if s != d]
        pairs, vectors_ = [pairs[i] for i in keep], [vectors_[i] for i in keep]
        loops = []
        for v in range(n):
            into = [a for (s, d), a in zip(pairs, vectors_) if d == v]
            loops.append(np.mean(into, axis=0) if into else np.zeros(len(attr[0])))
        pairs += [(v, v) for v in range(n)]
        vectors_ += loops
    z = (x @ w.project).reshape(n, h, c)
    out = np.zeros((n, h, c))
    for head in range(h):
        logit = []
        for (s, d), a in zip(pairs, vectors_):
            e = (a @ w.project_edge).reshape(h, c)[head]
            v = w.att_src[head] @ z[s, head] + w.att_dst[head] @ z[d, head] + w.att_edge[head] @ e
            logit.append(v if v > 0 else 0.2 * v)
        for node in range(n):
            into = [i for i, (_, d) in enumerate(pairs) if d == node]
            if not into:
                continue
            weights = np.exp(np.array([logit[i] for i in into]) - max(logit[i] for i in into))
            weights /= weights.sum()
            out[node, head] = sum(a * z[pairs[i][0], head] for a, i in zip(weights, into))
    flat = out.reshape(n, h * c) if concat else out.mean(axis=1)
    return flat + w.bias


def random_weights(rng, inputs_, heads, units, edge_dim, concat):
    return attention.AttentionWeights(
        rng.normal(size=(inputs_, heads * units)), rng.normal(size=(heads, units)), rng.normal(size=(heads, units)),
        rng.normal(size=(edge_dim, heads * units)), rng.normal(size=(heads, units)),
        rng.normal(size=heads * units if concat else units),
    )


@pytest.mark.parametrize("concat,self_loops,hot", [(True, True, 10), (False, True, 10**6), (True, False, 10)])
def test_attention_layer_equals_dense(spark, concat, self_loops, hot):
    rng = np.random.default_rng(5)
    n = 12
    x = rng.normal(size=(n, 5))
    edges = sorted({(int(a), 0 if i % 3 == 0 else int(b)) for i, (a, b) in enumerate(rng.integers(0, n, size=(60, 2)))})
    attr = rng.normal(size=(len(edges), 3))
    w = random_weights(rng, 5, 2, 3, 3, concat)
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node_id long, x array<double>")
    e = spark.createDataFrame([(i, s, d, a.tolist()) for i, ((s, d), a) in enumerate(zip(edges, attr))], "edge_idx long, src long, dst long, attr array<double>")
    got = attention.attention_layer(e, nodes, w, concat, self_loops, hot_rows=hot).collect()
    want = dense_layer(x, edges, attr, w, concat, self_loops)
    for r in got:
        assert np.allclose(r["x"], want[r["node_id"]], atol=1e-9)
    assert len(got) == n


@pytest.fixture
def tiny_batches(spark):
    """Arrow batches of three rows, so that groups and partitions span many batches."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    yield
    spark.conf.set(key, before)


def test_vector_sums_across_batches(spark, tiny_batches):
    rows = [(k, s, [float(i), 1.0]) for i, (k, s) in enumerate((i % 5 if i % 3 else 0, i % 2) for i in range(200))]
    df = spark.createDataFrame(rows, "k long, s int, values array<double>").repartition(7)
    want = {}
    for k, s, v in rows:
        want[k, s] = [a + b for a, b in zip(want.get((k, s), [0.0, 0.0]), v)]
    got = attention.vector_sums(df, ["k", "s"]).collect()
    assert len(got) == len(want) and {(r["k"], r["s"]): r["values"] for r in got} == want


def test_attention_across_batches(spark, tiny_batches):
    test_attention_layer_equals_dense(spark, True, True, 10)


@pytest.mark.parametrize("path", ["small corpus", "small queries", "blocks"])
def test_search_across_batches(spark, tiny_batches, path):
    test_search_paths_equal_brute_force(spark, path, 0.3)
    test_search_paths_equal_brute_force(spark, path, None)


def test_whole_network_equals_dense(spark):
    rng = np.random.default_rng(6)
    n = 8
    x = rng.normal(size=(n, 4))
    edges = sorted({(int(a), int(b)) for a, b in rng.integers(0, n, size=(20, 2))})
    attr = rng.normal(size=(len(edges), 3))
    sizes = [(4, 2, 3, True), (6, 2, 3, True), (6, 1, 3, False)]
    layers, h = [], x
    for inputs_, heads, units, concat in sizes:
        width = heads * units if concat else units
        w = random_weights(rng, inputs_, heads, units, 3, concat)
        norm = {"mean": rng.normal(size=width), "var": rng.uniform(0.5, 2, width), "weight": rng.normal(size=width), "bias": rng.normal(size=width)}
        layers.append({"attention": w, "norm": norm, "concat": concat})
        h = dense_layer(h, edges, attr, w, concat, True)
        h = (h - norm["mean"]) / np.sqrt(norm["var"] + 1e-5) * norm["weight"] + norm["bias"]
        h = np.where(h > 0, h, np.expm1(h))
    cls = {"w1": rng.normal(size=(9, 3)), "b1": rng.normal(size=3), "w2": rng.normal(size=(3, 1)), "b2": [0.3]}
    wide = np.concatenate([h[[s for s, _ in edges]], h[[d for _, d in edges]], attr], axis=1)
    want = np.maximum(wide @ cls["w1"] + cls["b1"], 0) @ cls["w2"] + 0.3
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node_id long, x array<double>")
    e = spark.createDataFrame([(i, s, d, a.tolist()) for i, ((s, d), a) in enumerate(zip(edges, attr))], "edge_idx long, src long, dst long, attr array<double>")
    got = {r["edge_idx"]: r["logit"] for r in attention.score_graph(e, nodes, layers, cls).collect()}
    assert np.allclose([got[i] for i in range(len(edges))], want[:, 0], atol=1e-8)


def test_weights_survive_their_table(spark):
    layers = {"conv1": {"project": np.arange(6.0).reshape(2, 3), "bias": np.array([1.0, 2.0])}}
    back = attention.load_weights(attention.weights_table(spark, layers))
    assert np.array_equal(back["conv1"]["project"], layers["conv1"]["project"])
    assert np.array_equal(back["conv1"]["bias"][0], layers["conv1"]["bias"])
    with pytest.raises(ValueError):
        attention.load_weights(attention.weights_table(spark, layers), max_rows=1)


def test_split_shares(spark, sf):
    rows = catalog_flows.edges(spark, sf).select("edge_idx", "mask").collect()
    assert sorted(r["edge_idx"] for r in rows) == list(range(len(rows)))
    assert sum(r["mask"] == "test" for r in rows) == len(rows) // 5


def test_pair_counts_cover_the_clean_rows(spark, sf):
    p = catalog_flows.pairs(spark, sf).agg(F.sum("connection_count")).first()[0]
    assert p == catalog_flows.clean(spark, sf).filter("src_ip_zeek IS NOT NULL AND dest_ip_zeek IS NOT NULL").count()
    assert inputs.flows(spark, sf).count() >= p


@pytest.mark.parametrize("name", ["s11_sort_key"])
def test_order_is_checked_without_one_task_for_all(spark, sf, name, capsys):
    from checks import catalog

    found = catalog.QUERIES[name](spark, sf)
    found.explain()
    assert "SinglePartition" not in capsys.readouterr().out
    assert found.where("NOT in_order").isEmpty() and found.count() > 0


def test_places_are_numbered_without_one_task_for_all(spark, sf, capsys):
    from checks import catalog

    found = catalog.QUERIES["l1_sort_by_severity"](spark, sf)
    found.explain()
    assert "SinglePartition" not in capsys.readouterr().out
    assert sorted(r["place"] for r in found.collect()) == list(range(1, found.count() + 1)) != []


def test_softmax_of_missing_and_huge_logits(spark):
    rows = [("a", 1, None), ("b", 1, 1000.0), ("c", 1, 1001.0), ("d", 2, None), ("e", 3, -1e6)]
    edges = spark.createDataFrame(rows, "edge_idx string, dst int, logit double").repartition(3)
    got = {r["edge_idx"]: r["alpha"] for r in attention.edge_softmax(edges).collect()}
    assert got["a"] is None and got["d"] is None and got["e"] == 1.0
    assert got["b"] == pytest.approx(1 / (1 + np.e)) and got["c"] == pytest.approx(np.e / (1 + np.e))
    assert attention.edge_softmax(edges.limit(0)).count() == 0
