"""What is merged into stored results: periods into pair states, new files into a keyed store."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from checks import inputs
from flowgraph.operators import graph, staging
from flowgraph.plans import batch
from flowgraph.sources import bucket_store, pair_store
from flowgraph.streaming.frontier import upsert_new_files


def write_periods(flows, root, periods):
    part = flows.withColumnRenamed("source_period", "period").where(F.col("period").isin(periods))
    part.coalesce(1).write.mode("append").partitionBy("period").parquet(f"{root}/parquet")


def edges_of(pairs):
    return {(r["src_ip_zeek"], r["dest_ip_zeek"]): r for r in pairs.collect()}


def same_pairs(merged, flows):
    got, want = edges_of(merged), edges_of(graph.pair_stats(staging.clean_features(staging.stage_flows(flows))))
    assert got.keys() == want.keys() and got
    for key, row in want.items():
        for name, value in row.asDict().items():
            assert got[key][name] == (pytest.approx(value, rel=1e-9, abs=1e-9) if isinstance(value, float) else value), (key, name)


def spoil(root, period):
    """Replace a period's files by as many bytes of nothing, with the same times, so that whoever opens one fails."""
    folder = f"{root}/parquet/period={period}"
    for name in os.listdir(folder):
        if name.startswith("part-"):
            path = f"{folder}/{name}"
            kept = os.stat(path)
            with open(path, "wb") as out:
                out.write(b"\0" * kept.st_size)
            os.utime(path, ns=(kept.st_atime_ns, kept.st_mtime_ns))


def test_a_new_period_is_merged_without_opening_the_old_ones(spark, sf, tmp_path):
    root, store = str(tmp_path / "zone"), str(tmp_path / "store")
    flows = inputs.flows(spark, sf).where("label_binary IS NOT NULL").cache()
    write_periods(flows, root, ["p1998", "p1999"])
    assert batch.update_pair_states(spark, root, store) == 2
    for period in ("p1998", "p1999"):
        spoil(root, period)
    assert batch.update_pair_states(spark, root, store) == 0
    write_periods(flows, root, ["p2000"])
    assert batch.update_pair_states(spark, root, store) == 1
    used = flows.where("source_period IN ('p1998', 'p1999', 'p2000')")
    same_pairs(graph.merged_pairs(pair_store.states(spark, store)), used)
    rows = {r["period"]: r["rows"] for r in pair_store.manifest(spark, store).collect()}
    assert sum(rows.values()) == used.count() and set(rows) == {"period=p1998", "period=p1999", "period=p2000"}


def test_changed_and_vanished_periods(spark, sf, tmp_path):
    root, store = str(tmp_path / "zone"), str(tmp_path / "store")
    flows = inputs.flows(spark, sf).cache()
    write_periods(flows, root, ["p1998", "p1999", "p2000"])
    batch.update_pair_states(spark, root, store)
    write_periods(flows.where("source_period = 'p1998'"), root, ["p1998"])  # a second file of an old period
    shutil.rmtree(f"{root}/parquet/period=p1999")
    assert batch.update_pair_states(spark, root, store) == 1
    used = flows.where("source_period = 'p2000'").unionByName(flows.where("source_period = 'p1998'")).unionByName(flows.where("source_period = 'p1998'"))
    same_pairs(graph.merged_pairs(pair_store.states(spark, store)), used)
    folders = [d for d, _, names in os.walk(f"{store}/states") if any(n.endswith(".parquet") for n in names)]
    assert len(folders) == 2  # states that no manifest names are gone
    assert len([d for d in os.listdir(f"{store}/manifest") if d.startswith("run=")]) == 1


def test_a_period_of_duplicates_only_has_no_states(spark, sf, tmp_path):
    root, store = str(tmp_path / "zone"), str(tmp_path / "store")
    flows = inputs.flows(spark, sf)
    write_periods(flows.withColumn("label_binary", F.when(F.col("source_period") == "p1998", "Duplicate").otherwise("False")), root, ["p1998", "p1999"])
    assert batch.update_pair_states(spark, root, store) == 2
    same_pairs(graph.merged_pairs(pair_store.states(spark, store)), flows.where("source_period = 'p1999'").withColumn("label_binary", F.lit("False")))
    with pytest.raises(ValueError):
        pair_store.create(spark, str(tmp_path / "empty"))
        pair_store.states(spark, str(tmp_path / "empty"))


def test_deviations_merge_without_large_squares(spark):
    rows = [("a", "s", "d", 1e8 + i % 3) for i in range(30)] + [("b", "s", "d", 1e8 + 10 + i % 2) for i in range(40)] + [("b", "s", "e", 5.0), ("b", None, "e", 5.0)]
    clean = spark.createDataFrame(rows, "period string, src_ip_zeek string, dest_ip_zeek string, log_duration double")
    clean = clean.withColumns({c: F.lit(1.0) for c in ("log_orig_bytes", "log_resp_bytes")})
    clean = clean.withColumns({c: F.lit(1) for c in ("proto_tcp", "proto_udp", "proto_icmp", "srv_http", "srv_dns", "label")})
    got, want = edges_of(graph.merged_pairs(graph.pair_states(clean))), edges_of(graph.pair_stats(clean))
    assert got.keys() == want.keys() and len(got) == 3 and got[("s", "e")]["std_log_duration"] is None
    assert got[("s", "d")]["std_log_duration"] == pytest.approx(want[("s", "d")]["std_log_duration"], rel=1e-9)


def test_graph_of_states_equals_the_graph_of_all_flows(spark, sf, tmp_path):
    root, store = str(tmp_path / "zone"), str(tmp_path / "store")
    write_periods(inputs.flows(spark, sf), root, ["p1998", "p1999", "p2000"])
    spark.sql("CREATE DATABASE IF NOT EXISTS whole")
    spark.sql("CREATE DATABASE IF NOT EXISTS parts")
    want = batch.flows_to_graph(spark, root, "whole").first()
    got = batch.update_graph(spark, root, store, "parts").first()
    for name in ("raw_rows", "nodes", "edges", "train", "test"):
        assert got[name] == want[name], name
    for table in ("mart_node_mapping", "mart_gnn_ready"):
        a, b = (spark.table(f"{db}.{table}").select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in spark.table(f"{db}.{table}").dtypes]) for db in ("whole", "parts"))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    store, inbox, state = (str(tmp_path / n) for n in ("store", "in", "state"))
    base = spark.range(100).selectExpr("id", "'old' AS text", "0 AS at")
    bucket_store.create(base.drop("at"), store, "id", 4)
    updates = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (500, "new", 1)], "id long, text string, at int")

    def run():
        upsert_new_files(spark, inbox, updates.schema, store, "id", state, "at")
        found = bucket_store.read(spark, store, "id").withColumn("file", F.col("_metadata.file_path"))
        return {r["id"]: (r["text"], r["file"]) for r in found.collect()}

    updates.write.parquet(inbox)
    first = run()
    assert len(first) == 101 and first[1][0] == "b" and first[500][0] == "new" and first[2][0] == "old"
    for name in os.listdir(f"{state}/commits"):  # as if the run had ended before the batch was committed
        os.remove(f"{state}/commits/{name}")
    assert run() == first
    shutil.rmtree(f"{state}-taken")  # as if it had ended while the store was written: put on top again, the same rows
    for name in os.listdir(f"{state}/commits"):
        os.remove(f"{state}/commits/{name}")
    assert {k: v[0] for k, v in run().items()} == {k: v[0] for k, v in first.items()}


def test_evaluation_counts_missed_attacks_and_takes_none(spark, tmp_path):
    corpus = spark.createDataFrame(
        [("C1", [1.0, 0.0], "T1", 9.5, 2021), ("C2", [0.9, 0.1], "T2", 8.0, 2019), ("C3", [0.8, 0.3], None, 7.5, 2022)],
        "cve_id string, values array<double>, matched_mitre_id string, severity_score double, year int",
    )
    attr = [1.0] * 8
    rows = [(0, 1, 2, attr, 1, "test", 3.0), (1, 2, 3, attr, 1, "test", -3.0), (2, 3, 4, attr, 0, "test", 3.0), (3, 4, 5, attr, 1, "train", 3.0)]
    edges = spark.createDataFrame(rows, "edge_idx long, src long, dst long, attr array<double>, y int, mask string, logit double")

    def encode(texts):
        return texts.withColumn("values", F.array(F.lit(1.0), F.lit(0.0)))

    row = batch.evaluate_retrieval(edges, corpus, encode, str(tmp_path / "out")).first()
    assert row["retrieval_rate"] == 0.5 and row["groundedness_mean"] == 1.0 and row["answer_relevance_mean"] == 1.0
    assert row["techniques"] == ["T1", "T2"] and row["unique_mitre_ids"] == 3 and row["avg_severity"] == pytest.approx(25 / 3)
    assert spark.read.json(str(tmp_path / "out")).first()["groundedness"]["mean"] == 1.0
    none = batch.evaluate_retrieval(edges.where("y = 0"), corpus, encode).first()
    assert none["retrieval_rate"] == 0.0 and none["context_relevance_mean"] == 0.0 and none["techniques"] == []
