"""Files, stores, publishing, streaming, text sources and the plugged encoder."""

import json
import os

import pytest
from pyspark.sql import functions as F

from checks import catalog_flows
from flowgraph.operators import quality
from flowgraph.operators.embedding import HashedTextEncoder, embed, embed_missing
from flowgraph.plans import batch
from flowgraph.schemas import CANONICAL, SORT_KEYS
from flowgraph.session import shared_dir, sized_for
from flowgraph.sources import files, knowledge, pages, sinks, vector_store
from flowgraph.streaming.frontier import ingest_new_files


@pytest.fixture
def zone(spark, tmp_path):
    """Seven small files in period folders below parquet/."""
    for i in range(7):
        folder = tmp_path / "zone" / "parquet" / f"p{i}"
        df = spark.createDataFrame([(f"u{i}", float(i) + 0.7, "tcp")], "uid string, orig_pkts double, proto string")
        if i == 6:
            df = df.withColumn("orig_pkts", F.col("orig_pkts").cast("string")).withColumn("vlan", F.lit("1.0"))
        df.coalesce(1).write.parquet(str(folder))
    return str(tmp_path / "zone")


def test_listing_cap_and_shards(spark, zone, tmp_path):
    found = files.list_files(spark, zone)
    assert found.count() == 7 and found.filter("size > 0").count() == 7
    capped, truncated = files.cap_files(found, 5)
    assert truncated and sorted(r["path"].split("/")[-2] for r in capped.collect()) == ["p0", "p1", "p2", "p3", "p4"]
    assert files.cap_files(found, 7)[1] is False
    with pytest.raises(RuntimeError):
        files.cap_files(found, 5, require_ack=True)
    os.makedirs(tmp_path / "empty")
    with pytest.raises(Exception):
        files.list_files(spark, str(tmp_path / "empty"))


def test_union_of_unequal_files(spark, zone):
    df = files.read_periods(spark, files.list_files(spark, zone), shards=5)
    assert df.columns == [*CANONICAL.names, "shard"]
    rows = {r["uid"]: r for r in df.collect()}
    assert rows["u2"]["orig_pkts"] == 2 and rows["u2"]["source_period"] == "p2"
    assert rows["u2"]["vlan"] == "unknown" and rows["u2"]["label_binary"] == "unknown" and rows["u2"]["label_tactic"] is None
    assert rows["u6"]["vlan"] == "1.0"
    assert [rows[f"u{i}"]["shard"] for i in range(7)] == [0, 1, 2, 3, 4, 0, 1]


def test_unreadable_file_is_named(spark, zone):
    bad = os.path.join(zone, "parquet", "p3", "part-bad.parquet")
    with open(bad, "wb") as f:
        f.write(b"no parquet")
    probed = files.probe_footers(files.list_files(spark, zone))
    assert probed.filter("error IS NOT NULL").count() == 1
    with pytest.raises(RuntimeError, match="part-bad"):
        files.read_periods(spark, files.list_files(spark, zone))


def test_publish_swaps_refuses_empty_and_keeps_one_old(spark, tmp_path):
    one = spark.createDataFrame([("a", "b", 1)], "src_ip_zeek string, dest_ip_zeek string, datetime int")
    first = sinks.publish(one, "default.swapped", SORT_KEYS)
    assert first.count() == 1
    old = sinks.table_location(spark, "default.swapped")
    second = sinks.publish(one.union(one), "default.swapped", SORT_KEYS)
    assert second.count() == 2 and spark.table("default.swapped").count() == 2
    assert sinks.table_location(spark, "default.swapped") != old and os.path.exists(old.replace("file:", ""))
    sinks.publish(one, "default.swapped", SORT_KEYS)
    sinks.publish(one.union(one), "default.swapped", SORT_KEYS)
    assert not os.path.exists(old.replace("file:", ""))
    assert len(sinks._versions(spark, sinks._home(spark, "default.swapped"))) == 2
    with pytest.raises(Exception):
        sinks.publish(one.limit(0), "default.swapped", SORT_KEYS)
    assert spark.table("default.swapped").count() == 2
    with pytest.raises(ValueError):
        sinks.publish(one.withColumn("more", F.lit(1)), "default.swapped")


def test_whole_batch(spark, sf):
    root = catalog_flows.raw_zone(spark, sf)
    spark.sql("CREATE DATABASE IF NOT EXISTS batchtest")
    summary = batch.flows_to_graph(spark, root, "batchtest", cap=None).first()
    assert summary["edges"] == summary["train"] + summary["test"] and summary["test"] == summary["edges"] // 5
    assert spark.table("batchtest.mart_node_mapping").count() == summary["nodes"]
    with pytest.raises(Exception):
        batch.flows_to_graph(spark, root, "batchtest", cap=None, expected_nodes=1)
    capped = batch.flows_to_graph(spark, root, "batchtest", cap=2, expected_nodes=1).first()
    assert capped["raw_rows"] < summary["raw_rows"]
    assert (capped["files_found"], capped["files_used"], capped["truncated"]) == (7, 2, True)
    uncapped = batch.flows_to_graph(spark, root, "batchtest").first()
    assert uncapped["raw_rows"] == summary["raw_rows"] and (uncapped["files_used"], uncapped["truncated"]) == (7, False)
    assert spark.table("batchtest.int_network_clean").count() > 0


def test_a_failing_check_leaves_the_published_tables(spark, sf, monkeypatch):
    root = catalog_flows.raw_zone(spark, sf)
    spark.sql("CREATE DATABASE IF NOT EXISTS checkedtest")
    batch.flows_to_graph(spark, root, "checkedtest")
    before = sinks.table_location(spark, "checkedtest.mart_gnn_ready")
    monkeypatch.setitem(quality.ACCEPTED, "mart_gnn_ready", {"split_mask": ["train"]})
    with pytest.raises(quality.CheckFailed, match="mart_gnn_ready.split_mask accepted_values"):
        batch.flows_to_graph(spark, root, "checkedtest")
    assert sinks.table_location(spark, "checkedtest.mart_gnn_ready") == before


def test_paths_with_blanks_and_folders_of_the_root(spark, tmp_path):
    zone = tmp_path / "parquet" / "top"
    period = zone / "2024-01-01 - 2024-01-08+x"
    spark.range(3).coalesce(1).write.parquet(str(period / "parquet" / "a"))
    spark.range(5).write.parquet(str(zone / "beside"))
    found = files.list_files(spark, str(zone))
    assert found.count() == 1
    probed = files.probe_footers(found)
    assert probed.filter("error IS NOT NULL").isEmpty() and probed.agg(F.sum("rows")).first()[0] == 3
    one = period / "b.parquet"
    spark.range(1).coalesce(1).write.parquet(str(one))
    assert files.with_source_period(spark.read.parquet(str(one))).first()["source_period"] == "b.parquet"
    inner = str(period / "parquet")
    moved = spark.read.option("recursiveFileLookup", "true").parquet(inner)
    assert {r["source_period"] for r in files.with_source_period(moved).collect()} == {"a"}
    (period / "part-x.parquet").write_bytes(next(one.glob("part-*.parquet")).read_bytes())
    direct = files.with_source_period(spark.read.parquet(str(period / "part-x.parquet")))
    assert direct.first()["source_period"] == "2024-01-01 - 2024-01-08+x"


def test_stores_only_spark_can_read_are_probed_by_spark(spark, tmp_path):
    """A path of a scheme the workers have no client for goes to Spark's own readers."""
    spark.range(4).coalesce(1).write.parquet(str(tmp_path / "in"))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.probe.link./in", f"file://{tmp_path}/in")
    found = files.list_files(spark, "viewfs://probe/in", below=None)
    probed = files.probe_footers(found).collect()
    assert [(r["rows"], r["error"]) for r in probed] == [(4, None)] and probed[0]["path"].startswith("viewfs://")


def test_any_number_of_files_goes_to_spark(spark, tmp_path, monkeypatch):
    """More files than Spark reads at a time, one of them broken."""
    monkeypatch.setattr(files, "_BY_SPARK", 2)
    spark.range(10).repartition(5).write.parquet(str(tmp_path / "in"))
    (tmp_path / "in" / "part-broken.parquet").write_bytes(b"no footer")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.many.link./in", f"file://{tmp_path}/in")
    probed = files.probe_footers(files.list_files(spark, "viewfs://many/in", below=None)).collect()
    assert len(probed) == 6 and sum(r["rows"] or 0 for r in probed) == 10
    assert [r["path"].rsplit("/", 1)[1] for r in probed if r["error"]] == ["part-broken.parquet"]


def test_later_files_win_whatever_their_size(spark, tmp_path):
    head = "cve_id,description,matched_mitre_id,severity_score,year\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1_old.csv").write_text(head + "A,old,T1,1.0,2020\n")
    (tmp_path / "in" / "2_new.csv").write_text(head + "".join(f"B{i},{'x' * 500},T1,1.0,2020\n" for i in range(2000)) + f"A,{'new ' * 1250},T1,2.0,2021\n")
    fitted = HashedTextEncoder(8).fit(spark.createDataFrame([("new",), ("old",)], "text string"))
    first = batch.ingest_cves(spark, str(tmp_path / "in"), fitted, None, str(tmp_path / "v1")).filter("id = 'A'").first()
    assert first["description"] == "new " * 1250 and first["description_short"] == ("new " * 1250)[:500] and first["severity_score"] == 2.0
    (tmp_path / "more.csv").write_text(head + "A,old,T1,3.0,2022\n")
    second = batch.ingest_cves(spark, str(tmp_path / "more.csv"), fitted, str(tmp_path / "v1"), str(tmp_path / "v2")).filter("id = 'A'").first()
    alone = fitted(spark.createDataFrame([("old",)], "description string"), "description").first()["values"]
    assert second["description"] == "old" and second["values"] == alone != first["values"]


def test_last_technique_of_the_bundle_wins(spark, tmp_path):
    def technique(name):
        return {"type": "attack-pattern", "name": name, "description": "d", "external_references": [{"source_name": "mitre-attack", "external_id": "T1"}]}

    (tmp_path / "b.json").write_text(json.dumps({"objects": [technique("z"), technique("a")]}))
    encode = HashedTextEncoder(4)
    encode.fit(spark.createDataFrame([("a",)], "text string"))
    store = batch.refresh_techniques(spark, str(tmp_path / "b.json"), encode, str(tmp_path / "store"))
    assert [r["name"] for r in store.collect()] == ["a"]


def test_stream_takes_each_file_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    df = spark.range(10)
    for _ in range(2):
        df.write.mode("append").parquet(source)
        for _ in range(2):
            ingest_new_files(spark, source, df.schema, target, state)
    assert spark.read.parquet(target).count() == 20


def test_bundle_references(spark, tmp_path):
    own = {"source_name": "mitre-attack"}
    objects = [
        {"type": "attack-pattern", "name": "n1", "description": "d", "external_references": [{"source_name": "x", "external_id": "X"}, {**own, "external_id": "A"}, {**own, "external_id": "B"}]},
        {"type": "attack-pattern", "name": "n2", "external_references": [{**own, "external_id": "A"}, own]},
        {"type": "attack-pattern", "name": "n3", "external_references": []},
        {"type": "attack-pattern", "name": "n4"},
        {"type": "attack-pattern", "name": "n5", "x_mitre_deprecated": True, "external_references": [{**own, "external_id": "C"}]},
        {"type": "attack-pattern", "name": "n6", "revoked": True, "external_references": [{**own, "external_id": "D"}]},
        {"type": "malware", "name": "n7", "external_references": [{**own, "external_id": "E"}]},
    ]
    path = tmp_path / "bundle.json"
    path.write_text(json.dumps({"type": "bundle", "objects": objects}, indent=1))
    got = {r["mitre_id"]: r for r in knowledge.extract_techniques(knowledge.read_bundle(spark, str(path))).collect()}
    assert set(got) == {"B", "D"}
    assert got["B"]["full_text"] == "Technique Name: n1. Description: d" and got["D"]["description"] == ""


def test_knowledge_base_ingest(spark, tmp_path):
    csv = tmp_path / "cves.csv"
    csv.write_text('cve_id,description,matched_mitre_id,severity_score,year\nA,"one\ntwo, ""x""",T1,7.5,2020\nB,,,,\nA,later,T2,8.0,2021\n')
    fitted = HashedTextEncoder(16).fit(spark.createDataFrame([("one",), ("later two",)], "text string"))
    encoded = []

    def encode(df, text):
        encoded.append(df.count())
        return fitted(df, text)

    first = batch.ingest_cves(spark, str(csv), encode, None, str(tmp_path / "v1"))
    rows = {r["id"]: r for r in first.collect()}
    assert set(rows) == {"A", "B"} and rows["A"]["description"] == "later" and rows["A"]["severity_score"] == 8.0
    assert (rows["B"]["severity_score"], rows["B"]["year"], rows["B"]["description"], rows["B"]["matched_mitre_id"]) == (0.0, 2026, "", None)
    csv.write_text("cve_id,description,matched_mitre_id,severity_score,year\nA,later,T2,9.9,2021\nC,new,T1,1.0,2022\n")
    second = batch.ingest_cves(spark, str(csv), encode, str(tmp_path / "v1"), str(tmp_path / "v2"))
    rows = {r["id"]: r for r in second.collect()}
    assert set(rows) == {"A", "B", "C"} and rows["A"]["severity_score"] == 9.9
    assert encoded == [2, 1]  # only the new record: the text of A is the same
    assert vector_store.index_stats(second).first()["total_vector_count"] == 3


def test_multiline_csv(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('cve_id,description,matched_mitre_id,severity_score,year\nA,"one\ntwo, ""x""",T1,7.5,2020\n')
    row = knowledge.read_cves(spark, str(path)).first()
    assert row["description"] == 'one\ntwo, "x"' and row["severity_score"] == 7.5 and row["year"] == 2020


def test_links_and_kinds(spark):
    html = (
        '<A class="x" HREF="part-1.parquet">a</A><a href=\'sub/\'>b</a><a name="n">c</a><!-- <a href="gone/">x</a> -->'
        '<a href="CSV_old/">d</a><a href="?C=N&amp;O=D">e</a><a href="../">f</a><a href="_SUCCESS">g</a><abbr href="no">h</abbr>'
    )
    df = spark.createDataFrame([(1, "http://h/parquet/", html), (2, "http://h/x/", html)], "page_id int, url string, html string")
    got = {(r["page_id"], r["href"]): r["kind"] for r in pages.crawl_frontier(df).collect()}
    assert got[1, "part-1.parquet"] == "file" and got[2, "part-1.parquet"] == "other"
    assert got[1, "sub/"] == "dir" and got[1, "CSV_old/"] == "skip" and got[1, "?C=N&O=D"] == "skip"
    assert got[1, "../"] == "skip" and got[1, "_SUCCESS"] == "skip" and got[1, ""] == "other"
    assert not any("gone" in k[1] or k[1] == "no" for k in got)


def test_plugged_encoder(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None), (3, "abcd")], "k int, text string")

    def model():
        return lambda texts: [[float(len(t)), 0.0] for t in texts]

    got = {r["k"]: r["values"] for r in embed(df, "text", model, dim=2).collect()}
    assert got == {1: [1.0, 0.0], 2: [0.0, 0.0], 3: [1.0, 0.0]}
    with pytest.raises(Exception, match="expected"):
        embed(df, "text", model, dim=3).collect()
    with pytest.raises(ValueError):
        HashedTextEncoder(4)(df)


def test_stored_vectors_are_not_encoded_again(spark):
    records = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, text string")
    stored = spark.createDataFrame([("a", [9.0]), ("z", [1.0])], "id string, values array<double>")
    out = embed_missing(records, stored, "id", lambda df: df.select("id", F.array(F.lit(0.0)).alias("values")))
    assert {r["id"]: r["values"] for r in out.collect()} == {"a": [9.0], "b": [0.0]}


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "edge_id int, cve_ids array<string>")
    sinks.export(df, str(tmp_path / "c"), "csv")
    back = {r["edge_id"]: r["cve_ids"] for r in spark.read.option("header", True).option("escape", '"').option("inferSchema", True).csv(str(tmp_path / "c")).collect()}
    assert back == {1: '["a","b"]', 2: "[]"}
    with pytest.raises(ValueError):
        sinks.export(df, str(tmp_path / "x"), "xml")


def test_settings(spark):
    assert sized_for(100 * 10**12)["spark.sql.shuffle.partitions"] == str(-(-100 * 10**12 // (256 << 20)))
    assert sized_for(10)["spark.sql.shuffle.partitions"] == "200"
    assert shared_dir(spark) == shared_dir(spark)


def test_a_description_finds_its_own_record(spark):
    from flowgraph.operators.retrieval import query_cve_by_text, query_mitre_for_cve

    texts = ["remote code execution in a web server", "weak password check", "buffer overflow in a parser"]
    rows = [(f"C{i}", t, f"T{i}", 5.0 + i, 2020 + i) for i, t in enumerate(texts)]
    cves = spark.createDataFrame(rows, "cve_id string, description string, matched_mitre_id string, severity_score double, year int")
    encoder = HashedTextEncoder(256)
    corpus = encoder.fit_encode(cves, "description")
    queries = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(9, "nothing alike")], "query_id long, text string")
    got = query_cve_by_text(queries, corpus, encoder).filter("rank = 1").collect()
    assert {(r["query_id"], r["cve_id"], r["similarity_score"]) for r in got} == {(i, f"C{i}", 1.0) for i in range(3)}
    severe = query_cve_by_text(queries, corpus, encoder, min_severity=6.0, year=2021, mitre_id="T1").collect()
    assert [(r["query_id"], r["cve_id"]) for r in severe] == [(1, "C1")]
    techniques = corpus.selectExpr("matched_mitre_id AS mitre_id", "description AS name", "description", "values")
    found = query_mitre_for_cve(queries, techniques, encoder).filter("rank = 1").collect()
    assert {(r["query_id"], r["mitre_id"]) for r in found} == {(i, f"T{i}") for i in range(3)}


def test_tables_are_counted_as_files_or_folders(spark, tmp_path):
    """A table may be a folder of parts, which count together under the table's name."""
    catalog = tmp_path / "a b=1"
    spark.range(30).repartition(3).write.parquet(str(catalog / "parts.parquet"))
    spark.range(4).coalesce(1).write.parquet(str(tmp_path / "one"))
    part = next(p for p in (tmp_path / "one").iterdir() if p.suffix == ".parquet")
    (catalog / "single.parquet").write_bytes(part.read_bytes())
    report = files.footer_report(files.list_files(spark, str(catalog), "*.parquet", below=None))
    assert report.count() == 4
    for root in (str(catalog), f"{catalog}/", f"file:{catalog}"):
        assert {r["file"]: r["rows"] for r in files.rows_by_table(report, root).collect()} == {"parts.parquet": 30, "single.parquet": 4}
