"""The bucketed store, checks observed on the way, footers of large files, tables of a run."""

import os

import pytest
from pyspark.sql import functions as F

from checks import inputs
from flowgraph.operators import quality, staging
from flowgraph.operators.embedding import HashedTextEncoder
from flowgraph.plans import batch
from flowgraph.session import Scratch, shared_dir
from flowgraph.sources import bucket_store, files


def tree(path):
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")) for d in os.listdir(path) if d.startswith("bucket=")}


def test_an_upsert_rewrites_the_buckets_it_touches(spark, tmp_path):
    path = str(tmp_path / "store")
    base = spark.range(1000).selectExpr("id", "cast(id as string) AS text")
    bucket_store.create(base, path, "id", 32)
    before = tree(path)
    rows = [(5, "a", 1), (5, "b", 2), (5000, "new", 1)]
    updates = spark.createDataFrame(rows, "id long, text string, at int")
    n = bucket_store.upsert(spark, path, updates, "id", "at")
    after = tree(path)
    assert 1 <= n <= 2 and sum(before[d] != after[d] for d in before) == n and set(before) == set(after)
    found = {r["id"]: r["text"] for r in bucket_store.read(spark, path, "id").collect()}
    assert len(found) == 1001 and found[5] == "b" and found[5000] == "new" and found[6] == "6"
    assert bucket_store.upsert(spark, path, updates, "id", "at") == n  # a repeated upsert changes nothing
    assert {r["id"]: r["text"] for r in bucket_store.read(spark, path, "id").collect()} == found


def test_store_edges(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.createDataFrame([(None, "none"), ("a", "x")], "k string, v string")
    bucket_store.create(df, path, "k", 4)
    assert bucket_store.upsert(spark, path, df.limit(0), "k") == 0
    bucket_store.upsert(spark, path, spark.createDataFrame([(None, "other")], "k string, v string"), "k")
    assert {(r["k"], r["v"]) for r in bucket_store.read(spark, path, "k").collect()} == {(None, "other"), ("a", "x")}
    with pytest.raises(ValueError):
        bucket_store.read(spark, path, "v")
    assert bucket_store.touched(spark, path, "k", df.where("k = 'a'")).where("k = 'a'").count() == 1
    assert bucket_store.buckets_for(0) == 1 and bucket_store.buckets_for(10**12) > 7000


def test_new_cves_rewrite_few_buckets_and_unchanged_ones_none(spark, tmp_path):
    head = "cve_id,description,matched_mitre_id,severity_score,year\n"
    old, new = tmp_path / "old.csv", tmp_path / "new.csv"
    old.write_text(head + "".join(f"C{i},text {i},T1,1.0,2020\n" for i in range(200)))
    new.write_text(head + "C7,changed,T1,1.0,2020\nC8,text 8,T1,1.0,2020\n")
    encode = HashedTextEncoder(8).fit(spark.createDataFrame([("text",), ("changed",)], "text string"))
    first, store = str(tmp_path / "v1"), str(tmp_path / "store")
    bucket_store.create(batch.ingest_cves(spark, str(old), encode, None, first), store, "id", 16)
    assert batch.update_cves(spark, str(new), encode, store) == 1
    rows = {r["id"]: r["description"] for r in bucket_store.read(spark, store, "id").collect()}
    assert len(rows) == 200 and rows["C7"] == "changed" and rows["C8"] == "text 8"
    before = tree(store)
    assert batch.update_cves(spark, str(new), encode, store) == 0 and tree(store) == before


def test_models_and_checks_read_the_flows_once(spark, sf):
    spark.sql("CREATE DATABASE IF NOT EXISTS watchtest")
    raw = inputs.flows(spark, sf)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    counts = batch.publish_models(raw.mapInArrow(counted, raw.schema), "watchtest")
    assert seen.value == raw.count() and counts["raw_rows"] == raw.count()
    assert counts["edges"] == spark.table("watchtest.mart_gnn_ready").count() == counts["train"] + counts["test"]
    assert counts["nodes"] == spark.table("watchtest.mart_node_mapping").count()
    assert quality.summary_of(spark, counts).first()["train_share"] == counts["train"] / counts["edges"]


def test_observed_lines_equal_counted_ones(spark):
    df = spark.createDataFrame([("a", 1, "train"), (None, None, "x"), ("b", 2, None)], "source_idx string, target_idx int, split_mask string")
    watch = quality.Watch("mart_gnn_ready", {"big": "target_idx > 1"})
    watch.on(df).write.format("noop").mode("overwrite").save()
    plain = quality.column_checks(df, "mart_gnn_ready", quality.NOT_NULL["mart_gnn_ready"], quality.ACCEPTED["mart_gnn_ready"])
    assert [tuple(r) for r in watch.lines()] == [tuple(r) for r in plain.collect()]
    assert watch.counts()["rows"] == 3 and watch.counts()["big"] == 1
    with pytest.raises(quality.CheckFailed, match="source_idx not_null: 1"):
        quality.require_lines(watch.lines())


def test_broken_files_above_the_limit_are_rows(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "good"))
    (tmp_path / "part-0.parquet").write_bytes(b"PAR1" + b"x" * 5000)
    (tmp_path / "part-1.parquet").write_bytes(b"short")
    key = "spark.sql.sources.binaryFile.maxLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    try:
        found = files.probe_footers(files.list_files(spark, str(tmp_path), below=None)).collect()
    finally:
        spark.conf.set(key, before)
    errors = {os.path.basename(r["path"]): r["error"] for r in found}
    assert len(found) == 3 and sum(e is None for e in errors.values()) == 1 and errors["part-0.parquet"] and errors["part-1.parquet"]


def test_a_large_file_is_opened_by_spark(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "good"))
    path = next((tmp_path / "good").glob("part-*.parquet"))
    probed = files._probe_by_scan(spark, str(path), 1)
    assert probed[2] == '[["id", "int64"]]' and probed[4:] == (100, None)


def test_scratch_drops_what_it_wrote(spark):
    scratch = Scratch(spark)
    kept, gone = scratch.write(spark.range(3), "first-of-two"), scratch.write(spark.range(4), "second-of-two")
    names = lambda: {n.rsplit("-", 1)[0] for n in os.listdir(shared_dir(spark).removeprefix("file:"))}
    assert {"first-of-two", "second-of-two"} <= names()
    scratch.drop(gone, None)
    assert "second-of-two" not in names() and kept.count() == 3
    scratch.drop_all()
    assert "first-of-two" not in names()
