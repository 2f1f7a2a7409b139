"""The pipeline against its stages, and the registration of the queries."""

from brute import linked_components

import corpus_pipeline
from flowgraph.llm import decontaminate, pii, quality, queries


def test_stages_in_order(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    columns = docs.columns
    good = corpus_pipeline.keep_good(spark, docs, sf_dir)
    labels = queries.table(spark, sf_dir, "labels").where("pmod(crc32(cast(doc_id as string)), 5) <> 0")
    scored = quality.score(docs, quality.train(docs, labels)).where(f"score >= {quality.KEEP}")
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in scored.collect()} and good.columns == columns

    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    single = corpus_pipeline.drop_near_copies(spark, docs, sf_dir)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(i for i, _, c in linked_components(rows) if i == c) and single.columns == columns

    clean = corpus_pipeline.drop_leaks(spark, docs, sf_dir)
    leaks = decontaminate.find_leaks(docs, queries.table(spark, sf_dir, "benchmark"))
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in rows} - {r["doc_id"] for r in leaks.collect()} and clean.columns == columns

    masked = corpus_pipeline.mask_personal_data(spark, docs, sf_dir)
    assert masked.dtypes == docs.dtypes
    assert all(not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in masked.collect())


def test_whole_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "packing"
    rows = out.collect()
    assert rows and {r["doc_id"] for r in rows} < {r["doc_id"] for r in queries.table(spark, sf_dir, "documents").collect()}
    for r in rows:
        assert len(r["ids"]) == r["length"] <= 4096


def test_run_of_nothing_and_awkward_rows(spark, sf_dir, tmp_path, awkward):
    for name in ("labels", "benchmark"):
        queries.table(spark, sf_dir, name).write.parquet(f"{tmp_path}/{name}.parquet")
    given = queries.table(spark, sf_dir, "documents")
    rows = given.limit(0).unionByName(awkward.selectExpr("doc_id", "text", "cast(null as string) lang", "cast(null as string) source", "n n_chars"))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 1
    given.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_operators_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op")} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
