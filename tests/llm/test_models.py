"""Chains, suffix tree, quality and language."""

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from brute import remainder, suffix_tree_scores

from flowgraph.llm import chain, language, quality, queries, suffix_tree


def test_marginals_are_those_of_all_labelings():
    rng = np.random.default_rng(1)
    for _ in range(20):
        kinds, n = int(rng.integers(2, 4)), int(rng.integers(1, 5))
        model = chain.Chain(np.zeros(0), rng.normal(size=(kinds, kinds)), rng.normal(size=kinds))
        emit = rng.normal(size=(n, kinds))
        prob, total = np.zeros((n, kinds)), 0.0
        for labels in itertools.product(range(kinds), repeat=n):
            weight = model.start[labels[0]] + sum(emit[t, k] for t, k in enumerate(labels))
            weight = np.exp(weight + sum(model.transitions[a, b] for a, b in zip(labels, labels[1:])))
            total += weight
            for t, k in enumerate(labels):
                prob[t, k] += weight
        got, log_total = chain.marginals(np.concatenate([emit, emit]), np.array([0, n, n, 2 * n]), model)
        assert np.allclose(got, np.concatenate([prob, prob]) / total) and np.isclose(log_total, 2 * np.log(total))


def test_gradient_of_the_likelihood():
    """Training raises the likelihood of separable sequences until they are labelled right."""
    flat, labels = np.array([0, 1, 0, 1, 0, 1]), np.array([0, 1, 0, 1, 0, 1])
    model = chain.fit(flat, np.arange(7), np.arange(6), np.array([0, 2, 6]), labels, 2, 2)
    prob, _ = chain.marginals(chain.emissions(model.weights, flat, np.arange(7)), np.array([0, 2, 6]), model)
    assert (prob.argmax(axis=1) == labels).all()


@pytest.mark.parametrize("block_bytes,bucket_bytes", [(6 << 20, 4 << 20), (20_000, 100_000)])
def test_suffix_tree_is_that_of_plain_counting(spark, documents, sf_dir, monkeypatch, block_bytes, bucket_bytes):
    """In one block, and in many that hand counts to each other and share their frequent words."""
    monkeypatch.setattr(suffix_tree, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(suffix_tree, "BUCKET_BYTES", bucket_bytes)
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    plain = suffix_tree_scores(rows, suffix_tree.DEPTH, suffix_tree.LEAST, suffix_tree.SMOOTHING)
    found = queries.op2_suffix_tree(spark, sf_dir).collect()
    assert len(found) == len(plain)
    for r in found:
        held, n, known, total, base, score = plain[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-9)
    unseen = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_distinct_names_are_those_of_numpy():
    """Also names that differ in their last bits alone, and none."""
    rng = np.random.default_rng(3)
    wide, near = rng.integers(0, 1 << 64, 400, np.uint64), np.uint64(1 << 63) + rng.integers(0, 40, 400, np.uint64)
    for names in (rng.choice(wide, 2000), rng.choice(near, 2000), np.concatenate([wide, near]), wide[:1], wide[:0]):
        found, where = suffix_tree._distinct(names)
        assert found.tolist() == sorted(set(names.tolist())) and found[where].tolist() == names.tolist()


def test_names_of_one_bucket_need_one_plain_sort(monkeypatch):
    """They begin alike, so that the bits they differ in are not those that give way to places."""
    names = np.uint64(0xABC << 52) + np.random.default_rng(4).integers(0, 1 << 20, 5000, np.uint64)
    unique = np.unique
    monkeypatch.setattr(np, "unique", lambda *_, **__: pytest.fail("sorted by numpy's slower way"))
    found, where = suffix_tree._distinct(names)
    assert found.tolist() == unique(names).tolist() and found[where].tolist() == names.tolist()


def test_numbers_survive_the_shuffle_without_their_empty_bytes():
    rng = np.random.default_rng(5)
    for x in (rng.integers(0, 1 << 64, 50, np.uint64), np.arange(300, dtype=np.uint32), np.zeros(9, np.int64), rng.random(7), np.array([True, False]), np.zeros(0)):
        back = suffix_tree._unsqueezed(suffix_tree._squeezed(x), x.dtype)
        assert back.dtype == x.dtype and back.tolist() == x.tolist()
    assert len(suffix_tree._squeezed(np.zeros(0, np.uint64))) == 0 and suffix_tree._squeezed(np.ones(5, np.uint64))[8] == 1


def test_words_have_names_of_their_own():
    words = ["", "a", "b", "ab", "ba", "aa", "é", "x" * 50_000, *map(str, range(100_000))]
    names = suffix_tree._named(pa.array(["left out", *words]).slice(1))
    assert len(set(names.tolist())) == len(words)
    assert names.tolist() == suffix_tree._named(pa.array(words)).tolist()


def test_blocks_of_the_tree_are_written_once_and_not_moved(spark, sf_dir, monkeypatch):
    """Rounds of counting add replies in buckets of the blocks; no round shuffles or rewrites the blocks."""
    from flowgraph.session import Scratch

    written, plans, by_block = [], [], suffix_tree._by_block
    for kind in ("write", "bucketed"):
        plain = getattr(Scratch, kind, Scratch.write)

        def noted(self, df, *args, plain=plain, **kwargs):
            written.append(next(a for a in reversed(args) if isinstance(a, str)))
            return plain(self, df, *args, **kwargs)

        monkeypatch.setattr(Scratch, kind, noted)

    def explained(*args):
        found = by_block(*args)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(suffix_tree, "_by_block", explained)
    monkeypatch.setattr(suffix_tree, "BUCKET_BYTES", 100_000)
    tables = {t.name for t in spark.catalog.listTables()}
    queries.op2_suffix_tree(spark, sf_dir).count()
    assert written.count("blocks") == 1
    assert len(plans) == suffix_tree.DEPTH + 2 and not any("Exchange" in plan for plan in plans)
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_suffix_tree_without_training(spark, awkward, nothing):
    from pyspark.sql import functions as F

    assert suffix_tree.score(nothing, F.lit(True)).count() == 0
    rows = suffix_tree.score(awkward, F.lit(False)).collect()
    assert len(rows) == 12 and all(r["base_score"] == r["score"] == 0 and r["n_known"] == 0 for r in rows)
    assert {r["doc_id"]: r["n_tokens"] for r in rows}[8] == 20_001


def test_root_probabilities_sum_to_one(spark, awkward):
    from pyspark.sql import functions as F

    rows = {r["doc_id"]: r for r in suffix_tree.score(awkward, F.lit(True)).collect()}
    assert rows[1]["n_tokens"] == rows[2]["n_tokens"] == rows[3]["n_tokens"] == 1
    assert rows[1]["train_tokens"] == sum(r["n_tokens"] for r in suffix_tree.score(awkward, F.lit(True)).collect())


def test_quality_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries.op7_quality(spark, sf_dir).toPandas()
    truth = pd.read_parquet(f"{sf_dir}/labels.parquet").dropna()
    both = found.merge(truth, on="doc_id")
    held = both[both.held_out]
    assert (both.held_out == [remainder(i, 5) == 0 for i in both.doc_id]).all() and len(held) > 50
    assert found.score.between(0, 1).all() and (found.predicted == (found.score >= 0.3)).all()
    assert (held.predicted == held.quality).mean() > 0.95
    assert held[held.quality == 1].predicted.mean() > 0.98


def test_line_measures():
    ends, size, bins = quality.line_bins(pa.array(["a a a\nB!! C!!\n", "", "\n", "same\nsame"]))
    assert ends.tolist() == [0, 3, 4, 6, 8] and size.tolist() == [5, 7, 0, 0, 0, 0, 4, 4]
    names = list(quality.EDGES)
    column = {n: bins[:, names.index(n)].tolist() for n in names}
    assert column["doubled"][0] == 6 and column["doubled"][1] == 0
    assert column["repeated"] == [0, 0, 0, 0, 0, 0, 0, 1]
    assert column["symbols"][1] >= 5 and column["capitals"][1] >= 4


def test_slices_and_single_texts_give_the_same_lines():
    texts = ["a b\n\nc", "", "é\n漢 漢", "x"]
    whole = quality.line_bins(pa.array(texts))
    parts = [quality.line_bins(pa.array(["?", t, "?"]).slice(1, 1)) for t in texts]
    assert (whole[2] == np.concatenate([p[2] for p in parts])).all() and (whole[1] == np.concatenate([p[1] for p in parts])).all()


def test_quality_edges(spark, awkward, nothing):
    labels = spark.createDataFrame([(4, 1), (7, 0), (7, 0), (9, 1), (None, 1), (2, None), (1, 0)], "doc_id long, quality int")
    model = quality.train(awkward, labels)
    rows = quality.score(awkward, model).collect()
    assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert quality.score(nothing, model).count() == 0
    untrained = quality.train(nothing, labels)
    assert {r["score"] for r in quality.score(awkward, untrained).collect()} == {0.5}
    assert quality.keep_good(awkward, untrained).columns == awkward.columns


def test_language_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries.op8_language(spark, sf_dir).toPandas()
    truth = pd.read_parquet(f"{sf_dir}/documents.parquet", columns=["doc_id", "lang"])
    both = found.merge(truth, on="doc_id")
    assert len(both) == len(truth) and both.score.between(0, 1).all()
    assert (both[both.held_out].lang_pred == both[both.held_out].lang).mean() > 0.97


def test_words_of_mixed_text_have_their_own_language(spark, documents):
    model = language.train(documents)
    some = {r["lang"]: r["text"].split()[:40] for r in documents.where("length(text) > 600").select("lang", "text").collect()}
    names = sorted(some)[:2]
    text = " ".join(some[names[0]] + some[names[1]])
    _, _, _, prob = language.label_words(pa.array([text]), model)
    picked = [model.languages[k] for k in prob.argmax(axis=1)]
    assert picked[:40].count(names[0]) > 32 and picked[40:].count(names[1]) > 32


def test_language_edges(spark, awkward, nothing, documents):
    model = language.train(documents)
    rows = language.identify(awkward, model).collect()
    undetermined = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert undetermined == {1, 2, 3} and all(r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    assert language.identify(nothing, model).count() == 0
    numbers = spark.createDataFrame([(1, "12 34 !"), (2, "!"), (3, "1a")], "doc_id long, text string")
    assert [r["lang_pred"] == "und" for r in language.identify(numbers, model).orderBy("doc_id").collect()] == [True, True, False]
    empty = language.train(documents.where("lang = 'none'"))
    assert {r["lang_pred"] for r in language.identify(awkward, empty).collect()} == {"und"}


def test_a_phrase_is_a_context_whatever_the_size_of_the_corpus(spark):
    """Seen twice among 6 million other tokens."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, "alpha beta gamma"), (2, "alpha beta gamma"), (3, "alpha beta gamma")], "doc_id long, text string")
    bulk = spark.range(100, 130).select(F.col("id").alias("doc_id"), F.repeat(F.lit("lorem ipsum "), 100_000).alias("text"))
    small = spark.range(100, 102).select(F.col("id").alias("doc_id"), F.lit("lorem ipsum lorem ipsum").alias("text"))
    for more in (small, bulk):
        found = suffix_tree.score(rows.unionByName(more), F.col("doc_id") != 3).where("doc_id = 3").first()
        assert found["n_known"] == 4 and found["score"] > found["base_score"] + 1
    assert found["train_tokens"] == 6_000_000 + 30 + 8 and found["score"] > -9
