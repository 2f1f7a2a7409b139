"""What must not grow faster than the input: scans, copies and what a task holds."""

import numpy as np
import pytest

from flowgraph.operators import knn as module


def random_vectors(spark, n, seed=1, size=16):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame([(i, rng.normal(size=size).tolist()) for i in range(n)], "id long, values array<double>").repartition(2)


def as_queries(df):
    return df.selectExpr("id AS query_id", "reverse(values) AS query_vec")


def same_as_broadcast(c, got):
    want = module.knn(as_queries(c), c, 3).select("query_id", "id", "rank", "similarity").collect()
    return sorted(got.select("query_id", "id", "rank", "similarity").collect()) == sorted(want)


def test_small_turns_share_a_scan(spark, monkeypatch):
    """60 turns of 10 queries are served by one scan where they fit the byte limit, by a few where a tenth of them do."""
    c = random_vectors(spark, 600)
    scans, stream = [], module._stream_corpus

    def counting(rows, *args):
        scans.append(rows.num_rows)
        return stream(rows, *args)

    for limit, most in ((module.BROADCAST_BYTES, 1), (600 * (8 * 16 + module.HELD_BYTES * 3) // 10, 11)):
        scans.clear()
        with monkeypatch.context() as m:
            m.setattr(module, "_stream_corpus", counting)
            m.setattr(module, "BROADCAST_BYTES", limit)
            got = module.knn(as_queries(c), c, 3, broadcast_rows=10, block_rows=20, pivots=4, rotate=True)
            assert 1 <= len(scans) <= most and sum(scans) == 600
        assert same_as_broadcast(c, got)


def test_copies_do_not_grow_with_the_corpus(spark, monkeypatch):
    """Blocks of 10 rows would be 30 and then 120 copies of every query; they grow with the corpus instead."""
    copies, kept = {}, module.materialize
    for n in (300, 1200):
        c, routed = random_vectors(spark, n, size=32), []

        def counting(df, name="step"):
            out = kept(df, name)
            if name == "routed":
                routed.append(out.selectExpr("sum(size(blocks)) AS n").first()["n"])
            return out

        with monkeypatch.context() as m:
            m.setattr(module, "materialize", counting)
            got = module.knn(as_queries(c), c, 3, broadcast_rows=10, block_rows=10, pivots=2, rotate=False)
        assert same_as_broadcast(c, got)
        copies[n] = routed[1] / n
    assert copies[1200] <= 1.3 * copies[300] <= 1.3 * 3 * module.BLOCK_SHARE


def test_words_are_counted_without_a_shuffle(spark):
    """One row of the result is one row of the input; the words of a text never leave its task."""
    from flowgraph.operators.sparse import SparseTextEncoder

    c = spark.createDataFrame([(i, f"one two w{i % 7} w{i}") for i in range(3000)] + [(3000, None), (3001, " .")], "id long, text string")
    terms = SparseTextEncoder().fit(c)(c, "id")
    assert "Exchange" not in terms._jdf.queryExecution().executedPlan().toString()
    assert terms.count() == 3000
    again = SparseTextEncoder().fit(c)(c.where("id < 2").selectExpr("0L AS id", "text"), "id").collect()
    assert len(again) == 1 and len(again[0]["terms"]) == 4  # one, two, w0, w1: rows of one id count together


@pytest.mark.parametrize("part", [64, 2_000_000])
def test_texts_that_all_share_words_make_no_pairs(spark, monkeypatch, part):
    """Every text shares words with every other: the pairs are never rows, and the result is that of the postings."""
    from flowgraph.operators import sparse

    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.5, 12) % 60)) for i in range(300)] + [(300 + i, "w1 w5 w9") for i in range(9)]
    c = spark.createDataFrame(rows, "id long, text string").repartition(3)
    terms = sparse.SparseTextEncoder().fit(c)(c, "id")
    q = terms.withColumnRenamed("id", "query_id")
    monkeypatch.setattr(sparse, "PAIRS_A_VECTOR", 1 << 60)
    want = sorted(sparse.search(q, terms, 4, 0.2).collect())
    monkeypatch.undo()
    monkeypatch.setattr(sparse, "PART_NUMBERS", part)
    monkeypatch.setattr(sparse, "BLOCK_ENTRIES", 500)
    names, kept = [], sparse.materialize

    def naming(df, name="step"):
        names.append(name)
        return kept(df, name)

    monkeypatch.setattr(sparse, "materialize", naming)
    assert sorted(sparse.search(q, terms, 4, 0.2).collect()) == want
    assert "pairs" not in names


def test_a_model_gets_a_bounded_number_of_texts_at_a_time(spark):
    from flowgraph.operators.embedding import HashedTextEncoder, embed

    df = spark.range(3000).selectExpr("id", "concat('text ', id) AS text").coalesce(1)

    def model():
        return lambda texts: [[len(texts), 0] if i % 2 else [len(texts), len(texts) - 512] for i in range(len(texts))]

    out = embed(df, "text", model, dim=2).selectExpr("id", "values[1] AS v").collect()
    assert len(out) == 3000 and all(r["v"] <= 0 for r in out)
    vectors = HashedTextEncoder(16).fit_encode(df).collect()
    assert {r["id"] for r in vectors} == set(range(3000)) and len({tuple(r["values"]) for r in vectors}) > 5


def test_vectors_of_40_mb_are_not_broadcast(spark):
    """Four workers of an executor hold a broadcast each, in two precisions."""
    c = spark.range(10_000).selectExpr("id", "array_repeat(1.0D, 512) AS values")
    assert module._if_small(c, "id", "values", None) is None


def test_texts_that_all_share_words_are_neither_copied_nor_kept(spark, monkeypatch):
    """Queries take turns over the corpus where it lies, and no table of vectors is left when the hits are known."""
    import os

    from flowgraph.operators import sparse
    from flowgraph.session import shared_dir

    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.5, 12) % 60)) for i in range(300)]
    c = spark.createDataFrame(rows, "id long, text string").repartition(3)
    terms = sparse.SparseTextEncoder().fit(c)(c, "id")
    monkeypatch.setattr(sparse, "BLOCK_ENTRIES", 500)
    before, plans, scanned = set(os.listdir(shared_dir(spark))), [], getattr(sparse, "_scanned", None)

    def explained(*args):
        plans.append(scanned(*args)._jdf.queryExecution().executedPlan().toString())
        return scanned(*args)

    monkeypatch.setattr(sparse, "_scanned", explained, raising=False)
    found = sparse.search(terms.withColumnRenamed("id", "query_id"), terms, 4, 0.2)
    left = {name.split("-")[0] for name in set(os.listdir(shared_dir(spark))) - before}
    assert left <= {"names", "turn"}
    assert len(plans) > 1 and not any("Exchange" in plan for plan in plans)
    assert found.count() > 300


def test_dense_words_are_hashed_in_the_task(spark):
    """Once for each distinct word of a few texts, not by an expression for every word; the vectors are those of plain counting."""
    import hashlib
    import math

    from flowgraph.operators.embedding import HashedTextEncoder

    rows = [(i, f"One two, w{i % 7} w{i % 7} x{i}") for i in range(1100)] + [(1100, None), (1101, " .")]
    c = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    encoder = HashedTextEncoder(32)
    for vectors in (encoder.fit_encode(c), encoder(c)):
        assert "md5" not in vectors._jdf.queryExecution().executedPlan().toString()
        got = {r["id"]: r["values"] for r in vectors.collect()}
        assert len(got) == 1102
    slots = {i: [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 32 for w in (t or "").lower().replace(",", " ").replace(".", " ").split()] for i, t in rows}
    idf = [math.log(1103 / (sum(s in v for v in slots.values()) + 1)) for s in range(32)]
    for i in (0, 6, 511, 512, 1099, 1100, 1101):
        plain = np.array([slots[i].count(s) * idf[s] for s in range(32)])
        assert np.allclose(got[i], plain / (np.linalg.norm(plain) or 1), atol=1e-6)
    again = HashedTextEncoder(32).fit(c)
    assert again._idf == encoder._idf == idf
