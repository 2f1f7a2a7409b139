"""Texts as sparse vectors, and the search over their postings, against brute force."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from flowgraph.operators import retrieval, sparse
from flowgraph.operators.sparse import SparseTextEncoder


def words_of(text):
    return (text or "").lower().split()


def brute(fitted, texts, slots):
    """id → {slot: weight} of space-separated words."""
    def slot(w):
        return int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % slots

    seen = Counter(s for _, t in fitted for s in {slot(w) for w in words_of(t)})
    out = {}
    for i, t in texts:
        w = {s: n * math.log((len(fitted) + 1) / (seen[s] + 1)) for s, n in Counter(map(slot, words_of(t))).items()}
        w = {s: x for s, x in w.items() if x > 0}
        length = math.sqrt(sum(x * x for x in w.values()))
        if w:
            out[i] = {s: x / length for s, x in w.items()}
    return out


def texts(seed, n, hot):
    """Texts of few frequent and many rare words; a third are one text, one holds no word and one is null."""
    rng = np.random.default_rng(seed)
    rows = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, rng.integers(1, 25)) % 400) for _ in range(n)]
    return [*rows, *[hot] * (n // 2), "", None, " ".join(f"w{i}" for i in range(3000))]


@pytest.mark.parametrize("slots", [64, 1 << 20])
@pytest.mark.parametrize("threshold", [0.05, 0.4, 0.95])
def test_search_equals_brute_force(spark, slots, threshold):
    held = [(f"c{i:03d}", t) for i, t in enumerate(texts(1, 60, "w1 w2 w77 w78"))]
    asked = list(enumerate([*texts(2, 25, "w2 w77 W78 w300"), held[5][1], held[7][1], "unknown words"]))
    c, q = spark.createDataFrame(held, "id string, text string").repartition(5), spark.createDataFrame(asked, "query_id long, text string")
    encoder = SparseTextEncoder(slots).fit(c)
    terms = encoder(c, "id")
    want_c, want_q = brute(held, held, slots), brute(held, asked, slots)
    assert {r["id"]: pytest.approx({t["slot"]: t["weight"] for t in r["terms"]}) for r in terms.collect()} == want_c
    got = {(r["query_id"], r["rank"]): (r["id"], round(r["similarity"], 9)) for r in sparse.search(encoder(q, "query_id"), terms, 4, threshold).collect()}
    want = {}
    for i, v in want_q.items():
        sims = sorted((-round(sum(x * u.get(s, 0.0) for s, x in sorted(v.items())), 12), name) for name, u in want_c.items())
        for rank, (s, name) in enumerate([x for x in sims if -x[0] >= threshold][:4], 1):
            want[i, rank] = (name, round(-s, 9))
    assert got == want


def test_only_pairs_with_a_common_deciding_slot_are_made(spark, monkeypatch):
    """A word of all texts but one makes no pairs, and copies are one vector."""
    rows = [(i, f"common rare{i % 50} other{i % 50}") for i in range(400)] + [(400, "alone")]
    c = spark.createDataFrame(rows, "id long, text string")
    terms = SparseTextEncoder().fit(c)(c, "id")
    pairs, kept = [], sparse.materialize

    def counting(df, name="step"):
        out = kept(df, name)
        if name == "pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(sparse, "materialize", counting)
    got = sparse.search(terms.withColumnRenamed("id", "query_id"), terms, 3, 0.8).collect()
    assert pairs == [51] and len(got) == 400 * 3 + 1
    assert all(r["similarity"] == 1 for r in got) and {r["id"] for r in got if r["query_id"] == 399} == {49, 99, 149}


def test_nothing_to_find(spark):
    c = spark.createDataFrame([("a", "some words"), ("b", "other words")], "id string, text string")
    encoder = SparseTextEncoder().fit(c)
    none = encoder(c.limit(0), "id")
    assert sparse.search(none.withColumnRenamed("id", "query_id"), encoder(c, "id"), 3, 0.5).collect() == []
    assert sparse.search(encoder(c, "id").withColumnRenamed("id", "query_id"), none, 3, 0.5).collect() == []
    with pytest.raises(ValueError):
        sparse.search(none.withColumnRenamed("id", "query_id"), none, 3, 0.0)
    with pytest.raises(ValueError):
        SparseTextEncoder()(c, "id")
    assert SparseTextEncoder().fit(c.limit(0))(c, "id").isEmpty()


def test_records_found_by_words_keep_the_filters(spark):
    rows = [("C1", "remote code execution", 9.0, 2020, "T1"), ("C2", "remote code execution", 3.0, 2020, "T1"), ("C3", "other flaw", 9.0, 2021, None),
            ("C1", "remote code", 8.0, 2020, "T1")]
    c = spark.createDataFrame(rows, "cve_id string, description string, severity_score double, year int, matched_mitre_id string")
    q = spark.createDataFrame([(1, "Remote code execution"), (2, None)], "query_id long, text string")
    found = retrieval.search_texts(q, c, min_severity=5.0, threshold=0.5).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["cve_id"], r["description"]) for r in found] == [
        (1, 1, "C1", "remote code execution"), (1, 2, "C1", "remote code")]
