"""Ranked search by signatures against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from flowgraph.llm import signature_search as search

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counted:
            m = 10 + (90 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in {*terms(text)} if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k=10, **more):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, ids string, score int")
    b = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id int, text string, rank int, item int")
    return sorted((tuple(r) for r in search.search(d, b, k, **more).collect()), key=repr)


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def test_ranks_equal_plain_scores(spark):
    rng = random.Random(1)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)]
    docs = [(i, prose(rng, words, int(rng.paretovariate(0.5)) % 3000)) for i in range(700)]
    docs += [(10_000 + i, docs[5][1]) for i in range(300)]  # one group of copies, all tied
    items = [(i, prose(rng, words, rng.randint(1, 40))) for i in range(90)] + [(500, docs[5][1])]
    want = plain(docs, items, 10)
    assert found(spark, docs, items) == want
    assert found(spark, docs, items, shard_bytes=2000) == want


def test_few_documents_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_BITS", 2000)
    monkeypatch.setattr(search, "BROADCAST_ROWS", 0)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(30)]
    docs = [(i, prose(rng, words, rng.randint(0, 30))) for i in range(200)]
    items = [(i, prose(rng, words, 5)) for i in range(20)]
    assert found(spark, docs, items, k=3) == plain(docs, items, 3)


def test_awkward_rows(spark):
    docs = [
        (1, None), (2, ""), (3, " .,\x00"), (4, "Äpfel äpfel ÄPFEL 漢字"), (5, "a_b-c"), (5, "a_b-c"), (None, "a b"), (None, "a"), (6, "x" * 60_000 + " a"),
        (7, "a " * 50_000), (8, "🙂 a1 A1"), (9, "KK k"), (10, "b"), (10, "c c c"),
    ]
    items = [(1, "A b"), (1, "A b"), (None, "äpfel"), (2, None), (3, ""), (4, "nowhere"), (5, "c"), (6, "K"), (7, "🙂 x"), (8, "x" * 60_000)]
    assert found(spark, docs, items) == plain(docs, items, 10)
    assert found(spark, docs, items, k=2) == plain(docs, items, 2)
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, docs[:3], items) == []


def test_bounds_are_bounds_and_tight():
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(300)]
    docs = [(i, prose(rng, words, rng.randint(1, 400))) for i in range(500)]
    items = [prose(rng, words, 12) for _ in range(70)]
    held = search.Gathered()
    held.add([i for i, _ in docs], pa.array([t for _, t in docs]))
    asked = search.Items(items)
    df = Counter(t for _, text in docs for t in {*terms(text)})
    total = sum(len(terms(t)) for _, t in docs)
    asked.weigh({int(n): df[w] for w, n in zip(asked.words, asked.names.view(np.int64))}, len(docs), total)
    exact = {(r[0], r[2]): r[3] for r in plain(docs, list(enumerate(items)), len(docs))}
    over, seen = 0, 0
    for batch in held.blocks():
        row = batch.to_pylist()[0]
        for first in range(0, len(items), search.ITEMS_A_TIME):
            for j, bounds in enumerate(asked.bounds(row, first)):
                for i, bound in zip(row["ids"], bounds.tolist()):
                    score = exact.get((first + j, i), 0)
                    assert bound >= score
                    over += bound > 1.3 * score + 1
                    seen += 1
    assert seen == len(docs) * len(items) and over < 0.05 * seen
