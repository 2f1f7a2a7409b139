"""Metrics against hand numbers and a brute-force pair count."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flowgraph.operators import evaluation as ev
from flowgraph.operators import training


def scored(spark, rows):
    return spark.createDataFrame([(float(s), int(y)) for s, y in rows], "score double, y int")


def brute_auc(rows):
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_of_equal_scores_is_half(spark):
    ladder = ev.score_ladder(scored(spark, [(0.4, 1), (0.4, 0), (0.4, 0)]))
    assert ev.roc_auc(ladder).first()[0] == 0.5


def test_auc_with_one_class_is_null(spark):
    assert ev.roc_auc(ev.score_ladder(scored(spark, [(0.4, 1)]))).first()[0] is None


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 1)), min_size=2, max_size=40))
def test_auc_equals_pair_count_and_mirrors(spark, rows):
    rows = [(s / 8, y) for s, y in rows] + [(0.5, 1), (0.25, 0)]
    auc = ev.roc_auc(ev.score_ladder(scored(spark, rows))).first()[0]
    assert auc == pytest.approx(brute_auc(rows))
    mirrored = ev.roc_auc(ev.score_ladder(scored(spark, [(1 - s, y) for s, y in rows]))).first()[0]
    assert mirrored == pytest.approx(1 - auc)


def test_average_precision_by_hand(spark):
    # precision 1/1 at recall 1/2, then 2/3 at recall 1
    rows = [(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0)]
    assert ev.average_precision(ev.score_ladder(scored(spark, rows))).first()[0] == pytest.approx(0.5 + 0.5 * 2 / 3)


def test_no_predicted_positive_gives_zero(spark):
    row = ev.precision_recall_f1(scored(spark, [(0.1, 1), (0.2, 0)])).first()
    assert tuple(row) == (0.0, 0.0, 0.0)
    assert tuple(ev.confusion(scored(spark, [(0.1, 1), (0.2, 0)])).first()) == (1, 0, 1, 0)
    assert tuple(ev.confusion(scored(spark, [])).first()) == (0, 0, 0, 0)


def test_best_threshold_ties_and_default(spark):
    sweep = spark.createDataFrame([(0.6, 0.5), (0.4, 0.5), (0.3, 0.1)], "threshold double, f1 double")
    assert tuple(ev.best_threshold(sweep).first()) == (0.6, 0.5)
    none = spark.createDataFrame([(0.6, 0.0)], "threshold double, f1 double")
    assert tuple(ev.best_threshold(none).first()) == (0.5, 0.0)


def test_false_positive_rate_is_over_negatives(spark):
    rows = [(0.9, 0), (0.1, 0), (0.9, 1), (0.9, 1)]
    row = ev.threshold_sweep(scored(spark, rows), [0.5]).first()
    assert row["fp_rate"] == 0.5 and row["recall"] == 1.0 and row["precision"] == pytest.approx(2 / 3)


def test_classifier_learns_and_selection_prefers_the_first_on_ties(spark):
    rows = [(i, [float(i % 2), 1.0], i % 2, "train" if i % 5 else "val") for i in range(200)]
    edges = spark.createDataFrame(rows, "edge_idx long, attr array<double>, y int, mask string")
    (model, f1, options), results = training.select_classifier(edges, [{"reg": 1e-4}, {"reg": 1e-3}])
    assert f1 == 1.0 and options == {"reg": 1e-4} and len(results) == 2
    scored_edges = training.classify_edges(model, edges)
    assert scored_edges.filter("(score >= 0.5) != (y = 1)").count() == 0


def test_three_way_mask_covers_everything(spark):
    edges = spark.range(2000).withColumnRenamed("id", "edge_idx")
    counts = {r["mask"]: r["count"] for r in training.three_way_mask(edges).groupBy("mask").count().collect()}
    assert sum(counts.values()) == 2000 and set(counts) == {"train", "val", "test"} and counts["train"] > counts["test"] > counts["val"]


def test_candidates_fitted_together_reach_their_optima(spark):
    rng = np.random.default_rng(5)
    x = np.c_[rng.normal(3, 2, (400, 3)), np.full(400, 7.0)]
    y = (x[:, 0] - x[:, 1] + rng.normal(0, 2, 400) > 1.5).astype(int)
    rows = [(i, [float(v) for v in x[i]], int(y[i]), "train") for i in range(400)] + [(400, [0.0] * 4, None, "train"), (401, [9.0] * 4, 1, "test")]
    edges = spark.createDataFrame(rows, "edge_idx long, attr array<double>, y int, mask string").repartition(7)
    regs = [0.0, 1e-3, 1.0]
    together = training.fit_edge_classifiers(edges, [{"reg": r} for r in regs])
    w = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0)
    mean = (w[:, None] * x).sum(0) / w.sum()
    dev = np.sqrt((w[:, None] * (x - mean) ** 2).sum(0) / w.sum())
    u = np.where(dev > 1e-9, (x - mean) / np.where(dev > 1e-9, dev, 1), 0)
    for reg, model in zip(regs, together):
        score = 1 / (1 + np.exp(-(x @ model.coefficients + model.intercept)))
        slope = (u * (w * (score - y))[:, None]).sum(0) / w.sum() + reg * model.optimum[1:]
        assert np.abs(slope).max() < 1e-8 and abs((w * (score - y)).sum()) < 1e-6 and model.coefficients[3] == 0
        alone = training.fit_edge_classifier(edges, reg=reg)
        assert np.allclose(alone.coefficients, model.coefficients, atol=1e-7)
    got = {r["edge_idx"]: r["logit"] for r in training.classify_edges(together[1], edges).collect()}
    assert got[3] == pytest.approx(float(x[3] @ together[1].coefficients + together[1].intercept))
    with pytest.raises(ValueError):
        training.fit_edge_classifier(edges.where("y = 1"))
    with pytest.raises(ValueError):
        training.fit_edge_classifier(edges.limit(0))
