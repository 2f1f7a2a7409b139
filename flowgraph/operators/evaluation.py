"""Metrics of scored edges ``(y, score)``: one aggregation each, or one ladder of distinct scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgraph.functions.rules import is_hit
from flowgraph.operators.numbering import running_sums
from flowgraph.schemas import DECISION_THRESHOLD, SWEEP_THRESHOLDS


def _positive() -> Column:
    return F.col("y") == 1


def _count(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0))


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return _ratio(2 * tp, 2 * tp + fp + fn)


def class_distribution(edges: DataFrame) -> DataFrame:
    """Count and percentage of both labels."""
    totals = edges.agg(_count(F.col("y") == 0).alias("n0"), _count(_positive()).alias("n1"), F.count("y").alias("n"))
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias("label"),
                        F.col(n).alias("count"),
                        (_ratio(F.col(n), F.col("n")) * 100).alias("percent"),
                    )
                    for label, n in (("Normal", "n0"), ("Attack", "n1"))
                ]
            )
        )
    )


def positive_weight(edges: DataFrame, mask: str = "train") -> DataFrame:
    """Negatives per positive among the rows of ``mask``; NULL without positives."""
    inside = F.col("mask") == mask
    return edges.agg(
        F.try_divide(
            _count(inside & (F.col("y") == 0)).cast("double"), _count(inside & _positive()).cast("double")
        ).alias("pos_weight")
    )


def confusion(scored: DataFrame, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    hit = is_hit(F.col("score"), threshold)
    return scored.agg(
        _count(~_positive() & ~hit).alias("tn"),
        _count(~_positive() & hit).alias("fp"),
        _count(_positive() & ~hit).alias("fn"),
        _count(_positive() & hit).alias("tp"),
    )


def precision_recall_f1(scored: DataFrame, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return confusion(scored, threshold).select(
        _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"), _f1(tp, fp, fn).alias("f1")
    )


def threshold_sweep(scored: DataFrame, thresholds=SWEEP_THRESHOLDS) -> DataFrame:
    """Recall, precision, F1 and false-positive rate at every threshold, from one pass."""
    counts = [F.count_if(_positive()).alias("p"), F.count_if(~_positive()).alias("n")]
    for i, t in enumerate(thresholds):
        hit = is_hit(F.col("score"), t)
        counts += [F.count_if(_positive() & hit).alias(f"tp{i}"), F.count_if(~_positive() & hit).alias(f"fp{i}")]
    lines = [
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"), "p", "n")
        for i, t in enumerate(thresholds)
    ]
    tp, fp, p, n = F.col("tp"), F.col("fp"), F.col("p"), F.col("n")
    return (
        scored.agg(*counts)
        .select(F.inline(F.array(*lines)))
        .select(
            "threshold",
            _ratio(tp, p).alias("recall"),
            _ratio(tp, tp + fp).alias("precision"),
            _f1(tp, fp, p - tp).alias("f1"),
            _ratio(fp, n).alias("fp_rate"),
        )
    )


def best_threshold(sweep: DataFrame, default: float = DECISION_THRESHOLD) -> DataFrame:
    """Highest F1, on ties the higher threshold; ``default`` when no F1 is above 0."""
    best = F.max(F.when(F.col("f1") > 0, F.struct("f1", "threshold")))
    return sweep.agg(best.alias("best")).select(
        F.coalesce("best.threshold", F.lit(default)).alias("threshold"), F.coalesce("best.f1", F.lit(0.0)).alias("f1")
    )


def classification_report(scored: DataFrame, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """Rows Normal, Attack, accuracy, macro avg and weighted avg."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n0, n1 = tn + fp, fn + tp
    total = n0 + n1
    per_class = {
        "precision": (_ratio(tn, tn + fn), _ratio(tp, tp + fp)),
        "recall": (_ratio(tn, n0), _ratio(tp, n1)),
        "f1": (_f1(tn, fn, fp), _f1(tp, fp, fn)),
    }
    accuracy = _ratio(tn + tp, total)

    def line(name, values, support):
        return F.struct(
            F.lit(name).alias("row"),
            *[v.alias(m) for m, v in zip(per_class, values)],
            support.cast("long").alias("support"),
        )

    lines = [
        line("Normal", [v[0] for v in per_class.values()], n0),
        line("Attack", [v[1] for v in per_class.values()], n1),
        line("accuracy", [accuracy] * 3, total),
        line("macro avg", [(a + b) / 2 for a, b in per_class.values()], total),
        line("weighted avg", [_ratio(a * n0 + b * n1, total) for a, b in per_class.values()], total),
    ]
    return confusion(scored, threshold).select(F.inline(F.array(*lines)))


def score_ladder(scored: DataFrame) -> DataFrame:
    """One row per distinct score, descending, with inclusive running counts of both classes."""
    steps = scored.groupBy("score").agg(F.count_if(_positive()).alias("p"), F.count_if(~_positive()).alias("n"))
    return running_sums(steps, [F.desc("score")], {"tp": "p", "fp": "n"})


def roc_auc(ladder: DataFrame) -> DataFrame:
    """Share of (positive, negative) pairs in the right order; a tie counts half."""
    pairs = F.sum(F.col("n").cast("double") * (F.col("tp") - F.col("p") / 2))
    return ladder.agg(
        F.try_divide(pairs, F.sum("p").cast("double") * F.sum("n").cast("double")).alias("roc_auc")
    )


def average_precision(ladder: DataFrame) -> DataFrame:
    """Step-wise area under the precision-recall curve."""
    area = F.sum(F.col("p") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
    return ladder.agg(F.try_divide(area, F.sum("p").cast("double")).alias("average_precision"))


def curve_points(ladder: DataFrame) -> DataFrame:
    """ROC and precision-recall point at every distinct score."""
    totals = ladder.agg(F.sum("p").alias("P"), F.sum("n").alias("N")).first()
    p, n = F.lit(totals["P"]), F.lit(totals["N"])
    tp, fp = F.col("tp"), F.col("fp")
    return ladder.select(
        F.col("score").alias("threshold"),
        _ratio(fp, n).alias("fpr"),
        _ratio(tp, p).alias("tpr"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, p).alias("recall"),
    )
