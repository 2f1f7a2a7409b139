"""Class-weighted edge classifier and choice among candidates: damped Newton steps, each one aggregation for all candidates."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgraph.functions.rules import is_hit, sigmoid
from flowgraph.operators.attention import vector_sums
from flowgraph.session import Scratch

#: Rows that reach the driver from one aggregation, at most; each holds a square of the features for every candidate.
PARTIALS = 64


@dataclass
class EdgeClassifier:
    """logit = intercept + coefficients · features; ``optimum`` holds the same in standardised features, the intercept first."""

    coefficients: np.ndarray
    intercept: float
    optimum: np.ndarray
    reg: float

    def logit(self, features: Column) -> Column:
        weights = F.array(*[F.lit(float(c)) for c in self.coefficients])
        return F.aggregate(F.zip_with(features, weights, lambda x, c: x * c), F.lit(float(self.intercept)), lambda s, v: s + v)


def _totals(rows: DataFrame, of) -> np.ndarray | None:
    """Sum of ``of(x, y)`` over the Arrow batches of ``rows(x, y)``: one partial sum a task, added up by Spark to a few."""
    salts = PARTIALS

    def add_up(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                part = of(x, batch.column("y").to_numpy(zero_copy_only=False))
                total = part if total is None else total + part
        if total is not None:
            salt = pa.array([TaskContext.get().partitionId() % salts], pa.int32())
            yield pa.RecordBatch.from_arrays([salt, pa.array([total], pa.list_(pa.float64()))], names=["salt", "values"])

    partial = vector_sums(rows.mapInArrow(add_up, "salt int, values array<double>"), ["salt"])
    found = [np.asarray(r["values"]) for r in partial.select("values").collect()]
    return np.sum(found, axis=0) if found else None


def fit_edge_classifiers(
    edges: DataFrame, candidates: list[dict], features: str = "attr", mask: str = "train"
) -> list[EdgeClassifier]:
    """Weighted logistic regression on the rows of ``mask`` for every candidate ``{"reg": …, "iterations": …}``.

    Positives weigh negatives / positives.  Features are standardised by their weighted mean and deviation (one that does not
    vary takes no part); ``reg`` penalises their squares, not the intercept.  The rows are evaluated once and written; then one
    pass gives the deviations and each step is one pass for all candidates, with gradient and curvature summed in the tasks.  A
    step that does not lower the loss is halved.  A row without a label is left out.
    """
    scratch = Scratch(edges.sparkSession)
    inside = edges.where((F.col("mask") == mask) & F.col("y").isNotNull())
    rows = scratch.write(inside.select(F.col(features).cast("array<double>").alias("x"), (F.col("y") == 1).cast("double").alias("y")), "train")

    def by_class(x, y):
        return np.concatenate([np.r_[len(p), p.sum(axis=0), (p * p).sum(axis=0)] for p in (x[y == 0], x[y == 1])])

    try:
        sums = _totals(rows, by_class)
        if sums is None or not all(part[0] for part in sums.reshape(2, -1)):
            raise ValueError("training rows hold only one class")
        negative, positive = sums.reshape(2, -1)
        weight = negative[0] / positive[0]
        mean_of = (negative + weight * positive) / (2 * negative[0])
        width = (len(mean_of) - 1) // 2
        mean = mean_of[1 : width + 1]
        variance = mean_of[width + 1 :] - mean * mean
        varies = variance > 1e-12 * mean * mean
        scale = np.where(varies, 1 / np.sqrt(np.where(varies, variance, 1.0)), 0.0)
        optima = _newton(rows, candidates, mean, scale, weight, 2 * negative[0])
    finally:
        scratch.drop_all()
    return [
        EdgeClassifier(best[1:] * scale, float(best[0] - (best[1:] * scale) @ mean), best, options.get("reg", 1e-4))
        for best, options in zip(optima, candidates)
    ]


def _newton(rows: DataFrame, candidates: list[dict], mean, scale, weight: float, total: float) -> list[np.ndarray]:
    """Standardised optimum of every candidate; those that are done no longer take part in a pass."""
    size = len(mean) + 1
    free = np.r_[0.0, np.ones(size - 1)]
    at = [np.zeros(size) for _ in candidates]
    trial, step, loss = [p.copy() for p in at], [1.0] * len(at), [np.inf] * len(at)
    move, gain = [np.zeros(size) for _ in at], [0.0] * len(at)
    active = list(range(len(at)))
    for turn in range(max((c.get("iterations", 50) for c in candidates), default=0)):
        active = [i for i in active if turn < candidates[i].get("iterations", 50)]
        if not active:
            break
        points = np.stack([trial[i] for i in active])

        def derivatives(x, y, points=points):
            u = np.concatenate([np.ones((len(x), 1)), (x - mean) * scale], axis=1)
            w = np.where(y == 1, weight, 1.0)
            out = []
            for point in points:
                m = u @ point
                low = np.exp(-np.abs(m))
                p = np.where(m >= 0, 1.0, low) / (1 + low)
                worse = w * (np.log1p(low) + np.maximum(m, 0) - y * m)
                out.append(np.r_[worse.sum(), u.T @ (w * (p - y)), (u.T @ (u * (w * p * (1 - p))[:, None])).ravel()])
            return np.concatenate(out)

        for i, part in zip(list(active), _totals(rows, derivatives).reshape(len(active), -1) / total):
            penalty = candidates[i].get("reg", 1e-4) * free
            value = part[0] + 0.5 * (penalty * trial[i]) @ trial[i]
            if value > loss[i] - 1e-4 * step[i] * gain[i] + 1e-12:
                step[i] /= 2
            else:
                at[i], loss[i], step[i] = trial[i], value, 1.0
                slope = part[1 : size + 1] + penalty * at[i]
                if np.abs(slope).max() < 1e-11:
                    active.remove(i)
                    continue
                move[i] = np.linalg.lstsq(part[size + 1 :].reshape(size, size) + np.diag(penalty), -slope, rcond=None)[0]
                gain[i] = -slope @ move[i]
            if step[i] < 1e-6:
                active.remove(i)
            trial[i] = at[i] + step[i] * move[i]
    return at


def fit_edge_classifier(
    edges: DataFrame, features: str = "attr", reg: float = 1e-4, iterations: int = 50, mask: str = "train"
) -> EdgeClassifier:
    """One candidate of :func:`fit_edge_classifiers`."""
    return fit_edge_classifiers(edges, [{"reg": reg, "iterations": iterations}], features, mask)[0]


def classify_edges(model: EdgeClassifier, edges: DataFrame, features: str = "attr") -> DataFrame:
    """Every edge with its ``logit`` and ``score``."""
    return edges.withColumn("logit", model.logit(F.col(features))).withColumn("score", sigmoid(F.col("logit")))


def select_classifier(edges: DataFrame, candidates: list[dict], features: str = "attr", validate_on: str = "val"):
    """Fit all candidates together and keep the best F1 on the validation rows, counted in one pass; the first wins a tie."""
    models = fit_edge_classifiers(edges, candidates, features)
    positive = F.col("y") == 1
    hits = [is_hit(sigmoid(m.logit(F.col(features)))) for m in models]
    counts = edges.where(F.col("mask") == validate_on).agg(
        F.count_if(positive).alias("positive"),
        *[F.count_if(hit).alias(f"hit{i}") for i, hit in enumerate(hits)],
        *[F.count_if(hit & positive).alias(f"right{i}") for i, hit in enumerate(hits)],
    ).first()
    f1 = [2.0 * counts[f"right{i}"] / ((counts[f"hit{i}"] + counts["positive"]) or 1) for i in range(len(models))]
    best = max(range(len(models)), key=lambda i: (f1[i], -i))
    return (models[best], f1[best], candidates[best]), list(zip(candidates, f1))


def three_way_mask(edges: DataFrame, key: str = "edge_idx", seed: int = 42, val: int = 10, test: int = 20) -> DataFrame:
    """Optional train/val/test split in percent, from a hash of the edge key."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(100))
    return edges.withColumn(
        "mask", F.when(bucket < test, "test").when(bucket < test + val, "val").otherwise("train")
    )
