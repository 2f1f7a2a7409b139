"""Column expressions on ARRAY<DOUBLE> vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def l2_normalize(a: Column) -> Column:
    """Unit length; a zero vector stays zero."""
    length = norm(a)
    return F.when(length == 0, F.transform(a, lambda x: x.cast("double"))).otherwise(
        F.transform(a, lambda x: x.cast("double") / length)
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either vector is zero."""
    length = norm(a) * norm(b)
    return F.when(length == 0, F.lit(0.0)).otherwise(dot(a, b) / length)


def relu(a: Column) -> Column:
    return F.transform(a, lambda x: F.greatest(x, F.lit(0.0)))


def elu(a: Column, alpha: float = 1.0) -> Column:
    return F.transform(a, lambda x: F.when(x > 0, x).otherwise(F.lit(alpha) * F.expm1(x)))


def batch_norm(x: Column, mean: Column, var: Column, weight: Column, bias: Column, eps: float = 1e-5) -> Column:
    """Scoring-mode batch norm: an affine map with stored statistics."""
    params = F.arrays_zip(mean.alias("m"), var.alias("v"), weight.alias("w"), bias.alias("b"))
    return F.zip_with(x, params, lambda v, p: (v - p["m"]) / F.sqrt(p["v"] + eps) * p["w"] + p["b"])


#: Everything that is neither letter nor digit separates words.
WORD_GAP = r"[^\p{L}\p{N}]+"
