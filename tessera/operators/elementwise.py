"""Per-cell operators: projections (one input) and coordinate joins (two inputs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.core import Cells, hash_uniform, maybe_broadcast, require_same_shape
from tessera.functions import scalar


def _map(a: Cells, expr: Column) -> Cells:
    return a.with_df(a.df.select(*a.coords, expr.alias("value")))


def scale(a: Cells, alpha: float) -> Cells:
    return _map(a, F.col("value") * F.lit(float(alpha)))


def relu(a: Cells) -> Cells:
    return _map(a, scalar.relu("value"))


def gelu(a: Cells) -> Cells:
    return _map(a, scalar.gelu("value"))


def dropout(a: Cells, p: float, seed: int) -> Cells:
    """Zero a cell when ``u(seed, coords) < p``, else divide it by ``1 - p``.

    The draw is a hash of the coordinates, so a retried task or a different
    partitioning keeps exactly the same mask.
    """
    if not 0.0 <= p < 1.0:
        raise ValueError("dropout: need 0 <= p < 1")
    u = hash_uniform(seed, *a.coords)
    return _map(a, F.when(u < F.lit(float(p)), F.lit(0.0))
                .otherwise(F.col("value") / F.lit(1.0 - float(p))))


def _zip(op: str, a: Cells, b: Cells, fn) -> Cells:
    """Inner equi-join on all coordinates, then ``fn(a.value, b.value)``.

    Coordinates are unique keys, so neither side can be skewed; Catalyst picks
    the join (sort-merge for two large sides, broadcast when AQE sees a small
    side at run time).
    """
    require_same_shape(op, a, b)
    left = a.df.select(*a.coords, F.col("value").alias("_a"))
    right = b.df.select(*b.coords, F.col("value").alias("_b"))
    joined = left.join(right, a.coords, "inner")
    return a.with_df(joined.select(*a.coords, fn(F.col("_a"), F.col("_b")).alias("value")))


def add(a: Cells, b: Cells) -> Cells:
    return _zip("add", a, b, lambda x, y: x + y)


def sub(a: Cells, b: Cells) -> Cells:
    return _zip("sub", a, b, lambda x, y: x - y)


def mul(a: Cells, b: Cells) -> Cells:
    return _zip("mul", a, b, lambda x, y: x * y)


def relu_backward(pre: Cells, g: Cells) -> Cells:
    """Upstream gradient where the pre-activation is > 0 (NaN counts as not)."""
    return _zip("relu_backward", pre, g, scalar.relu_grad)


def gelu_backward(x: Cells, g: Cells) -> Cells:
    return _zip("gelu_backward", x, g, scalar.gelu_grad)


def add_bias(y: Cells, b: Cells) -> Cells:
    """``Y[i, j] + b[j]`` for a 2-d ``Y`` and a 1-d ``b``.

    ``b`` has ``Y.shape[1]`` cells, known on the driver, so it is broadcast
    when that is small and shuffle-joined otherwise.
    """
    if y.ndim != 2 or b.ndim != 1 or b.shape[0] != y.shape[1]:
        raise ValueError(f"add_bias: need Y [B, D] and b [D], got {y.shape}, {b.shape}")
    bias = maybe_broadcast(b.df.select(F.col("c0").alias("c1"), F.col("value").alias("_b")),
                           b.size)
    out = y.df.join(bias, "c1").select("c0", "c1", (F.col("value") + F.col("_b")).alias("value"))
    return y.with_df(out)


# ------------------------------------------------------------ packed operands

_ZIP_OPS = {
    "add": lambda x, y: x + y,
    "sub": lambda x, y: x - y,
    "mul": lambda x, y: x * y,
    "relu_backward": scalar.relu_grad,
    "gelu_backward": scalar.gelu_grad,
}


def zip_rows(df, left: str, right: str, op: str, out: str = "out"):
    """Binary elementwise operator on two array columns of the same rows.

    When both operands live in one packed table no join is needed at all: a
    row-local ``zip_with`` (JVM higher-order function) pairs the values.
    Arrays of different lengths are an error, like a shape mismatch.
    """
    if op not in _ZIP_OPS:
        raise ValueError(f"zip_rows: unknown operator {op}")
    fn = _ZIP_OPS[op]
    a = F.col(left).cast("array<double>")
    b = F.col(right).cast("array<double>")
    same = F.size(a) == F.size(b)
    zipped = F.zip_with(a, b, lambda x, y: fn(x, y))
    return df.withColumn(out, F.when(same, zipped).otherwise(
        F.raise_error(F.lit(f"zip_rows: '{left}' and '{right}' differ in length"))))
