"""Column expressions for activations and their gradients.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the tanh form of GELU (must equal the reference's numbers).
GELU_C0 = 0.7978845608
GELU_C1 = 0.044715


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def relu(x: str | Column) -> Column:
    """Negative values become 0; NaN and -0.0 pass through unchanged."""
    x = _c(x)
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def relu_grad(pre: str | Column, g: str | Column) -> Column:
    """``pre > 0 ? g : 0``. NaN compares greater than anything in Spark SQL,
    so NaN is excluded explicitly to keep the IEEE meaning (NaN > 0 is false)."""
    pre, g = _c(pre), _c(g)
    return F.when((pre > 0) & ~F.isnan(pre), g).otherwise(F.lit(0.0))


def gelu(x: str | Column) -> Column:
    x = _c(x)
    inner = F.lit(GELU_C0) * (x + F.lit(GELU_C1) * x * x * x)
    return F.lit(0.5) * x * (F.lit(1.0) + F.tanh(inner))


def gelu_grad(x: str | Column, g: str | Column) -> Column:
    """d gelu / dx times the upstream gradient ``g``."""
    x, g = _c(x), _c(g)
    t = F.tanh(F.lit(GELU_C0) * (x + F.lit(GELU_C1) * x * x * x))
    term1 = F.lit(0.5) * (F.lit(1.0) + t)
    term2 = (F.lit(0.5) * x * (F.lit(1.0) - t * t)
             * (F.lit(GELU_C0) * (F.lit(1.0) + F.lit(3.0 * GELU_C1) * x * x)))
    return (term1 + term2) * g
