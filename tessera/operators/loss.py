"""Targets, loss and accuracy on cell tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.core import Cells

# Fixed value: the reference adds this inside the logarithm of the loss.
LOG_EPS = 1e-8
# Code of a label that is not known.
UNKNOWN = -1


def one_hot(labels: DataFrame, row: str, label: str, k: int, n_rows: int | None = None) -> Cells:
    """Cells ``(c0=row, c1=k, 1.0 if label == k else 0.0)``; a label outside
    ``0..k-1`` (e.g. the unknown code -1) gives an all-zero row."""
    df = labels.select(F.col(row).cast("bigint").alias("c0"), _code(label),
                       F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_k"))
    out = df.select("c0", F.col("_k").cast("bigint").alias("c1"),
                    (F.col("_y") == F.col("_k")).cast("double").alias("value"))
    if n_rows is None:
        top = labels.agg(F.max(row)).first()[0]
        n_rows = 1 if top is None else int(top) + 1
    return Cells(out, (n_rows, k))


def _code(label: str) -> Column:
    """The label code; NULL is the unknown code."""
    return F.coalesce(F.col(label).cast("bigint"), F.lit(UNKNOWN)).alias("_y")


def _with_labels(p: Cells, labels: DataFrame, row: str, label: str) -> DataFrame:
    """Cells with the row's code; a row without a label has the unknown code."""
    lab = labels.select(F.col(row).cast("bigint").alias("c0"), _code(label))
    return p.df.join(lab, "c0", "left").withColumn("_y", F.coalesce("_y", F.lit(UNKNOWN)))


def cross_entropy(p: Cells, labels: DataFrame, row: str = "row", label: str = "label") -> DataFrame:
    """``mean_i Σ_k -t_ik · log(p_ik + 1e-8)`` with the one-hot ``t`` implicit.

    Rows are counted as cells over classes, so no distinct count is needed; rows
    with an unknown label, or without one, add 0 to the sum but count in the mean.
    """
    if p.ndim != 2:
        raise ValueError("cross_entropy: 2-d probabilities required")
    df = _with_labels(p, labels, row, label)
    term = F.when(F.col("c1") == F.col("_y"), -F.log(F.col("value") + F.lit(LOG_EPS))).otherwise(0.0)
    return df.agg((F.sum(term) * F.lit(float(p.shape[1])) / F.count(F.lit(1))).alias("loss"))


def accuracy(pred: DataFrame, labels: DataFrame, row: str = "row", pred_col: str = "k",
             label: str = "label") -> DataFrame:
    """``100 · mean(pred == label)`` over all predictions; an unknown or missing label is never correct."""
    lab = labels.select(F.col(row).alias("_r"), _code(label))
    df = pred.join(lab, pred[row] == lab["_r"], "left")
    right = F.coalesce(F.col(pred_col) == F.col("_y"), F.lit(False))
    return df.agg((F.avg(right.cast("double")) * 100.0).alias("accuracy"))


def softmax_xent_grad(p: Cells, labels: DataFrame, row: str = "row", label: str = "label") -> Cells:
    """Gradient of mean cross-entropy w.r.t. the logits: ``(p - t) / n``."""
    df = _with_labels(p, labels, row, label)
    t = (F.col("c1") == F.col("_y")).cast("double")
    return p.with_df(df.select("c0", "c1", ((F.col("value") - t) / F.lit(float(p.shape[0]))).alias("value")))


# ---------------------------------------------------------------- packed rows
# One record per row: scores (or probabilities) as an array, the label beside
# them. Everything is row-local but the final sums.

def softmax_packed(scores: str | Column) -> Column:
    """Max-shifted softmax of an array column (NaN anywhere makes all NaN)."""
    x = (F.col(scores) if isinstance(scores, str) else scores).cast("array<double>")
    # one-element arrays bind the maximum and the sum, so each is computed once a row
    e = F.transform(F.array(F.struct(x.alias("x"), F.array_max(x).alias("top"))),
                    lambda s: F.transform(s["x"], lambda v: F.exp(v - s["top"])))
    summed = F.transform(e, lambda y: F.struct(y.alias("e"), F.aggregate(y, F.lit(0.0), lambda a, v: a + v).alias("t")))
    return F.transform(summed, lambda s: F.transform(s["e"], lambda v: v / s["t"]))[0]


def argmax_packed(scores: str | Column) -> Column:
    """First index of the largest value. NaN never wins, but one in place 0 does."""
    x = (F.col(scores) if isinstance(scores, str) else scores).cast("array<double>")
    key = F.transform(x, lambda v, i: F.when(F.isnan(v), F.when(i == 0, float("inf")).otherwise(float("-inf"))).otherwise(v))
    return (F.array_position(key, F.array_max(key)) - 1).cast("bigint")


def cross_entropy_rows(rows: DataFrame, probs: str, label: str) -> DataFrame:
    """:func:`cross_entropy` of packed rows: one pass and one sum."""
    y = F.coalesce(F.col(label).cast("int"), F.lit(UNKNOWN))
    known = (y >= 0) & (y < F.size(probs))
    term = F.when(known, -F.log(F.get(F.col(probs), y) + F.lit(LOG_EPS))).otherwise(0.0)
    return rows.agg((F.sum(term) / F.count(F.lit(1))).alias("loss"))


def accuracy_rows(rows: DataFrame, scores: str, label: str) -> DataFrame:
    """:func:`accuracy` of packed rows: one pass and one sum."""
    right = F.coalesce(argmax_packed(scores) == F.col(label).cast("bigint"), F.lit(False))
    return rows.agg((F.avg(right.cast("double")) * 100.0).alias("accuracy"))


def softmax_xent_grad_rows(rows: DataFrame, probs: str, label: str, n: int, out: str = "grad") -> DataFrame:
    """``(p - t) / n`` of packed rows; row-local."""
    y = F.coalesce(F.col(label).cast("int"), F.lit(UNKNOWN))
    return rows.withColumn(out, F.transform(F.col(probs).cast("array<double>"),
                                            lambda p, i: (p - (i == y).cast("double")) / F.lit(float(n))))
