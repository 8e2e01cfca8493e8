"""Softmax along any axis, and row argmax."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.core import Cells, maybe_broadcast, prod

# A window keeps one slice in one task (in a spillable buffer). Above this
# slice length the grouped form is used instead: mergeable partial sums of the
# slice, joined back once.
WINDOW_SLICE_MAX = 1_000_000

# Width of the bands of values whose exponentials are summed together (grouped
# form). A value lies within half a width of its band's middle, so an exponential is
# between e^-64 and e^64 and neither overflows nor vanishes in any sum.
BAND = 128.0


def softmax(a: Cells, axis: int = -1, method: str = "auto") -> Cells:
    """Max-shifted softmax of every slice along ``axis``.

    A NaN or +inf inside a slice makes the whole slice NaN, as in the
    reference (``max`` is NaN-propagating in Spark too).
    """
    axis = axis % a.ndim
    keys = [c for d, c in enumerate(a.coords) if d != axis]
    if method == "auto":
        method = "window" if a.shape[axis] <= WINDOW_SLICE_MAX else "grouped"
    v = F.col("value")
    if method == "window":
        w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
        e = a.df.withColumn("_e", F.exp(v - F.max(v).over(w)))
        out = e.select(*a.coords, (F.col("_e") / F.sum("_e").over(w)).alias("value"))
    elif method == "grouped":
        out = _grouped(a, axis, keys)
    else:
        raise ValueError(f"softmax: unknown method {method}")
    return a.with_df(out)


def _grouped(a: Cells, axis: int, keys: list[str]) -> DataFrame:
    """Long slices in one pass over the cells and one join.

    Each value belongs to the band of width ``BAND`` nearest to it, and ``exp(v - middle)`` is
    summed per slice and band: a mergeable sum that needs no maximum beforehand, reduced in each task
    before the shuffle. A slice's sum is that of its top band and the one below: anything lower is
    under e^-128 of the sum. Neighbouring bands differ in parity, so the top even and the top odd
    band hold both. Values within ``BAND / 2`` of zero are not shifted at all.
    """
    n_slices = prod(tuple(s for d, s in enumerate(a.shape) if d != axis))
    cells = a.df if keys else a.df.withColumn("_z", F.lit(0))  # a vector is one slice
    keys = keys or ["_z"]
    v, band = F.col("value"), F.rint(F.col("value") / BAND)
    # exp(-inf) is 0; written out, as the band of -inf has no middle
    e = F.when(v == float("-inf"), F.lit(0.0)).otherwise(F.exp(v - F.col("_b") * BAND))
    parts = cells.select(*keys, "value", band.alias("_b")).groupBy(*keys, "_b").agg(F.sum(e).alias("_s"))
    odd = F.coalesce(F.abs(F.col("_b") % 2) == 1, F.lit(False))  # not NaN, NULL and infinities
    tops = parts.groupBy(*keys).agg(F.max(F.when(odd, F.struct("_b", "_s"))).alias("_odd"),
                                    F.max(F.when(~odd, F.struct("_b", "_s"))).alias("_even"))
    tops = tops.withColumn("_top", F.greatest("_odd._b", "_even._b"))
    scaled = [F.coalesce(F.col(f"{p}._s") * F.exp((F.col(f"{p}._b") - F.col("_top")) * BAND), F.lit(0.0))
              for p in ("_odd", "_even")]
    sums = tops.select(*keys, (F.col("_top") * BAND).alias("_m"), (scaled[0] + scaled[1]).alias("_t"))
    return cells.join(maybe_broadcast(sums, n_slices), keys).select(
        *a.coords, (F.exp(v - F.col("_m")) / F.col("_t")).alias("value"))


def softmax_rows(a: Cells) -> Cells:
    if a.ndim != 2:
        raise ValueError("softmax_rows: 2-d matrix required")
    return softmax(a, 1)


def argmax_rows(a: Cells) -> DataFrame:
    """First index of each row's maximum: ``(c0, k)``.

    Ties go to the lowest index (``max`` of ``(value, -index)``). NaN never
    wins, except a NaN in column 0, which the reference's scan keeps.
    """
    if a.ndim != 2:
        raise ValueError("argmax_rows: 2-d matrix required")
    v = F.col("value")
    key = (F.when(F.isnan(v) & (F.col("c1") == 0), F.lit(float("inf")))
           .when(F.isnan(v), F.lit(float("-inf"))).otherwise(v))
    best = a.df.groupBy("c0").agg(F.max(F.struct(key.alias("p"), (-F.col("c1")).alias("nk"))).alias("_b"))
    return best.select("c0", (-F.col("_b.nk")).cast("bigint").alias("k"))
