"""Matrix products and column sums.

Three physical forms of ``A · B`` (all give the same cells):

* ``cells``  — join on the inner index, ``sum(a*b)`` grouped by output cell.
  The smaller side is broadcast when its cell count (known from the shape)
  is under ``BROADCAST_CELLS``. Makes ``m·n·p`` intermediate rows, so it is
  the choice only when one side is small.
* ``block``  — cells are packed into blocks where they are read and the three
  dimensions are cut into a grid of ``gi × gj × gk`` cells, chosen from the
  shapes so that no operand panel and no result panel of a grid cell exceeds
  ``PANEL_CELLS``. Blocks of A go to the ``gj`` grid cells of their rows and
  inner range, blocks of B to ``gi``; the cells are dealt in order over a
  bounded number of partitions, which add up the inner panels of a result
  panel as they stream by (``operators/blocks.py``). A tall-skinny ``XᵀX`` is
  split over its inner dimension, a wide product over its output.
* ``rows``   — packed rows times a small dense matrix shipped to every task:
  row-local numpy, no shuffle at all (dense-layer scoring).

``gram_rows`` computes ``XᵀX`` from packed rows with one partial ``d × d``
product per partition, then a small aggregation: the shuffle is
``partitions · d²`` numbers whatever the number of rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.core import BROADCAST_CELLS, Cells, Shipped, arrow_matrix, fits_broadcast, packed_shape
from tessera.operators.blocks import from_rows, matmul_blocks, numbered, partial_products, to_cells, to_rows

# Rows (and columns) that stay together when a matrix is cut into panels.
DEFAULT_BLOCK = 128
# Largest dense panel a task of the block product holds (32 MB of doubles).
PANEL_CELLS = 4_000_000


def _check(a: Cells, b: Cells) -> None:
    if a.ndim != 2 or b.ndim != 2:
        raise ValueError("matmul: only 2-d matrices")
    if a.shape[1] != b.shape[0]:
        raise ValueError(f"matmul: inner dimensions differ {a.shape} x {b.shape}")


def _products_cells(a: Cells, b: Cells) -> DataFrame:
    left = a.df.select(F.col("c0"), F.col("c1").alias("_k"), F.col("value").alias("_a"))
    right = b.df.select(F.col("c0").alias("_k"), F.col("c1"), F.col("value").alias("_b"))
    if fits_broadcast(b.size) and b.size <= a.size:
        right = F.broadcast(right)
    elif fits_broadcast(a.size):
        left = F.broadcast(left)
    return left.join(right, "_k").select("c0", "c1", (F.col("_a") * F.col("_b")).alias("value"))


def grid(m: int, k: int, p: int, bs: int | tuple[int, int, int]) -> tuple[int, int, int]:
    """``(gi, gj, gk)`` for an ``m × k`` by ``k × p`` product in blocks of ``bs`` rows, inner places and columns.

    Dimensions are doubled, the one that adds the fewest moved cells first,
    until every panel fits ``PANEL_CELLS``. Copies of an A cell are ``gj``, of
    a B cell ``gi``, partial results at most ``gk``.
    """
    bm, bk, bp = (bs, bs, bs) if isinstance(bs, int) else bs
    most = [math.ceil(m / bm), math.ceil(p / bp), math.ceil(k / bk)]
    g = [1, 1, 1]

    def moved(gi, gj, gk):
        return m * k * gj + k * p * gi + m * p * gk

    def panels(gi, gj, gk):
        rows, cols, inner = m / gi, p / gj, k / gk
        return {0: rows * inner, 1: inner * cols, 2: rows * cols}

    while True:
        size = panels(*g)
        big = max(size, key=lambda x: size[x])
        if size[big] <= PANEL_CELLS:
            return tuple(g)
        # the dimensions that make the largest panel smaller
        axes = [x for x in {0: (0, 2), 1: (2, 1), 2: (0, 1)}[big] if g[x] < most[x]]
        if not axes:
            return tuple(g)
        best = min(axes, key=lambda x: moved(*[min(most[y], 2 * v) if y == x else v for y, v in enumerate(g)]))
        g[best] = min(most[best], 2 * g[best])


def _products_block(a: Cells, b: Cells, bs: int) -> DataFrame:
    """Partial result blocks of the grid product (see ``operators/blocks.py``)."""
    return partial_products(a, b, tuple(min(bs, n) for n in (*a.shape, b.shape[1])))[0]


def matmul(a: Cells, b: Cells, acc: Cells | None = None, method: str = "auto",
           block: int = DEFAULT_BLOCK) -> Cells:
    """``A · B`` (+ ``acc`` when given: the reference's product accumulates into
    its output). The accumulator rows join the same final aggregation, so
    accumulating costs no extra shuffle."""
    _check(a, b)
    shape = (a.shape[0], b.shape[1])
    if acc is not None and acc.shape != shape:
        raise ValueError(f"matmul: accumulator shape {acc.shape} != {shape}")
    if method == "auto":
        method = "cells" if (fits_broadcast(a.size) or fits_broadcast(b.size)) else "block"
    if method == "block":
        return to_cells(matmul_blocks(a, b, acc, (block, block, block)))
    if method != "cells":
        raise ValueError(f"matmul: unknown method {method}")
    parts = _products_cells(a, b)
    if acc is not None:
        parts = parts.unionByName(acc.df.select("c0", "c1", "value"))
    out = parts.groupBy("c0", "c1").agg(F.sum("value").alias("value"))
    return Cells(out, shape)


def col_sum(a: Cells) -> Cells:
    """``Σ_i A[i, j]`` — the bias gradient. Partial sums per task, then a
    shuffle of at most ``partitions · D`` rows."""
    if a.ndim != 2:
        raise ValueError("col_sum: 2-d matrix required")
    out = a.df.groupBy(F.col("c1").alias("c0")).agg(F.sum("value").alias("value"))
    return Cells(out, (a.shape[1],))


# ---------------------------------------------------------------- packed rows

def _list_column(mat: np.ndarray) -> pa.Array:
    n, d = mat.shape
    offsets = pa.array(np.arange(0, n * d + 1, d, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(mat.reshape(-1)))


def matmul_rows(df: DataFrame, key: str, col: str, w: np.ndarray,
                bias: np.ndarray | None = None, out: str = "out", keep: tuple[str, ...] = ()) -> DataFrame:
    """Packed rows ``X`` (one array per row) times a small dense ``W`` (+ bias);
    the columns in ``keep`` come along.

    ``W`` reaches the tasks in the closure when small and as a broadcast
    variable when larger (capped at ``BROADCAST_CELLS`` values); the work is
    row-local (no shuffle). A larger ``W`` takes the product of cells instead
    (:func:`matmul_wide`). Rows of another length raise ``ValueError``.
    """
    w = np.asarray(w, dtype=np.float64)
    if w.ndim != 2 or w.size > BROADCAST_CELLS:
        raise ValueError("matmul_rows: W must be a 2-d matrix small enough to ship to tasks")
    b = np.zeros(w.shape[1]) if bias is None else np.asarray(bias, dtype=np.float64)
    shipped = Shipped(df.sparkSession, [w, b])
    schema = T.StructType([df.schema[c] for c in (key, *keep)] + [T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(batches):
        wt, bt = shipped.get()
        for batch in batches:
            y = arrow_matrix(batch.column(col), wt.shape[0]) @ wt + bt
            yield pa.RecordBatch.from_arrays([batch.column(key), *[batch.column(c) for c in keep], _list_column(y)],
                                             names=[key, *keep, out])

    src = df.select(key, *keep, F.col(col).cast("array<double>").alias(col))
    return src.mapInArrow(run, schema)


def matmul_wide(df: DataFrame, key: str, col: str, w: Cells, bias: Cells | None = None,
                out: str = "out") -> DataFrame:
    """:func:`matmul_rows` for a ``W`` of any size, given as cells: the grid
    product over packed blocks. Rows are numbered first, so keys may be any values (equal keys
    are rows of their own)."""
    x, cells, width = F.col(col).cast("array<double>"), w.df.select("c0", "c1", "value"), w.shape[0]
    if bias is not None:
        # the bias is one more row of W, met by a one at the end of every row
        x, width = F.concat(x, F.array(F.lit(1.0))), width + 1
        cells = cells.unionByName(bias.df.select(F.lit(width - 1).cast("bigint").alias("c0"), F.col("c0").alias("c1"), "value"))
    rows, n = numbered(df.select(key, x.alias("_x")), [key], "_row")
    if not n:
        return df.select(key, F.array().cast("array<double>").alias(out)).limit(0)
    x = from_rows(rows, "_row", "_x", (n, width), (DEFAULT_BLOCK, DEFAULT_BLOCK))
    y = to_rows(matmul_blocks(x, Cells(cells, (width, w.shape[1])), block=(DEFAULT_BLOCK,) * 3), "_row", "_y")
    return rows.select(key, "_row").join(y, "_row").select(key, F.col("_y").alias(out))


def gram_rows(df: DataFrame, col: str, width: int | None = None) -> Cells:
    """``XᵀX`` of packed rows: partial products per task, then one small sum.

    The partial of a task is cut into panels of rows of the result, at most
    ``BROADCAST_CELLS`` values each and one scan per panel, so memory per task
    is bounded for any width and no row ids are needed. ``width`` is found (and
    checked) in one job when omitted.
    """
    x = F.col(col).cast("array<double>")
    if width is None:
        _, width = packed_shape(df.select(x.alias(col)), F.col(col))

    def panel(lo: int, hi: int):
        def run(batches):
            acc = np.zeros((hi - lo, width))
            for batch in batches:
                m = arrow_matrix(batch.column(0), width)
                acc += m[:, lo:hi].T @ m
            i, j = np.indices(acc.shape).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array((lo + i).astype(np.int64)), pa.array(j.astype(np.int64)),
                                              pa.array(acc.reshape(-1))], names=["c0", "c1", "value"])
        return run

    high = max(1, BROADCAST_CELLS // width)
    parts = [df.select(x.alias(col)).mapInArrow(panel(lo, min(lo + high, width)), "c0 bigint, c1 bigint, value double")
             for lo in range(0, width, high)]
    every = parts[0]
    for other in parts[1:]:
        every = every.unionByName(other)
    return Cells(every.groupBy("c0", "c1").agg(F.sum("value").alias("value")), (width, width))
