"""Cell tables with an implied zero: a coordinate without a row is 0.0.

The tables are those of ``Cells`` and carry the same shape; only the meaning of a missing cell differs, so it has
a type of its own. A stored 0.0 is allowed and means the same. NULL values are kept as NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.core import Cells, fits_broadcast, int_div, maybe_broadcast, prod, require_same_shape
from tessera.operators.loss import _code

# Cells of one inner index that a task of a product joins; an index with more is dealt over several.
HOT_CELLS = 1_000_000


class SparseCells(Cells):
    """A matrix whose missing cells are zero."""


def _nonzero(shape: tuple[int, ...], df: DataFrame) -> SparseCells:
    return SparseCells(df.filter(F.col("value").isNull() | (F.col("value") != 0.0)), shape)


def sparsify(a: Cells) -> SparseCells:
    """Drop the zeros (0.0 and -0.0); NaN, infinities and NULL stay."""
    return _nonzero(a.shape, a.select_cells())


def densify(a: SparseCells) -> Cells:
    """Every cell of the shape; those without a row are 0.0."""
    grid = a.df.sparkSession.range(0, a.size)
    strides = [prod(a.shape[d + 1:]) for d in range(a.ndim)]
    grid = grid.select(*[(int_div(F.col("id"), st) % F.lit(n)).cast("bigint").alias(c)
                         for c, st, n in zip(a.coords, strides, a.shape)])
    stored = a.select_cells().withColumn("_stored", F.lit(True))
    out = grid.join(stored, a.coords, "left")
    return Cells(out.select(*a.coords, F.when(F.col("_stored"), F.col("value")).otherwise(F.lit(0.0)).alias("value")),
                 a.shape)


def one_hot_sparse(labels: DataFrame, row: str, label: str, k: int, n_rows: int) -> SparseCells:
    """One cell a row, ``(row, code, 1.0)``: ``one_hot`` without its ``k - 1`` zeros. A label
    outside ``0..k-1``, or none, has no cell."""
    rows = labels.select(F.col(row).cast("bigint").alias("c0"), _code(label)).filter(F.col("_y").between(0, k - 1))
    return SparseCells(rows.select("c0", F.col("_y").alias("c1"), F.lit(1.0).alias("value")), (n_rows, k))


def _outer(op: str, a: SparseCells, b: SparseCells, fn) -> SparseCells:
    """Full join on the coordinates, absent cells as 0.0; zeros of the result are dropped.

    Coordinates are unique, so no key is hot. A stored NULL stays NULL.
    """
    require_same_shape(op, a, b)
    left = a.df.select(*a.coords, F.struct("value").alias("_a"))
    right = b.df.select(*b.coords, F.struct("value").alias("_b"))
    x, y = [F.when(F.col(s).isNull(), F.lit(0.0)).otherwise(F.col(f"{s}.value")) for s in ("_a", "_b")]
    both = left.join(right, a.coords, "full")
    return _nonzero(a.shape, both.select(*a.coords, fn(x, y).alias("value")))


def add(a: SparseCells, b: SparseCells) -> SparseCells:
    return _outer("add", a, b, lambda x, y: x + y)


def sub(a: SparseCells, b: SparseCells) -> SparseCells:
    return _outer("sub", a, b, lambda x, y: x - y)


def mul(a: SparseCells, b: SparseCells) -> SparseCells:
    """The product; a NaN or infinity beside an implied zero gives NaN, as it does beside a stored one."""
    return _outer("mul", a, b, lambda x, y: x * y)


def transpose(a: SparseCells) -> SparseCells:
    if a.ndim != 2:
        raise ValueError("transpose: 2-d matrix required")
    return SparseCells(a.df.select(F.col("c1").alias("c0"), F.col("c0").alias("c1"), "value"),
                       (a.shape[1], a.shape[0]))


def matmul(a: SparseCells, b: Cells) -> SparseCells:
    """``A @ B`` over the stored cells of ``A`` (``B`` dense or sparse): work and shuffle follow the stored cells.

    Implied zeros add nothing, so a NaN or infinity of ``B`` reaches only rows that hold its
    inner index; a result cell that no stored cell reaches is an implied zero. A ``B`` within the
    broadcast bound is sent to every task. For a larger one both sides are joined on the inner index; an
    index with more than ``HOT_CELLS`` cells in ``A`` (a class that a third of all rows has) is dealt over
    parts by row, and only its row of ``B`` is copied to them.
    """
    if a.ndim != 2 or b.ndim != 2 or a.shape[1] != b.shape[0]:
        raise ValueError(f"matmul: shapes {a.shape} and {b.shape} do not meet")
    left = a.df.select("c0", F.col("c1").alias("_k"), F.col("value").alias("_x"))
    right = b.df.select(F.col("c0").alias("_k"), "c1", F.col("value").alias("_w"))
    if fits_broadcast(b.size):
        pairs = left.join(F.broadcast(right), "_k")
    else:
        left, right = _dealt(left, right)
        pairs = left.join(right, ["_k", "_part"])
    out = pairs.groupBy("c0", "c1").agg(F.sum(F.col("_x") * F.col("_w")).alias("value"))
    return SparseCells(out, (a.shape[0], b.shape[1]))


def _dealt(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with a part number: 0, or for hot indices one of as many parts as they need."""
    counts = left.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HOT_CELLS)
    hot = counts.select("_k", F.ceil(F.col("_n") / HOT_CELLS).cast("int").alias("_parts"))
    n_hot = hot.count()  # at most the cells over HOT_CELLS
    if not n_hot:
        zero = F.lit(0).alias("_part")
        return left.select("*", zero), right.select("*", zero)
    hot = maybe_broadcast(hot, n_hot)
    one = F.coalesce(F.col("_parts"), F.lit(1))
    left = left.join(hot, "_k", "left").withColumn("_part", F.pmod(F.xxhash64("c0"), one).cast("int")).drop("_parts")
    right = right.join(hot, "_k", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), one - 1))).drop("_parts")
    return left, right
