"""Shape operators: transpose, reshape, lookup and shape inspection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.core import Cells, coord_names, int_div, prod


def transpose(a: Cells, dim0: int = 0, dim1: int = 1) -> Cells:
    """Swap two axes. Only column names change: no job, no shuffle, and later
    filters on the swapped coordinates still reach the parquet scan."""
    if a.ndim < 2 or not (0 <= dim0 < a.ndim and 0 <= dim1 < a.ndim):
        raise ValueError(f"transpose: invalid dims {dim0}, {dim1} for rank {a.ndim}")
    names = a.coords
    swapped = list(names)
    swapped[dim0], swapped[dim1] = names[dim1], names[dim0]
    shape = list(a.shape)
    shape[dim0], shape[dim1] = a.shape[dim1], a.shape[dim0]
    df = a.df.select(*[F.col(src).alias(dst) for src, dst in zip(swapped, names)], "value")
    return Cells(df, tuple(shape))


def reshape(a: Cells, new_shape: tuple[int, ...]) -> Cells:
    """Same cells read in row-major order under a new shape (a projection)."""
    new_shape = tuple(int(s) for s in new_shape)
    if prod(new_shape) != a.size:
        raise ValueError(f"reshape: {a.shape} has {a.size} cells, {new_shape} wants {prod(new_shape)}")
    old_strides = [prod(a.shape[d + 1:]) for d in range(a.ndim)]
    flat = reduce(lambda x, y: x + y,
                  [F.col(c) * F.lit(st) for c, st in zip(a.coords, old_strides)])
    new_strides = [prod(new_shape[d + 1:]) for d in range(len(new_shape))]
    cols = [(int_div(F.col("_flat"), st) % F.lit(dim)).cast("bigint").alias(n)
            for n, st, dim in zip(coord_names(len(new_shape)), new_strides, new_shape)]
    df = a.df.select(flat.alias("_flat"), "value").select(*cols, "value")
    return Cells(df, new_shape)


def cell_at(a: Cells, coords: tuple[int, ...]) -> DataFrame:
    """Bounds-checked lookup of one cell (a pushed-down filter)."""
    if len(coords) != a.ndim or any(not 0 <= c < s for c, s in zip(coords, a.shape)):
        raise IndexError(f"cell_at: {coords} outside shape {a.shape}")
    cond = reduce(lambda x, y: x & y, [F.col(n) == F.lit(int(c)) for n, c in zip(a.coords, coords)])
    return a.df.filter(cond).select(*a.coords, "value")


def cells_at(a: Cells, wanted: DataFrame) -> DataFrame:
    """Lookup of many coordinates given as a table with columns ``c0..``.

    Coordinates outside the shape are dropped and repeated coordinates are
    collapsed (map-side, so one coordinate asked for by a third of the rows
    is no hot key) before a left-semi join; the matrix side is never
    duplicated.
    """
    inside = reduce(lambda x, y: x & y,
                    [(F.col(n) >= 0) & (F.col(n) < F.lit(s)) for n, s in zip(a.coords, a.shape)])
    keys = (wanted.select(*[F.col(n).cast("bigint").alias(n) for n in a.coords]).filter(inside)
            .dropDuplicates())
    return a.df.join(keys, a.coords, "left_semi").select(*a.coords, "value")


def shape_of(a: Cells) -> DataFrame:
    """Observed rank, extent per axis, cell count and distinct-coordinate count.

    ``dense`` is true when the table holds every cell of its declared shape
    exactly once and no value is NULL. A coordinate with a NULL in it is a cell
    but no distinct coordinate; an empty table has NULL extents and counts of 0.

    Cells inside the shape set bits of 64-bit words over their flat index, so what is
    shuffled is one row per word that a task has met: a 64th of the cells where a task
    reads neighbours, never more than the cells where it does not (words, not fixed
    bitmaps of 4 KB, for that reason). Cells outside the shape are grouped by their
    coordinates.
    """
    coords = [F.col(c) for c in a.coords]
    indexed = a.size < 1 << 63  # else no flat index of 64 bits, and no table that is dense
    flat = F.lit(None).cast("bigint")
    if indexed:
        strides = [prod(a.shape[d + 1:]) for d in range(a.ndim)]
        inside = reduce(lambda x, y: x & y, [(c >= 0) & (c < F.lit(s)) for c, s in zip(coords, a.shape)])
        flat = F.when(inside, reduce(lambda x, y: x + y, [c * F.lit(st) for c, st in zip(coords, strides)]))
    cells = a.df.select(*coords, "value", flat.alias("_flat"))
    word = F.shiftright("_flat", 6)
    # shiftleft with a column of shifts has no function of its own
    bit = F.expr("shiftleft(1L, cast(_flat & 63 as int))")
    other = F.when(F.col("_flat").isNull(), F.struct(*a.coords))
    aggs = [F.max(c).alias(f"_hi{i}") for i, c in enumerate(a.coords)]
    aggs += [F.min(c).alias(f"_lo{i}") for i, c in enumerate(a.coords)]
    words = cells.groupBy(word.alias("_word"), other.alias("_other")).agg(
        F.bit_or(bit).alias("_bits"), F.count(F.lit(1)).alias("_n"), F.count("value").alias("_values"), *aggs)
    whole = reduce(lambda x, y: x & y, [F.col(f"_other.{c}").isNotNull() for c in a.coords])
    known = F.when(F.col("_other").isNull(), F.bit_count("_bits")).otherwise(whole.cast("int"))

    def total(c, name):
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)

    stats = words.agg(*[(F.max(f"_hi{i}") + 1).alias(f"d{i}") for i in range(a.ndim)],
                      *[F.min(f"_lo{i}").alias(f"_lo{i}") for i in range(a.ndim)],
                      total("_n", "n_cells"), total(known, "n_distinct"), total("_values", "n_values"))
    dims_ok = reduce(lambda x, y: x & y, [(F.col(f"d{i}") == F.lit(s)) & (F.col(f"_lo{i}") == 0)
                                          for i, s in enumerate(a.shape)])
    full = F.lit(a.size if indexed else -1)
    dense = (dims_ok & (F.col("n_cells") == full) & (F.col("n_distinct") == full)
             & (F.col("n_values") == full))
    return stats.select(F.lit(a.ndim).alias("rank"), *[f"d{i}" for i in range(a.ndim)],
                        "n_cells", "n_distinct", dense.alias("dense"))


def assert_dense(a: Cells) -> Cells:
    row = shape_of(a).first()
    if not row["dense"]:
        raise ValueError(f"matrix is not dense for shape {a.shape}: {row.asDict()}")
    return a
