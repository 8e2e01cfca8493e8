"""Moving between packed rows (record + array column) and cell tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.core import BROADCAST_CELLS, Cells, packed_shape


def rows_to_cells(df: DataFrame, key: str, array_col: str | None = None,
                  columns: list[str] | None = None, n_rows: int | None = None,
                  width: int | None = None) -> Cells:
    """Explode packed rows into a 2-d cell table ``(c0=key, c1=j, value)``.

    Either ``array_col`` (an array column) or ``columns`` (scalar feature
    columns, packed in the given order) supplies the values. ``key`` must be a
    dense 0-based row index when the result is used as a matrix; ``n_rows`` and
    ``width`` give the shape. When one is omitted, one job finds both and checks
    the rows: ragged rows, NULL arrays or values, and keys other than
    ``0 .. n-1`` raise ``ValueError``.
    """
    if (array_col is None) == (columns is None):
        raise ValueError("give exactly one of array_col or columns")
    arr = F.col(array_col) if array_col else F.array(*[F.col(c).cast("double") for c in columns])
    base = df.select(F.col(key).cast("bigint").alias("c0"), arr.alias("_arr"))
    cells = base.select("c0", F.posexplode("_arr").alias("c1", "value")).select(
        "c0", F.col("c1").cast("bigint").alias("c1"), F.col("value").cast("double").alias("value"))
    if n_rows is None or width is None:
        n_rows, width = packed_shape(base, F.col("_arr"), F.col("c0"))
    return Cells(cells, (n_rows, width))


def cells_to_rows(cells: Cells, key: str = "c0", out: str = "features") -> DataFrame:
    """Pack a 2-d cell table back into one row per ``c0`` with an ordered array.

    One shuffle on the row coordinate; each group holds exactly one row's
    width of cells, so no group grows with the number of rows.
    """
    if cells.ndim != 2:
        raise ValueError("cells_to_rows needs a 2-d matrix")
    if cells.shape[1] > BROADCAST_CELLS:
        raise ValueError(f"cells_to_rows: rows of {cells.shape[1]} values are too wide to pack")
    grouped = cells.df.groupBy("c0").agg(
        F.array_sort(F.collect_list(F.struct("c1", "value"))).alias("_cells"))
    return grouped.select(F.col("c0").alias(key),
                          F.transform("_cells", lambda s: s["value"]).alias(out))
