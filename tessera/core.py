"""Cell-table wrapper and shared helpers.

A dense N-d matrix is a DataFrame with one row per cell: integer coordinate
columns ``c0 .. c{n-1}`` and a DOUBLE ``value``. The shape travels with the
wrapper on the driver, so every shape check happens before a job is planned
and every broadcast decision is made on a size that is known, not guessed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest number of cells (or packed values, or shipped weights) sent to every
# executor. 1M (bigint, bigint, double) rows is ~25-40 MB as a hashed relation,
# cheap to fan out to a thousand executors; anything larger takes a shuffle
# join (or, for weights, is refused).
BROADCAST_CELLS = 1_000_000


# Model-sized arrays up to this many values ride in the task closure; larger
# ones are sent once per executor as a broadcast variable.
CLOSURE_VALUES = 100_000


class Shipped:
    """Numpy arrays (weights, parameters) that tasks need.

    Bounded by ``BROADCAST_CELLS`` values; small ones travel inside the task
    closure, larger ones as a Spark broadcast variable (sent once per
    executor, not once per task). ``release()`` frees the broadcast after an
    eager job; lazy results keep it alive as long as they are referenced.
    """

    def __init__(self, spark, arrays):
        arrays = [np.asarray(a, dtype=np.float64) for a in arrays]
        total = sum(a.size for a in arrays)
        if total > BROADCAST_CELLS:
            raise ValueError(f"{total} values are too many to ship to every task")
        self._local = arrays if total <= CLOSURE_VALUES else None
        self._bc = None if self._local is not None else spark.sparkContext.broadcast(arrays)

    def get(self) -> list:
        return self._local if self._bc is None else self._bc.value

    def release(self) -> None:
        if self._bc is not None:
            self._bc.destroy()
            self._bc = None


def coord_names(ndim: int) -> list[str]:
    return [f"c{d}" for d in range(ndim)]


def prod(shape: tuple[int, ...]) -> int:
    return int(math.prod(shape)) if shape else 1


@dataclass(frozen=True)
class Cells:
    """A dense matrix stored as a cell table plus its shape."""

    df: DataFrame
    shape: tuple[int, ...]

    def __post_init__(self):
        shape = tuple(int(s) for s in self.shape)
        if not shape or any(s <= 0 for s in shape):
            raise ValueError(f"invalid shape {self.shape}")
        object.__setattr__(self, "shape", shape)

    @property
    def ndim(self) -> int:
        return len(self.shape)

    @property
    def coords(self) -> list[str]:
        return coord_names(self.ndim)

    @property
    def size(self) -> int:
        return prod(self.shape)

    def with_df(self, df: DataFrame, shape: tuple[int, ...] | None = None) -> "Cells":
        return Cells(df, self.shape if shape is None else shape)

    def select_cells(self) -> DataFrame:
        """The canonical projection ``c0.., value`` (prunes extra columns)."""
        return self.df.select(*self.coords, "value")

    def named(self, *names: str, value: str = "value", digits: int | None = None) -> DataFrame:
        """Rename coordinates for presentation; optionally round the value."""
        if len(names) != self.ndim:
            raise ValueError(f"need {self.ndim} names, got {names}")
        v = F.col("value")
        if digits is not None:
            v = F.round(v, digits)
        return self.df.select(*[F.col(c).alias(n) for c, n in zip(self.coords, names)],
                              v.alias(value))

    @staticmethod
    def from_df(df: DataFrame, coords: list[str], value: str, shape: tuple[int, ...]) -> "Cells":
        """Adopt any table whose columns hold coordinates and a value."""
        if len(coords) != len(shape):
            raise ValueError("one coordinate column per dimension is required")
        out = df.select(*[F.col(c).cast("bigint").alias(n)
                          for c, n in zip(coords, coord_names(len(shape)))],
                        F.col(value).cast("double").alias("value"))
        return Cells(out, shape)


def arrow_matrix(col, width: int | None = None) -> np.ndarray:
    """A ``list<double>`` Arrow column as an ``(n, width)`` array.

    Every row must hold the same number of values (``width`` when given), at
    least one, and neither a row nor a value may be NULL: anything else is a
    shape mismatch and raises ``ValueError``; no value ever moves between rows.
    """
    n = len(col)
    if n == 0:
        return np.zeros((0, width or 0))
    if col.null_count:
        raise ValueError("packed rows: NULL array")
    sizes = np.diff(np.asarray(col.offsets))
    width = int(sizes[0]) if width is None else width
    if width == 0 or (sizes != width).any():
        raise ValueError(f"packed rows: lengths {sorted(set(sizes.tolist()))[:5]}, expected {width or 'at least 1'}")
    flat = col.flatten()
    if flat.null_count:
        raise ValueError("packed rows: NULL value in an array")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(n, width)


def packed_shape(df: DataFrame, array: Column, key: Column | None = None) -> tuple[int, int]:
    """``(rows, width)`` of packed rows, checked in one job: equal widths, no NULL
    array or value and, with a key, keys that are exactly ``0 .. rows - 1``."""
    size = F.size(array)
    bad = array.isNull() | F.exists(array, lambda x: x.isNull())
    aggs = [F.count(F.lit(1)).alias("n"), F.min(size).alias("lo"), F.max(size).alias("hi"), F.max(bad).alias("bad")]
    if key is not None:
        aggs += [F.min(key).alias("first"), F.max(key).alias("last"), F.count_distinct(key).alias("keys")]
    r = df.agg(*aggs).first()
    if not r["n"]:
        raise ValueError("packed rows: empty table")
    if r["bad"] is not False or r["lo"] != r["hi"] or r["lo"] < 1:
        raise ValueError(f"packed rows: widths {r['lo']} to {r['hi']}, NULLs: {r['bad']}")
    if key is not None and (r["first"], r["last"], r["keys"]) != (0, r["n"] - 1, r["n"]):
        raise ValueError(f"packed rows: keys {r['first']} to {r['last']} ({r['keys']} distinct) are not 0 to {r['n'] - 1}")
    return int(r["n"]), int(r["lo"])


def int_div(a: Column, n: int) -> Column:
    """Exact integer quotient (a floating quotient is wrong above 2**53)."""
    return F.call_function("div", a.cast("bigint"), F.lit(int(n)).cast("bigint")) if n != 1 else a.cast("bigint")


def require_same_shape(op: str, a: Cells, b: Cells) -> None:
    if a.shape != b.shape:
        raise ValueError(f"{op}: shapes differ {a.shape} vs {b.shape}")


def fits_broadcast(cells: int) -> bool:
    return cells <= BROADCAST_CELLS


def maybe_broadcast(df: DataFrame, cells: int) -> DataFrame:
    """Broadcast hint only for a side whose size is proven small."""
    return F.broadcast(df) if fits_broadcast(cells) else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition to the cluster's parallelism, but only when the input
    arrives in fewer partitions than there are cores (e.g. one large parquet
    row group). Hash partitioning on ``keys`` (deterministic without the sort
    a round-robin repartition needs); round robin when no key is given.

    Meant for data that is persisted and scanned many times (training rows):
    a one-pass job is better off without the extra shuffle. On large inputs
    read from many files this is a no-op.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)


_GAMMA = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def splitmix(z: np.ndarray) -> np.ndarray:
    """splitmix64 (Steele, Lea & Flood 2014) of unsigned 64-bit integers."""
    with np.errstate(over="ignore"):
        z = z + _GAMMA
        z = (z ^ (z >> np.uint64(30))) * _MIX1
        z = (z ^ (z >> np.uint64(27))) * _MIX2
        return z ^ (z >> np.uint64(31))


def splitmix_into(z: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """:func:`splitmix` in the place of its argument, with a second array of that size."""
    with np.errstate(over="ignore"):
        z += _GAMMA
        np.right_shift(z, np.uint64(30), out=spare)
        for mix, shift in ((_MIX1, 27), (_MIX2, 31)):
            z ^= spare
            z *= mix
            np.right_shift(z, np.uint64(shift), out=spare)
        z ^= spare
    return z


HASH_BITS = 52


def hash_bits(seed: int, *keys: str | Column) -> Column:
    """52 hash bits (a BIGINT in ``[0, 2**52)``) of ``seed|key1|key2...``: the
    first 13 hex digits of the md5. Exact integer, so bit prefixes can be used
    as buckets without any rounding question."""
    parts = [F.lit(str(int(seed)))] + [
        (k if isinstance(k, Column) else F.col(k)).cast("string") for k in keys
    ]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def hash_uniform(seed: int, *keys: str | Column) -> Column:
    """Layout-independent uniform number in [0, 1) from a seed and key columns.

    ``hash_bits / 2**52``. The same number comes out however the data is
    partitioned, and the same expression exists in plain SQL
    (:func:`hash_uniform_sql`), so it can be checked by an oracle and
    recomputed exactly when a task is retried. SQL engines agree on the text
    of integer and string keys; floating-point keys hash consistently within
    Spark, but other engines may print them differently.
    """
    return hash_bits(seed, *keys) / F.lit(float(2 ** HASH_BITS))


def hash_uniform_sql(seed: int, *keys: str) -> str:
    """The same number as :func:`hash_uniform`, as DuckDB SQL text."""
    inner = ", ".join([f"'{int(seed)}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return (f"(CAST('0x' || substr(md5(concat_ws('|', {inner})), 1, 13) AS BIGINT)"
            f" / 4503599627370496.0)")
