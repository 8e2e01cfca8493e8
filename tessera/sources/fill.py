"""Constant and random matrices generated on the executors from ``spark.range``."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.core import Cells, coord_names, hash_uniform, prod


# Cells generated per task (~100 MB of rows): the partition count grows with
# the matrix, so no task ever generates an unbounded share of it.
ROWS_PER_PARTITION = 4_000_000


def _grid(spark: SparkSession, shape: tuple[int, ...], partitions: int | None = None):
    """One row per flat index with its row-major coordinates."""
    n = prod(shape)
    parts = partitions or max(1, math.ceil(n / ROWS_PER_PARTITION))
    flat = spark.range(0, n, numPartitions=parts).withColumnRenamed("id", "_flat")
    strides = [prod(shape[d + 1:]) for d in range(len(shape))]
    cols = [
        (F.floor(F.col("_flat") / F.lit(st)) % F.lit(dim)).cast("bigint").alias(name)
        for name, st, dim in zip(coord_names(len(shape)), strides, shape)
    ]
    return flat.select("_flat", *cols)


def full(spark: SparkSession, shape: tuple[int, ...], value: float) -> Cells:
    g = _grid(spark, tuple(shape))
    return Cells(g.select(*coord_names(len(shape)), F.lit(float(value)).alias("value")), tuple(shape))


def ones(spark: SparkSession, shape: tuple[int, ...]) -> Cells:
    return full(spark, shape, 1.0)


def zeros(spark: SparkSession, shape: tuple[int, ...]) -> Cells:
    return full(spark, shape, 0.0)


def rand_uniform(spark: SparkSession, shape: tuple[int, ...], seed: int) -> Cells:
    """Uniform in [-1, 1) keyed by (seed, flat index): same numbers for any
    partitioning, and the same on a retried task."""
    g = _grid(spark, tuple(shape))
    value = F.lit(2.0) * hash_uniform(seed, "_flat") - F.lit(1.0)
    return Cells(g.select(*coord_names(len(shape)), value.alias("value")), tuple(shape))
