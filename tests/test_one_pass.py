"""One-pass forms: density by words of bits, long softmax slices by bands, the row cap."""

import contextlib
import io
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from matrix_help import SF001, cells, dense
from tessera.core import Cells
from tessera.operators import shape, softmax
from tessera.plans import suite


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _seen(spark, rows, shp):
    names = ", ".join(f"c{i} bigint" for i in range(len(shp)))
    df = spark.createDataFrame(rows, names + ", value double").repartition(3)
    return shape.shape_of(Cells(df, shp)).first().asDict()


def test_density_counts(spark):
    full = [(i, j, 1.0) for i in range(5) for j in range(70)]
    want = {"rank": 2, "d0": 5, "d1": 70, "n_cells": 350, "n_distinct": 350, "dense": True}
    assert _seen(spark, full, (5, 70)) == want
    # a hole filled by a repeated cell, a NULL value, cells outside the shape, NULL coordinates
    assert _seen(spark, full[:-1] + full[:1], (5, 70)) == {**want, "n_distinct": 349, "dense": False}
    assert _seen(spark, full[:-1] + [(4, 69, None)], (5, 70)) == {**want, "dense": False}
    out = full + [(9, 0, 1.0), (9, 0, 2.0), (0, -3, 1.0)]
    assert _seen(spark, out, (5, 70)) == {**want, "d0": 10, "n_cells": 353, "n_distinct": 352, "dense": False}
    none = full + [(None, 0, 1.0), (None, None, 1.0)]
    assert _seen(spark, none, (5, 70)) == {**want, "n_cells": 352, "dense": False}


def test_density_of_empty_and_huge_shapes(spark):
    assert _seen(spark, [], (2, 2)) == {"rank": 2, "d0": None, "d1": None, "n_cells": 0, "n_distinct": 0,
                                        "dense": False}
    big = 1 << 33
    got = _seen(spark, [(big - 1, big - 1, 1.0), (0, 0, 1.0), (0, 0, 1.0)], (big, big))
    assert (got["d0"], got["n_cells"], got["n_distinct"], got["dense"]) == (big, 3, 2, False)
    edge = (1 << 63) - 1
    got = _seen(spark, [(edge - 1, 1.0), (63, 1.0), (64, 1.0)], (edge,))
    assert (got["d0"], got["n_distinct"]) == (edge, 3)


def test_density_shuffles_words(spark):
    """At most one shuffled row per 64 neighbouring cells, and no distinct count over cells."""
    n = 6400
    a = Cells(spark.range(0, n, numPartitions=4).select(F.col("id").alias("c0"), F.lit(1.0).alias("value")), (n,))
    p = plan(shape.shape_of(a))
    assert "count(distinct" not in p and "bit_or" in p and "SortAggregate" not in p
    assert len(re.findall(r"Exchange \(\d+\)", p)) == 2
    assert shape.shape_of(a).first()["dense"]


def _want(x, axis):
    with np.errstate(invalid="ignore", over="ignore"):
        e = np.exp(x - x.max(axis=axis, keepdims=True))
        return e / e.sum(axis=axis, keepdims=True)


@pytest.mark.parametrize("spread", [1.0, 40.0, 1e3, 1e9, 1e300])
def test_bands_equal_the_maximum_form(spark, spread):
    x = np.random.default_rng(5).normal(size=(60, 4)) * spread
    x[7] = x[3]
    for axis in (0, 1):
        got = dense(softmax.softmax(cells(spark, x), axis, method="grouped"))
        assert np.allclose(got, _want(x, axis), rtol=1e-12, atol=1e-300)
    v = dense(softmax.softmax(cells(spark, x[:, 0]), 0, method="grouped"))
    assert np.allclose(v, _want(x[:, 0], 0), rtol=1e-12, atol=1e-300)


def test_bands_at_their_edges(spark):
    x = np.array([[31.999999, 32.0, 32.000001], [-32.0, 96.0, 95.999], [0.0, -0.0, 64.0], [-1e-20, -800.0, -744.0], [63.999, 64.0, 192.0], [-64.0, -64.001, 0.0]])
    assert np.allclose(dense(softmax.softmax(cells(spark, x), 1, method="grouped")), _want(x, 1), rtol=1e-12)


def test_bands_with_infinities_and_nan(spark):
    inf, nan = float("inf"), float("nan")
    x = np.array([[1.0, -inf, 2.0], [-inf, -inf, -inf], [inf, 0.0, 1.0], [nan, 1.0, 2.0], [-inf, 700.0, -inf]])
    got = dense(softmax.softmax(cells(spark, x), 1, method="grouped"))
    assert np.allclose(got, _want(x, 1), equal_nan=True)
    same = dense(softmax.softmax(cells(spark, x), 1, method="window"))
    assert np.allclose(got, same, equal_nan=True)


def test_long_slices_read_the_cells_twice(spark):
    """One aggregate of the cells and one join back; before there were two of each."""
    p = plan(suite.q_softmax_axis0_grouped(spark, SF001))
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 2
    assert len(re.findall(r"^\(\d+\) \w*Join", p, re.M)) == 1


def test_row_cap_of_a_shuffled_input(spark, tmp_path):
    """Rows that come out of a shuffle in another order, or in other partitions, the second time."""
    from tessera.operators.split import head
    noisy = spark.range(0, 5000, numPartitions=4).withColumn("r", F.rand()).repartition(9, "r")
    got = head(noisy, 700)
    rows = [r["id"] for r in got.collect()]
    assert len(rows) == len(set(rows)) == 700 and rows == [r["id"] for r in got.collect()]
    assert got.columns == ["id", "r"]
    assert head(noisy, 0).count() == 0 and head(noisy, 10_000).count() == 5000
    assert head(noisy.filter("id < 0"), 5).count() == 0
    # the numbering's columns give way to those of the input
    clash = noisy.select(F.col("id").alias("_part"), F.lit(None).cast("string").alias("_pos"))
    assert head(clash, 30).columns == ["_part", "_pos"] and head(clash, 30).count() == 30
