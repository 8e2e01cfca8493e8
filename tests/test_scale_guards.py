"""The size guards and automatic choices that keep plans bounded at scale."""

import contextlib
import io

import numpy as np
import pytest

from matrix_help import SF001, cells, dense
from tessera.core import Cells
from tessera.operators import linalg, softmax
from tessera.sources import fill
from tessera.sources.packing import cells_to_rows


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_generated_partitions_grow_with_the_matrix(spark):
    small = fill.ones(spark, (10, 10)).df.rdd.getNumPartitions()
    big = fill.ones(spark, (10 ** 7, 10)).df.rdd.getNumPartitions()
    assert small == 1 and big == 25  # 4M cells per task


def test_wide_rows_are_not_packed(spark, monkeypatch):
    import tessera.sources.packing as packing
    monkeypatch.setattr(packing, "BROADCAST_CELLS", 3)
    with pytest.raises(ValueError):
        cells_to_rows(cells(spark, np.ones((2, 4))))


def test_shipped_matrix_is_size_checked(spark, monkeypatch):
    rows = spark.createDataFrame([(0, [1.0, 2.0])], "r bigint, x array<double>")
    monkeypatch.setattr(linalg, "BROADCAST_CELLS", 3)
    with pytest.raises(ValueError):
        linalg.matmul_rows(rows, "r", "x", np.ones((2, 2)))


def test_long_slices_switch_to_grouped_softmax(spark, monkeypatch):
    x = fill.rand_uniform(spark, (4, 50), 3)
    want = dense(softmax.softmax(x, 1))
    monkeypatch.setattr(softmax, "WINDOW_SLICE_MAX", 10)
    s = softmax.softmax(x, 1)
    assert "Window" not in _plan(s.df)
    assert np.allclose(dense(s), want, atol=1e-15)


def test_product_of_two_large_sides_uses_blocks(spark, monkeypatch):
    import tessera.core as core
    a = fill.rand_uniform(spark, (40, 6), 1)
    b = fill.rand_uniform(spark, (6, 30), 2)
    monkeypatch.setattr(core, "BROADCAST_CELLS", 100)
    out = linalg.matmul(a, b, block=8)
    p = _plan(out.df)
    assert "MapInArrow" in p and "cell" in p and "Join" not in p
    assert np.allclose(dense(out), dense(a) @ dense(b), atol=1e-12)


def test_broadcast_only_below_the_bound(spark, monkeypatch):
    import tessera.core as core
    e = Cells(spark.read.parquet(f"{SF001}/embeddings.parquet").selectExpr(
        "vec_id AS c0", "0L AS c1", "1.0D AS value"), (500, 1))
    w = fill.ones(spark, (1, 3))
    assert "broadcast" in _plan(linalg.matmul(e, w, method="cells").df).lower()
    monkeypatch.setattr(core, "BROADCAST_CELLS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(linalg.matmul(e, w, method="cells").df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spread_is_a_noop_on_parallel_input(spark):
    from tessera.core import spread
    many = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism * 2)
    assert spread(many, "id") is many
    one = spark.range(0, 1000, numPartitions=1)
    assert spread(one, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_checkpoint_folder_comes_from_the_session(spark):
    from tessera.session import checkpoint_dir, scratch_table_path
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    current = checkpoint_dir(spark)
    assert current == spark.sparkContext.getCheckpointDir()
    if configured:
        assert configured.rstrip("/") in current
    assert scratch_table_path(spark, "t").startswith(current)
