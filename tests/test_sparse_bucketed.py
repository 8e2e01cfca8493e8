"""Cells with an implied zero, bucketed cell tables and the streamed loader."""

import contextlib
import io
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from matrix_help import SF001, cells, dense
from tessera.operators import elementwise as ew
from tessera.operators import loss, sparse
from tessera.plans import suite
from tessera.session import scratch_table_path
from tessera.sources import bucketed
from tessera.sources.csv import read_labeled_csv
from tessera.streaming.loading import load_labeled_stream


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@contextlib.contextmanager
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _random(seed, shape, share=0.3):
    rng = np.random.default_rng(seed)
    return np.where(rng.random(shape) < share, rng.normal(size=shape), 0.0)


# ------------------------------------------------------------ implied zeros

def test_sparse_arithmetic_equals_dense(spark):
    x, y = _random(1, (7, 5)), _random(2, (7, 5))
    a, b = sparse.sparsify(cells(spark, x)), sparse.sparsify(cells(spark, y))
    assert a.df.count() == np.count_nonzero(x)
    assert (dense(sparse.densify(a)) == x).all()
    for fn, want in ((sparse.add, x + y), (sparse.sub, x - y), (sparse.mul, x * y)):
        got = fn(a, b)
        assert np.allclose(dense(sparse.densify(got)), want)
        assert got.df.filter("value = 0").count() == 0
    with pytest.raises(ValueError):
        sparse.add(a, sparse.transpose(a))


def test_sparse_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    x, y = np.array([[nan, inf, -0.0, 2.0]]), np.array([[0.0, 0.0, 5.0, -2.0]])
    a, b = sparse.sparsify(cells(spark, x)), sparse.sparsify(cells(spark, y))
    assert a.df.count() == 3
    with np.errstate(invalid="ignore"):
        for fn, want in ((sparse.add, x + y), (sparse.sub, x - y), (sparse.mul, x * y)):
            assert np.allclose(dense(sparse.densify(fn(a, b))), want, equal_nan=True)
    # a stored NULL is not a missing cell
    hole = sparse.SparseCells(spark.createDataFrame([(0, 1, None), (0, 2, 3.0)], "c0 long, c1 long, value double"), (1, 4))
    got = {r["c1"]: r["value"] for r in sparse.densify(sparse.add(hole, b)).df.collect()}
    assert got == {0: 0.0, 1: None, 2: 8.0, 3: -2.0}
    none = sparse.SparseCells(hole.df.limit(0), (2, 2))
    assert (dense(sparse.densify(none)) == 0).all() and sparse.mul(none, none).df.count() == 0


def test_sparse_one_hot_and_its_product(spark):
    lab = spark.createDataFrame([(0, 2), (1, None), (2, 0), (3, 9), (4, 2), (5, -1)], "row bigint, label int")
    hot = sparse.one_hot_sparse(lab, "row", "label", 3, 6)
    assert sorted(map(tuple, hot.df.collect())) == [(0, 2, 1.0), (2, 0, 1.0), (4, 2, 1.0)]
    full = dense(loss.one_hot(lab, "row", "label", 3, 6))
    assert (dense(sparse.densify(hot)) == full).all()
    w = np.random.default_rng(3).normal(size=(3, 4))
    assert np.allclose(dense(sparse.densify(sparse.matmul(hot, cells(spark, w)))), full @ w)
    with pytest.raises(ValueError):
        sparse.matmul(hot, cells(spark, w.T))


def test_sparse_product_deals_out_hot_indices(spark, monkeypatch):
    """An index that a third of the rows hold, beyond the broadcast bound."""
    from tessera import core
    monkeypatch.setattr(core, "BROADCAST_CELLS", 5)
    monkeypatch.setattr(sparse, "HOT_CELLS", 10)
    rng = np.random.default_rng(4)
    codes = np.where(rng.random(90) < 0.4, 1, rng.integers(0, 30, 90))
    x, w = np.zeros((90, 30)), rng.normal(size=(30, 4))
    x[np.arange(90), codes] = rng.normal(size=90)
    a = sparse.sparsify(cells(spark, x))
    assert np.allclose(dense(sparse.densify(sparse.matmul(a, cells(spark, w)))), x @ w)
    left, right = sparse._dealt(a.df.select("c0", F.col("c1").alias("_k"), "value"),
                                cells(spark, w).df.select(F.col("c0").alias("_k"), "c1", "value"))
    hot = left.filter("_k = 1").groupBy("_part").count().collect()
    assert len(hot) > 1 and left.count() == 90
    assert right.filter("_k = 1").select("_part").distinct().count() >= len(hot)
    assert right.filter("_k = 2").select("_part").distinct().count() == 1


# ------------------------------------------------------------ buckets

def test_bucketed_operands_meet_without_a_shuffle(spark):
    x, y = np.random.default_rng(0).normal(size=(40, 6)), np.random.default_rng(1).normal(size=(40, 6))
    (a, first), (b, second) = (bucketed.write_bucketed(cells(spark, v)) for v in (x, y))
    with no_broadcast(spark):
        for op in (ew.add, ew.sub, ew.mul, ew.relu_backward, ew.gelu_backward):
            p = plan(op(a, b).df)
            assert "Exchange" not in p and "SortMergeJoin" in p
        assert np.allclose(dense(ew.add(a, b)), x + y) and np.allclose(dense(ew.mul(a, b)), x * y)
    folder = spark.sql(f"DESCRIBE TABLE EXTENDED {first}").filter("col_name = 'Location'").first()["data_type"]
    for name in (first, second):
        bucketed.drop_bucketed(spark, name)
        assert not spark.catalog.tableExists(name)
    assert not os.path.exists(folder.removeprefix("file:"))


def test_bucket_count_follows_the_shape(spark):
    assert bucketed.bucket_count(spark, (10, 10)) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert bucketed.bucket_count(spark, (10 ** 6, 10 ** 4)) == 2500
    assert bucketed.bucket_count(spark, (10 ** 9, 10 ** 6)) == bucketed.MAX_BUCKETS


# ------------------------------------------------------------ streamed loading

def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stream_and_batch_agree(spark, tmp_path):
    sf = str(tmp_path)
    spark.read.parquet(f"{SF001}/lineitem.parquet").repartition(5).write.parquet(f"{sf}/lineitem.parquet")
    path = suite._broken_lines(spark, sf)
    for modes in ({}, {"bad_number": "zero", "unknown": "drop"}):
        batch = read_labeled_csv(spark, path, 4, suite._FLAGS, **modes)
        stream = load_labeled_stream(spark, path, 4, suite._FLAGS, files_per_batch=2, **modes)
        for want, got in zip(batch, stream):
            assert got.schema.simpleString() == want.schema.simpleString()
            assert want.count() > 0 and _rows(got) == _rows(want)


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    folder, out = tmp_path / "in", scratch_table_path(spark, "csv-stream-test")
    folder.mkdir()
    samples, rejects = load_labeled_stream(spark, str(folder), 1, {"x": 0}, out=out)
    assert samples.count() == 0 and rejects.count() == 0 and samples.columns == ["id", "f0", "label_name", "label"]
    (folder / "a.csv").write_text("id,v,name\n1,2.5,x\n2,,x\n")
    samples, rejects = load_labeled_stream(spark, str(folder), 1, {"x": 0}, out=out)
    assert _rows(samples) == [("1", 2.5, "x", 0)] and [r["id"] for r in rejects.collect()] == ["2"]
    (folder / "b.csv").write_text("id,v,name\n3,7,x\n")
    again, _ = load_labeled_stream(spark, str(folder), 1, {"x": 0}, out=out)
    assert _rows(again) == [("1", 2.5, "x", 0), ("3", 7.0, "x", 0)]


def test_stream_stops_at_an_unknown_label(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v,name\n1,2.5,who\n")
    with pytest.raises(Exception, match="unknown label"):
        load_labeled_stream(spark, str(tmp_path), 1, {"x": 0}, unknown="error")
