"""Malformed input is an error or a defined result, never a shifted or lost value."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from matrix_help import SF001, cells, dense
from tessera.core import Cells, int_div
from tessera.operators import linalg, loss, shape
from tessera.operators.attention import _tile_partials, attention
from tessera.plans import layers, mlp
from tessera.sources.csv import encode_labels, read_labeled_csv
from tessera.sources.packing import rows_to_cells

BAD = {
    "ragged": [(0, [1.0, 2.0, 3.0, 4.0]), (1, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])],
    "null row": [(0, [1.0, 2.0, 3.0, 4.0]), (1, None)],
    "null value": [(0, [1.0, 2.0, 3.0, 4.0]), (1, [1.0, None, 3.0, 4.0])],
    "empty row": [(0, [1.0, 2.0, 3.0, 4.0]), (1, [])],
}


def _rows(spark, kind):
    return spark.createDataFrame(BAD[kind], "r bigint, x array<double>").coalesce(1)


@pytest.mark.parametrize("kind", BAD)
def test_bad_arrays_raise(spark, kind):
    df = _rows(spark, kind)
    params = layers.linear_init(spark, "l1", 4, 2, 1)
    net = mlp.mlp_init(spark, 4, 3, 2, 1)
    labelled = df.withColumn("y", F.lit(0))
    for run in (
        lambda: rows_to_cells(df, "r", "x"),
        lambda: linalg.gram_rows(df, "x"),
        lambda: linalg.gram_rows(df, "x", width=4).df.collect(),
        lambda: linalg.matmul_rows(df, "r", "x", np.ones((4, 2))).collect(),
        lambda: layers.linear_forward(params, "l1", df, "r", "x").collect(),
        lambda: layers.linear_backward(params, "l1", df.withColumn("dy", F.array(F.lit(1.0), F.lit(2.0))), None, "r",
                                       "x", "dy")[0].collect(),
        lambda: attention(df, id_col="r", q_col="x").collect(),
        lambda: mlp.mlp_gradients(net, labelled, "x", "y").collect(),
        lambda: mlp.mlp_predict(net, df, "x").collect(),
        lambda: mlp.mlp_evaluate(net, labelled, "x", "y").collect(),
        lambda: mlp.mlp_train(labelled, labelled, "x", "y", hidden=2, classes=2, epochs=1)):
        with pytest.raises(Exception, match="packed rows"):
            run()


@pytest.mark.parametrize("keys", [(0, 2), (1, 2), (0, 0), (-1, 0)])
def test_sparse_or_repeated_keys_raise(spark, keys):
    df = spark.createDataFrame([(k, [1.0, 2.0]) for k in keys], "r bigint, x array<double>")
    with pytest.raises(ValueError, match="keys"):
        rows_to_cells(df, "r", "x")


def test_unknown_and_missing_labels(spark):
    p = cells(spark, [[0.9, 0.1], [0.2, 0.8], [0.5, 0.5], [0.6, 0.4]])
    lab = spark.createDataFrame([(0, 0), (1, None), (2, -1)], "row bigint, label int")
    assert np.isclose(loss.cross_entropy(p, lab).first()[0], -np.log(0.9 + 1e-8) / 4)
    t = dense(loss.one_hot(lab, "row", "label", 2, 3))
    assert (t == [[1, 0], [0, 0], [0, 0]]).all()
    g = dense(loss.softmax_xent_grad(p, lab))
    assert np.allclose(g, (dense(p) - [[1, 0], [0, 0], [0, 0], [0, 0]]) / 4)
    pred = spark.createDataFrame([(0, 0), (1, 1), (2, 0), (3, 0)], "row bigint, k bigint")
    assert loss.accuracy(pred, lab).first()[0] == 25.0
    rows = spark.createDataFrame([([0.9, 0.1], 0), ([0.2, 0.8], None), ([0.5, 0.5], -1), ([0.6, 0.4], 7)],
                                 "p array<double>, label int")
    assert np.isclose(loss.cross_entropy_rows(rows, "p", "label").first()[0], -np.log(0.9 + 1e-8) / 4)
    assert loss.accuracy_rows(rows, "p", "label").first()[0] == 25.0


def test_shape_of_negative_coordinates(spark):
    df = spark.createDataFrame([(-1, 1.0), (0, 1.0), (2, 1.0)], "c0 bigint, value double")
    assert not shape.shape_of(Cells(df, (3,))).first()["dense"]


def test_integer_division_is_exact(spark):
    big = (1 << 60) + 5
    assert spark.range(1).select(int_div(F.lit(big), 3)).first()[0] == big // 3


def test_null_groups_attend_to_each_other(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, None, [0.0, 1.0]), (2, None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "i bigint, g int, x array<double>")
    got = {(r["i"], r["j"]): r["value"] for r in attention(df, id_col="i", q_col="x", group="g").collect()}
    assert {k[0] for k in got} == {0, 1, 2}
    x = np.array([r[2] for r in rows[1:]])
    s = np.exp(x @ x.T / np.sqrt(2))
    want = s / s.sum(axis=1, keepdims=True) @ x
    assert np.allclose([[got[i, 0], got[i, 1]] for i in (1, 2)], want)


def test_attention_holds_one_query_block(spark):
    import pyarrow as pa
    kind = pa.list_(pa.struct([("q_id", pa.int64()), ("q", pa.list_(pa.float64()))]))
    block = lambda ids, n: pa.array([[{"q_id": i, "q": [float(i), 1.0]} for i in ids]] * n, kind)
    n = 3
    held = pa.RecordBatch.from_arrays(
        [pa.array([{"v": 0}] * (2 * n)), pa.array([0] * n + [1] * n), pa.concat_arrays([block([0, 1], n), block([2, 3], n)]),
         pa.concat_arrays([block([0, 1], n), block([2, 3], n)])], ["g", "_b", "qblock", "kblock"])
    out = _tile_partials(None)(iter([held]))
    first = next(out)
    assert first.column("q_id").to_pylist() == [0, 1]  # emitted before the second block is finished
    assert sum(b.num_rows for b in out) == 2


# ------------------------------------------------------------ block product

def test_grid_splits_the_inner_dimension():
    gi, gj, gk = linalg.grid(64, 10 ** 9, 64, 128)
    assert gk >= 64 and gi == gj == 1
    gi, gj, gk = linalg.grid(10 ** 5, 10 ** 5, 10 ** 5, 128)
    assert max(gi, gj) < 100  # copies of a cell, not one per block


def test_tall_product_plans_many_partitions(spark):
    x = Cells(spark.range(1).selectExpr("id AS c0", "id AS c1", "1.0D AS value"), (10 ** 9, 64))
    parts = linalg._products_block(shape.transpose(x), x, 128)
    assert parts.rdd.getNumPartitions() >= 64  # planned, not run


def test_block_product_of_any_grid(spark, monkeypatch):
    monkeypatch.setattr(linalg, "PANEL_CELLS", 40)
    rng = np.random.default_rng(0)
    a, b = rng.standard_normal((13, 37)), rng.standard_normal((37, 11))
    got = dense(linalg.matmul(cells(spark, a), cells(spark, b), method="block", block=3))
    assert np.prod(linalg.grid(13, 37, 11, 3)) > 8 and np.allclose(got, a @ b)


def test_wide_gram_stays_row_local(spark, monkeypatch):
    monkeypatch.setattr(linalg, "BROADCAST_CELLS", 20)
    x = np.random.default_rng(1).standard_normal((30, 9))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(4)
    assert np.allclose(dense(linalg.gram_rows(df, "x")), x.T @ x)


def test_large_layers_take_the_grid_product(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x, g = rng.standard_normal((7, 6)), rng.standard_normal((7, 5))
    df = spark.createDataFrame([(3 * i, x[i].tolist(), g[i].tolist()) for i in range(7)],
                               "r bigint, x array<double>, dy array<double>")
    params = layers.linear_init(spark, "l1", 6, 5, 3)

    def run():
        fwd = dict(layers.linear_forward(params, "l1", df, "r", "x").collect())
        grads, dx = layers.linear_backward(params, "l1", df, None, "r", "x", "dy")
        return (np.array([fwd[3 * i] for i in range(7)]),
                {(r["name"], r["i"], r["j"]): r["grad"] for r in grads.collect()}, dict(dx.collect()))

    small = run()
    monkeypatch.setattr(layers, "BROADCAST_CELLS", 10)
    large = run()
    assert np.allclose(small[0], large[0], atol=1e-9)
    assert small[1].keys() == large[1].keys() and all(abs(small[1][k] - large[1][k]) < 1e-9 for k in small[1])
    assert all(np.allclose(small[2][k], large[2][k], atol=1e-9) for k in small[2])


# ------------------------------------------------------------ loader

def _csv(text):
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-csv-", dir="/tmp"), "a.csv")
    with open(path, "w") as f:
        f.write(text)
    return path


def test_rows_of_another_length_keep_their_line(spark):
    path = _csv("id,a,b,c,d,name\n1,1,2,3,4,Iris-setosa\n2,1,2,3,4,5,Iris-setosa\n3,1,2\n")
    samples, rejects = read_labeled_csv(spark, path)
    assert [r["id"] for r in samples.collect()] == ["1"]
    got = {r["id"]: (r["reason"], r["line"]) for r in rejects.collect()}
    assert got["2"] == ("too many fields", "2,1,2,3,4,5,Iris-setosa") and got["3"] == ("missing label", "3,1,2")


def test_empty_mapping_knows_nothing(spark):
    df = encode_labels(spark.createDataFrame([("a",), (None,)], "n string"), "n", {})
    assert [r["label"] for r in df.collect()] == [-1, -1]


def test_row_cap_is_the_first_rows(spark):
    from tessera.operators.split import head
    df = spark.range(0, 100, numPartitions=7)
    got = head(df, 40)
    assert [r["id"] for r in got.collect()] == list(range(40))
    assert got.rdd.getNumPartitions() == 7 and head(df, 1000).count() == 100


# ------------------------------------------------------------ storage

def test_stream_of_a_table_of_many_files(spark):
    from tessera.plans import suite
    from tessera.streaming.scoring import predict_stream
    folder = tempfile.mkdtemp(prefix="tessera-parts-", dir="/tmp")
    spark.read.parquet(f"{SF001}/lineitem.parquet").repartition(5).write.parquet(f"{folder}/lineitem.parquet")
    stats, params, keep = suite.lineitem_stats(spark, SF001), suite._fixed_params(spark), ["l_orderkey", "l_linenumber"]
    got = predict_stream(spark, folder, "lineitem", lambda df: suite.lineitem_features(df, stats), params, keep=keep)
    assert got.count() == 6000


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from tessera import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_training_keeps_rows_once(spark):
    from tessera.plans import suite
    sc = spark.sparkContext._jsc.sc()
    before, most = sc.getPersistentRDDs().size(), []
    totals = mlp._totals

    def counted(*a, **k):
        most.append(sc.getPersistentRDDs().size() - before)
        return totals(*a, **k)

    mlp._totals, keep = counted, totals
    try:
        suite.q_mlp_train(spark, SF001, epochs=1, eval_every=1)
    finally:
        mlp._totals = keep
    assert max(most) <= 2
