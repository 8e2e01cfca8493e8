"""Hand-derived numbers (FIXTURES.md §4), including the edge values of
SURVEY §1.4: NaN, -0.0, ties, unknown labels."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from matrix_help import SF01, cells, dense
from tessera.core import Cells
from tessera.operators import elementwise as ew
from tessera.operators import loss, softmax
from tessera.operators.attention import attention_cells
from tessera.plans import layers
from tessera.sources import csv


def test_attention_two_by_three(spark):
    Q = cells(spark, [[1, 0, 0], [0, 1, 0]])
    K = cells(spark, [[1, 2, 3], [4, 5, 6]])
    V = cells(spark, [[7, 8, 9], [10, 11, 12]])
    out = dense(attention_cells(Q, K, V))
    expect = [9.549023659, 10.549023659, 11.549023659]
    assert np.allclose(out, [expect, expect], atol=1e-8)


@pytest.mark.parametrize("method", ["window", "grouped"])
def test_softmax_vector(spark, method):
    out = dense(softmax.softmax(cells(spark, [1, 2, 3]), 0, method=method))
    assert np.allclose(out, [0.09003057, 0.24472847, 0.66524096], atol=1e-8)


def test_gelu_and_gradient(spark):
    xs = [-2, -1, 0, 0.5, 1, 2]
    g = dense(ew.gelu(cells(spark, xs)))
    assert np.allclose(g, [-0.045402306, -0.158808009, 0, 0.345714010, 0.841191991, 1.954597694],
                       atol=1e-8)
    d = dense(ew.gelu_backward(cells(spark, xs), cells(spark, [1.0] * 6)))
    assert np.allclose(d, [-0.086099257, -0.082964084, 0.5, 0.867369904, 1.082964084, 1.086099257],
                       atol=1e-8)


def test_relu_edges(spark):
    out = dense(ew.relu(cells(spark, [-1, -0.0, 0, 2, float("nan")])))
    assert out[0] == 0 and out[2] == 0 and out[3] == 2
    assert out[1] == 0 and math.copysign(1, out[1]) == -1  # -0.0 passes through
    assert math.isnan(out[4])


def test_relu_backward_nan_is_not_positive(spark):
    out = dense(ew.relu_backward(cells(spark, [-1, 1, float("nan")]), cells(spark, [9, 9, 9])))
    assert list(out) == [0, 9, 0]


def test_argmax_first_wins_and_nan(spark):
    p = cells(spark, [[0.5, 0.5, 0.0], [0.1, float("nan"), 0.2], [float("nan"), 3.0, 1.0],
                      [1.0, 2.0, 2.0]])
    got = {r["c0"]: r["k"] for r in softmax.argmax_rows(p).collect()}
    assert got == {0: 0, 1: 2, 2: 0, 3: 1}


def _params(spark, W, b, layer="l1"):
    return layers.params_from_arrays(spark, {layer: (np.array(W, float), np.array(b, float))})


def _rows(spark, mat, col="x"):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(mat)],
                                 f"r bigint, {col} array<double>")


def _collect_rows(df, col):
    return np.array([r[col] for r in sorted(df.collect(), key=lambda r: r["r"])])


def test_linear_forward_and_backward(spark):
    params = _params(spark, [[1, 0, -1], [2, 1, 0]], [0.5, -0.5, 0])
    X = _rows(spark, [[1, 2], [3, 4], [5, 6]])
    y = _collect_rows(layers.linear_forward(params, "l1", X, "r", "x"), "out")
    assert np.allclose(y, [[5.5, 1.5, -1], [11.5, 3.5, -3], [17.5, 5.5, -5]])
    dY = _rows(spark, np.eye(3), "dy")
    grads, dx = layers.linear_backward(params, "l1", X, dY, "r", "x", "dy")
    g = {(r["name"], r["i"], r["j"]): r["grad"] for r in grads.collect()}
    assert np.allclose([[g[("W", i, j)] for j in range(3)] for i in range(2)], [[1, 3, 5], [2, 4, 6]])
    assert np.allclose([g[("b", 0, j)] for j in range(3)], [1, 1, 1])
    assert np.allclose(_collect_rows(dx, "dx"), [[1, 2], [0, 1], [-1, 0]])


def test_adam_two_steps(spark):
    params = _params(spark, [[0.5]], [0.0])
    t = 0
    expect = [(0.490000001, 0.01, 1e-5), (0.494941899, -0.021, 9.999e-5)]
    for grad, (w, m, v) in zip([0.1, -0.3], expect):
        params = params.withColumn("grad", F.when(F.col("name") == "W", F.lit(grad)).otherwise(0.0))
        params, t = layers.adam_step(params, t, lr=0.01)
        row = params.filter("name = 'W'").first()
        assert row["value"] == pytest.approx(w, abs=1e-9)
        assert row["m"] == pytest.approx(m, abs=1e-12)
        assert row["v"] == pytest.approx(v, abs=1e-12)
    assert t == 2


def test_unknown_label_code_one_hot_and_loss(spark):
    df = spark.createDataFrame([(0, "Iris-setosa"), (1, "weird")], "row bigint, name string")
    enc = csv.encode_labels(df, "name", csv.IRIS_LABELS)
    codes = {r["row"]: r["label"] for r in enc.collect()}
    assert codes == {0: 0, 1: -1}
    oh = dense(loss.one_hot(enc, "row", "label", 3))
    assert list(oh[1]) == [0, 0, 0] and list(oh[0]) == [1, 0, 0]
    p = cells(spark, [[0.2, 0.3, 0.5], [0.2, 0.3, 0.5]])
    ce = loss.cross_entropy(p, enc.filter("row = 1")).first()["loss"]
    assert ce == 0.0  # the unknown row contributes nothing (and n = 2 from the shape)


def test_dropout_keeps_and_scales(spark):
    a = Cells(spark.range(0, 10000).select(F.col("id").alias("c0"), F.lit(1.0).alias("value")),
              (10000,))
    vals = [r["value"] for r in ew.dropout(a, 0.25, 3).df.collect()]
    zeros = sum(1 for v in vals if v == 0.0)
    assert 2200 < zeros < 2800
    assert all(v == 0.0 or v == pytest.approx(1 / 0.75) for v in vals)


def test_split_exact_and_equal_to_row_number(spark):
    from tessera.core import hash_uniform
    from tessera.operators import split
    from pyspark.sql import Window
    orders = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey")
    flagged = split.train_val_split(orders, ["o_orderkey"], 0.8, 7)
    sizes = {r["is_train"]: r["n"] for r in split.split_sizes(flagged).collect()}
    assert sizes == {True: 12000, False: 3000}
    ref = orders.withColumn("_u", hash_uniform(7, "o_orderkey")).withColumn(
        "rn", F.row_number().over(Window.orderBy("_u", "o_orderkey")))
    ref_train = {r["o_orderkey"] for r in ref.filter("rn <= 12000").collect()}
    got_train = {r["o_orderkey"] for r in flagged.filter("is_train").collect()}
    assert ref_train == got_train
