"""Packed block matrices, products of them, and the network whose weights stay tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from matrix_help import cells, dense
from tessera.core import Cells
from tessera.operators import blocks as B
from tessera.operators import linalg
from tessera.plans import mlp, resume, wide

RNG = np.random.default_rng(3)


def back(x):
    return dense(B.to_cells(x))


@pytest.mark.parametrize("shape,block", [((7, 5), (3, 2)), ((1, 1), (4, 4)), ((6, 8), (3, 4)), ((9, 2), (9, 2))])
def test_cells_to_blocks_and_back(spark, shape, block):
    a = RNG.standard_normal(shape)
    c = cells(spark, a)
    mixed = Cells(c.df.repartition(5), shape)  # pieces of blocks from many tasks
    assert np.array_equal(back(B.from_cells(c, block)), a) and np.array_equal(back(B.from_cells(mixed, block)), a)
    assert np.array_equal(back(B.transposed(B.from_cells(c, block))), a.T)


def test_ordered_cells_are_packed_whole(spark):
    """Blocks that one task reads in full carry no places."""
    p = B.pieces(cells(spark, RNG.standard_normal((6, 4))).df.coalesce(1), (6, 4), (3, 2)).collect()
    assert len(p) == 4 and all(len(r["at"]) == 0 and len(r["values"]) == 6 for r in p)


def test_cells_outside_the_shape_raise(spark):
    c = Cells(cells(spark, np.ones((3, 3))).df, (3, 2))
    with pytest.raises(Exception, match="outside"):
        B.from_cells(c, (2, 2)).df.collect()
    with pytest.raises(Exception, match="NULL"):
        B.from_cells(Cells(c.df.withColumn("value", F.lit(None).cast("double")), (3, 3)), (2, 2)).df.collect()


def test_missing_cells_are_zero(spark):
    a = np.where(RNG.random((8, 6)) < 0.3, 1.5, 0.0)
    c = cells(spark, a)
    sparse = Cells(c.df.where("value <> 0"), a.shape)
    got = B.matmul_blocks(sparse, cells(spark, np.eye(6)), block=(3, 2, 4))
    out = np.zeros(a.shape)
    for r in B.to_cells(got).df.collect():
        out[r["c0"], r["c1"]] = r["value"]
    assert np.array_equal(out, a)


@pytest.mark.parametrize("panel", [30, 10 ** 6])
@pytest.mark.parametrize("least", [1, 10 ** 9])
def test_products_of_any_grid(spark, monkeypatch, panel, least):
    """Whole and partial result panels, one partition and many, cells and blocks, with an accumulator."""
    monkeypatch.setattr(linalg, "PANEL_CELLS", panel)
    monkeypatch.setattr(B, "LEAST_CELLS", least)
    a, b, c = RNG.standard_normal((11, 23)), RNG.standard_normal((23, 9)), RNG.standard_normal((11, 9))
    x, y = cells(spark, a), cells(spark, b)
    assert np.allclose(back(B.matmul_blocks(x, y, block=(3, 4, 2))), a @ b)
    bx, by = B.from_cells(x, (3, 4)), B.from_cells(y, (4, 2))
    assert np.allclose(back(B.matmul_blocks(bx, by, cells(spark, c))), a @ b + c)
    assert np.allclose(back(B.matmul_blocks(B.transposed(bx), bx)), a.T @ a)


def test_inner_blocks_must_agree(spark):
    a, b = B.from_cells(cells(spark, np.ones((4, 6))), (2, 3)), B.from_cells(cells(spark, np.ones((6, 4))), (2, 2))
    with pytest.raises(ValueError, match="inner blocks"):
        B.matmul_blocks(a, b)


def test_partitions_follow_bytes_not_grid_cells(spark):
    """100,000 cubed is cut into 262,144 grid cells, but not into so many partitions."""
    x = Cells(spark.range(0).selectExpr("id AS c0", "id AS c1", "1.0D AS value"), (10 ** 5, 10 ** 5))
    g = linalg.grid(*[10 ** 5] * 3, 128)
    parts = linalg._products_block(x, x, 128).rdd.getNumPartitions()
    wave = 4 * spark.sparkContext.defaultParallelism
    moved = 10 ** 10 * (g[0] + g[1])
    assert math.prod(g) > 100_000 and parts <= wave * min(B.WAVES[1], math.ceil(8 * moved / (wave * B.PARTITION_BYTES)))
    # however large the matrix is said to be
    assert B._parts(spark, 10 ** 18, 10 ** 15) == wave * B.WAVES[1]


def test_rows_to_blocks_and_back(spark):
    a = RNG.standard_normal((17, 7))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(a)], "row bigint, x array<double>").repartition(4)
    x = B.from_rows(df, "row", "x", a.shape, (5, 3))
    got = {r["row"]: r["out"] for r in B.to_rows(x).collect()}
    assert np.array_equal(np.array([got[i] for i in range(17)]), a)


def test_numbering_is_dense_and_stable(spark):
    df = spark.createDataFrame([(k * k - 50, f"v{k}") for k in range(101)], "k bigint, v string")
    a, n = B.numbered(df.repartition(7), ["k"])
    b, _ = B.numbered(df.repartition(3), ["k"])
    rows = {r["k"]: r["row"] for r in a.collect()}
    assert n == 101 and sorted(rows.values()) == list(range(101)) and rows == {r["k"]: r["row"] for r in b.collect()}
    assert B.numbered(df.limit(0), ["k"])[1] == 0


def test_matmul_wide_keys_may_be_negative_or_text(spark):
    a, w, bias = RNG.standard_normal((9, 5)), RNG.standard_normal((5, 4)), RNG.standard_normal(4)
    df = spark.createDataFrame([(f"k{i - 4}", r.tolist()) for i, r in enumerate(a)], "k string, x array<double>")
    got = dict(linalg.matmul_wide(df, "k", "x", cells(spark, w), cells(spark, bias)).collect())
    assert np.allclose(np.array([got[f"k{i - 4}"] for i in range(9)]), a @ w + bias)


# ------------------------------------------------------------ the network

def data(spark, n=60, d=7, k=4, seed=5):
    rng = np.random.default_rng(seed)
    x, y = rng.standard_normal((n, d)), rng.integers(-1, k, n)
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(n)], "id bigint, x array<double>, y int")
    return x, y, df.repartition(4)


def numpy_run(x, y, P, epochs, masks=None, p_drop=0.0, lr=0.01):
    """Losses and weights of the plain loop."""
    from tessera.plans.layers import adam_numpy
    P, m, v = [p.copy() for p in P], [np.zeros_like(p) for p in P], [np.zeros_like(p) for p in P]
    losses = []
    for t in range(epochs):
        W1, b1, W2, b2 = P
        a = np.maximum(x @ W1 + b1, 0)
        if masks is not None:
            a = np.where(masks(t + 1), a / (1 - p_drop), 0)
        z = a @ W2 + b2
        e = np.exp(z - z.max(1, keepdims=True))
        p = e / e.sum(1, keepdims=True)
        hit = np.flatnonzero(y >= 0)
        losses.append(-np.log(p[hit, y[hit]] + 1e-8).sum() / len(x))
        dz = p.copy()
        dz[hit, y[hit]] -= 1
        dh = np.where(a > 0, dz @ W2.T, 0)
        grads = [x.T @ dh, dh.sum(0), a.T @ dz, dz.sum(0)]
        new = [adam_numpy(w, g / len(x), mm, vv, t, lr, 0.9, 0.999, 1e-8) for w, g, mm, vv in zip(P, grads, m, v)]
        P, m, v = [q[0] for q in new], [q[1] for q in new], [q[2] for q in new]
    return losses, P


def test_wide_training_equals_numpy(spark):
    x, y, df = data(spark)
    init = mlp.mlp_init(spark, 7, 13, 4, 2)
    metrics, net = wide.mlp_train_wide(df, df, "x", "y", ["id"], hidden=13, classes=4, epochs=3, init=init, block=5)
    losses, P = numpy_run(x, y, mlp.params_arrays(init), 3)
    got = sorted(map(tuple, metrics.collect()))
    assert [r[0] for r in got] == [1, 2, 3] and np.allclose([r[1] for r in got], losses, atol=1e-9)
    assert all(np.allclose(a, b, atol=1e-9) for a, b in zip(mlp.params_arrays(net.params()), P))


def test_wide_dropout_equals_numpy(spark):
    x, y, df = data(spark, n=24)
    init = mlp.mlp_init(spark, 7, 10, 4, 2)
    _, net = wide.mlp_train_wide(df, df, "x", "y", ["id"], hidden=10, classes=4, epochs=2, eval_every=9, init=init, block=5,
                                 dropout=0.3, seed=11)
    numbers = {r["id"]: r["row"] for r in wide.rows(df, "x", "y", ["id"], 7, wide._Scratch(spark), 5).numbers.collect()}
    order = np.argsort([numbers[i] for i in range(24)])
    _, P = numpy_run(x[order], y[order], mlp.params_arrays(init), 2, lambda t: wide.dropout_keep(24, 10, 0.3, t, 11), 0.3)
    assert all(np.allclose(a, b, atol=1e-9) for a, b in zip(mlp.params_arrays(net.params()), P))


def test_more_weights_than_a_broadcast_takes(spark):
    """1.2 million weights, three epochs: the numpy loop to 1e-9."""
    x, y, df = data(spark, n=40, d=48, k=3)
    hidden = 24_000
    rng = np.random.default_rng(9)
    P = [rng.uniform(-.02, .02, (48, hidden)), rng.uniform(-.1, .1, hidden), rng.uniform(-.02, .02, (hidden, 3)), np.zeros(3)]
    flat = spark.range(48 * hidden)
    from tessera.core import hash_uniform
    value = (hash_uniform(4, "id") - 0.5) / 32
    w1 = flat.select(F.lit("l1").alias("layer"), F.lit("W").alias("name"), F.expr(f"int(id div {hidden})").alias("i"),
                     F.expr(f"int(id % {hidden})").alias("j"), value.alias("value"))
    rest = [("l1", "b", 0, j, float(P[1][j])) for j in range(hidden)] + \
        [("l2", "W", i, j, float(P[2][i, j])) for i in range(hidden) for j in range(3)] + [("l2", "b", 0, j, 0.0) for j in range(3)]
    init = w1.unionByName(spark.createDataFrame(rest, w1.schema))
    P[0] = w1.orderBy("i", "j").select("value").toPandas()["value"].to_numpy().reshape(48, hidden)
    metrics, net = wide.mlp_train_wide(df, df, "x", "y", ["id"], hidden=hidden, classes=3, epochs=3, eval_every=3, init=init)
    losses, P = numpy_run(x, y, P, 3)
    assert np.isclose(metrics.first()["train_loss"], losses[-1], atol=1e-9)
    got = net.params().where("layer = 'l1' AND name = 'W'").orderBy("i", "j").select("value").toPandas()["value"].to_numpy()
    assert np.allclose(got.reshape(48, hidden), P[0], atol=1e-9)
    out = net.params().where("layer = 'l2' AND name = 'W'").orderBy("i", "j").select("value").toPandas()["value"].to_numpy()
    assert np.allclose(out.reshape(hidden, 3), P[2], atol=1e-9)


def test_operators_switch_to_tables(spark, monkeypatch):
    """Gradients, prediction, evaluation and training give the same whether weights are shipped or stay tables."""
    _, _, df = data(spark)
    init = mlp.mlp_init(spark, 7, 6, 4, 2)

    def run():
        g = {tuple(r[:4]): r["grad"] for r in mlp.mlp_gradients(init, df, "x", "y").collect()}
        p = {r["id"]: tuple(r) for r in mlp.mlp_predict(init, df, "x", keep=["id"]).collect()}
        e = mlp.mlp_evaluate(init, df, "x", "y").first()
        m, w = mlp.mlp_train(df, df, "x", "y", hidden=6, classes=4, epochs=2, eval_every=1, dropout=0.0, init=init)
        return g, p, tuple(e), sorted(map(tuple, m.collect())), {tuple(r[:4]): r["value"] for r in w.collect()}

    small = run()
    monkeypatch.setattr(mlp, "BROADCAST_CELLS", 10)
    large = run()
    assert small[0].keys() == large[0].keys() and all(abs(small[0][k] - large[0][k]) < 1e-9 for k in small[0])
    assert small[1].keys() == large[1].keys() and all(np.allclose(small[1][k], large[1][k], atol=1e-9) for k in small[1])
    assert np.allclose(small[2], large[2], atol=1e-9) and np.allclose(small[3], large[3], atol=1e-9)
    assert small[4].keys() == large[4].keys() and all(abs(small[4][k] - large[4][k]) < 1e-9 for k in small[4])


# ------------------------------------------------------------ resumed training

class Killed(Exception):
    pass


@pytest.mark.parametrize("form", ["arrays", "tables"])
def test_resumed_training_equals_the_unbroken_run(spark, tmp_path, monkeypatch, form):
    """A run killed in epoch 7 goes on from its last whole state and ends bit for bit like one that was not."""
    _, _, df = data(spark, n=30)
    df = df.cache()
    epochs, every, fatal = (10, 2, 7) if form == "arrays" else (3, 1, 3)

    def run(folder, epochs=epochs):
        if form == "arrays":
            m, w = mlp.mlp_train(df, df, "x", "y", hidden=5, classes=4, epochs=epochs, eval_every=3, dropout=0.2, seed=3,
                                 folder=folder, save_every=every)
        else:
            m, net = wide.mlp_train_wide(df, df, "x", "y", ["id"], hidden=5, classes=4, epochs=epochs, eval_every=3, dropout=0.2,
                                         seed=3, folder=folder, save_every=every, block=4)
            w = net.params()
        return sorted(map(tuple, m.collect())), sorted(tuple(r) for r in w.collect())

    want = run(None)
    folder = str(tmp_path / "state")
    saved = resume.save

    def dies(spark_, where, epoch, tables):
        if epoch >= fatal - 1:  # dies while it writes: the state is there, but not done
            next(iter(tables.values())).write.mode("overwrite").parquet(resume.path(where, epoch, next(iter(tables))))
            raise Killed
        saved(spark_, where, epoch, tables)

    monkeypatch.setattr(resume, "save", dies)
    with pytest.raises(Killed):
        run(folder)
    monkeypatch.setattr(resume, "save", saved)
    assert 0 < resume.latest(spark, folder, epochs) < fatal
    assert run(folder) == want
    assert resume.latest(spark, folder, epochs) == epochs and run(folder)[0] == want[0]
