"""Full-batch training against an independent numpy loop (same rows, same
dropout masks), plus finite-difference checks of the Spark gradient job."""

import numpy as np
import pytest

from matrix_help import SF001
from tessera.operators import split
from tessera.plans import mlp, suite


@pytest.fixture(scope="module")
def data(spark):
    xy = suite._lineitem_xy(spark, SF001)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *suite._MEASURES]
    flagged = split.train_val_split(xy, keys, 0.8, 7)
    return flagged.filter("is_train"), flagged.filter("NOT is_train")


def _arrays(df):
    rows = mlp.prepare(df, "x", "y").collect()
    return (np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows]),
            np.array([r["h"] for r in rows], dtype=np.int64))


def _numpy_train(P, X, y, h, Xv, yv, epochs, lr, p, eval_every, seed):
    W1, b1, W2, b2 = [a.copy() for a in P]
    params = [W1, b1, W2, b2]
    ms = [np.zeros_like(a) for a in params]
    vs = [np.zeros_like(a) for a in params]
    n, k = len(y), W2.shape[1]
    T = np.eye(k)[y]
    Tv = np.eye(k)[yv]
    out = []
    for e in range(1, epochs + 1):
        W1, b1, W2, b2 = params
        H = X @ W1 + b1
        H[H < 0] = 0.0
        u = mlp.unit_uniform(h, W1.shape[1], e, seed)
        H = np.where(u < p, 0.0, H / (1 - p))
        Z = H @ W2 + b2
        Pz = np.exp(Z - Z.max(1, keepdims=True))
        Pz /= Pz.sum(1, keepdims=True)
        loss = -(T * np.log(Pz + 1e-8)).sum() / n
        dZ = (Pz - T) / n
        grads = [None, None, H.T @ dZ, dZ.sum(0)]
        dH = dZ @ W2.T
        dH[~(H > 0)] = 0.0
        grads[0], grads[1] = X.T @ dH, dH.sum(0)
        for i in range(4):
            ms[i] = 0.9 * ms[i] + 0.1 * grads[i]
            vs[i] = 0.999 * vs[i] + 0.001 * grads[i] ** 2
            params[i] = params[i] - lr * (ms[i] / (1 - 0.9 ** e)) / (np.sqrt(vs[i] / (1 - 0.999 ** e)) + 1e-8)
        if e % eval_every == 0:
            W1, b1, W2, b2 = params
            Hv = np.maximum(Xv @ W1 + b1, 0)
            Zv = Hv @ W2 + b2
            Pv = np.exp(Zv - Zv.max(1, keepdims=True))
            Pv /= Pv.sum(1, keepdims=True)
            vloss = -(Tv * np.log(Pv + 1e-8)).sum() / len(yv)
            acc = 100.0 * (Pv.argmax(1) == yv).mean()
            out.append((e, loss, vloss, acc))
    return out, params


def test_training_matches_numpy(spark, data):
    train, val = data
    init = mlp.mlp_init(spark, 4, 16, 3, 7)
    P0 = mlp.params_arrays(init)
    metrics, params = mlp.mlp_train(train, val, "x", "y", epochs=10, eval_every=5, dropout=0.1,
                                    seed=7, init=init)
    X, y, h = _arrays(train)
    Xv, yv, _ = _arrays(val)
    want, want_params = _numpy_train(P0, X, y, h, Xv, yv, 10, 0.01, 0.1, 5, 7)
    got = sorted(tuple(r) for r in metrics.collect())
    assert len(got) == len(want) == 2
    for g, w in zip(got, want):
        assert g[0] == w[0]
        assert np.allclose(g[1:], w[1:], atol=1e-9)
    for g, w in zip(mlp.params_arrays(params), want_params):
        assert np.allclose(g, w, atol=1e-9)


def test_gradient_finite_differences(spark, data):
    train, _ = data
    params = suite._fixed_params(spark)
    P = mlp.params_arrays(params)
    g = {(r["layer"], r["name"], r["i"], r["j"]): r["grad"]
         for r in mlp.mlp_gradients(params, train, "x", "y").collect()}
    X, y, h = _arrays(train)

    def loss(Pm):
        return mlp.forward_backward(X, y, h, Pm, need_grad=False)[0] / len(y)

    eps = 1e-6
    for (idx, (layer, name)) in [(0, ("l1", "W")), (1, ("l1", "b")), (2, ("l2", "W")), (3, ("l2", "b"))]:
        flat = P[idx].reshape(-1)
        for pos in [0, flat.size // 2, flat.size - 1]:
            up = [a.copy() for a in P]
            dn = [a.copy() for a in P]
            up[idx].reshape(-1)[pos] += eps
            dn[idx].reshape(-1)[pos] -= eps
            fd = (loss(up) - loss(dn)) / (2 * eps)
            if name == "W":
                i, j = divmod(pos, P[idx].shape[1])
            else:
                i, j = 0, pos
            assert g[(layer, name, i, j)] == pytest.approx(fd, abs=1e-6)


def test_partition_count_does_not_change_gradients(spark, data):
    train, _ = data
    params = suite._fixed_params(spark)
    a = {(r[0], r[1], r[2], r[3]): r[4] for r in mlp.mlp_gradients(params, train, "x", "y").collect()}
    b = {(r[0], r[1], r[2], r[3]): r[4]
         for r in mlp.mlp_gradients(params, train.repartition(13), "x", "y").collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_spark_side_reduction_matches_driver_side(spark, data, monkeypatch):
    """Large models sum their gradient partials with a Spark aggregation (and
    evaluate in separate jobs); the result equals the driver-side sum."""
    train, val = data
    init = mlp.mlp_init(spark, 4, 16, 3, 7)
    m1, p1 = mlp.mlp_train(train, val, "x", "y", epochs=4, eval_every=2, seed=7, init=init)
    monkeypatch.setattr(mlp, "DRIVER_REDUCE_MAX", 0)
    m2, p2 = mlp.mlp_train(train, val, "x", "y", epochs=4, eval_every=2, seed=7, init=init)
    a, b = sorted(tuple(r) for r in m1.collect()), sorted(tuple(r) for r in m2.collect())
    assert [r[0] for r in a] == [r[0] for r in b] == [2, 4]
    assert np.allclose([r[1:] for r in a], [r[1:] for r in b], atol=1e-12)
    for x, y in zip(mlp.params_arrays(p1), mlp.params_arrays(p2)):
        assert np.allclose(x, y, atol=1e-12)


def test_broadcast_shipping_matches_closure(spark, data, monkeypatch):
    """Large models reach the tasks as broadcast variables (destroyed after
    each eager epoch job); results equal the closure path."""
    import tessera.core as core
    from tessera.operators import linalg
    train, val = data
    init = mlp.mlp_init(spark, 4, 16, 3, 7)
    params = suite._fixed_params(spark)
    rows = spark.createDataFrame([(i, [float(i), 1.0, -2.0]) for i in range(50)],
                                 "r bigint, x array<double>")
    W = np.arange(6.0).reshape(3, 2)

    def run():
        m, p = mlp.mlp_train(train, val, "x", "y", epochs=3, eval_every=1, seed=7, init=init)
        pred = mlp.mlp_predict(params, val, "x", keep=["l_orderkey", "l_linenumber"])
        prod = linalg.matmul_rows(rows, "r", "x", W)
        return (sorted(tuple(r) for r in m.collect()), mlp.params_arrays(p),
                sorted(tuple(r) for r in pred.collect()), sorted((r["r"], tuple(r["out"])) for r in prod.collect()))

    closure = run()
    monkeypatch.setattr(core, "CLOSURE_VALUES", 0)
    broadcast = run()
    assert np.allclose([r[1:] for r in closure[0]], [r[1:] for r in broadcast[0]], atol=1e-12)
    for a, b in zip(closure[1], broadcast[1]):
        assert np.allclose(a, b, atol=1e-12)
    assert closure[2] == broadcast[2] and closure[3] == broadcast[3]


def test_scalar_feature_columns_equal_array(spark, data):
    train, _ = data
    params = suite._fixed_params(spark)
    a = {tuple(r[:4]): r[4] for r in mlp.mlp_gradients(params, train, "x", "y").collect()}
    b = {tuple(r[:4]): r[4] for r in mlp.mlp_gradients(params, train, suite.FEATURES, "y").collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)
    pa_ = sorted(tuple(r) for r in mlp.mlp_predict(params, train, "x", keep=["l_orderkey"]).collect())
    pb_ = sorted(tuple(r) for r in mlp.mlp_predict(params, train, suite.FEATURES, keep=["l_orderkey"]).collect())
    assert len(pa_) == len(pb_) and all(
        x[:2] == y[:2] and np.allclose(x[2:], y[2:], atol=1e-12) for x, y in zip(pa_, pb_))
