"""Gradient steps of the class model against plain ones, and sums out of a float's range."""

import numpy as np

from tessera.llm import maxent as M


def plain(weights, batches):
    w, squares = weights.astype(np.float64), np.ones(weights.shape)
    for feats, cls in batches:
        z = w[feats].sum(axis=1)
        z -= z.max(axis=1, keepdims=True)
        g = np.exp(z)
        g /= g.sum(axis=1, keepdims=True)
        g[np.arange(len(cls)), cls] -= 1
        for k in range(feats.shape[1]):
            for f in np.unique(feats[:, k]):
                own = feats[:, k] == f
                total = g[own].sum(axis=0) / np.sqrt(own.sum())
                squares[f] += total * total
                w[f] -= M.RATE * total / np.sqrt(squares[f])
    return w


def test_steps_equal_plain_ones(monkeypatch):
    monkeypatch.setattr(M, "BATCH", 300)
    rng = np.random.default_rng(5)
    feats = np.concatenate([np.zeros((900, 1), np.int64), 1 + rng.zipf(1.4, (900, 4)) % 500], axis=1).astype(np.int32)
    cls = rng.integers(0, M.CLASSES, 900).astype(np.uint8)
    start = rng.standard_normal((M.FEATURES, M.CLASSES)).astype(np.float32)
    steps = M.Steps(start)
    steps.take(feats, cls)
    want = plain(start, [(feats[i:i + 300], cls[i:i + 300]) for i in range(0, 900, 300)])
    assert np.allclose(steps.w, want, atol=1e-4)


def test_large_sums_stay_finite():
    weights = np.zeros((M.FEATURES, M.CLASSES), np.float32)
    weights[1, 3], weights[2] = 500, -700
    logs = M.class_logs(weights, np.array([[0, 1, 0, 0, 0], [0, 2, 0, 0, 0], [0, 0, 0, 0, 0]]))
    assert np.isfinite(logs).all() and abs(logs[0, 3]) < 1e-6
    assert np.allclose(logs[1:], -np.log(M.CLASSES), atol=1e-4)


def test_sums_of_runs_of_any_length():
    rng = np.random.default_rng(2)
    ids = np.repeat(np.arange(60), [*range(1, 41), *[1] * 19, 900])
    ids = ids[rng.permutation(len(ids))].astype(np.int32)
    g = rng.standard_normal((len(ids), M.CLASSES)).astype(np.float32)
    order = np.argsort(ids, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], np.diff(ids[order]) > 0]))
    at, size, total = M._totals(g, order, cut)
    assert (np.diff(size) <= 0).all() and sorted(ids[order[at]]) == list(range(60))
    for i, n, t in zip(ids[order[at]], size, total):
        assert n == (ids == i).sum() and np.allclose(t, g[ids == i].astype(np.float64).sum(axis=0), atol=1e-3)
