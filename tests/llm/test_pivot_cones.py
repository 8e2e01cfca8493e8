"""Operator 3 on vectors that lie in a narrow cone, and its choices from the sample."""

import time

import numpy as np
import pytest

from tessera.llm import pivots

VECTORS = "vec_id bigint, embedding array<double>, label int"


def cone(rng, n, middle, d=64):
    """Unit vectors whose cosines lie around ``middle``."""
    base, r = rng.standard_normal(d), rng.standard_normal((n, d))
    base /= np.linalg.norm(base)
    r -= np.outer(r @ base, base)
    return np.sqrt(middle) * base + np.sqrt(1 - middle) * r / np.linalg.norm(r, axis=1, keepdims=True)


def partner(rng, x, cos):
    n = rng.standard_normal(x.shape)
    n -= (n * x).sum(axis=1, keepdims=True) * x
    return cos * x + np.sqrt(1 - cos * cos) * n / np.linalg.norm(n, axis=1, keepdims=True)


def truth(x, threshold=0.93):
    """Links of each row by all pairs, in blocks of rows."""
    return np.concatenate([(x[k:k + 1000] @ x.T >= threshold).sum(axis=1) - 1 for k in range(0, len(x), 1000)])


def measured(spark, x):
    rows = spark.createDataFrame([(k, v, 0) for k, v in enumerate(x.tolist())], VECTORS).repartition(8)
    start = time.time()
    got = pivots.near_duplicates(rows).select("vec_id", "n_links").orderBy("vec_id").toPandas()
    return got["n_links"].to_numpy(), time.time() - start


@pytest.mark.parametrize("middle", [0.5, 0.7, 0.85])
def test_recall_in_a_cone(spark, middle):
    """6,000 vectors of which a third have a partner at 0.932; no link that is none, 0.9 of the others and more."""
    rng = np.random.default_rng(8)
    x = cone(rng, 4000, middle)
    x = np.vstack([x, partner(rng, x[:2000], 0.932)])
    links, want = measured(spark, x)[0], truth(x)
    assert want.sum() >= 4000 and (links <= want).all()
    assert links.sum() >= 0.95 * want.sum()


def test_a_cone_gets_many_pivots():
    rng = np.random.default_rng(9)
    for middle in (0.0, 0.5, 0.8):
        x = cone(rng, 4096, middle)
        assert len(pivots.choose_pivots(x, 1024, pivots._apart(x, 0.93))) == 1024


def test_choices_from_odd_samples():
    one = np.ones((1, 4)) / 2
    assert pivots._apart(one, 0.93) == pivots.APART and len(pivots.choose_pivots(one)) == 1
    assert pivots.settings(one, one, 0.93) == (1, pivots.SHARED)
    same = np.repeat(one, 500, axis=0)
    assert len(pivots.choose_pivots(same, 64, pivots._apart(same, 0.93))) == 1
    flat = np.array([[1.0], [-1.0]])
    assert pivots.settings(flat, pivots.choose_pivots(flat), 0.93)[0] >= 1


def test_pivots_in_order_and_apart():
    x = cone(np.random.default_rng(10), 1500, 0.3, 16)
    got, out = pivots.choose_pivots(x, 90, 0.6), []
    for v in x:
        if len(out) < 90 and all(v @ o < 0.6 for o in out):
            out.append(v)
    assert np.allclose(got, np.array(out))


def test_near_copies_are_not_parted(spark):
    """Vectors that are nearly all linked with each other: one list, no link lost."""
    rng = np.random.default_rng(11)
    x = cone(rng, 300, 0.965, 32)
    assert len(pivots.choose_pivots(x, 1024, pivots._apart(x, 0.93))) < 10
    assert (measured(spark, x)[0] == truth(x)).all()
