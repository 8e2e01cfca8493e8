"""Attention in super-blocks: fewer copies of the key blocks, the same values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.attention import attention, block_pairs


def table(spark, n=180, d=5, seed=1):
    x = np.random.default_rng(seed).standard_normal((n, d))
    g = [0 if i % 3 else i % 7 for i in range(n)]  # one group holds most rows
    return x, g, spark.createDataFrame([(i, g[i], x[i].tolist()) for i in range(n)], "i bigint, g int, x array<double>")


def brute(x, g):
    out = np.zeros_like(x)
    for k in set(g):
        rows = [i for i in range(len(g)) if g[i] == k]
        s = x[rows] @ x[rows].T / np.sqrt(x.shape[1])
        p = np.exp(s - s.max(1, keepdims=True))
        out[rows] = p / p.sum(1, keepdims=True) @ x[rows]
    return out


@pytest.mark.parametrize("per", [1, 3, 100])
def test_any_super_block_gives_the_same(spark, monkeypatch, per):
    from tessera.operators import attention as module
    plain = module.block_pairs
    monkeypatch.setattr(module, "block_pairs", lambda *a, **k: plain(*a, **k, super_tiles=per))
    x, g, df = table(spark)
    for keys in (None, df.select("i", "g", F.col("x").alias("k"), F.col("x").alias("v"))):
        kw = {} if keys is None else {"k_col": "k", "v_col": "v"}
        got = attention(df, keys, id_col="i", q_col="x", group="g", tile=8, **kw)
        out = np.zeros_like(x)
        for r in got.collect():
            out[r["i"], r["j"]] = r["value"]
        assert np.allclose(out, brute(x, g))


def test_copies_fall_by_the_super_block(spark, monkeypatch):
    from tessera.operators import attention as module
    plain, made = module._replicas, []
    monkeypatch.setattr(module, "_replicas", lambda *a: made.append(plain(*a)) or made[-1])
    _, _, df = table(spark)
    pairs = [block_pairs(df, id_col="i", q_col="x", group="g", tile=8, super_tiles=per).count() for per in (1, 4)]
    one, four = (x.count() for x in made)
    assert pairs[0] == pairs[1] == one and four <= one / 3
