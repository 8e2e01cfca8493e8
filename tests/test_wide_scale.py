"""The wide network on more rows than hidden units can be written for: nothing of rows by hidden units is kept."""

import os

import numpy as np
import pytest
from test_blocks import data, numpy_run

from tessera.operators import blocks as B
from tessera.plans import mlp, wide


def run(spark, monkeypatch, n=70, hidden=40, block=8, share=None, **kw):
    if share:
        monkeypatch.setattr(wide, "SHARE_CELLS", share)
    x, y, df = data(spark, n=n)
    init = mlp.mlp_init(spark, 7, hidden, 4, 2)
    _, net = wide.mlp_train_wide(df, df, "x", "y", ["id"], hidden=hidden, classes=4, epochs=2, eval_every=2, init=init,
                                 block=block, **kw)
    return x, y, df, init, net


@pytest.mark.parametrize("hidden, share", [(40, None), (43, None), (40, 200), (43, 200)])
def test_activations_made_in_tasks_equal_numpy(spark, monkeypatch, hidden, share):
    """Whole and broken last blocks of units, one group of units and several, several groups of rows; dropout."""
    monkeypatch.setattr(wide, "TASK_CELLS", 500)
    x, y, df, init, net = run(spark, monkeypatch, hidden=hidden, share=share, dropout=0.3, seed=11)
    data_ = wide.rows(df, "x", "y", ["id"], 7, wide._Scratch(spark), 8)
    gi, gj = wide._dealt(net, data_.x)
    assert gi > 1 and (gj > 1) == (share is not None)
    numbers = {r["id"]: r["row"] for r in data_.numbers.collect()}
    order = np.argsort([numbers[i] for i in range(len(x))])
    _, P = numpy_run(x[order], y[order], mlp.params_arrays(init), 2,
                     lambda t: wide.dropout_keep(len(x), hidden, 0.3, t, 11), 0.3)
    assert all(np.allclose(a, b, atol=1e-9) for a, b in zip(mlp.params_arrays(net.params()), P))


def test_no_table_of_rows_by_units_is_written(spark, monkeypatch):
    written = []
    plain = wide._Scratch.__call__

    def spy(self, df, name, schema=None):
        out = plain(self, df, name, schema)
        path = self.paths[-1].removeprefix("file:")
        written.append(sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path)))
        return out

    monkeypatch.setattr(wide._Scratch, "__call__", spy)
    run(spark, monkeypatch, n=300, hidden=4000, block=64)
    assert max(written) < 300 * 4000 * 8 / 4


def test_a_product_is_never_broadcast(spark):
    """The size of a product is guessed from its operands; a join with it must not send it through the driver."""
    rng = np.random.default_rng(1)
    make = lambda r, c: B.from_cells(_cells(spark, rng.standard_normal((r, c))), (16, 16))
    product = B.matmul_blocks(make(48, 2), make(2, 48), block=(16, 16, 16))
    joined = B.combine(make(48, 48), [product], lambda i, j, a, b: a + b).df
    joined.collect()
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()


def _cells(spark, x):
    from matrix_help import cells
    return cells(spark, x)
