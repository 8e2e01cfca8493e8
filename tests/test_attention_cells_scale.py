"""Attention in cells of a super-block and a chunk: what a task reads and what crosses to Python does not grow with the pairs."""

import numpy as np
import pytest
from test_super_blocks import brute, table

from tessera.operators import attention as module
from tessera.operators.attention import attention, cell_blocks


def values(df, x, **kw):
    out = np.full_like(x, np.nan)
    for r in attention(df, id_col="i", q_col="x", group="g", **kw).collect():
        assert np.isnan(out[r["i"], r["j"]])
        out[r["i"], r["j"]] = r["value"]
    return out


@pytest.mark.parametrize("held, chunk, few", [(64 << 20, 96 << 20, True), (2000, 3000, True), (2000, 3000, False)])
def test_any_cells_give_the_same(spark, monkeypatch, held, chunk, few):
    monkeypatch.setattr(module, "HELD_BYTES", held)
    monkeypatch.setattr(module, "CHUNK_BYTES", chunk)
    if not few:
        monkeypatch.setattr(module, "BROADCAST_CELLS", 1)
    x, g, df = table(spark)
    assert np.allclose(values(df, x, tile=8), brute(x, g))


def test_small_tiles_cost_no_pairs(spark):
    """Rows that cross to Python are blocks by cells, not pairs of blocks: tiles of 2 gave 90 times 90 pairs."""
    x, g, df = table(spark)
    blocks = cell_blocks(df, id_col="i", q_col="x", group="g", tile=2)
    pairs = sum((-(-g.count(k) // 2)) ** 2 for k in set(g))
    assert blocks.count() < pairs / 3
    assert np.allclose(values(df, x, tile=2), brute(x, g))


def test_a_task_reads_a_bounded_share_of_the_keys(spark, monkeypatch):
    """Without groups one super-block read all keys; now a cell has a chunk of them, and four times the rows are no more a task."""
    monkeypatch.setattr(module, "HELD_BYTES", 8 * 12 * 64)
    monkeypatch.setattr(module, "CHUNK_BYTES", 8 * 6 * 64)
    most = []
    for n in (400, 1600):
        _, _, df = table(spark, n=n)
        blocks = cell_blocks(df, id_col="i", q_col="x", tile=16)
        most.append(max(sum(len(r) for r in part) for part in blocks.select("block").rdd.map(
            lambda r: r[0]).glom().collect()))
    assert most[1] < 2 * most[0] and most[1] < 1600
