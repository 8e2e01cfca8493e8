"""Training rows in packed arrays: an epoch hands over arrays, not rows, and draws the same masks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.plans import mlp


@pytest.mark.parametrize("p", [0.0, 1e-300, 0.1, 1 / 3, 0.5, 1 - 2 ** -53, 1.0])
def test_kept_units_are_those_of_the_uniform_draw(p):
    h = np.random.default_rng(3).integers(-2 ** 62, 2 ** 62, 500)
    assert (mlp.kept_units(h, 9, p, 4, 7) == (mlp.unit_uniform(h, 9, 4, 7) >= p)).all()


def test_packed_rows_are_the_rows(spark, monkeypatch):
    monkeypatch.setattr(mlp, "PACKED_ROWS", 7)
    df = spark.range(100).select("id", (F.col("id") * 0.5).alias("a"), (F.col("id") % 3).cast("int").alias("label"))
    rows = mlp.prepare(df, ["a"], "label", "id").withColumn("t", F.pmod("h", F.lit(2)).cast("int"))
    got, sizes = {}, []
    for r in mlp.packed(rows, 1).collect():
        h = np.frombuffer(r["h"], np.int64)
        sizes.append(len(h))
        assert (h % 2 == r["t"]).all()
        got.update(zip(h.tolist(), zip(np.frombuffer(r["x"], np.float64).tolist(), np.frombuffer(r["y"], np.int64).tolist())))
    assert max(sizes) <= 7 and got == {i: (i * 0.5, i % 3) for i in range(100)}


def test_an_epoch_reads_packed_rows(spark, monkeypatch):
    """Few rows cross to Python in an epoch: before, each training row did."""
    seen = []
    plain = mlp._totals
    monkeypatch.setattr(mlp, "_totals", lambda rows, *a, **k: seen.append(rows.count()) or plain(rows, *a, **k))
    df = spark.range(3000).select(F.rand(1).alias("a"), (F.col("id") % 3).cast("int").alias("label"), "id").repartition(3, "id")
    metrics, _ = mlp.mlp_train(df, df, ["a"], "label", hidden=4, epochs=2, eval_every=2, seed=1, row_hash="id", dropout=0.1)
    assert seen and max(seen) <= 2 * spark.sparkContext.defaultParallelism and metrics.count() == 1


def test_csv_lines_are_parsed_once(spark, monkeypatch):
    """Statistics, split and epochs of the whole program read the persisted rows, not the lines again."""
    from matrix_help import SF001

    from tessera.plans import suite
    seen, plain = spark.sparkContext.accumulator(0), suite.csv.read_labeled_csv

    def counted(*a, **k):
        samples, rejects = plain(*a, **k)

        def run(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        return samples.mapInArrow(run, samples.schema), rejects

    monkeypatch.setattr(suite.csv, "read_labeled_csv", counted)
    suite.q_train_from_csv(spark, SF001, epochs=1, eval_every=1)
    assert seen.value == spark.read.parquet(f"{SF001}/lineitem.parquet").count()


def test_flagged_rows_are_packed_in_one_pass(spark):
    """Training and validation rows of one table: it is read once and released, the numbers are those of two tables."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(3000).select(F.rand(1).alias("a"), (F.col("id") % 3).cast("int").alias("label"), "id",
                                  (F.col("id") % 5 > 0).alias("known")).repartition(3, "id")
    counted = df.mapInArrow(run, df.schema)
    source = df.select("id").persist()
    source.count()
    how = dict(hidden=4, epochs=3, eval_every=1, seed=1, row_hash="id", dropout=0.1)
    flagged, _ = mlp.mlp_train(counted, "known", ["a"], "label", persist=False, source=source, **how)
    assert seen.value == 3000 and not source.is_cached
    two, _ = mlp.mlp_train(df.filter("known"), df.filter("NOT known"), ["a"], "label", **how)
    a, b = ([tuple(r) for r in t.orderBy("epoch").collect()] for t in (flagged, two))
    assert len(a) == 3 and np.allclose(a, b, rtol=1e-12, atol=0)


def test_a_step_reuses_its_arrays():
    """One set of arrays for steps of other lengths, with the numbers of fresh ones."""
    rng, scratch = np.random.default_rng(2), mlp.Scratch()
    P = [rng.normal(size=s) for s in ((4, 16), 16, (16, 3), 3)]
    for n in (900, 7, 901):
        X, y, h = rng.normal(size=(n, 4)), rng.integers(-1, 3, n), rng.integers(-2 ** 62, 2 ** 62, n)
        for scale in (False, True):
            got = mlp.forward_backward(X, y, h, P, 0.3, 5, 1, scale, scratch=scratch)
            fresh = mlp.forward_backward(X, y, h, P, 0.3, 5, 1, scale)
            assert got[:2] == fresh[:2] and all((g == f).all() for g, f in zip(got[3], fresh[3]))
    assert {c.size for c in scratch.values()} == {16 * 901, 3 * 901}


def test_large_gradients_are_added_by_spark(spark, monkeypatch):
    df = spark.range(2000).select(F.rand(1).alias("a"), (F.col("id") % 3).cast("int").alias("label"), "id").repartition(3, "id")
    how = dict(hidden=4, epochs=3, eval_every=1, seed=1, row_hash="id", dropout=0.1)
    few = mlp.mlp_train(df, df, ["a"], "label", **how)[0].orderBy("epoch").collect()
    monkeypatch.setattr(mlp, "DRIVER_REDUCE_MAX", 1)
    many = mlp.mlp_train(df, df, ["a"], "label", **how)[0].orderBy("epoch").collect()
    assert np.allclose([tuple(r) for r in few], [tuple(r) for r in many], rtol=1e-12, atol=0)
