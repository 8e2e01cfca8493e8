"""Registered queries: one Spark job per operator over the driver's tables,
each paired (where SQL can say it) with an equivalent DuckDB statement.

Inputs, all read in full:

* ``E``  — ``embeddings`` exploded to cells ``(vec_id, j, value)``;
  ``E2`` — the same with ``j`` reversed (a second operand of equal shape).
* ``W0`` — a fixed 64 × 10 matrix from integer arithmetic on ``spark.range``
  (``((7k + 3c) mod 11 - 5) / 8``, exact in binary, same in SQL).
* ``lineitem`` — four standardised measures and a 3-class unit-price band
  for the network queries; ``orders`` keys for permutation and split.

Every computed value is rounded to 6 digits at the edge, on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.core import Cells, hash_bits, packed_shape, spread
from tessera.operators import elementwise as ew
from tessera.operators import blocks, linalg, loss, shape, softmax, sparse, split
from tessera.operators.attention import attention, attention_cells
from tessera.plans import layers, mlp, wide
from tessera.session import remove_table, scratch_table_path, ship_package
from tessera.sources import bucketed, csv, fill
from tessera.sources.packing import cells_to_rows, rows_to_cells
from tessera.sources.tables import read_table
from tessera.streaming.loading import load_labeled_stream

DIGITS = 6
W0_COLS = 10
SEED = 7


def _r(c):
    return F.round(c, DIGITS)


def _emb(spark, sf) -> DataFrame:
    return read_table(spark, sf, "embeddings", "vec_id", "embedding", "label")


def _E(spark, sf) -> Cells:
    return rows_to_cells(_emb(spark, sf), "vec_id", "embedding")


def _E2(e: Cells) -> Cells:
    last = e.shape[1] - 1
    return e.with_df(e.df.select("c0", (F.lit(last) - F.col("c1")).alias("c1"), "value"))


def _W0(spark, rows: int) -> Cells:
    df = spark.range(0, rows * W0_COLS).select(
        (F.col("id") / W0_COLS).cast("bigint").alias("c0"),
        (F.col("id") % W0_COLS).alias("c1"))
    df = df.withColumn("value", ((F.col("c0") * 7 + F.col("c1") * 3) % 11 - 5) / 8.0)
    return Cells(df, (rows, W0_COLS))


def _out(cells: Cells, *names: str) -> DataFrame:
    return cells.named(*names, digits=DIGITS)


def _labels(spark, sf) -> DataFrame:
    return _emb(spark, sf).select(F.col("vec_id").alias("row"), F.col("label"))


# ------------------------------------------------------------ lineitem network

# Fixed test weights of the 4-16-3 network: irrational values, so no
# pre-activation cancels to an exact zero (ReLU kink) — see SURVEY §7.
def _fixed_params(spark: SparkSession) -> DataFrame:
    def layer(name, n_in, n_out, w_off, w_step, b_off):
        w = spark.range(0, n_in * n_out).select(
            F.lit(name).alias("layer"), F.lit("W").alias("name"),
            (F.col("id") / n_out).cast("int").alias("i"), (F.col("id") % n_out).cast("int").alias("j"))
        w = w.withColumn("value", 0.5 * F.sin(F.lit(w_off) + F.col("i") * w_step + F.col("j")))
        b = spark.range(0, n_out).select(
            F.lit(name).alias("layer"), F.lit("b").alias("name"), F.lit(0).alias("i"),
            F.col("id").cast("int").alias("j"))
        b = b.withColumn("value", 0.1 * F.cos(F.lit(b_off) + F.col("j")))
        return w.unionByName(b)
    z = F.lit(0.0)
    return layer("l1", 4, 16, 1, 16, 1).unionByName(layer("l2", 16, 3, 100, 3, 50)).select(
        "*", z.alias("grad"), z.alias("m"), z.alias("v"))


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# standardised measures as scalar columns (``x`` is the same four as an array)
FEATURES = ["f0", "f1", "f2", "f3"]


def lineitem_stats(spark, sf) -> list[tuple[float, float]]:
    """Mean and population deviation of the four measures (one aggregate job)."""
    li = read_table(spark, sf, "lineitem", *_MEASURES)
    row = li.agg(*[F.avg(c).alias(f"a{i}") for i, c in enumerate(_MEASURES)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(_MEASURES)]).first()
    return [(row[f"a{i}"], row[f"s{i}"]) for i in range(len(_MEASURES))]


def lineitem_features(li: DataFrame, stats: list[tuple[float, float]]) -> DataFrame:
    """Standardised measures as ``x`` and the unit-price band as ``y``
    (a projection, so it applies to a stream as well)."""
    feats = [(F.col(c) - F.lit(a)) / F.lit(s) for c, (a, s) in zip(_MEASURES, stats)]
    unit = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    band = F.coalesce(((unit > 1400).cast("int") + (unit > 3100).cast("int")), F.lit(-1))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *_MEASURES,
                     *[e.alias(f) for e, f in zip(feats, FEATURES)], F.array(*feats).alias("x"),
                     band.alias("y"))


def _lineitem_xy(spark, sf) -> DataFrame:
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    *_MEASURES)
    return lineitem_features(li, lineitem_stats(spark, sf))


# ------------------------------------------------------------------ queries

def q_attention_by_label(spark, sf, tile=None):
    kw = {} if tile is None else {"tile": tile}
    out = attention(_emb(spark, sf), id_col="vec_id", q_col="embedding", group="label", **kw)
    return out.select("vec_id", "j", _r(F.col("value")).alias("value"))


def q_attention_by_label_tiled(spark, sf):
    # small tiles: every label group splits into several query and key blocks,
    # so the associative merge of partial softmax triples is exercised
    return q_attention_by_label(spark, sf, tile=16)


def q_attention_by_label_values(spark, sf):
    """Keys and values differ: each vector attends with its embedding as key
    and the reversed embedding as value (the general, non-self path)."""
    emb = _emb(spark, sf)
    keys = emb.select("vec_id", "label", F.col("embedding").alias("k"),
                      F.reverse("embedding").alias("v"))
    out = attention(emb, keys, id_col="vec_id", q_col="embedding", k_col="k", v_col="v",
                    group="label")
    return out.select("vec_id", "j", _r(F.col("value")).alias("value"))


def q_attention_cells(spark, sf):
    """Attention of cell matrices without groups: queries and keys are the embeddings, values
    the reversed ones."""
    e = _E(spark, sf)
    return _out(attention_cells(e, e, _E2(e)), "vec_id", "j")


def q_rows_to_cells(spark, sf):
    return _out(_E(spark, sf), "vec_id", "j")


def q_cells_to_rows(spark, sf):
    rows = cells_to_rows(_E(spark, sf), "vec_id", "features")
    return rows.select("vec_id", F.transform("features", lambda x: _r(x)).alias("features"))


def _n_vectors(spark, sf) -> int:
    return _emb(spark, sf).count()


def q_fill_ones(spark, sf):
    return _out(fill.ones(spark, (_n_vectors(spark, sf), 64)), "c0", "c1")


def q_fill_zeros(spark, sf):
    return _out(fill.zeros(spark, (_n_vectors(spark, sf), 64)), "c0", "c1")


def q_fill_uniform(spark, sf):
    return _out(fill.rand_uniform(spark, (_n_vectors(spark, sf), 64), SEED), "c0", "c1")


def q_scale(spark, sf):
    return _out(ew.scale(_E(spark, sf), 0.5), "vec_id", "j")


def q_relu(spark, sf):
    return _out(ew.relu(_E(spark, sf)), "vec_id", "j")


def q_gelu(spark, sf):
    return _out(ew.gelu(ew.scale(_E(spark, sf), 4.0)), "vec_id", "j")


def q_transpose(spark, sf):
    return _out(shape.transpose(_E(spark, sf), 0, 1), "c0", "c1")


def q_reshape(spark, sf):
    e = _E(spark, sf)
    return _out(shape.reshape(e, (e.shape[0], 8, 8)), "c0", "c1", "c2")


def q_cell_at(spark, sf):
    e = _E(spark, sf)
    wanted = _emb(spark, sf).select(F.col("vec_id").alias("c0"), F.col("label").alias("c1"))
    return e.with_df(shape.cells_at(e, wanted)).named("vec_id", "j", digits=DIGITS)


def q_shape_of(spark, sf):
    return shape.shape_of(_E(spark, sf))


def q_one_hot(spark, sf):
    labels = _emb(spark, sf)
    return _out(loss.one_hot(labels, "vec_id", "label", 10), "vec_id", "k")


def q_dropout(spark, sf):
    return _out(ew.dropout(_E(spark, sf), 0.1, 11), "vec_id", "j")


def _zipped(spark, sf, op, left=1.0) -> DataFrame:
    """``op`` of each embedding (times ``left``) and its reverse: both are columns of
    one row, so nothing is joined."""
    rows = _emb(spark, sf).select(
        "vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda x: x * left).alias("a"),
        F.reverse("embedding").alias("b"))
    return _exploded(ew.zip_rows(rows, "a", "b", op), "vec_id", "out")


def q_add(spark, sf):
    return _zipped(spark, sf, "add")


def q_add_tables(spark, sf):
    """The same sum of two cell tables that meet on their coordinates."""
    e = _E(spark, sf)
    return _out(ew.add(e, _E2(e)), "vec_id", "j")


def q_add_bucketed(spark, sf):
    """The same sum of two tables stored in buckets of their coordinates: the join moves nothing."""
    e = _E(spark, sf)
    a, _ = bucketed.write_bucketed(e)
    b, _ = bucketed.write_bucketed(_E2(e))
    return _out(ew.add(a, b), "vec_id", "j")


def q_add_sparse(spark, sf):
    """The sum of the positive parts of two tables that hold no zeros, as a dense table again."""
    e = _E(spark, sf)
    a, b = sparse.sparsify(ew.relu(e)), sparse.sparsify(ew.relu(_E2(e)))
    return _out(sparse.densify(sparse.add(a, b)), "vec_id", "j")


def _hot(spark, sf) -> sparse.SparseCells:
    return sparse.one_hot_sparse(_emb(spark, sf), "vec_id", "label", 10, _n_vectors(spark, sf))


def q_one_hot_sparse(spark, sf):
    return _out(_hot(spark, sf), "vec_id", "k")


def q_matmul_sparse(spark, sf):
    """Sums of the vectors of each label: the transposed one-hot matrix, one cell a row, times ``E``."""
    return _out(sparse.matmul(sparse.transpose(_hot(spark, sf)), _E(spark, sf)), "label", "j")


def q_sub(spark, sf):
    return _zipped(spark, sf, "sub")


def q_mul(spark, sf):
    return _zipped(spark, sf, "mul")


def q_relu_backward(spark, sf):
    return _zipped(spark, sf, "relu_backward")


def q_gelu_backward(spark, sf):
    return _zipped(spark, sf, "gelu_backward", 4.0)


def q_add_bias(spark, sf):
    e = _E(spark, sf)
    b = Cells(spark.range(0, e.shape[1]).select(
        F.col("id").alias("c0"), ((F.col("id") - 32) / 64.0).alias("value")), (e.shape[1],))
    return _out(ew.add_bias(e, b), "vec_id", "j")


def q_matmul(spark, sf):
    e = _E(spark, sf)
    return _out(linalg.matmul(e, _W0(spark, e.shape[1])), "vec_id", "c")


def q_matmul_acc(spark, sf):
    e = _E(spark, sf)
    acc = fill.ones(spark, (e.shape[0], W0_COLS))
    return _out(linalg.matmul(e, _W0(spark, e.shape[1]), acc=acc), "vec_id", "c")


def q_matmul_block(spark, sf):
    e = _E(spark, sf)
    return _out(linalg.matmul(e, _W0(spark, e.shape[1]), method="block", block=32), "vec_id", "c")


def q_gram(spark, sf):
    return _out(linalg.gram_rows(_emb(spark, sf), "embedding"), "c0", "c1")


def q_gram_block(spark, sf):
    e = _E(spark, sf)
    return _out(linalg.matmul(shape.transpose(e), e, method="block", block=32), "c0", "c1")


def q_col_sum(spark, sf):
    return _out(linalg.col_sum(_E(spark, sf)), "j")


def q_softmax_rows(spark, sf):
    return _out(softmax.softmax_rows(_E(spark, sf)), "vec_id", "j")


def q_softmax_axis0(spark, sf):
    return _out(softmax.softmax(_E(spark, sf), 0), "vec_id", "j")


def q_softmax_axis0_grouped(spark, sf):
    return _out(softmax.softmax(_E(spark, sf), 0, method="grouped"), "vec_id", "j")


def q_softmax_3d(spark, sf):
    e = _E(spark, sf)
    return _out(softmax.softmax(shape.reshape(e, (e.shape[0], 8, 8)), 1), "c0", "c1", "c2")


def q_argmax_rows(spark, sf):
    return softmax.argmax_rows(_E(spark, sf)).select(F.col("c0").alias("vec_id"), "k")


def q_softmax_rows_packed(spark, sf):
    rows = _emb(spark, sf).select("vec_id", loss.softmax_packed("embedding").alias("p"))
    return _exploded(rows, "vec_id", "p")


def q_argmax_rows_packed(spark, sf):
    return _emb(spark, sf).select("vec_id", loss.argmax_packed("embedding").alias("k"))


def _logits(spark, sf) -> Cells:
    e = _E(spark, sf)
    return linalg.matmul(e, _W0(spark, e.shape[1]))


def _logit_rows(spark, sf) -> DataFrame:
    """``(vec_id, label, z)``: each vector's scores beside its own label."""
    k, c = np.indices((64, W0_COLS))
    w = ((k * 7 + c * 3) % 11 - 5) / 8.0
    return linalg.matmul_rows(_emb(spark, sf), "vec_id", "embedding", w, out="z", keep=("label",))


def q_cross_entropy(spark, sf):
    rows = _logit_rows(spark, sf).withColumn("p", loss.softmax_packed("z"))
    return loss.cross_entropy_rows(rows, "p", "label").select(_r(F.col("loss")).alias("loss"))


def q_accuracy(spark, sf):
    return loss.accuracy_rows(_logit_rows(spark, sf), "z", "label").select(_r(F.col("accuracy")).alias("accuracy"))


def q_softmax_xent_grad(spark, sf):
    rows = _logit_rows(spark, sf).withColumn("p", loss.softmax_packed("z"))
    out = loss.softmax_xent_grad_rows(rows, "p", "label", _n_vectors(spark, sf))
    return _exploded(out, "vec_id", "grad").withColumnRenamed("j", "k")


def q_cross_entropy_cells(spark, sf):
    p = softmax.softmax_rows(_logits(spark, sf))
    return loss.cross_entropy(p, _labels(spark, sf)).select(_r(F.col("loss")).alias("loss"))


def q_accuracy_cells(spark, sf):
    pred = softmax.argmax_rows(_logits(spark, sf)).withColumnRenamed("c0", "row")
    return loss.accuracy(pred, _labels(spark, sf)).select(_r(F.col("accuracy")).alias("accuracy"))


def q_softmax_xent_grad_cells(spark, sf):
    p = softmax.softmax_rows(_logits(spark, sf))
    return _out(loss.softmax_xent_grad(p, _labels(spark, sf)), "vec_id", "k")


def q_unknown_labels(spark, sf):
    """Targets, loss, accuracy and gradient where some class names are unknown, some are
    NULL and some rows have no label at all: none is ever a target, all are counted."""
    named = _emb(spark, sf).where("vec_id % 11 <> 0").select(
        F.col("vec_id").alias("row"),
        F.when(F.col("label") == 3, None).when(F.col("label") == 7, "odd")
        .otherwise(F.concat(F.lit("c"), F.col("label").cast("string"))).alias("name"))
    codes = csv.encode_labels(named, "name", {f"c{k}": k for k in range(W0_COLS)}).select(
        "row", F.when(F.col("label") >= 0, F.col("label")).otherwise(
            F.when(F.col("name").isNotNull(), F.col("label"))).alias("label"))
    z = _logits(spark, sf)
    p = softmax.softmax_rows(z)
    pred = softmax.argmax_rows(z).withColumnRenamed("c0", "row")
    targets = loss.one_hot(codes, "row", "label", W0_COLS).df.agg(F.sum("value").alias("targets"))
    grad = loss.softmax_xent_grad(p, codes).df.agg(F.sum(F.abs("value")).alias("grad"))
    parts = {"loss": loss.cross_entropy(p, codes), "accuracy": loss.accuracy(pred, codes), "targets": targets, "grad": grad}
    rows = [df.select(F.lit(name).alias("metric"), _r(F.col(name)).alias("value")) for name, df in parts.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def _orders(spark, sf):
    return read_table(spark, sf, "orders", "o_orderkey")


def q_shuffle_rank(spark, sf):
    return split.shuffle_rank(_orders(spark, sf), ["o_orderkey"], SEED)


def q_train_val_split(spark, sf):
    return split.train_val_split(_orders(spark, sf), ["o_orderkey"], 0.8, SEED)


_FLAGS = {"A": 0, "N": 1}


def q_encode_labels(spark, sf):
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag")
    return csv.encode_labels(li, "l_returnflag", _FLAGS)


def q_read_labeled_csv(spark, sf):
    """lineitem written as a labelled CSV (id, 4 measures, class name) in the
    shared scratch folder, then loaded back through the CSV loader."""
    li = read_table(spark, sf, "lineitem", "l_orderkey", *_MEASURES, "l_returnflag")
    path = scratch_table_path(spark, "labeled-csv")
    li.write.option("header", "true").csv(path)
    samples, _ = csv.read_labeled_csv(spark, path, 4, _FLAGS)
    return samples.select("id", *[_r(F.col(f"f{i}")).alias(f"f{i}") for i in range(4)],
                          "label_name", "label")


def _broken_lines(spark, sf) -> str:
    """lineitem as a labelled CSV in which every 5th order has a fault, by its key."""
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", *_MEASURES, "l_returnflag")
    k = F.col("l_orderkey") % 25
    num = [F.col(c).cast("string") for c in _MEASURES]
    first = F.when(k == 0, "").when(k == 5, "12x").when(k == 10, "junk").otherwise(num[0])
    name = F.when(k == 15, "").otherwise(F.col("l_returnflag"))
    tail = F.when(k == 20, F.lit(",extra")).otherwise(F.lit(""))
    line = F.concat(F.concat_ws(",", F.concat_ws("-", "l_orderkey", "l_linenumber"), first, *num[1:], name), tail)
    path = scratch_table_path(spark, "broken-csv")
    # whole lines as the one field of the CSV writer, which starts every part file with the header; its
    # separator is a character that no line has, so nothing is quoted
    li.select(line.alias("id,a,b,c,d,name")).write.option("header", "true").option("sep", "\x01").csv(path)
    return path


def q_read_labeled_csv_rejects(spark, sf):
    _, rejects = csv.read_labeled_csv(spark, _broken_lines(spark, sf), 4, _FLAGS)
    return rejects.select("id", "reason")


def q_read_labeled_csv_zero(spark, sf):
    """``bad_number='zero'`` and unknown classes dropped."""
    samples, _ = csv.read_labeled_csv(spark, _broken_lines(spark, sf), 4, _FLAGS, bad_number="zero", unknown="drop")
    return samples.select("id", _r(F.col("f0")).alias("f0"), "label")


def q_read_labeled_csv_stream(spark, sf):
    """The samples of ``read_labeled_csv_zero``, loaded as a stream of files."""
    samples, _ = load_labeled_stream(spark, _broken_lines(spark, sf), 4, _FLAGS, bad_number="zero", unknown="drop")
    return samples.select("id", _r(F.col("f0")).alias("f0"), "label")


def q_read_labeled_csv_stream_rejects(spark, sf):
    """The rejects of ``read_labeled_csv_rejects``, the stream's other sink."""
    _, rejects = load_labeled_stream(spark, _broken_lines(spark, sf), 4, _FLAGS)
    return rejects.select("id", "reason")


HEAD_ROWS = 1000


def q_read_labeled_csv_head(spark, sf):
    """The loader's row cap: as many rows as asked for, all of them accepted ones."""
    path = _broken_lines(spark, sf)
    capped, _ = csv.read_labeled_csv(spark, path, 4, _FLAGS, max_rows=HEAD_ROWS)
    every, _ = csv.read_labeled_csv(spark, path, 4, _FLAGS)
    found = capped.select("id").join(every.select("id"), "id", "left_semi")
    return found.agg(F.count(F.lit(1)).alias("n"))


def _exploded(rows: DataFrame, key: str, col: str) -> DataFrame:
    """Packed output rows as cells ``(key, j, value)``, rounded."""
    return rows.select(key, F.posexplode(col).alias("j", "value")).select(
        key, F.col("j").cast("bigint").alias("j"), _r(F.col("value")).alias("value"))


def _packed_E(spark, sf):
    return _emb(spark, sf).select("vec_id", F.col("embedding").cast("array<double>").alias("x"))


def _layer_dims(spark, sf) -> tuple[int, int]:
    """Input width (checked on all rows) and number of classes (label column only)."""
    emb = _emb(spark, sf)
    _, d = packed_shape(emb, F.col("embedding"))
    k = emb.agg(F.count_distinct("label").alias("k")).first()["k"]
    return int(d), int(k)


def _round_params(df: DataFrame) -> DataFrame:
    return df.select("layer", "name", "i", "j", *[_r(F.col(c)).alias(c) for c in ("value", "grad", "m", "v")])


def q_linear_init(spark, sf):
    d, k = _layer_dims(spark, sf)
    return _round_params(layers.linear_init(spark, "l1", d, k, 5))


def q_linear_forward(spark, sf):
    d, k = _layer_dims(spark, sf)
    params = layers.linear_init(spark, "l1", d, k, 5)
    out = layers.linear_forward(params, "l1", _packed_E(spark, sf), "vec_id", "x")
    return _exploded(out, "vec_id", "out")


def _x_dy(spark, sf, k):
    """Packed rows with the layer input ``x`` and the upstream gradient
    ``dy = one_hot(label) - 0.1`` side by side (no join between them)."""
    return _emb(spark, sf).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"),
        F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                    lambda c: (c == F.col("label")).cast("double") - 0.1).alias("dy"))


def _backward(spark, sf):
    d, k = _layer_dims(spark, sf)
    params = layers.linear_init(spark, "l1", d, k, 5)
    grads, dx = layers.linear_backward(params, "l1", _x_dy(spark, sf, k), None, "vec_id", "x", "dy")
    return params, grads, dx


def q_linear_dw(spark, sf):
    _, grads, _ = _backward(spark, sf)
    return grads.filter(F.col("name") == "W").select("i", "j", _r(F.col("grad")).alias("grad"))


def q_linear_db(spark, sf):
    _, grads, _ = _backward(spark, sf)
    return grads.filter(F.col("name") == "b").select("j", _r(F.col("grad")).alias("grad"))


def q_linear_dx(spark, sf):
    _, _, dx = _backward(spark, sf)
    return _exploded(dx, "vec_id", "dx")


def q_adam_step(spark, sf):
    params, grads, _ = _backward(spark, sf)
    updated, _ = layers.adam_step(layers.apply_grads(params, grads), 0, lr=0.01)
    return _round_params(updated)


def q_mlp_gradients(spark, sf):
    g = mlp.mlp_gradients(_fixed_params(spark), _lineitem_xy(spark, sf), FEATURES, "y")
    return g.select("layer", "name", "i", "j", _r(F.col("grad")).alias("grad"),
                    _r(F.col("loss")).alias("loss"))


def q_mlp_predict(spark, sf):
    out = mlp.mlp_predict(_fixed_params(spark), _lineitem_xy(spark, sf), FEATURES,
                          keep=["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", "pred", *[_r(F.col(f"p{c}")).alias(f"p{c}") for c in range(3)])


def q_mlp_evaluate(spark, sf):
    out = mlp.mlp_evaluate(_fixed_params(spark), _lineitem_xy(spark, sf), FEATURES, "y")
    return out.select("n", _r(F.col("loss")).alias("loss"), _r(F.col("accuracy")).alias("accuracy"))


def q_mlp_train(spark, sf, epochs=20, eval_every=5, dropout=0.1):
    """20 full-batch epochs on the exact 80/20 split of lineitem; the metrics
    table (one row per evaluation) is the result."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]  # unique
    # spread and persist the rows once: the split's passes and every epoch
    # read this cache; train and validation are projections of it
    data = _lineitem_xy(spark, sf).select(*keys, *FEATURES, "y", F.xxhash64(*keys).alias("h"),
                                          hash_bits(SEED, *keys).alias("u_bits"))
    rows = spread(data, "h").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        flagged = split.train_val_split(rows, keys, 0.8, SEED, hash_col="u_bits")
        metrics, _ = mlp.mlp_train(flagged, "is_train", FEATURES, "y",
                                   hidden=16, classes=3, epochs=epochs, eval_every=eval_every,
                                   seed=SEED, row_hash="h", dropout=dropout, persist=False, source=rows)
    finally:
        rows.unpersist()
    return metrics


def q_mlp_train_plain(spark, sf):
    """Three epochs without dropout, evaluated after each: the steps SQL can repeat."""
    out = q_mlp_train(spark, sf, epochs=3, eval_every=1, dropout=0.0)
    return out.select("epoch", *[F.round(c, 5).alias(c) for c in ("train_loss", "val_loss", "val_acc")])


#: Hidden units of the wide network: with 64 inputs more weights than a broadcast takes.
WIDE_UNITS = 16_384


def q_mlp_train_wide(spark, sf):
    """One epoch of a 64-16384-10 network on the embeddings, weights as block tables: each hidden unit's new weights
    in (the last is its bias) and out; the row after the last unit has the output biases."""
    emb = _emb(spark, sf)
    d, k = _layer_dims(spark, sf)
    init = layers.linear_init(spark, "l1", d, WIDE_UNITS, 5).unionByName(layers.linear_init(spark, "l2", WIDE_UNITS, k, 6))
    init = init.withColumn("value", F.col("value") / 64.0)
    _, net = wide.mlp_train_wide(emb, emb, "embedding", "label", ["vec_id"], hidden=WIDE_UNITS, classes=k, epochs=1,
                                 eval_every=2, init=init)
    w_in = blocks.to_rows(blocks.transposed(net.weights(1)), "unit", "w_in")
    w_out = blocks.to_rows(net.weights(2), "unit", "w_out")
    return w_out.join(w_in, "unit", "left").select(
        "unit", *[F.transform(F.coalesce(c, F.array().cast("array<double>")), lambda v: _r(v)).alias(c) for c in ("w_in", "w_out")])


# Class names written for the unit-price bands of lineitem.
_BANDS = {"band-low": 0, "band-mid": 1, "band-high": 2}


def q_train_from_csv(spark, sf, epochs=20, eval_every=5):
    """The reference's training program end to end: a labelled CSV (lineitem
    written with class names, in the shared scratch folder) -> loader and
    class codes -> exact 80/20 split of the seeded permutation -> 4-16-3
    network with ReLU, dropout 0.1, softmax, Adam -> validation metrics."""
    li = read_table(spark, sf, "lineitem", "l_orderkey", *_MEASURES)
    unit = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    name = (F.when(unit > 3100, "band-high").when(unit > 1400, "band-mid")
            .when(unit.isNotNull(), "band-low"))
    path = scratch_table_path(spark, "bands-csv")
    li.select(F.monotonically_increasing_id().alias("id"), *_MEASURES, name.alias("class")) \
        .write.option("header", "true").csv(path)
    samples, _ = csv.read_labeled_csv(spark, path, 4, _BANDS)
    keys = ["id"]
    # the lines are parsed once: statistics, split and epochs read the persisted rows
    data = samples.select("id", *[f"f{i}" for i in range(4)], "label", F.xxhash64("id").alias("h"),
                          hash_bits(SEED, *keys).alias("u_bits"))
    rows = spread(data, "h").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stats = rows.agg(*[F.avg(f"f{i}").alias(f"a{i}") for i in range(4)],
                         *[F.stddev_pop(f"f{i}").alias(f"s{i}") for i in range(4)]).first()
        z = [((F.col(f"f{i}") - F.lit(stats[f"a{i}"])) / F.lit(stats[f"s{i}"])).alias(f"z{i}")
             for i in range(4)]
        flagged = split.train_val_split(rows, keys, 0.8, SEED, hash_col="u_bits").select("*", *z)
        metrics, _ = mlp.mlp_train(flagged, "is_train", [f"z{i}" for i in range(4)], "label", hidden=16, classes=3,
                                   epochs=epochs, eval_every=eval_every, seed=SEED, row_hash="h", persist=False, source=rows)
    finally:
        rows.unpersist()
        remove_table(spark, path)
    return metrics


def q_mlp_predict_stream(spark, sf):
    from tessera.streaming.scoring import predict_stream
    stats = lineitem_stats(spark, sf)
    out = predict_stream(spark, sf, "lineitem", lambda df: lineitem_features(df, stats),
                         _fixed_params(spark), keep=["l_orderkey", "l_linenumber"],
                         features=FEATURES)
    return out.select(
        "l_orderkey", "l_linenumber", "pred", *[_r(F.col(f"p{c}")).alias(f"p{c}") for c in range(3)])


def _shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Registered form of a query: first make the package importable on the
    executors (once per context), then build the query."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "attention_by_label": q_attention_by_label,
    "attention_by_label_tiled": q_attention_by_label_tiled,
    "attention_by_label_values": q_attention_by_label_values,
    "attention_cells": q_attention_cells,
    "rows_to_cells": q_rows_to_cells,
    "cells_to_rows": q_cells_to_rows,
    "fill_ones": q_fill_ones,
    "fill_zeros": q_fill_zeros,
    "fill_uniform": q_fill_uniform,
    "scale": q_scale,
    "relu": q_relu,
    "gelu": q_gelu,
    "transpose": q_transpose,
    "reshape": q_reshape,
    "cell_at": q_cell_at,
    "shape_of": q_shape_of,
    "one_hot": q_one_hot,
    "dropout": q_dropout,
    "add": q_add,
    "add_tables": q_add_tables,
    "add_bucketed": q_add_bucketed,
    "add_sparse": q_add_sparse,
    "one_hot_sparse": q_one_hot_sparse,
    "matmul_sparse": q_matmul_sparse,
    "sub": q_sub,
    "mul": q_mul,
    "relu_backward": q_relu_backward,
    "gelu_backward": q_gelu_backward,
    "add_bias": q_add_bias,
    "matmul": q_matmul,
    "matmul_acc": q_matmul_acc,
    "matmul_block": q_matmul_block,
    "gram": q_gram,
    "gram_block": q_gram_block,
    "col_sum": q_col_sum,
    "softmax_rows": q_softmax_rows,
    "softmax_axis0": q_softmax_axis0,
    "softmax_axis0_grouped": q_softmax_axis0_grouped,
    "softmax_3d": q_softmax_3d,
    "argmax_rows": q_argmax_rows,
    "softmax_rows_packed": q_softmax_rows_packed,
    "argmax_rows_packed": q_argmax_rows_packed,
    "cross_entropy_cells": q_cross_entropy_cells,
    "accuracy_cells": q_accuracy_cells,
    "softmax_xent_grad_cells": q_softmax_xent_grad_cells,
    "unknown_labels": q_unknown_labels,
    "cross_entropy": q_cross_entropy,
    "accuracy": q_accuracy,
    "softmax_xent_grad": q_softmax_xent_grad,
    "shuffle_rank": q_shuffle_rank,
    "train_val_split": q_train_val_split,
    "encode_labels": q_encode_labels,
    "read_labeled_csv": q_read_labeled_csv,
    "read_labeled_csv_rejects": q_read_labeled_csv_rejects,
    "read_labeled_csv_zero": q_read_labeled_csv_zero,
    "read_labeled_csv_head": q_read_labeled_csv_head,
    "read_labeled_csv_stream": q_read_labeled_csv_stream,
    "read_labeled_csv_stream_rejects": q_read_labeled_csv_stream_rejects,
    "linear_init": q_linear_init,
    "linear_forward": q_linear_forward,
    "linear_dw": q_linear_dw,
    "linear_db": q_linear_db,
    "linear_dx": q_linear_dx,
    "adam_step": q_adam_step,
    "mlp_gradients": q_mlp_gradients,
    "mlp_predict": q_mlp_predict,
    "mlp_predict_stream": q_mlp_predict_stream,
    "mlp_evaluate": q_mlp_evaluate,
    "mlp_train": q_mlp_train,
    "mlp_train_plain": q_mlp_train_plain,
    "mlp_train_wide": q_mlp_train_wide,
    "train_from_csv": q_train_from_csv,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _shipped(fn) for name, fn in _QUERIES.items()}
