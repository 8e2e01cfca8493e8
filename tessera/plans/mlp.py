"""Two-layer network (in → hidden, ReLU, dropout → classes, softmax).

Training is full-batch: every epoch is one Spark job over all training rows.
Each task runs the forward and backward pass of its rows in numpy and emits a
single partial ``(n, loss, gradient vector)``. The partials are summed on the
driver when ``partitions × parameters`` is small (a one-level tree
aggregate), otherwise by a Spark aggregation so that only the parameter-sized
total reaches the driver, which applies Adam. No DataFrame is
carried from epoch to epoch, so lineage never grows; the training rows are
packed into arrays of some thousand rows and persisted once (recomputed from
parquet if an executor is lost), so an epoch hands numpy whole arrays, not rows.

Dropout masks come from a hash of (row hash, unit, epoch, seed) — splitmix64
(Steele, Lea & Flood 2014) — so a retried task draws exactly the same mask.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.core import BROADCAST_CELLS, Shipped, arrow_matrix, packed_shape, splitmix, splitmix_into, spread
from tessera.operators.loss import LOG_EPS
from tessera.plans import resume, wide
from tessera.plans.layers import adam_numpy, layer_arrays, linear_init, params_from_arrays

LAYERS = ("l1", "l2")


class Scratch(dict):
    """Arrays that the steps of a task use again: numpy would ask the system for fresh memory in each operation."""

    def array(self, name: str, shape: tuple[int, int], dtype=np.float64) -> np.ndarray:
        size = math.prod(shape)
        if name not in self or self[name].size < size:
            self[name] = np.empty(size, dtype)
        return self[name][:size].reshape(shape)


def _draws(row_hash: np.ndarray, units: int, epoch: int, seed: int, scratch: Scratch | None = None) -> np.ndarray:
    """64 hash bits per (unit, row) from the row hash, epoch and seed; the 53 upper ones are the draw."""
    scratch = Scratch() if scratch is None else scratch
    shape = units, len(row_hash)
    bits, spare = scratch.array("bits", shape, np.uint64), scratch.array("spare", shape, np.uint64)
    with np.errstate(over="ignore"):
        base = splitmix(row_hash.astype(np.int64).view(np.uint64) ^ splitmix(
            np.array([seed * 1_000_003 + epoch], dtype=np.uint64)))
        np.add(np.arange(units, dtype=np.uint64)[:, None], base[None, :], out=bits)
    return splitmix_into(bits, spare)


def unit_uniform(row_hash: np.ndarray, units: int, epoch: int, seed: int) -> np.ndarray:
    """Uniform [0, 1) per (row, unit) from the row hash, epoch and seed."""
    return (_draws(row_hash, units, epoch, seed).T >> np.uint64(11)).astype(np.float64) * (1.0 / 9007199254740992.0)


def kept_units(row_hash: np.ndarray, units: int, p_drop: float, epoch: int, seed: int) -> np.ndarray:
    """``unit_uniform(...) >= p_drop``, compared as integers."""
    return ~_dropped(row_hash, units, p_drop, epoch, seed).T


def _dropped(row_hash: np.ndarray, units: int, p_drop: float, epoch: int, seed: int,
             scratch: Scratch | None = None) -> np.ndarray:
    """The others of :func:`kept_units`, units by rows."""
    least = math.ceil(p_drop * 9007199254740992.0)
    if least >= 1 << 53:
        return np.ones((units, len(row_hash)), bool)
    return _draws(row_hash, units, epoch, seed, scratch) < np.uint64(least << 11)


def forward_backward(X, y, row_hash, P, p_drop=0.0, epoch=0, seed=0,
                     scale_dropout_grad=False, need_grad=True, scratch=None):
    """One pass over a block of rows. Returns (loss_sum, correct, probs, grads); with a
    caller's ``scratch`` the probabilities hold until its next pass."""
    scratch = Scratch() if scratch is None else scratch
    W1, b1, W2, b2 = P
    # units and classes by rows: numpy's loops, sums and maxima run along many rows, not a few units
    n, (units, k) = len(y), W2.shape
    A = np.matmul(W1.T, X.T, out=scratch.array("A", (units, n)))
    A += b1[:, None]
    drop = live = None
    if p_drop > 0.0:
        drop = _dropped(row_hash, units, p_drop, epoch, seed, scratch)
        if scale_dropout_grad:
            live = (A > 0) & ~drop
    np.maximum(A, 0.0, out=A)
    if drop is not None:
        A /= 1.0 - p_drop
        np.copyto(A, 0.0, where=drop)
    prob = np.matmul(W2.T, A, out=scratch.array("prob", (k, n)))
    prob += b2[:, None]
    prob -= prob.max(axis=0)
    np.exp(prob, out=prob)
    prob /= prob.sum(axis=0)
    at = np.flatnonzero((y >= 0) & (y < k))
    hit = y[at], at
    loss_sum = float(-np.log(prob[hit] + LOG_EPS).sum())
    correct = int((np.argmax(prob, axis=0)[at] == y[at]).sum())
    if not need_grad:
        return loss_sum, correct, prob.T, None
    dZ = scratch.array("dZ", (k, n))
    dZ[...] = prob
    dZ[hit] -= 1.0
    dW2, db2 = A @ dZ.T, dZ.sum(axis=1)
    dH = np.matmul(W2, dZ, out=scratch.array("dH", (units, n)))
    if live is not None:
        np.copyto(dH, 0.0, where=~live)
        dH /= 1.0 - p_drop
    else:
        # the reference masks with the post-dropout activation
        np.copyto(dH, 0.0, where=~(A > 0))
    dW1, db1 = X.T @ dH.T, dH.sum(axis=1)
    return loss_sum, correct, prob.T, (dW1, db1, dW2, db2)


def _flat(parts) -> np.ndarray:
    return np.concatenate([np.asarray(p, dtype=np.float64).reshape(-1) for p in parts])


def _unflat(vec: np.ndarray, P) -> list[np.ndarray]:
    out, pos = [], 0
    for p in P:
        out.append(vec[pos:pos + p.size].reshape(p.shape))
        pos += p.size
    return out


def _feature_columns(features: str | list[str]) -> list:
    """Features as one array column (``x``) or as scalar columns (``_f0..``);
    scalar columns move through Arrow and the cache without per-row arrays."""
    if isinstance(features, str):
        return [F.col(features).cast("array<double>").alias("x")]
    return [F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(features)]


def _matrix(batch: pa.RecordBatch, width: int | None = None) -> np.ndarray:
    names = batch.schema.names
    if "x" in names:
        return arrow_matrix(batch.column("x"), width)
    cols = sorted((c for c in names if c.startswith("_f")), key=lambda c: int(c[2:]))
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
                            for c in cols])


#: Rows and numbers of a packed row, and activations of one step of numpy at most.
PACKED_ROWS, PACKED_CELLS, STEP_CELLS = 8192, 1 << 20, 1 << 16
_PACKED = "t int, x binary, y binary, h binary"


def packed(tagged: DataFrame, width: int) -> DataFrame:
    """Rows of :func:`prepare` with a tag ``t`` as arrays of some thousand rows of a tag, packed where they are."""
    most = max(1, min(PACKED_ROWS, PACKED_CELLS // max(width, 1)))

    def run(batches):
        held: dict[int, list] = {}

        def rows(tag, whole):
            X, y, h = (np.concatenate(c) for c in zip(*held[tag]))
            stop = len(y) // most * most if whole else len(y)
            for a in range(0, stop, most):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tag], pa.int32()), *[pa.array([c[a:min(a + most, stop)].tobytes()], pa.binary()) for c in (X, y, h)]],
                    ["t", "x", "y", "h"])
            held[tag] = [(X[stop:], y[stop:], h[stop:])]

        for b in batches:
            if not b.num_rows:
                continue
            columns, tags = _rows(b, width), b.column("t").to_numpy(zero_copy_only=False)
            for tag in np.unique(tags).tolist():
                held.setdefault(tag, []).append(tuple(c[tags == tag] for c in columns))
                if sum(len(y) for _, y, _ in held[tag]) >= most:
                    yield from rows(tag, True)
        for tag in held:
            yield from rows(tag, False)

    return tagged.mapInArrow(run, _PACKED)


def _step_rows(units: int) -> int:
    """Rows of a step, which numpy's temporaries keep small."""
    return max(64, STEP_CELLS // max(units, 1))


def _chunks(batch: pa.RecordBatch, width: int, units: int):
    """(0, X, y, h) of a batch of :func:`prepare`, in steps."""
    X, y, h = _rows(batch, width)
    for a in range(0, len(y), _step_rows(units)):
        yield 0, *(c[a:a + _step_rows(units)] for c in (X, y, h))


def _packed_chunks(rows, width: int, units: int):
    """(tag, X, y, h) of rows of :func:`packed`, in steps."""
    for tag, *blobs in rows:
        X = np.frombuffer(blobs[0], np.float64).reshape(-1, width)
        y, h = (np.frombuffer(c, np.int64) for c in blobs[1:])
        for a in range(0, len(y), _step_rows(units)):
            yield tag, *(c[a:a + _step_rows(units)] for c in (X, y, h))


def _rows(batch: pa.RecordBatch, width: int | None = None):
    X = _matrix(batch, width)
    y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
    h = batch.column("h").to_numpy(zero_copy_only=False).astype(np.int64)
    return X, y, h


_PARTIAL = T.StructType([T.StructField("n", T.LongType()), T.StructField("loss", T.DoubleType()),
                         T.StructField("correct", T.LongType()),
                         T.StructField("g", T.ArrayType(T.DoubleType()))])


def _sums(chunks, weights, p_drop, epoch, seed, scale_dropout_grad, need_grad):
    """``(tag, n, loss, correct, g)`` of each tag in a task's chunks: 0 = train (dropout and gradients),
    1 = validation (no dropout, loss and accuracy only), so an evaluation can ride along with a training pass."""
    size, scratch = sum(p.size for p in weights), Scratch()
    acc = {}
    for tag, X, y, h in chunks:
        if not len(y):
            continue
        train = need_grad and tag == 0
        ls, c, _, grads = forward_backward(
            X, y, h, weights, p_drop if tag == 0 else 0.0, epoch, seed, scale_dropout_grad, train, scratch)
        n0, l0, c0, g0 = acc.get(tag, (0, 0.0, 0, np.zeros(size) if train else None))
        if train:
            g0 = g0 + _flat(grads)
        acc[tag] = (n0 + len(y), l0 + ls, c0 + c, g0)
    for tag, sums in sorted(acc.items()):
        yield tag, *sums


def _partials(P, *how):
    """One partial per task of plain rows."""
    def run(batches):
        weights = P.get()
        chunks = (c for b in batches if b.num_rows for c in _chunks(b, *weights[0].shape))
        for _, n, loss, correct, g in _sums(chunks, weights, *how):
            garr = pa.array([g.tolist() if g is not None else []], type=pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([loss]), pa.array([correct], pa.int64()), garr], names=_PARTIAL.names)

    return run


def _packed_partials(P, *how):
    """One partial per tag and task of packed rows."""
    def run(rows):
        weights = P.get()
        return _sums(_packed_chunks(rows, *weights[0].shape), weights, *how)

    return run


def prepare(df: DataFrame, features: str | list[str], label: str,
            row_hash: str | None = None, tag: Column | None = None) -> DataFrame:
    """Project to the features (``x ARRAY<DOUBLE>`` or scalar ``_f0..``),
    ``y INT`` and ``h BIGINT``; ``h`` keys the dropout draw (a hash of the
    whole row when no column is given). A ``tag`` becomes ``t INT``."""
    h = F.col(row_hash) if row_hash else F.xxhash64(*df.columns)
    tags = [] if tag is None else [tag.cast("int").alias("t")]
    return df.select(*_feature_columns(features), F.col(label).cast("int").alias("y"),
                     h.cast("bigint").alias("h"), *tags)


# Largest partitions × parameters count whose partial sums are summed on the
# driver directly (a one-level tree aggregate); above it Spark sums them.
DRIVER_REDUCE_MAX = 4_000_000


def _totals(rows: DataFrame | RDD, P, p_drop=0.0, epoch=0, seed=0, scale_dropout_grad=False,
            need_grad=True, parts=None, spark=None):
    """One pass over the rows of :func:`prepare` or, packed, of one tag: ``(n, loss_sum, correct, gradient_sum)``.

    Every task emits one partial. When ``partitions × parameters`` is small
    the partials are summed on the driver (what ``treeAggregate`` does);
    otherwise Spark sums them per parameter index and only the
    parameter-sized total is collected. ``parts``: partitions where they are known (asking plans the rows again).
    """
    spark = spark or rows.sparkSession
    shipped = Shipped(spark, P)
    how = shipped, p_drop, epoch, seed, scale_dropout_grad, need_grad
    size = sum(p.size for p in P)
    try:
        if isinstance(rows, RDD):
            partials = rows.mapPartitions(_packed_partials(*how)).map(lambda r: r[1:])
            parts = parts or rows.getNumPartitions()
        else:
            partials = rows.mapInArrow(_partials(*how), _PARTIAL)
            parts = parts or (rows.rdd.getNumPartitions() if need_grad else 0)
        if not need_grad or parts * size <= DRIVER_REDUCE_MAX:
            n, loss, correct, g = _added(partials.collect(), size if need_grad else 0)
        else:
            if isinstance(rows, RDD):
                partials = spark.createDataFrame(partials.map(lambda r: (*r[:3], r[3].tolist())), _PARTIAL, verifySchema=False)
            n, loss, correct, g = _added_by_spark(partials, size)
    finally:
        shipped.release()
    if need_grad and n == 0:
        raise ValueError("mlp: no training rows")
    return n, loss, correct, g if need_grad else None


def _added(partials, size):
    """Sums of collected partials."""
    n, loss, correct, g = 0, 0.0, 0, np.zeros(size)
    for r in partials:
        n, loss, correct = n + r[0], loss + r[1], correct + r[2]
        if size:
            g += np.asarray(r[3])
    return n, loss, correct, g


def _added_by_spark(partials: DataFrame, size: int):
    exploded = partials.select("n", "loss", "correct", F.posexplode("g").alias("idx", "gv"))
    sums = exploded.groupBy("idx").agg(F.sum("gv").alias("g"), F.sum("n").alias("n"),
                                       F.sum("loss").alias("loss"),
                                       F.sum("correct").alias("correct")).collect()
    if len(sums) != size:
        raise ValueError("mlp: no training rows")
    g = np.zeros(size)
    for r in sums:
        g[r["idx"]] = r["g"]
    r0 = sums[0]
    return int(r0["n"]), float(r0["loss"]), int(r0["correct"]), g


def _train_and_eval(both: RDD, P, p_drop, epoch, seed, scale_dropout_grad, spark):
    """One job: the gradient pass over the training rows (tag 0) and the evaluation
    pass over the others with the same weights. Returns (train totals, validation totals)."""
    shipped = Shipped(spark, P)
    try:
        found = both.mapPartitions(_packed_partials(shipped, p_drop, epoch, seed, scale_dropout_grad, True)).collect()
    finally:
        shipped.release()
    train, val = (_added([r[1:] for r in found if r[0] == t], size)
                  for t, size in enumerate((sum(p.size for p in P), 0)))
    if train[0] == 0:
        raise ValueError("mlp: no training rows")
    return train, val


def too_wide(params: DataFrame | list) -> bool:
    """Whether the weights of a parameter table are too many to ship; they stay tables then (``plans/wide.py``)."""
    return isinstance(params, DataFrame) and params.count() > BROADCAST_CELLS


def params_arrays(params: DataFrame) -> list[np.ndarray]:
    """``[W1, b1, W2, b2]`` with one collect (model-sized, size-checked)."""
    found = layer_arrays(params, None)
    return [*found["l1"], *found["l2"]]


def mlp_init(spark: SparkSession, in_dim: int, hidden: int, classes: int, seed: int) -> DataFrame:
    return linear_init(spark, "l1", in_dim, hidden, seed).unionByName(
        linear_init(spark, "l2", hidden, classes, seed + 1))


def mlp_gradients(params: DataFrame, df: DataFrame, features: str | list[str], label: str,
                  row_hash: str | None = None, p_drop: float = 0.0, epoch: int = 0,
                  seed: int = 0, scale_dropout_grad: bool = False) -> DataFrame:
    """Loss gradient of every parameter for one full-batch step:
    ``(layer, name, i, j, grad)`` plus ``loss`` (mean cross-entropy) repeated."""
    if too_wide(params):
        return wide.mlp_gradients_wide(params, df, features, label, [row_hash] if row_hash else [], p_drop=p_drop,
                                       epoch=epoch, seed=seed)
    P = params_arrays(params)
    n, loss, _, g = _totals(prepare(df, features, label, row_hash), P, p_drop, epoch, seed,
                            scale_dropout_grad)
    spark = df.sparkSession
    return _grad_table(spark, P, g / n).withColumn("loss", F.lit(loss / n))


def _grad_table(spark: SparkSession, P, g: np.ndarray) -> DataFrame:
    W1g, b1g, W2g, b2g = _unflat(g, P)
    return params_from_arrays(spark, {"l1": (W1g, b1g), "l2": (W2g, b2g)}).select(
        "layer", "name", "i", "j", F.col("value").alias("grad"))


def mlp_evaluate(params: DataFrame | list, df: DataFrame, features: str | list[str], label: str) -> DataFrame:
    """``(n, loss, accuracy)`` of the network without dropout; one job (block tables above 1M weights)."""
    if too_wide(params):
        return wide.mlp_evaluate_wide(params, df, features, label, [])
    P = params if isinstance(params, list) else params_arrays(params)
    n, loss, correct, _ = _totals(prepare(df, features, label, row_hash=None), P, need_grad=False)
    spark = df.sparkSession
    return spark.createDataFrame(
        [(n, loss / n if n else None, 100.0 * correct / n if n else None)],
        "n bigint, loss double, accuracy double")


def mlp_predict(params: DataFrame | list, df: DataFrame, features: str | list[str],
                keep: list[str] | None = None) -> DataFrame:
    """Class probabilities ``p0..p{k-1}`` and the first argmax ``pred`` per row;
    row-local (``mapInArrow``), so it also runs on a streaming DataFrame. Weights above 1M stay block
    tables (batch only)."""
    if too_wide(params):
        out = wide.mlp_predict_wide(params, df, features, keep or [])
        k = params.where("layer = 'l2' AND name = 'b'").count()
        return out.select(*(keep or []), "pred", *[F.col("p")[c].alias(f"p{c}") for c in range(k)])
    P = params if isinstance(params, list) else params_arrays(params)
    if sum(p.size for p in P) > BROADCAST_CELLS:
        raise ValueError("mlp_predict: model too large to ship to tasks")
    shipped = Shipped(df.sparkSession, P)
    keep = keep or []
    k = P[2].shape[1]
    src = df.select(*keep, *_feature_columns(features))
    fields = [f for f in src.schema.fields if f.name in keep]
    schema = T.StructType(fields + [T.StructField("pred", T.IntegerType())]
                          + [T.StructField(f"p{c}", T.DoubleType()) for c in range(k)])

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            n = batch.num_rows
            X = _matrix(batch, P[0].shape[0])
            y = np.full(n, -1, dtype=np.int64)
            _, _, prob, _ = forward_backward(X, y, y, shipped.get(), need_grad=False)
            cols = [batch.column(c) for c in keep]
            cols.append(pa.array(np.argmax(prob, axis=1).astype(np.int32)))
            cols += [pa.array(prob[:, c]) for c in range(k)]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "pred"] + [f"p{c}" for c in range(k)])

    return src.mapInArrow(run, schema)


def _metric(pending, vn, vloss, vcorrect):
    epoch, train_loss = pending
    return (epoch, train_loss, vloss / vn if vn else None, 100.0 * vcorrect / vn if vn else None)


def _width(df: DataFrame, features: str | list[str]) -> int:
    """Inputs of a row: the number of columns, or the first array's length (all rows are checked when they are read)."""
    if not isinstance(features, str):
        return len(features)
    first = df.select(F.size(features).alias("n")).first()
    return max(first["n"], 0) if first else 0


_SAVED = "part string, weights array<double>, m array<double>, v array<double>"
_METRICS = "epoch int, train_loss double, val_loss double, val_acc double"


def _save_state(spark, folder, epoch, P, m, v, metrics, pending) -> None:
    state = [(f"p{i}", *[x.reshape(-1).tolist() for x in arrays]) for i, arrays in enumerate(zip(P, m, v))]
    due = [(*pending, None, None)] if pending else []
    resume.save(spark, folder, epoch, {"state": spark.createDataFrame(state, _SAVED),
                                       "metrics": spark.createDataFrame(metrics, _METRICS),
                                       "pending": spark.createDataFrame(due, _METRICS)})


def _load_state(spark, folder, epoch, P):
    """Weights, moments, metrics and the evaluation still due, as they were saved; shapes are those of ``P``."""
    rows = {r["part"]: r for r in resume.load(spark, folder, epoch, "state").collect()}
    if {k: len(r["weights"]) for k, r in rows.items()} != {f"p{i}": p.size for i, p in enumerate(P)}:
        raise ValueError(f"mlp_train: the state in {folder} is of another network")
    out = [[np.array(rows[f"p{i}"][c]).reshape(p.shape) for i, p in enumerate(P)] for c in ("weights", "m", "v")]
    metrics = [tuple(r) for r in resume.load(spark, folder, epoch, "metrics").orderBy("epoch").collect()]
    due = resume.load(spark, folder, epoch, "pending").first()
    return *out, metrics, (due["epoch"], due["train_loss"]) if due else None


def mlp_train(train: DataFrame, val: DataFrame | str, features: str | list[str], label: str, *,
              hidden: int = 16, classes: int = 3, epochs: int = 2000, lr: float = 0.01,
              beta1: float = 0.9, beta2: float = 0.999, eps: float = 1e-8,
              dropout: float = 0.1, eval_every: int = 200, seed: int = 0,
              row_hash: str | None = None, scale_dropout_grad: bool = False,
              init: DataFrame | None = None, persist: bool = True, folder: str | None = None,
              save_every: int = 1, source: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Full-batch Adam training; returns ``(metrics, params)``. A caller whose rows are
    persisted already says ``persist=False``; they are packed as they lie, not spread first.

    ``val`` is a table, or the column of ``train`` that is true for training rows and false for validation
    rows: both are then packed in one pass. ``source`` is a persisted table that the rows come from; it is
    released once they are packed, so that epochs have its memory.

    With ``folder`` the weights, moments and metrics are saved there every ``save_every`` epochs, and a run
    that finds a saved state goes on from it; on the same partitions it ends like one that was never broken, bit for bit.
    More than 1M weights take the block tables of ``plans/wide.py``, whose dropout masks go by row numbers.

    ``metrics`` has one row per evaluation: ``(epoch, train_loss, val_loss,
    val_acc)``; validation runs without dropout every ``eval_every`` epochs,
    inside the next epoch's job (same weights), so it costs no job of its own
    except after the last epoch.
    """
    spark = train.sparkSession
    # persisted once for all epochs; a lost block is recomputed from its
    # (short, deterministic) lineage
    flag = val if isinstance(val, str) else None
    in_dim = len(features) if not isinstance(features, str) else None
    if (in_dim or _width(train, features)) * hidden + hidden * classes > BROADCAST_CELLS:
        if flag:
            train, val = train.filter(F.col(flag)), train.filter(~F.col(flag))
        metrics, net = wide.mlp_train_wide(
            train, val, features, label, [row_hash] if row_hash else [], hidden=hidden, classes=classes, epochs=epochs, lr=lr,
            beta1=beta1, beta2=beta2, eps=eps, dropout=dropout, eval_every=eval_every, seed=seed, init=init, folder=folder,
            save_every=save_every)
        return metrics, net.params()
    if flag:
        tables = [prepare(train.filter(F.col(flag).isNotNull()), features, label, row_hash, F.when(F.col(flag), 0).otherwise(1))]
    else:
        tables = [prepare(df, features, label, row_hash, F.lit(t)) for t, df in enumerate((train, val))]
    in_dim = in_dim or packed_shape(tables[0].where("t = 0"), F.col("x"))[1]
    if persist:
        tables = [spread(df, "h") for df in tables]
    # kept as an RDD of arrays: tasks get them one by one, where Arrow would put a whole partition of such rows in one batch
    both = packed(reduce(DataFrame.unionByName, tables), in_dim).rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
    tr, va = both.filter(lambda r: r[0] == 0), both.filter(lambda r: r[0] == 1)
    try:
        if source is not None:
            both.count()
            source.unpersist()
        params = init if init is not None else mlp_init(spark, in_dim, hidden, classes, seed)
        P = params_arrays(params)
        m = [np.zeros_like(p) for p in P]
        v = [np.zeros_like(p) for p in P]
        metrics = []
        pending = None  # (epoch, train loss) whose validation is still due
        t = resume.latest(spark, folder, epochs)
        if t:
            P, m, v, metrics, pending = _load_state(spark, folder, t, P)
        size = sum(p.size for p in P)
        parts = both.getNumPartitions()
        fuse = parts * size <= DRIVER_REDUCE_MAX
        for epoch in range(t + 1, epochs + 1):
            if pending is not None and fuse:
                # the weights after epoch e are the weights of epoch e+1's pass
                (n, loss, _, g), (vn, vloss, vcorrect, _) = _train_and_eval(
                    both, P, dropout, epoch, seed, scale_dropout_grad, spark)
                metrics.append(_metric(pending, vn, vloss, vcorrect))
                pending = None
            else:
                n, loss, _, g = _totals(tr, P, dropout, epoch, seed, scale_dropout_grad, parts=parts, spark=spark)
            grads = _unflat(g / n, P)
            new = [adam_numpy(p, gp, mp, vp, t, lr, beta1, beta2, eps)
                   for p, gp, mp, vp in zip(P, grads, m, v)]
            P, m, v = [x[0] for x in new], [x[1] for x in new], [x[2] for x in new]
            t += 1
            if epoch % eval_every == 0:
                pending = (epoch, loss / n)
                if epoch == epochs or not fuse:
                    vn, vloss, vcorrect, _ = _totals(va, P, need_grad=False, spark=spark)
                    metrics.append(_metric(pending, vn, vloss, vcorrect))
                    pending = None
            if folder and epoch % save_every == 0:
                _save_state(spark, folder, epoch, P, m, v, metrics, pending)
    finally:
        both.unpersist()
    metrics_df = spark.createDataFrame(metrics, _METRICS)
    return metrics_df, params_from_arrays(spark, {"l1": (P[0], P[1]), "l2": (P[2], P[3])})
