"""The two-layer network (in -> hidden, ReLU, dropout -> classes, softmax) with weights of any number.

Weights, activations and gradients are block tables (``operators/blocks.py``); a layer is one matrix, its
bias the last row, met by a one at the end of each input row. An epoch is a few products of tables, each
written to the shared folder so that no lineage grows:

1. ``dZ = softmax(A W2) - targets``, loss and hits     (written; a task holds one block row)
2. ``A' dZ`` and ``X' dH``, ``dH = (dZ W2') * (A > 0)``   (sums over the rows, written)
3. new ``W1`` and ``W2`` by Adam                       (written; blocks meet on their numbers)

The activations ``A = relu(X W1)``, dropped out, are rows by hidden units: a task that needs some makes them from the
rows and units it holds, block row by block row, so nothing of that size is shuffled or written. Only where the copies
of the inputs would be more than the activations (inputs wider than the hidden layer) do ``A`` and ``dH`` become tables.

The driver holds the shapes, the epoch and the metrics. Rows are numbered by the ``key`` columns, then inputs and
label; the numbers also key the dropout draws, so a retried task draws the same masks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.core import packed_shape, splitmix
from tessera.operators import blocks as B
from tessera.operators.blocks import Blocks
from tessera.operators.loss import LOG_EPS
from tessera.plans import resume
from tessera.plans.layers import linear_init
from tessera.session import remove_table, scratch_table_path

BLOCK = 128
#: Weights that a task holds at most (more: hidden units are dealt out), activations that make up a task, and those that
#: it makes at once.
SHARE_CELLS, TASK_CELLS, SLICE_CELLS = 1 << 22, 1 << 24, 1 << 18
_STATE = "bi bigint, bj bigint, values array<double>, m array<double>, v array<double>"
_GRADED = "bi bigint, bj bigint, values array<double>, loss double, correct bigint"


def _layout(dims: tuple[int, int, int], block: int, layer: int) -> tuple[tuple[int, int], tuple[int, int]]:
    """Shape of a layer with its bias row, and of its blocks: rows of the second are cut like columns of the first."""
    d, h, k = dims
    if layer == 1:
        return (d + 1, h), (min(block, d + 1), min(block, h))
    return (h + 1, k), (min(block, h), min(block, k))


@dataclass(frozen=True)
class Net:
    """Both layers as block tables with moments, ``(bi, bj, values, m, v)``; ``block`` holds the block
    lengths of rows, inputs, hidden units and classes."""

    l1: DataFrame
    l2: DataFrame
    dims: tuple[int, int, int]
    block: int = BLOCK

    def weights(self, layer: int) -> Blocks:
        table = self.l1 if layer == 1 else self.l2
        return Blocks(table.select("bi", "bj", "values"), *_layout(self.dims, self.block, layer))

    def params(self) -> DataFrame:
        """The parameter table ``(layer, name, i, j, value, grad, m, v)``, gradients 0."""
        parts = []
        for name, layer, table in (("l1", 1, self.l1), ("l2", 2, self.l2)):
            w = self.weights(layer)
            last = w.shape[0] - 1
            cells = None
            for col in ("values", "m", "v"):
                own = B.to_cells(replace(w, df=table.select("bi", "bj", F.col(col).alias("values")))).df.select(
                    "c0", "c1", F.col("value").alias(col))
                cells = own if cells is None else cells.join(own, ["c0", "c1"])
            bias = F.col("c0") == last
            parts.append(cells.select(
                F.lit(name).alias("layer"), F.when(bias, "b").otherwise("W").alias("name"),
                F.when(bias, 0).otherwise(F.col("c0")).cast("int").alias("i"), F.col("c1").cast("int").alias("j"),
                F.col("values").alias("value"), F.lit(0.0).alias("grad"), "m", "v"))
        return parts[0].unionByName(parts[1])


def net(params: DataFrame, dims: tuple[int, int, int] | None = None, block: int = BLOCK) -> Net:
    """The block form of a parameter table, moments 0; ``dims`` (inputs, hidden units, classes) is found when omitted."""
    if dims is None:
        top = {r["layer"]: (r["i"] + 1, r["j"] + 1) for r in params.where("name = 'W'").groupBy("layer").agg(
            F.max("i").alias("i"), F.max("j").alias("j")).collect()}
        if set(top) != {"l1", "l2"} or top["l1"][1] != top["l2"][0]:
            raise ValueError(f"mlp: layers {top} do not fit together")
        dims = (*top["l1"], top["l2"][1])
    tables = []
    zero = F.array_repeat(F.lit(0.0), F.size("values"))
    for layer, name, last in ((1, "l1", dims[0]), (2, "l2", dims[1])):
        shape, size = _layout(dims, block, layer)
        cells = params.where(F.col("layer") == name).select(
            F.when(F.col("name") == "b", last).otherwise(F.col("i")).cast("bigint").alias("c0"),
            F.col("j").cast("bigint").alias("c1"), "value")
        own = B.assembled(B.pieces(cells, shape, size), shape, size)
        tables.append(own.df.select("bi", "bj", "values", zero.alias("m"), zero.alias("v")))
    return Net(*tables, dims, block)


class _Scratch:
    """Written tables of a run; those of an epoch go when the next one has been written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame, name: str, schema: str | None = None) -> DataFrame:
        path = scratch_table_path(self.spark, f"wide-{name}")
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, keep: int = 0) -> None:
        gone, self.paths = self.paths[:len(self.paths) - keep], self.paths[len(self.paths) - keep:]
        for path in gone:
            remove_table(self.spark, path)


# ------------------------------------------------------------------ rows

@dataclass(frozen=True)
class Rows:
    """Numbered rows: inputs with a one at the end as blocks, and labels by block row."""

    x: Blocks
    labels: DataFrame | None
    numbers: DataFrame
    n: int


def rows(df: DataFrame, features: str | list[str], label: str | None, key: list[str], width: int, scratch: _Scratch,
         block: int = BLOCK) -> Rows:
    """Rows of ``df`` as blocks; ``features`` is an array column or scalar columns."""
    x = F.col(features).cast("array<double>") if isinstance(features, str) else \
        F.array(*[F.col(c).cast("double") for c in features])
    y = F.lit(-1) if label is None else F.coalesce(F.col(label).cast("int"), F.lit(-1))
    named = [F.col(c).alias(f"_k{i}") for i, c in enumerate(key)]
    numbered, n = B.numbered(df.select(*named, F.concat(x, F.array(F.lit(1.0))).alias("_x"), y.alias("_y")),
                             [*[f"_k{i}" for i in range(len(key))], "_x", "_y"], "row")
    if not n:
        raise ValueError("mlp: no rows")
    numbered = scratch(numbered, "rows")
    size = min(block, n)
    full = B.from_rows(numbered, "row", "_x", (n, width + 1), (size, min(block, width + 1)))
    labels = numbered.groupBy(B.int_div(F.col("row"), size).alias("bi")).agg(
        F.array_sort(F.collect_list(F.struct("row", "_y"))).alias("_l")).select(
        "bi", F.lit(-1).cast("bigint").alias("bj"), F.transform("_l", lambda r: r["_y"].cast("double")).alias("values"))
    numbers = numbered.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(key)], "row")
    return Rows(replace(full, df=scratch(full.df, "x")), scratch(labels, "y"), numbers, n)


# ------------------------------------------------------------------ one pass

def _uniform(first_row: int, high: int, first_unit: int, wide: int, epoch: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = splitmix(np.array([seed * 1_000_003 + epoch], np.uint64))
        base = splitmix(np.arange(first_row, first_row + high, dtype=np.uint64) ^ key)
        z = splitmix(base[:, None] + np.arange(first_unit, first_unit + wide, dtype=np.uint64)[None, :])
    return (z >> np.uint64(11)).astype(np.float64) / 9007199254740992.0


def dropout_keep(rows_: int, units: int, p_drop: float, epoch: int, seed: int) -> np.ndarray:
    """The mask of kept activations, row numbers by units."""
    return _uniform(0, rows_, 0, units, epoch, seed) >= p_drop


def activations(net_: Net, x: Blocks, p_drop: float = 0.0, epoch: int = 0, seed: int = 0) -> Blocks:
    """``relu(X W1)``, dropped out and scaled in training."""
    z = B.matmul_blocks(x, net_.weights(1))
    n, (rs, cs) = z.shape[0], z.block

    def fn(i, j, v):
        a = np.where(v < 0, 0.0, v)
        if p_drop > 0:
            high = min(rs, n - i * rs)
            keep = _uniform(i * rs, high, j * cs, len(v) // high, epoch, seed) >= p_drop
            a = np.where(keep.reshape(-1), a / (1.0 - p_drop), 0.0)
        return a

    return B.mapped(z, fn)


def with_ones(a: Blocks) -> Blocks:
    """A column of ones after the last: what meets the bias row."""
    (n, d), (rs, cs) = a.shape, a.block
    last = math.ceil(d / cs) - 1

    def run(batches):
        def out():
            for b in batches:
                for i, j, v in zip(b.column("bi").to_pylist(), b.column("bj").to_pylist(), B._arrays(b.column("values"))):
                    high = min(rs, n - i * rs)
                    if j != last:
                        yield i, j, v
                    elif d % cs:
                        yield i, j, np.hstack([v.reshape(high, -1), np.ones((high, 1))]).reshape(-1)
                    else:
                        yield i, j, v
                        yield i, j + 1, np.ones(high)
        yield from B.batches_of(out())

    B.bounded_batches(a.df.sparkSession)
    return Blocks(a.df.mapInArrow(run, B.SCHEMA), (n, d + 1), a.block)


def without_bias(w: Blocks) -> Blocks:
    """A layer's weights without the bias row."""
    (d, k), (rs, cs) = w.shape, w.block
    last = (d - 1) // rs
    if (d - 1) % rs == 0:
        return Blocks(w.df.where(F.col("bi") < last), (d - 1, k), w.block)

    def fn(i, j, v):
        return v[:len(v) - min(cs, k - j * cs)] if i == last else v

    return replace(B.mapped(w, fn), shape=(d - 1, k))


# ------------------------------------------------------------------ activations where they are needed

def _dealt(own: Net, x: Blocks) -> tuple[int, int] | None:
    """Groups of rows and of hidden units; a task has one of each. None where the copies of the inputs would be more
    than the activations."""
    (n, _), (rs, _), (d, h, k) = x.shape, x.block, own.dims
    units = min(math.ceil(h / own.block), math.ceil(h * (d + k + 1) / SHARE_CELLS))
    if units * (d + 1) >= h:
        return None
    cores = x.df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(math.ceil(n / rs), 4 * cores, math.ceil(n * h / (units * TASK_CELLS)))), units


def _met(own: Net, x: Blocks, groups: tuple[int, int], dz: Blocks | None = None) -> DataFrame:
    """Rows ``(cell, at, side, bi, bj, values)`` in order: the weights of a cell's units (sides 1 and 2, ``at`` -1), then
    block row by block row its inputs (3) and gradients of the outputs (4)."""
    gi, gj = groups
    spark = x.df.sparkSession

    def group(c: str, n: int):
        return F.pmod(F.col(c), F.lit(n))

    def named(df, cell, at, side):
        return df.select(cell.alias("cell"), at.cast("bigint").alias("at"), F.lit(side).alias("side"), "bi", "bj", "values")

    both = None
    for side, w, by in ((1, own.weights(1), "bj"), (2, own.weights(2), "bi")):
        some = named(B._copies(w.df, gi, "_x"), F.col("_x") * gj + group(by, gj), F.lit(-1), side)
        both = some if both is None else both.unionByName(some)
    for side, t in ((3, x), (4, dz)):
        if t is not None:
            both = both.unionByName(named(B._copies(t.df, gj, "_y"), group("bi", gi) * gj + F.col("_y"), F.col("bi"), side))
    parts = min(gi * gj, 64 * spark.sparkContext.defaultParallelism)
    B.bounded_batches(spark)
    return both.repartitionById(parts, B.int_div(F.col("cell") * parts, gi * gj).cast("int")).sortWithinPartitions(
        "cell", "at", "side", "bi", "bj")


def _by_place(batches):
    """(cell, at, [(side, bi, bj, values), ...]) of the stream of :func:`_met`."""
    place, held = None, []
    for b in batches:
        heads = zip(*(b.column(c).to_pylist() for c in ("cell", "at", "side", "bi", "bj")))
        for (cell, at, *head), v in zip(heads, B._arrays(b.column("values"))):
            if (cell, at) != place:
                if held:
                    yield *place, held
                place, held = (cell, at), []
            held.append((*head, np.array(v)))
    if held:
        yield *place, held


class _Units:
    """The weights of a cell's hidden units, in slices of some of their blocks: (blocks, W1, W2)."""

    def __init__(self, dims: tuple[int, int, int], block: int, high: int, group: int, groups: int, found: list):
        d, h, k = dims
        self.dims, self.cs, self.ks, ds = dims, min(block, h), min(block, k), min(block, d + 1)
        self.wide = {j: min(self.cs, h - j * self.cs) for j in range(group, math.ceil(h / self.cs), groups)}
        first = {j: np.zeros((d + 1, w)) for j, w in self.wide.items()}
        # the bias row is the last of its block, or a block by itself
        self.bias = h // self.cs if h // self.cs % groups == group else None
        second = {i: np.zeros((min(self.cs, h + 1 - i * self.cs), k)) for i in {*self.wide, self.bias} - {None}}
        for side, i, j, v in found:
            if side == 1:
                first[j][i * ds:(i + 1) * ds] = v.reshape(-1, self.wide[j])
            else:
                second[i][:, j * self.ks:(j + 1) * self.ks] = v.reshape(len(second[i]), -1)
        self.shift = second[self.bias][-1] if self.bias is not None else np.zeros(k)
        step, js = max(1, SLICE_CELLS // (high * self.cs)), list(self.wide)
        self.slices = [(some, np.hstack([first[j] for j in some]), np.vstack([second[j][:self.wide[j]] for j in some]))
                       for some in (js[a:a + step] for a in range(0, len(js), step))]

    def made(self, x: np.ndarray, some: list[int], w: np.ndarray, first_row: int, p_drop: float, epoch: int, seed: int):
        """Activations of block row ``x`` in the units of a slice."""
        a = x @ w
        np.maximum(a, 0.0, out=a)
        if p_drop > 0:
            keep = np.hstack([_uniform(first_row, len(x), j * self.cs, self.wide[j], epoch, seed) for j in some]) >= p_drop
            a = np.where(keep, a / (1.0 - p_drop), 0.0)
        return a


def _block_row(found: list, side: int, shape: tuple[int, int], wide: int) -> np.ndarray:
    panel = np.zeros(shape)
    for s, _, j, v in found:
        if s == side:
            panel[:, j * wide:(j + 1) * wide] = v.reshape(shape[0], -1)
    return panel


_PARTS = "layer int, cell bigint, bi bigint, bj bigint, values array<double>"


def _part_rows(rows_) -> pa.RecordBatch:
    layer, cell, bi, bj, values = zip(*rows_)
    flat = [np.ascontiguousarray(v).reshape(-1) for v in values]
    return pa.RecordBatch.from_arrays(
        [pa.array(layer, pa.int32()), *[pa.array(c, pa.int64()) for c in (cell, bi, bj)],
         B._list(np.concatenate(flat), np.cumsum([0] + [len(v) for v in flat]))], ["layer", "cell", "bi", "bj", "values"])


def _added(parts: DataFrame, n: int) -> DataFrame:
    """Blocks with the same numbers added up, in order of their cells."""
    def run(batches):
        def sums():
            at, total = None, None
            for b in batches:
                for key, v in zip(zip(*(b.column(c).to_pylist() for c in ("layer", "bi", "bj"))), B._arrays(b.column("values"))):
                    if key == at:
                        total += v
                        continue
                    if at is not None:
                        yield _part_rows([(at[0], 0, *at[1:], total)])
                    at, total = key, np.array(v)
            if at is not None:
                yield _part_rows([(at[0], 0, *at[1:], total)])
        yield from sums()

    return parts.repartition(n, "layer", "bi", "bj").sortWithinPartitions("layer", "bi", "bj", "cell").mapInArrow(run, _PARTS)


def _logits(own: Net, x: Blocks, p_drop: float = 0.0, epoch: int = 0, seed: int = 0) -> Blocks:
    """``A W2`` with the bias."""
    groups = _dealt(own, x)
    if groups is None:
        return B.matmul_blocks(with_ones(activations(own, x, p_drop, epoch, seed)), own.weights(2))
    (n, wide), (rs, cs), dims, block, gj = x.shape, x.block, own.dims, own.block, groups[1]
    k = dims[2]
    ks = min(block, k)

    def run(batches):
        units = None
        for cell, i, found in _by_place(batches):
            if i < 0:
                units = _Units(dims, block, rs, cell % gj, gj, found)
                continue
            panel = _block_row(found, 3, (min(rs, n - i * rs), wide), cs)
            z = np.tile(units.shift, (len(panel), 1))
            for some, w1, w2 in units.slices:
                z += units.made(panel, some, w1, i * rs, p_drop, epoch, seed) @ w2
            yield _part_rows([(0, cell, i, j, z[:, j * ks:(j + 1) * ks]) for j in range(math.ceil(k / ks))])

    z = _met(own, x, groups).mapInArrow(run, _PARTS)
    if gj > 1:
        z = _added(z, B._parts(z.sparkSession, n * k * gj, math.ceil(n / rs)))
    return Blocks(z.select("bi", "bj", "values"), (n, k), (rs, ks))


def _gradients(own: Net, x: Blocks, dz: Blocks, groups: tuple[int, int], scratch: _Scratch, p_drop: float, epoch: int,
               seed: int) -> tuple[Blocks, Blocks]:
    """Gradients of both layers, as sums over the rows."""
    (n, wide), (rs, cs), dims, block, gj = x.shape, x.block, own.dims, own.block, groups[1]
    d, h, k = dims
    ks, ds = min(block, k), min(block, d + 1)

    def run(batches):
        at, units, sums, bias = None, None, [], np.zeros(k)

        def given():
            for (some, w1, _), (g1, g2) in zip(units.slices, sums):
                left = 0
                for j in some:
                    mine = slice(left, left + units.wide[j])
                    left += units.wide[j]
                    down = g2[mine] if j != units.bias else np.vstack([g2[mine], bias])
                    yield [(1, at, i, j, g1[i * ds:(i + 1) * ds, mine]) for i in range(math.ceil((d + 1) / ds))] + [
                        (2, at, j, c, down[:, c * ks:(c + 1) * ks]) for c in range(math.ceil(k / ks))]
            if units.bias is not None and units.bias not in units.wide:
                yield [(2, at, units.bias, c, bias[None, c * ks:(c + 1) * ks]) for c in range(math.ceil(k / ks))]

        for cell, i, found in _by_place(batches):
            if i < 0:
                if units is not None:
                    yield from map(_part_rows, given())
                at, units, bias = cell, _Units(dims, block, rs, cell % gj, gj, found), np.zeros(k)
                sums = [(np.zeros(w1.shape), np.zeros(w2.shape)) for _, w1, w2 in units.slices]
                continue
            high = min(rs, n - i * rs)
            panel, grad = _block_row(found, 3, (high, wide), cs), _block_row(found, 4, (high, k), ks)
            bias += grad.sum(axis=0)
            for (some, w1, w2), (g1, g2) in zip(units.slices, sums):
                a = units.made(panel, some, w1, i * rs, p_drop, epoch, seed)
                g2 += a.T @ grad
                back = grad @ w2.T
                back[a <= 0] = 0.0
                g1 += panel.T @ back
        if units is not None:
            yield from map(_part_rows, given())

    parts = _met(own, x, groups, dz).mapInArrow(run, _PARTS)
    blocks_ = math.ceil((d + 1) / ds) * math.ceil(h / min(block, h))
    total = scratch(_added(parts, B._parts(parts.sparkSession, h * (d + 1 + k) * groups[0], blocks_)), "g")
    return tuple(Blocks(total.where(F.col("layer") == layer).select("bi", "bj", "values"), *_layout(dims, block, layer))
                 for layer in (1, 2))


def _graded(z: Blocks, labels: DataFrame) -> DataFrame:
    """``(bi, bj, values, loss, correct)``: softmax minus targets by block, the sums of a block row beside its first block."""
    (n, k), (rs, cs) = z.shape, z.block

    def run(batches):
        for i, found in B.block_rows(batches):
            high = min(rs, n - i * rs)
            y = found[0][1].astype(np.int64)  # labels have the block number -1 and come first
            panel = np.zeros((high, k))
            for j, v in found[1:]:
                panel[:, j * cs:(j + 1) * cs] = v.reshape(high, -1)
            e = np.exp(panel - panel.max(axis=1, keepdims=True))
            p = e / e.sum(axis=1, keepdims=True)
            known = (y >= 0) & (y < k)
            hit = np.flatnonzero(known)
            loss = float(-np.log(p[hit, y[hit]] + LOG_EPS).sum())
            correct = int((np.argmax(p, axis=1)[hit] == y[hit]).sum())
            p[hit, y[hit]] -= 1.0
            for j in range(math.ceil(k / cs)):
                part = p[:, j * cs:(j + 1) * cs].reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i]), pa.array([j]), B._list(part, [0, len(part)]), pa.array([loss if j == 0 else None], pa.float64()),
                     pa.array([correct if j == 0 else None], pa.int64())], ["bi", "bj", "values", "loss", "correct"])

    both = replace(z, df=z.df.select("bi", "bj", "values").unionByName(labels))
    return B.by_block_row(both).mapInArrow(run, _GRADED)


def _sums(graded: DataFrame) -> tuple[float, int]:
    r = graded.where("loss IS NOT NULL").agg(F.sum("loss").alias("loss"), F.sum("correct").alias("c")).first()
    return r["loss"], r["c"]


def _backward(net_: Net, data: Rows, scratch: _Scratch, p_drop: float, epoch: int, seed: int):
    """``(loss sum, correct, gradient of l1, of l2)``, the gradients as sums over the rows."""
    groups = _dealt(net_, data.x)
    if groups is not None:
        z = _logits(net_, data.x, p_drop, epoch, seed)
        graded = scratch(_graded(z, data.labels), "dz")
        dz = Blocks(graded.select("bi", "bj", "values"), z.shape, z.block)
        return *_sums(graded), *_gradients(net_, data.x, dz, groups, scratch, p_drop, epoch, seed)
    a = activations(net_, data.x, p_drop, epoch, seed)
    a = replace(a, df=scratch(a.df, "a"))
    ones = with_ones(a)
    z = B.matmul_blocks(ones, net_.weights(2))
    graded = scratch(_graded(z, data.labels), "dz")
    loss, correct = _sums(graded)
    dz = Blocks(graded.select("bi", "bj", "values"), z.shape, z.block)
    g2 = B.matmul_blocks(B.transposed(ones), dz)
    da = B.matmul_blocks(dz, B.transposed(without_bias(net_.weights(2))))
    dh = B.combine(a, [da], lambda i, j, act, grad: np.where(act > 0, grad, 0.0), keep="left")
    dh = replace(dh, df=scratch(dh.df, "dh"))
    g1 = B.matmul_blocks(B.transposed(data.x), dh)
    return loss, correct, g1, g2


def _adam(table: DataFrame, w: Blocks, grad: Blocks, n: int, t: int, lr, beta1, beta2, eps) -> DataFrame:
    """New ``(bi, bj, values, m, v)``: blocks meet their gradients on their numbers (none: zero)."""
    c1, c2 = 1.0 - beta1 ** t, 1.0 - beta2 ** t
    # a product's size is guessed from its operands: without a hint its blocks could all be sent through the driver
    both = table.join(grad.df.select("bi", "bj", F.col("values").alias("g")).hint("merge"), ["bi", "bj"], "left").select(
        "bi", "bj", "values", "m", "v", F.coalesce("g", F.array_repeat(F.lit(0.0), F.size("values"))).alias("g"))

    def run(batches):
        for b in batches:
            for i, j, w0, m0, v0, g in zip(b.column("bi").to_pylist(), b.column("bj").to_pylist(),
                                           *(B._arrays(b.column(c)) for c in ("values", "m", "v", "g"))):
                g = g / n
                m = beta1 * m0 + (1.0 - beta1) * g
                v = beta2 * v0 + (1.0 - beta2) * g * g
                new = w0 - lr * (m / c1) / (np.sqrt(v / c2) + eps)
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([j]), *[B._list(x, [0, len(x)]) for x in (new, m, v)]],
                                                 ["bi", "bj", "values", "m", "v"])

    return both.mapInArrow(run, _STATE)


# ------------------------------------------------------------------ the operators

def _width(df: DataFrame, features) -> int:
    return len(features) if not isinstance(features, str) else packed_shape(df, F.col(features))[1]


def mlp_gradients_wide(params: DataFrame, df: DataFrame, features, label: str, key: list[str], *, p_drop: float = 0.0,
                       epoch: int = 0, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """Loss gradient of every parameter, ``(layer, name, i, j, grad, loss)``, for weights of any number."""
    spark = df.sparkSession
    scratch = _Scratch(spark)
    own = net(params, block=block)
    own = replace(own, l1=scratch(own.l1, "l1"), l2=scratch(own.l2, "l2"))
    data = rows(df, features, label, key, own.dims[0], scratch, block)
    loss, _, g1, g2 = _backward(own, data, scratch, p_drop, epoch, seed)
    parts = []
    for name, g in (("l1", g1), ("l2", g2)):
        bias = F.col("c0") == g.shape[0] - 1
        parts.append(B.to_cells(g).df.select(
            F.lit(name).alias("layer"), F.when(bias, "b").otherwise("W").alias("name"),
            F.when(bias, 0).otherwise(F.col("c0")).cast("int").alias("i"), F.col("c1").cast("int").alias("j"),
            (F.col("value") / data.n).alias("grad"), F.lit(loss / data.n).alias("loss")))
    return parts[0].unionByName(parts[1])


def _evaluated(own: Net, data: Rows) -> tuple[int, float, float]:
    loss, correct = _sums(_graded(_logits(own, data.x), data.labels))
    return data.n, loss / data.n, 100.0 * correct / data.n


def mlp_evaluate_wide(params: DataFrame | Net, df: DataFrame, features, label: str, key: list[str],
                      block: int = BLOCK) -> DataFrame:
    """``(n, loss, accuracy)`` without dropout."""
    own = params if isinstance(params, Net) else net(params, block=block)
    scratch = _Scratch(df.sparkSession)
    data = rows(df, features, label, key, own.dims[0], scratch, own.block)
    found = _evaluated(own, data)
    scratch.drop()
    return df.sparkSession.createDataFrame([found], "n bigint, loss double, accuracy double")


def mlp_predict_wide(params: DataFrame | Net, df: DataFrame, features, key: list[str], block: int = BLOCK) -> DataFrame:
    """The key columns, the first argmax ``pred`` and the class probabilities ``p ARRAY<DOUBLE>`` of each row."""
    own = params if isinstance(params, Net) else net(params, block=block)
    data = rows(df, features, None, key, own.dims[0], _Scratch(df.sparkSession), own.block)
    z = B.to_rows(_logits(own, data.x), "row", "_z")
    top = F.array_max("_z")
    e = z.select("row", (F.array_position("_z", top) - 1).cast("int").alias("pred"),
                 F.transform("_z", lambda v: F.exp(v - F.array_max("_z"))).alias("_e"))
    total = F.aggregate("_e", F.lit(0.0), lambda s, v: s + v)
    p = e.withColumn("_s", total).select("row", "pred", F.transform("_e", lambda v: v / F.col("_s")).alias("p"))
    return data.numbers.join(p.hint("merge"), "row").select(*key, "pred", "p")


def mlp_train_wide(train: DataFrame, val: DataFrame, features, label: str, key: list[str], *, hidden: int, classes: int,
                   epochs: int, lr: float = 0.01, beta1: float = 0.9, beta2: float = 0.999, eps: float = 1e-8,
                   dropout: float = 0.0, eval_every: int = 1, seed: int = 0, init: DataFrame | None = None,
                   block: int = BLOCK, folder: str | None = None, save_every: int = 1) -> tuple[DataFrame, Net]:
    """Full-batch Adam training; ``(metrics, network)`` with metrics ``(epoch, train_loss, val_loss, val_acc)``.

    With ``folder`` the state is saved there every ``save_every`` epochs, and a run that finds one goes on from it."""
    spark = train.sparkSession
    scratch, fixed = _Scratch(spark), _Scratch(spark)
    width = _width(train, features)
    dims = (width, hidden, classes)
    tr = rows(train, features, label, key, width, fixed, block)
    va = rows(val, features, label, key, width, fixed, block)
    done = resume.latest(spark, folder, epochs)
    if done:
        own = Net(resume.load(spark, folder, done, "l1"), resume.load(spark, folder, done, "l2"), dims, block)
        metrics = [tuple(r) for r in resume.load(spark, folder, done, "metrics").orderBy("epoch").collect()]
    else:
        if init is None:
            init = linear_init(spark, "l1", width, hidden, seed).unionByName(linear_init(spark, "l2", hidden, classes, seed + 1))
        own, metrics = net(init, dims, block), []
    shape = "epoch int, train_loss double, val_loss double, val_acc double"
    own = replace(own, l1=scratch(own.l1, "l1"), l2=scratch(own.l2, "l2"))
    for epoch in range(done + 1, epochs + 1):
        loss, _, g1, g2 = _backward(own, tr, scratch, dropout, epoch, seed)
        tables = [_adam(t, own.weights(k), g, tr.n, epoch, lr, beta1, beta2, eps)
                  for k, t, g in ((1, own.l1, g1), (2, own.l2, g2))]
        own = replace(own, l1=scratch(tables[0], "l1"), l2=scratch(tables[1], "l2"))
        scratch.drop(keep=2)
        if epoch % eval_every == 0:
            metrics.append((epoch, loss / tr.n, *_evaluated(own, va)[1:]))
        if folder and epoch % save_every == 0:
            resume.save(spark, folder, epoch, {"l1": own.l1, "l2": own.l2, "metrics": spark.createDataFrame(metrics, shape)})
    fixed.drop()
    return spark.createDataFrame(metrics, shape), own
