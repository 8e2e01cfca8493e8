"""Matrices as tables of packed blocks ``(bi, bj, values ARRAY<DOUBLE>)``.

A block holds up to ``rows x cols`` cells of the matrix in row-major order; those at the edges are
smaller, and a block that is not there is zero. What is shuffled is arrays: cells are packed
in the task that reads them, into pieces of a block (``at``: places inside it; none when the
piece is the whole block), and the receiving task puts pieces where they belong.

The product cuts rows, columns and the inner dimension into a grid of cells
(:func:`tessera.operators.linalg.grid`). The grid's cells are dealt in order over a number of
partitions that follows the bytes moved and the cores; a partition reads its cells in order, adds the
inner panels of one result panel as they come, and gives it out when the next begins. A task holds a result
panel and one panel of each operand.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.core import Cells, arrow_matrix, int_div

#: Cells that a task packs at once.
PACKED_CELLS = 1 << 20
#: Bytes of an Arrow batch of blocks; bytes of a partition of a product, and the least and most waves of
#: four tasks a core that its partitions make.
BATCH_BYTES, PARTITION_BYTES, WAVES = 32 << 20, 512 << 20, (2, 256)
#: Cells of a partition below which it is not worth a task of its own.
LEAST_CELLS = 1 << 18
SCHEMA = "bi bigint, bj bigint, values array<double>"
_PIECES = "bi bigint, bj bigint, at array<int>, values array<double>"


@dataclass(frozen=True)
class Blocks:
    """A block table with the matrix's shape and the blocks' (rows, cols)."""

    df: DataFrame
    shape: tuple[int, int]
    block: tuple[int, int]

    def __post_init__(self):
        if len(self.shape) != 2 or min(*self.shape, *self.block) < 1:
            raise ValueError(f"invalid block matrix {self.shape} by {self.block}")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of blocks are cut by bytes: a default batch of 10,000 blocks would be gigabytes."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    have = re.match(r"\d+", spark.conf.get(key))
    if not have or int(have[0]) > BATCH_BYTES:
        spark.conf.set(key, BATCH_BYTES)


def _list(values: np.ndarray, offsets) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def _arrays(col) -> Iterator[np.ndarray]:
    """Numpy views of the rows of a list column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = np.asarray(col.offsets)
    flat = col.values
    if flat.null_count or col.null_count:
        raise ValueError("blocks: NULL block or value")
    flat = flat.to_numpy(zero_copy_only=False)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        yield flat[a:b]


def _batch(rows: list[tuple], with_places: bool = False) -> pa.RecordBatch:
    """An Arrow batch of (bi, bj, values) or (bi, bj, at, values) rows."""
    cols, names = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], ["bi", "bj"]
    kinds = (("at", np.int32), ("values", np.float64)) if with_places else (("values", np.float64),)
    for k, (name, kind) in enumerate(kinds, 2):
        parts = [np.asarray(r[k], kind).reshape(-1) for r in rows]
        cols.append(_list(np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])))
        names.append(name)
    return pa.RecordBatch.from_arrays(cols, names)


def batches_of(rows: Iterator[tuple], with_places: bool = False) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 12 * len(r[-1])
        if size >= BATCH_BYTES // 4:
            yield _batch(held, with_places)
            held, size = [], 0
    if held:
        yield _batch(held, with_places)


def _extent(b, n: int, size: int):
    """Rows (columns) of block ``b`` of a dimension of ``n`` in blocks of ``size``."""
    return np.minimum(size, n - np.asarray(b) * size)


# ------------------------------------------------------------------ in and out

def pieces(cells: DataFrame, shape: tuple[int, int], block: tuple[int, int]) -> DataFrame:
    """Cells ``(c0, c1, value)`` packed where they are read: no shuffle."""
    (m, n), (rs, cs) = shape, block

    def packed(held):
        r, c, v = (np.concatenate(x) for x in zip(*held))
        if len(r) and (min(r.min(), c.min()) < 0 or r.max() >= m or c.max() >= n):
            raise ValueError(f"blocks: a cell lies outside {shape}")
        bi, bj = r // rs, c // cs
        high, wide = _extent(bi, m, rs), _extent(bj, n, cs)
        at = (r - bi * rs) * wide + c - bj * cs
        order = np.lexsort((at, bj, bi))
        bi, bj, at, v, full = (x[order] for x in (bi, bj, at, v, high * wide))
        cut = np.flatnonzero(np.concatenate([[True], (bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])]))
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(v)]):
            # a whole block needs no places; twice the same cell is no whole block
            whole = b - a == full[a] and at[a] == 0 and at[b - 1] == b - a - 1 and (np.diff(at[a:b]) == 1).all()
            yield bi[a], bj[a], at[:0] if whole else at[a:b], v[a:b]

    def run(batches):
        held, size = [], 0
        for b in batches:
            cols = [b.column(k) for k in range(3)]
            if any(c.null_count for c in cols):
                raise ValueError("blocks: NULL coordinate or value")
            held.append([c.to_numpy(zero_copy_only=False) for c in cols])
            size += b.num_rows
            if size >= PACKED_CELLS:
                yield from batches_of(packed(held), True)
                held, size = [], 0
        if size:
            yield from batches_of(packed(held), True)

    bounded_batches(cells.sparkSession)
    return cells.select(F.col("c0").cast("bigint"), F.col("c1").cast("bigint"), F.col("value").cast("double")).mapInArrow(
        run, _PIECES)


def _as_pieces(x: Cells | Blocks, block: tuple[int, int]) -> tuple[DataFrame, tuple[int, int]]:
    if isinstance(x, Cells):
        return pieces(x.df, x.shape, block), block
    return x.df.select("bi", "bj", F.array().cast("array<int>").alias("at"), "values"), x.block


def _put(target: np.ndarray, at: np.ndarray, values: np.ndarray, add: bool) -> None:
    if not len(at):
        if len(values) != target.size:
            raise ValueError(f"blocks: {len(values)} values in a block of {target.shape}")
        values = values.reshape(target.shape)
        if add:
            target += values
        else:
            target[:] = values
        return
    spot = at // target.shape[1], at % target.shape[1]
    if add:
        np.add.at(target, spot, values)
    else:
        target[spot] = values


def _parts(spark: SparkSession, cells: int, most: int) -> int:
    """Partitions for ``cells`` moved doubles: at least ``LEAST_CELLS`` each, else by bytes in waves of four tasks a
    core, and never more than ``most`` units of work."""
    wave = 4 * spark.sparkContext.defaultParallelism
    waves = min(max(math.ceil(8 * cells / (wave * PARTITION_BYTES)), WAVES[0]), WAVES[1])
    return max(1, min(most, wave * waves, cells // LEAST_CELLS))


def assembled(rows: DataFrame, shape: tuple[int, int], block: tuple[int, int], add: bool = False) -> Blocks:
    """Pieces put together (or added up) block by block; one shuffle of arrays."""
    (m, n), (rs, cs) = shape, block

    def run(batches):
        def blocks():
            at, out = None, None
            for b in batches:
                keys = zip(b.column("bi").to_pylist(), b.column("bj").to_pylist())
                for key, spot, v in zip(keys, _arrays(b.column("at")), _arrays(b.column("values"))):
                    if key != at:
                        if at is not None:
                            yield *at, out.reshape(-1)
                        at, out = key, np.zeros((int(_extent(key[0], m, rs)), int(_extent(key[1], n, cs))))
                    _put(out, spot, v, add)
            if at is not None:
                yield *at, out.reshape(-1)
        yield from batches_of(blocks())

    most = math.ceil(m / rs) * math.ceil(n / cs)
    ordered = rows.repartition(_parts(rows.sparkSession, m * n, most), "bi", "bj").sortWithinPartitions("bi", "bj")
    return Blocks(ordered.mapInArrow(run, SCHEMA), shape, block)


def from_cells(x: Cells, block: tuple[int, int]) -> Blocks:
    block = tuple(min(b, s) for b, s in zip(block, x.shape))
    return assembled(pieces(x.df, x.shape, block), x.shape, block)


def numbered(df: DataFrame, by: list[str], name: str = "row") -> tuple[DataFrame, int]:
    """``df`` with row numbers ``0 .. n-1`` and ``n``: rows are dealt into hash buckets and numbered in
    each by ``by``; one count a bucket (a partition's worth of buckets) reaches the driver."""
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int"))
    counts = {r["_bucket"]: r["c"] for r in dealt.groupBy("_bucket").agg(F.count(F.lit(1)).alias("c")).collect()}
    starts, total = [], 0
    for b in range(parts):
        starts.append(total)
        total += counts.get(b, 0)
    first = F.array(*[F.lit(s).cast("bigint") for s in starts])
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*by)) - 1
    return dealt.withColumn(name, F.element_at(first, F.col("_bucket") + 1) + place).drop("_bucket"), total


def from_rows(df: DataFrame, row: str, col: str, shape: tuple[int, int], block: tuple[int, int]) -> Blocks:
    """Packed rows with their numbers ``row`` (0 to n-1) as blocks; every array has the matrix's width."""
    block = tuple(min(b, s) for b, s in zip(block, shape))
    (m, n), (rs, cs) = shape, block
    cells_at_once = max(1, PACKED_CELLS // n)

    def packed(rows, values):
        order = np.argsort(rows, kind="stable")
        rows, values = rows[order], values[order]
        bi = rows // rs
        cut = np.flatnonzero(np.concatenate([[True], bi[1:] != bi[:-1]]))
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(rows)]):
            for j, lo in enumerate(range(0, n, cs)):
                part = values[a:b, lo:lo + cs]
                wide = part.shape[1]
                at = ((rows[a:b] - bi[a] * rs)[:, None] * wide + np.arange(wide)).reshape(-1)
                yield bi[a], j, at[:0] if len(at) == int(_extent(bi[a], m, rs)) * wide else at, part.reshape(-1)

    def run(batches):
        held = []
        for b in batches:
            number = b.column(0).to_numpy(zero_copy_only=False)
            held.append((number, arrow_matrix(b.column(1), n)))
            if sum(len(r) for r, _ in held) >= cells_at_once:
                yield from batches_of(packed(*(np.concatenate(x) for x in zip(*held))), True)
                held = []
        if held:
            yield from batches_of(packed(*(np.concatenate(x) for x in zip(*held))), True)

    bounded_batches(df.sparkSession)
    cut = df.select(F.col(row).cast("bigint"), F.col(col).cast("array<double>")).mapInArrow(run, _PIECES)
    return assembled(cut, shape, block)


def to_cells(x: Blocks) -> Cells:
    (_, n), (rs, cs) = x.shape, x.block
    wide = F.least(F.lit(cs).cast("bigint"), F.lit(n).cast("bigint") - F.col("bj") * cs)
    out = x.df.select("bi", "bj", wide.alias("wide"), F.posexplode("values").alias("at", "value"))
    return Cells(out.select((F.col("bi") * rs + F.call_function("div", F.col("at").cast("bigint"), F.col("wide"))).alias("c0"),
                            (F.col("bj") * cs + F.col("at") % F.col("wide")).alias("c1"), "value"), x.shape)


def to_rows(x: Blocks, row: str = "row", out: str = "out") -> DataFrame:
    """``(row, array)`` of every row of block rows that are there: a block row's blocks side by side."""
    (m, n), (rs, cs) = x.shape, x.block

    def emit(i, panel):
        high = len(panel)
        return pa.RecordBatch.from_arrays([pa.array(np.arange(i * rs, i * rs + high)),
                                           _list(panel.reshape(-1), np.arange(0, high * n + 1, n))], [row, out])

    def run(batches):
        for i, blocks in block_rows(batches):
            panel = np.zeros((int(_extent(i, m, rs)), n))
            for j, v in blocks:
                panel[:, j * cs:(j + 1) * cs] = v.reshape(len(panel), -1)
            yield emit(i, panel)

    return by_block_row(x).mapInArrow(run, f"{row} bigint, {out} array<double>")


def by_block_row(x: Blocks) -> DataFrame:
    parts = _parts(x.df.sparkSession, math.prod(x.shape), math.ceil(x.shape[0] / x.block[0]))
    return x.df.repartition(parts, "bi").sortWithinPartitions("bi", "bj")


def block_rows(batches) -> Iterator[tuple[int, list[tuple[int, np.ndarray]]]]:
    """(bi, [(bj, values), ...]) of a stream sorted by block row."""
    at, held = None, []
    for b in batches:
        for i, j, v in zip(b.column("bi").to_pylist(), b.column("bj").to_pylist(), _arrays(b.column("values"))):
            if i != at:
                if held:
                    yield at, held
                at, held = i, []
            held.append((j, np.array(v)))
    if held:
        yield at, held


# ------------------------------------------------------------------ arithmetic

def combine(a: Blocks, others: list[Blocks], fn: Callable, keep: str = "inner") -> Blocks:
    """``fn(bi, bj, values of a, values of the others)`` for blocks that meet on their numbers; with ``keep="left"``
    blocks that others lack are zero."""
    df = a.df
    for k, o in enumerate(others):
        if (o.shape, o.block) != (a.shape, a.block):
            raise ValueError(f"blocks: shapes differ {a.shape} by {a.block} vs {o.shape} by {o.block}")
        # a product's size is guessed from its operands: without a hint its blocks could all be sent through the driver
        df = df.join(o.df.select("bi", "bj", F.col("values").alias(f"_v{k}")).hint("merge"), ["bi", "bj"], keep)
    names = [f"_v{k}" for k in range(len(others))]
    if keep == "left":
        zero = F.array_repeat(F.lit(0.0), F.size("values"))
        df = df.select("bi", "bj", "values", *[F.coalesce(n, zero).alias(n) for n in names])

    def run(batches):
        def rows():
            for b in batches:
                cols = [_arrays(b.column(n)) for n in ("values", *names)]
                for i, j, *v in zip(b.column("bi").to_pylist(), b.column("bj").to_pylist(), *cols):
                    yield i, j, fn(i, j, *v)
        yield from batches_of(rows())

    bounded_batches(df.sparkSession)
    return Blocks(df.mapInArrow(run, SCHEMA), a.shape, a.block)


def mapped(a: Blocks, fn: Callable) -> Blocks:
    """``fn(bi, bj, values)`` for each block."""
    return combine(a, [], fn)


def transposed(a: Blocks) -> Blocks:
    (m, n), (rs, cs) = a.shape, a.block

    def run(batches):
        def rows():
            for b in batches:
                for i, j, v in zip(b.column("bi").to_pylist(), b.column("bj").to_pylist(), _arrays(b.column("values"))):
                    yield j, i, v.reshape(int(_extent(i, m, rs)), -1).T.reshape(-1)
        yield from batches_of(rows())

    bounded_batches(a.df.sparkSession)
    return Blocks(a.df.mapInArrow(run, SCHEMA), (n, m), (cs, rs))


def _panel_sums(g: tuple[int, int, int], shape: tuple[int, int, int], block: tuple[int, int, int]):
    """Pieces of both operands in order of grid cell -> blocks of partial results."""
    (gi, gj, gk), (m, k, p), (bm, bk, bp) = g, shape, block
    rows, inner, cols = (math.ceil(math.ceil(x / b) / n) for x, b, n in ((m, bm, gi), (k, bk, gk), (p, bp, gj)))

    def emit(cell, out):
        x, y = divmod(cell, gj)
        for r in range(rows):
            for c in range(cols):
                i, j = r * gi + x, c * gj + y
                high, wide = int(_extent(i, m, bm)), int(_extent(j, p, bp))
                if high > 0 and wide > 0:
                    yield i, j, out[r * bm:r * bm + high, c * bp:c * bp + wide].reshape(-1)

    def run(batches):
        def blocks():
            at, result, panels = None, None, None
            for b in batches:
                heads = zip(*(b.column(c).to_pylist() for c in ("cell", "side", "bi", "bj")))
                for (cell, side, i, j), spot, v in zip(heads, _arrays(b.column("at")), _arrays(b.column("values"))):
                    if cell != at:
                        if at is not None:
                            result += panels[0] @ panels[1]
                            if cell // gk != at // gk:
                                yield from emit(at // gk, result)
                                result = None
                        if result is None:
                            result = np.zeros((rows * bm, cols * bp))
                        at, panels = cell, (np.zeros((rows * bm, inner * bk)), np.zeros((inner * bk, cols * bp)))
                    hi, wi = ((bm, bk), (bk, bp))[side]
                    hn, wn = ((m, k), (k, p))[side]
                    r, c = (i // gi * bm, j // gk * bk) if side == 0 else (i // gk * bk, j // gj * bp)
                    _put(panels[side][r:r + int(_extent(i, hn, hi)), c:c + int(_extent(j, wn, wi))], spot, v, False)
            if at is not None:
                result += panels[0] @ panels[1]
                yield from emit(at // gk, result)
        yield from batches_of(blocks())

    return run


def _copies(df: DataFrame, n: int, name: str) -> DataFrame:
    """``n`` copies of each row, numbered by ``name``; many are made in two steps, so no array is long."""
    step = 1 << 12
    if n <= step:
        return df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))
    far, near = f"{name}f", f"{name}n"
    some = _copies(_copies(df, math.ceil(n / step), far), step, near)
    return some.withColumn(name, F.col(far) * step + F.col(near)).where(F.col(name) < n).drop(far, near)


def partial_products(a: Cells | Blocks, b: Cells | Blocks, block: tuple[int, int, int]
                     ) -> tuple[DataFrame, tuple[int, int], bool]:
    """Blocks of partial results of ``a`` times ``b``, their size, and whether they are whole; otherwise blocks with the same
    numbers are to be added."""
    from tessera.operators.linalg import grid

    (m, k), p = a.shape, b.shape[1]
    if k != b.shape[0]:
        raise ValueError(f"matmul: inner dimensions differ {a.shape} x {b.shape}")
    (left, (bm, bk)), (right, (bk2, bp)) = _as_pieces(a, block[:2]), _as_pieces(b, block[1:])
    if bk != bk2:
        raise ValueError(f"matmul: inner blocks differ {bk} and {bk2}")
    g = gi, gj, gk = grid(m, k, p, (bm, bk, bp))
    cells = gi * gj * gk
    spark = left.sparkSession
    parts = _parts(spark, m * k * gj + k * p * gi, cells)

    def part(c: str, n: int):
        return F.pmod(F.col(c), F.lit(n))

    left = _copies(left, gj, "_y").select(
        ((part("bi", gi) * gj + F.col("_y")) * gk + part("bj", gk)).alias("cell"), F.lit(0).alias("side"),
        "bi", "bj", "at", "values")
    right = _copies(right, gi, "_x").select(
        ((F.col("_x") * gj + part("bj", gj)) * gk + part("bi", gk)).alias("cell"), F.lit(1).alias("side"),
        "bi", "bj", "at", "values")
    # a result panel's inner panels lie in one partition; where there are fewer result panels than
    # partitions, consecutive ones do, and a result panel has a few partial sums
    whole = parts <= gi * gj
    unit, units = (int_div(F.col("cell"), gk), gi * gj) if whole else (F.col("cell"), cells)
    both = left.unionByName(right).withColumn("_part", int_div(unit * parts, units).cast("int"))
    bounded_batches(spark)
    ordered = both.repartitionById(parts, F.col("_part")).sortWithinPartitions("cell", "side").drop("_part")
    return ordered.mapInArrow(_panel_sums(g, (m, k, p), (bm, bk, bp)), SCHEMA), (bm, bp), whole


def matmul_blocks(a: Cells | Blocks, b: Cells | Blocks, acc: Cells | Blocks | None = None,
                  block: tuple[int, int, int] = (128, 128, 128)) -> Blocks:
    """``A B`` (+ ``acc``) as blocks. Operands given as cells are packed into blocks of ``block`` on the way."""
    shape = (a.shape[0], b.shape[1])
    if acc is not None and acc.shape != shape:
        raise ValueError(f"matmul: accumulator shape {acc.shape} != {shape}")
    block = tuple(min(x, y) for x, y in zip(block, (*a.shape, b.shape[1])))
    parts, own, whole = partial_products(a, b, block)
    if whole and acc is None:
        return Blocks(parts, shape, own)
    parts = parts.select("bi", "bj", F.array().cast("array<int>").alias("at"), "values")
    if acc is not None:
        more, have = _as_pieces(acc, own)
        if have != own:
            raise ValueError(f"matmul: accumulator blocks {have} != {own}")
        parts = parts.unionByName(more)
    return assembled(parts, shape, own, add=True)
