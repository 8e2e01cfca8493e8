"""Scaled dot-product attention, ``softmax(Q Kᵀ / sqrt(d_k)) V``, per group.

Plan (no step holds or emits all row pairs of a group, and a group holding a
third of all rows is spread over many tasks):

1. Count queries and keys per group (partial aggregation) and derive the
   number of query and key blocks per group: ``ceil(n / tile)``.
2. Attach the block counts to the rows (broadcast when the number of groups
   is proven small, a shuffle join otherwise) and give every row a hash
   block inside its group, ``floor(u(id) · n_blocks)`` — even in
   expectation, and a hot group simply gets more blocks. Each (group, block) is
   packed into one row (about ``tile`` vectors).
3. Cut the query blocks of a group into super-blocks and its key blocks into
   chunks; a cell is a super-block and a chunk. Their sizes follow the number of
   pairs and cores, and are bounded by bytes, so neither a task's memory nor what it reads
   grows with the group. A query block goes to the cells of its super-block, a key
   block to those of its chunk, and the cells are dealt over the partitions by number: a
   hot group is spread over many tasks, and no block pair is shuffled or made a row.
4. ``mapInArrow``: a task holds the queries of one cell and reads its key blocks as a stream;
   numpy computes the scores and, per query, the partial triple (row max ``m``,
   ``l = Σ exp(s-m)``, ``o = Σ exp(s-m)·v``), merged from slice to slice (the online-softmax
   merge is associative), so a cell emits one row per query.
5. Exact final merge in Spark: one group-by on ``(group, query)`` gathers the
   query's partials, one per chunk of its group, and JVM higher-order functions compute
   ``Σ o·exp(m-M) / Σ l·exp(m-M)`` with ``M = max m``. One shuffle of packed
   rows, no explode before it.

:func:`block_pairs` gives the block pairs as rows, for kernels that need them so.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.core import BROADCAST_CELLS, Cells, arrow_matrix, hash_uniform, int_div
from tessera.operators.blocks import bounded_batches
from tessera.session import scratch_table_path
from tessera.sources.packing import cells_to_rows

DEFAULT_TILE = 512
# Query blocks of a super-block at most, and super-blocks of a task, once there are enough for all cores.
SUPER_TILES, SUPERS_PER_TASK = 32, 2
# Bytes of the queries with their sums that a task holds, and of the keys and values of a cell; cells of a core at least, as
# far as there are blocks, and of a task, once there are enough.
HELD_BYTES, CHUNK_BYTES, CELLS_PER_CORE, CELLS_PER_TASK = 64 << 20, 96 << 20, 4, 2
# Queries and keys of one product.
SLICE = 512, 1024


def _packed_blocks(col, matrices: int | None = None):
    """``(offsets, ids, [matrices...])`` of a column of packed blocks, decoded at once (the first ``matrices`` of them): a
    block's rows are those between its offsets."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = np.asarray(col.offsets).astype(np.int64)
    rows = col.values.slice(off[0], off[-1] - off[0])
    kinds = rows.type
    ids = rows.field(0).to_numpy(zero_copy_only=False)
    return off - off[0], ids, [arrow_matrix(rows.field(i)) for i in range(1, 1 + matrices if matrices else kinds.num_fields)]


class _Held:
    """The queries of a cell and their partial triples."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, scale: float | None):
        self.ids, self.queries, self.scale = ids, queries, scale
        self.m, self.l, self.o = np.full(len(ids), -np.inf), np.zeros(len(ids)), None

    def meet(self, keys: np.ndarray, values: np.ndarray) -> None:
        if self.queries.shape[1] != keys.shape[1]:
            raise ValueError("attention: query and key widths differ")
        if self.o is None:
            self.o = np.zeros((len(self.ids), values.shape[1]))
        s = self.scale if self.scale is not None else 1.0 / math.sqrt(keys.shape[1])
        for a in range(0, len(self.ids), SLICE[0]):
            mine = slice(a, a + SLICE[0])
            q = self.queries[mine] * s
            for b in range(0, len(keys), SLICE[1]):
                P = q @ keys[b:b + SLICE[1]].T
                m = np.maximum(self.m[mine], P.max(axis=1))
                P -= m[:, None]
                np.exp(P, out=P)
                old = np.exp(self.m[mine] - m)
                self.l[mine] = self.l[mine] * old + P.sum(axis=1)
                self.o[mine] = self.o[mine] * old[:, None] + P @ values[b:b + SLICE[1]]
                self.m[mine] = m


def _cell_partials(scale: float | None):
    """Arrow batches of blocks in order of cells, queries before keys -> partial triples per query of a cell."""

    def emit(group, held):
        n, w = held.o.shape
        offsets = pa.array(np.arange(0, n * w + 1, w, dtype=np.int32))
        return pa.RecordBatch.from_arrays(
            [group.take(pa.array(np.zeros(n, dtype=np.int64))), pa.array(held.ids.astype(np.int64)), pa.array(held.m),
             pa.array(held.l), pa.ListArray.from_arrays(offsets, pa.array(held.o.reshape(-1)))],
            names=["g", "q_id", "m", "l", "o"])

    def run(batches):
        at, group, waiting, held = None, None, [], None
        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in ("g", "_s", "_c", "side"))))
            cut = [i for i in range(len(places)) if not i or places[i] != places[i - 1]]
            for i, j in zip(cut, [*cut[1:], len(places)]):
                *cell, side = places[i]
                if cell != at:
                    if held is not None and held.o is not None:
                        yield emit(group, held)
                    at, group, waiting, held = cell, batch.column("g").slice(i, 1), [], None
                blocks = batch.column("block").slice(i, j - i)
                if side == 0:
                    _, ids, mats = _packed_blocks(blocks, 1)
                    waiting.append((ids, mats[0]))
                elif waiting or held is not None:
                    if held is None:
                        held, waiting = _Held(*(np.concatenate(x) for x in zip(*waiting)), scale), []
                    _, _, mats = _packed_blocks(blocks)
                    held.meet(mats[0], mats[-1])  # blocks without values use their keys
        if held is not None and held.o is not None:
            yield emit(group, held)

    return run


def _merge(state, m2, l2, o2):
    """Online-softmax merge of two partial triples for the same queries."""
    m1, l1, o1 = state
    m = np.maximum(m1, m2)
    a, b = np.exp(m1 - m), np.exp(m2 - m)
    return m, l1 * a + l2 * b, o1 * a[:, None] + o2 * b[:, None]


def _tile_partials(scale: float | None):
    """Arrow batches of block pairs -> merged partial triples per query.

    Only the query block at hand is held: its triples are merged as its pairs
    arrive and emitted when the next block begins. Pairs of one block that do
    not arrive together give several partials, which the final merge sums
    exactly.
    """

    def emit(group, state):
        q_ids, m, l, o = state
        n, w = o.shape
        offsets = pa.array(np.arange(0, n * w + 1, w, dtype=np.int32))
        return pa.RecordBatch.from_arrays(
            [group.take(pa.array(np.zeros(n, dtype=np.int64))), pa.array(q_ids.astype(np.int64)), pa.array(m),
             pa.array(l), pa.ListArray.from_arrays(offsets, pa.array(o.reshape(-1)))],
            names=["g", "q_id", "m", "l", "o"])

    def run(batches):
        at, group, state = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            gcol, bcol = batch.column("g"), batch.column("_b").to_pylist()
            (qoff, qids, (queries,)), (koff, _, mats) = _packed_blocks(batch.column("qblock")), _packed_blocks(batch.column("kblock"))
            keys, values = mats[0], mats[-1]  # blocks without values use their keys
            if queries.shape[1] != keys.shape[1]:
                raise ValueError("attention: query and key widths differ")
            s = scale if scale is not None else 1.0 / math.sqrt(keys.shape[1])
            for r, g in enumerate(gcol.to_pylist()):
                mine, theirs = slice(qoff[r], qoff[r + 1]), slice(koff[r], koff[r + 1])
                q_ids = qids[mine]
                S = (queries[mine] @ keys[theirs].T) * s
                m = S.max(axis=1)
                P = np.exp(S - m[:, None])
                part = (m, P.sum(axis=1), P @ values[theirs])
                key = (g, bcol[r])
                if key == at and np.array_equal(state[0], q_ids):
                    state = (q_ids, *_merge(state[1:], *part))
                    continue
                if at is not None:
                    yield emit(group, state)
                at, group, state = key, gcol.slice(r, 1), (q_ids, *part)
        if at is not None:
            yield emit(group, state)

    return run


def _packed(rows: DataFrame, sizes: DataFrame, n_col: str, id_col: str, seed: int,
            fields: list[str], name: str, partitions: int, super_tiles: int) -> DataFrame:
    """Hash block inside the group, then one packed row per (group, super-block, block).

    Rows are hash-partitioned on ``(group, super-block)`` first: a hot group's
    super-blocks spread over many tasks, the packed blocks come out partitioned the
    way the pair join needs them, and adaptive execution does not fold the
    numpy-heavy stages into a single task (an explicit partition count is
    kept as asked).
    """
    x = rows.join(sizes.select("g", n_col), "g").withColumn(
        "_b", F.floor(hash_uniform(seed, id_col) * F.col(n_col)).cast("bigint"))
    return (x.withColumn("_s", int_div(F.col("_b"), super_tiles)).repartition(partitions, "g", "_s").groupBy("g", "_s", "_b")
            .agg(F.collect_list(F.struct(id_col, *fields)).alias(name)))


def merge_partials(partials: DataFrame) -> DataFrame:
    """Exact merge of partial softmax triples ``(g, q_id, m, l, o)`` into
    ``(g, q_id, _out)`` with ``_out = Σ o·exp(m-M) / Σ l·exp(m-M)``, ``M = max m``.

    One group-by on ``(g, q_id)``; a query normally has a single partial
    (all pairs of its block met in one task), so the gathered list is tiny.
    """
    merged = partials.groupBy("g", "q_id").agg(
        F.collect_list(F.struct("m", "l", "o")).alias("_p"))
    top = F.array_max(F.transform("_p", lambda p: p["m"]))

    def weight(p):
        return F.exp(p["m"] - top)

    denom = F.aggregate("_p", F.lit(0.0), lambda acc, p: acc + p["l"] * weight(p))
    width = F.size(F.col("_p")[0]["o"])
    numer = F.aggregate(
        "_p", F.array_repeat(F.lit(0.0), width),
        lambda acc, p: F.zip_with(acc, p["o"], lambda a, b: a + b * weight(p)))
    single = F.col("_p")[0]
    out = (F.when(F.size("_p") == 1, F.transform(single["o"], lambda x: x / single["l"]))
           .otherwise(F.transform(numer, lambda x: x / denom)))
    return merged.select("g", "q_id", out.alias("_out"))


def _replicas(kb: DataFrame, sizes: DataFrame, per: int) -> DataFrame:
    """Every key block once for each query super-block of its group."""
    last = int_div(F.col("_qn") - 1, per)
    return kb.join(sizes.select("g", "_qn"), "g").select(
        "g", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_s"), "kblock")


def block_pairs(queries: DataFrame, keys: DataFrame | None = None, *, id_col: str,
                q_col: str, k_col: str | None = None, v_col: str | None = None,
                key_id_col: str | None = None, group: str | None = None,
                tile: int = DEFAULT_TILE, key_tile: int | None = None,
                seed: int = 17, super_tiles: int | None = None) -> DataFrame:
    """One row per (query block, key block) of a group,
    ``(g, _b, qblock, kblock)``, partitioned on ``(g, super-block)``. ``super_tiles`` query blocks
    make a super-block (by default by the number of blocks and cores)."""
    key_tile = key_tile or tile
    self_attention = (keys is None and k_col in (None, q_col) and v_col in (None, q_col, k_col)
                      and key_tile == tile)
    keys = queries if keys is None else keys
    k_col = k_col or q_col
    v_col = v_col or k_col
    key_id_col = key_id_col or id_col
    # rows without a group are a group of their own: a struct compares NULLs as equal
    def grouped(by: str):
        # one group for all rows is a computed 0: joins on a constant would lose their key
        return F.struct((F.col(group) if group else F.pmod(F.xxhash64(by), F.lit(1)).cast("int")).alias("v")).alias("g")

    q = queries.select(grouped(id_col), F.col(id_col).cast("bigint").alias("q_id"),
                       F.col(q_col).cast("array<double>").alias("q"))
    kv = keys.select(grouped(key_id_col), F.col(key_id_col).cast("bigint").alias("k_id"),
                     F.col(k_col).cast("array<double>").alias("k"),
                     F.col(v_col).cast("array<double>").alias("v"))

    nq = q.groupBy("g").agg(F.count(F.lit(1)).alias("_nq"))
    nk = nq.withColumnRenamed("_nq", "_nk") if self_attention else \
        kv.groupBy("g").agg(F.count(F.lit(1)).alias("_nk"))
    sizes = nq.join(nk, "g").select(
        "g", F.ceil(F.col("_nq") / F.lit(float(tile))).alias("_qn"),
        F.ceil(F.col("_nk") / F.lit(float(key_tile))).alias("_kn"))
    # one row per group: broadcast only when the group count is proven small;
    # the same small job gives the total number of query blocks
    stats = sizes.agg(F.count(F.lit(1)).alias("groups"), F.sum("_qn").alias("qblocks")).first()
    if stats["groups"] <= BROADCAST_CELLS:
        sizes = F.broadcast(sizes)
    # super-blocks: as many as keep all cores busy, then larger ones, so that a key block is copied less often
    blocks = int(stats["qblocks"] or 1)
    cores = queries.sparkSession.sparkContext.defaultParallelism
    per = super_tiles or max(1, min(SUPER_TILES, blocks // (4 * cores)))
    supers = math.ceil(blocks / per)
    parts = max(1, min(supers, max(4 * cores, supers // SUPERS_PER_TASK)))

    qb = _packed(q, sizes, "_qn", "q_id", seed, ["q"], "qblock", parts, per)
    if self_attention:
        # keys = values = queries: the key blocks are the query blocks; the
        # plan reuses the same exchange instead of re-reading and re-packing
        kb = qb.select("g", F.col("qblock").alias("kblock"))
    else:
        kb = _packed(kv, sizes, "_kn", "k_id", seed + 1, ["k", "v"], "kblock", parts, per).select("g", "kblock")
    # every key block meets every query super-block of its group; both sides are
    # partitioned on (group, super-block), so all pairs of a query block meet in one task; the
    # merge join gives them one query block after the other
    krep = _replicas(kb, sizes, per).repartition(parts, "g", "_s")
    bounded_batches(queries.sparkSession)
    return qb.join(krep.hint("merge"), ["g", "_s"]).select(F.col("g.v").alias("g"), "_b", "qblock", "kblock")


def cell_blocks(queries: DataFrame, keys: DataFrame | None = None, *, id_col: str,
                q_col: str, k_col: str | None = None, v_col: str | None = None,
                key_id_col: str | None = None, group: str | None = None,
                tile: int = DEFAULT_TILE, key_tile: int | None = None, seed: int = 17,
                widths: tuple[int, int] | None = None) -> DataFrame:
    """Steps 1-3 of the plan: the blocks of every cell, ``(g, _s, _c, side, block)``, the queries (side 0) before the
    keys (side 1), the cells in order and dealt evenly over the partitions. ``widths``: of the queries and of the keys or
    values, where they are known (else the rows are counted with them)."""
    spark = queries.sparkSession
    key_tile = key_tile or tile
    k_col = k_col or q_col
    v_col = v_col or k_col
    self_attention = keys is None and k_col == q_col and v_col == q_col and key_tile == tile
    keys = queries if keys is None else keys
    key_id_col = key_id_col or id_col
    two = v_col != k_col

    # rows without a group are a group of their own: a struct compares NULLs as equal
    def vectors(df, by, a, b):
        g = F.struct((F.col(group) if group else F.pmod(F.xxhash64(by), F.lit(1)).cast("int")).alias("v"))
        second = [(F.col(b) if b else F.lit(None)).cast("array<double>").alias("b")] if two else []
        return df.select(g.alias("g"), F.col(by).cast("bigint").alias("id"), F.col(a).cast("array<double>").alias("a"), *second)

    def counted(x, n, w):
        found = [F.lit(widths[n == "_nk"])] if widths else [F.max(F.size(c)) for c in ("a", *(["b"] if two else []))]
        return x.groupBy("g").agg(F.count(F.lit(1)).alias(n), F.greatest(*found, F.lit(1)).alias(w))

    q = vectors(queries, id_col, q_col, None)
    kv = q if self_attention else vectors(keys, key_id_col, k_col, v_col)
    nq = counted(q, "_nq", "_qw")
    nk = nq.select("g", F.col("_nq").alias("_nk"), F.col("_qw").alias("_kw")) if self_attention else counted(kv, "_nk", "_kw")
    sizes = nq.join(nk, "g").withColumns({"_qn": F.ceil(F.col("_nq") / F.lit(float(tile))),
                                          "_kn": F.ceil(F.col("_nk") / F.lit(float(key_tile)))})
    # a row per group, written once: several plans use it
    path = scratch_table_path(spark, "attention-sizes")
    sizes.write.parquet(path)
    sizes = spark.read.schema(sizes.schema).parquet(path)
    stats = sizes.agg(F.count(F.lit(1)).alias("groups"), F.sum("_qn").alias("blocks"), F.sum("_nq").alias("n"),
                      F.sum(F.col("_nq").cast("double") * F.col("_nk")).alias("pairs"), F.max("_qw").alias("qw"),
                      F.max("_kw").alias("kw")).first()
    cores = spark.sparkContext.defaultParallelism
    qw, kw = int(stats["qw"] or 1), int(stats["kw"] or 1)
    side = math.sqrt((stats["pairs"] or 1.0) / (CELLS_PER_CORE * cores))
    per = max(1, int(min(side, HELD_BYTES / (8 * (qw + kw + 2)))) // tile)
    chunk = max(1, int(min(side, CHUNK_BYTES / (8 * (2 if two else 1) * (kw + 1)))) // key_tile)
    sizes = sizes.select("g", "_qn", "_kn", F.ceil(F.col("_qn") / F.lit(per)).alias("_sn"),
                         F.ceil(F.col("_kn") / F.lit(chunk)).alias("_cn"))
    few = stats["groups"] <= BROADCAST_CELLS
    total = int(sizes.agg(F.sum(F.col("_sn") * F.col("_cn"))).first()[0] or 1)
    parts = max(1, min(total, max(CELLS_PER_CORE * cores, total // CELLS_PER_TASK)))
    # the number of a group's first cell; of very many groups a hash, which is as even
    before = F.sum(F.col("_sn") * F.col("_cn")).over(Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1))
    first = F.coalesce(before, F.lit(0)) if few else F.pmod(F.xxhash64("g"), F.lit(total))
    sizes = sizes.withColumn("_first", first)
    if few:
        sizes = F.broadcast(sizes)

    packing = max(1, min(int(stats["blocks"] or 1), max(CELLS_PER_CORE * cores, 8 * qw * int(stats["n"] or 1) // CHUNK_BYTES)))

    def packed(x, n_col, salt):
        rows = x.join(sizes.select("g", n_col), "g").withColumn(
            "_b", F.floor(hash_uniform(salt, "id") * F.col(n_col)).cast("bigint"))
        return rows.repartition(packing, "g", "_b").groupBy("g", "_b").agg(F.collect_list(
            F.struct("id", "a", *(["b"] if two else []))).alias("block"))

    def several(blocks, n_col, own, own_n, other, other_n, mark):
        x = blocks.join(sizes, "g").withColumn(own, F.expr(f"_b * {own_n} div {n_col}"))
        x = x.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other_n) - 1)))
        place = F.pmod(F.col("_first") + F.col("_s") * F.col("_cn") + F.col("_c"), F.lit(total))
        return x.select("g", "_s", "_c", F.lit(mark).alias("side"), "block", int_div(place * parts, total).cast("int").alias("_p"))

    qb = packed(q, "_qn", seed)
    kb = qb if self_attention else packed(kv, "_kn", seed + 1)
    both = several(qb, "_qn", "_s", "_sn", "_c", "_cn", 0).unionByName(several(kb, "_kn", "_c", "_cn", "_s", "_sn", 1))
    bounded_batches(spark)
    return both.repartitionById(parts, F.col("_p")).sortWithinPartitions("g", "_s", "_c", "side").select(
        F.col("g.v").alias("g"), "_s", "_c", "side", "block")


def attention(queries: DataFrame, keys: DataFrame | None = None, *, id_col: str,
              q_col: str, k_col: str | None = None, v_col: str | None = None,
              key_id_col: str | None = None, group: str | None = None,
              d_k: int | None = None, tile: int = DEFAULT_TILE, key_tile: int | None = None,
              seed: int = 17, widths: tuple[int, int] | None = None) -> DataFrame:
    """Grouped single-head attention on packed rows.

    ``queries`` holds ``id_col`` and the query vector ``q_col``; ``keys`` (the
    same table when omitted: self-attention) holds ``key_id_col``, ``k_col``
    and ``v_col``. Rows only attend to keys of the same ``group``; without a
    group every query attends to every key. ``tile`` / ``key_tile`` bound the
    number of vectors per query / key block. Returns cells
    ``(group, id_col, j, value)``.
    """
    # without d_k, each task scales by the key width it sees (no extra job)
    scale = None if d_k is None else 1.0 / math.sqrt(float(d_k))
    blocks = cell_blocks(queries, keys, id_col=id_col, q_col=q_col, k_col=k_col, v_col=v_col,
                         key_id_col=key_id_col, group=group, tile=tile, key_tile=key_tile, seed=seed, widths=widths)

    gtype = blocks.schema["g"].dataType
    partial_schema = T.StructType([
        T.StructField("g", gtype), T.StructField("q_id", T.LongType()),
        T.StructField("m", T.DoubleType()), T.StructField("l", T.DoubleType()),
        T.StructField("o", T.ArrayType(T.DoubleType()))])
    partials = blocks.mapInArrow(_cell_partials(scale), partial_schema)

    rows = merge_partials(partials)
    out = rows.select("g", "q_id", F.posexplode("_out").alias("j", "value"))
    names = [F.col("q_id").alias(id_col), F.col("j").cast("bigint").alias("j"), "value"]
    if group:
        return out.select(F.col("g").alias(group), *names)
    return out.select(*names)


def attention_cells(Q: Cells, K: Cells, V: Cells, d_k: int | None = None,
                    tile: int = DEFAULT_TILE) -> Cells:
    """The reference's form: three 2-d matrices [seq, d] -> [seq, d_v]."""
    if Q.ndim != 2 or K.ndim != 2 or V.ndim != 2:
        raise ValueError("attention_cells: 2-d matrices required")
    if Q.shape[1] != K.shape[1] or K.shape[0] != V.shape[0]:
        raise ValueError(f"attention_cells: incompatible shapes {Q.shape} {K.shape} {V.shape}")
    qr = cells_to_rows(Q, "r", "q")
    kr = cells_to_rows(K, "r", "k").join(cells_to_rows(V, "r", "v"), "r")
    out = attention(qr, kr, id_col="r", q_col="q", k_col="k", v_col="v",
                    d_k=d_k or Q.shape[1], tile=tile, widths=(Q.shape[1], max(K.shape[1], V.shape[1])))
    return Cells(out.select(F.col("r").alias("c0"), F.col("j").alias("c1"), "value"),
                 (Q.shape[0], V.shape[1]))
