"""Operator 3: near-duplicate embeddings by a pivot-permutation index.

Reference points are a bounded sample: of the vectors with the smallest id hashes (``DRAWN`` for
each wanted pivot) those that are no closer to each other than ``APART`` of the way from the sample's median cosine to 1
(nor than the threshold), so vectors in a narrow cone get as many pivots as vectors all around. One pivot is wanted for every ``ROWS`` rows, at
least ``PIVOTS`` and at most ``MOST``. A vector is described by its ``PREFIX`` nearest pivots and posted in the inverted
lists of the nearest of them, per label. Two vectors that meet in a list and share enough pivots of their
descriptions are candidates; a candidate is checked by its cosine in double precision in the list of the
smallest pivot they share, so each link is found once. In how many lists a vector is posted (``LISTS`` or more) and how
many pivots are enough (``SHARED`` or fewer) is measured on sample vectors turned to the threshold. Postings carry the
vector, so nothing but counts and a spanning forest leaves a list: a group of copies never becomes all its pairs.

Lists are cut into blocks of ``BLOCK`` and a task holds two blocks at most, however
long a list is. Equal vectors of a label are one node with a multiplicity. All rows are
indexed; only pivots are sampled. Recall against brute force is measured in the tests
(1.0 on the given tables and on random pairs at cosine 0.932; 0.9 and more in cones).

Defined cases: a null label, a null, empty or zero vector and one with null or non-finite
components link with nothing and are kept; vectors of different lengths are not compared;
repeated rows are other vectors, linked with each other; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, lowest, partitions, tidy, written

DRAWN = 4
PIVOTS = 1024
MOST = 8192
ROWS = 128
APART = 0.5
PREFIX = 24
LISTS = 8
SHARED = 8
BLOCK = 1024
FOLD = 512
TURNED = 1000
MISSED = 0.004


def _vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vec, size): valid vectors as packed doubles."""
    kind = rows.schema["label"].dataType.simpleString()

    def run(batches):
        for b in batches:
            lists = b.column(2).cast(pa.list_(pa.float64()))
            off = np.asarray(lists.offsets)
            flat = lists.values.to_numpy(zero_copy_only=False)  # null components become NaN
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            with np.errstate(over="ignore", invalid="ignore"):
                squares = np.concatenate([[0.0], np.cumsum(np.where(np.isfinite(flat), flat != 0, False))])
            ok = (off[1:] > off[:-1]) & (bad[off[1:]] == bad[off[:-1]]) & (squares[off[1:]] > squares[off[:-1]])
            ok &= ~np.asarray(lists.is_null()) & ~np.asarray(b.column(1).is_null())
            at = np.flatnonzero(ok)
            vec = [flat[off[i]:off[i + 1]].astype("<f8").tobytes() for i in at]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(vec, pa.binary()),
                 pa.array([len(v) // 8 for v in vec], pa.int32())], ["vec_id", "label", "vec", "size"])

    return rows.mapInArrow(tidy(run), f"vec_id bigint, label {kind}, vec binary, size int")


def choose_pivots(units: np.ndarray, count: int = PIVOTS, apart: float = APART) -> np.ndarray:
    """Rows of ``units``, in order, that are not within ``apart`` of one taken before."""
    out, k = np.zeros((count, units.shape[1])), 0
    for at in range(0, len(units), 256):
        block = units[at:at + 256]
        block = block[(block @ out[:k].T).max(axis=1, initial=-2.0) < apart]
        near = block @ block.T >= apart
        shut = np.zeros(len(block), bool)
        for i in range(len(block)):
            if k < count and not shut[i]:
                out[k], k = block[i], k + 1
                shut |= near[i]
    return out[:k]


def _apart(units: np.ndarray, threshold: float) -> float:
    """The closest that pivots may be: ``APART`` of the way from the median cosine (0 or more) to 1, but not
    above the threshold, so that a group of near copies is not parted by pivots of its own."""
    few = units[:512]
    if len(few) < 2:
        return APART
    middle = max(0.0, float(np.median((few @ few.T)[np.triu_indices(len(few), 1)])))
    return min(threshold, middle + (1 - middle) * APART)


def nearest(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The ``PREFIX`` nearest pivots of each row, in order; the rows in steps that bound the products."""
    m = min(PREFIX, len(pivots))
    out = np.zeros((len(x), m), "<i2")
    for at in range(0, len(x), 1024):
        near = x[at:at + 1024].astype(np.float32) @ pivots.T
        top = np.argpartition(-near, m - 1, axis=1)[:, :m]
        order = np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable")
        out[at:at + 1024] = np.take_along_axis(top, order, 1)
    return out


def settings(units: np.ndarray, pivots: np.ndarray, threshold: float) -> tuple[int, int]:
    """(lists, shared): how many lists a vector is posted in and how many shared pivots make a candidate,
    so that of sample vectors and the same turned to the threshold, towards other sample vectors, hardly any
    pair (``MISSED``) is lost by either. Bounded by the ``PREFIX`` described pivots and by one."""
    x = units[:TURNED]
    centred = x - x.mean(axis=0)
    side = np.roll(centred, 1, axis=0) - centred
    side -= (side * x).sum(axis=1, keepdims=True) * x
    norm = np.linalg.norm(side, axis=1)
    some = norm > 1e-9
    if not some.any():  # copies of one vector: nothing to turn towards
        return min(LISTS, len(pivots)), SHARED
    x, side = x[some], side[some] / norm[some][:, None]
    sent = pivots.astype(np.float32)
    a, b = nearest(x, sent), nearest(threshold * x + np.sqrt(max(0.0, 1 - threshold * threshold)) * side, sent)
    same = a[:, :, None] == b[:, None, :]
    shared = min(SHARED, max(1, int(np.quantile(same.sum(axis=(1, 2)), MISSED))))
    for lists in range(min(LISTS, a.shape[1]), a.shape[1]):
        if same[:, :lists, :lists].any(axis=(1, 2)).mean() >= 1 - MISSED:
            return lists, shared
    return a.shape[1], shared


def _described(nodes: DataFrame, pivots: dict[int, np.ndarray], lists: dict[int, int]) -> DataFrame:
    """``nodes`` with ``prefix``, packed numbers of the nearest pivots in order, and ``posts``, how many of them
    have lists that the vector is posted in."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    sent = {k: v.astype(np.float32) for k, v in pivots.items()}

    def run(batches):
        for b in batches:
            size = b.column(b.schema.get_field_index("size")).to_numpy()
            raw = b.column(b.schema.get_field_index("vec")).to_pylist()
            prefix = [np.zeros(1, "<i2").tobytes()] * len(raw)  # a length without pivots: one list for all
            posts = np.ones(len(raw), np.int32)
            for d in np.unique(size):
                if int(d) not in sent:
                    continue
                at = np.flatnonzero(size == d)
                x = np.frombuffer(b"".join([raw[i] for i in at]), "<f8").reshape(len(at), d)
                posts[at] = lists[int(d)]
                for i, p in zip(at, nearest(x / np.abs(x).max(axis=1, keepdims=True), sent[int(d)])):
                    prefix[i] = p.tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(prefix, pa.binary()), pa.array(posts)],
                                             [*b.schema.names, "prefix", "posts"])

    return nodes.mapInArrow(tidy(run), f"{fields}, prefix binary, posts int")


def _links(block, x, prefix, pivot, cross: bool, threshold: float, lists: int, shared: int):
    """Links of one cell: pairs (i, j) of its rows.

    Shared pivots are counted by a product over ``FOLD`` folded pivot numbers, which never counts too few; pairs
    that pass it and the cosine are counted again one by one."""
    n, shared = len(x), min(shared, prefix.shape[1])
    norm = np.sqrt((x * x).sum(axis=1))
    a, b = (np.flatnonzero(block == k) for k in (block.min(), block.max())) if cross else (np.arange(n),) * 2
    slot = np.arange(n)[:, None] * FOLD + prefix.astype(np.int64) % FOLD
    counts = np.bincount(slot.ravel(), minlength=n * FOLD).reshape(n, FOLD).astype(np.float32)
    near = counts[a] @ counts[b].T >= shared
    if not cross:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    i, j = a[i], b[j]
    out = []
    for k in range(0, len(i), 1 << 15):
        p, q = i[k:k + (1 << 15)], j[k:k + (1 << 15)]
        cos = (x[p] * x[q]).sum(axis=1) / (norm[p] * norm[q])
        p, q = p[cos >= threshold], q[cos >= threshold]
        same = prefix[p][:, :, None] == prefix[q][:, None, :]
        enough = same.sum(axis=(1, 2)) >= shared
        first = np.where(same[:, :lists, :lists].any(axis=2), prefix[p][:, :lists], np.iinfo(np.int16).max).min(axis=1)
        out.append((p[enough & (first == pivot)], q[enough & (first == pivot)]))
    return [np.concatenate(c) for c in zip(*out)] if out else (np.zeros(0, int), np.zeros(0, int))


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the pairs: the smallest row of each component with its others."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return [(int(label[k]), k) for k in np.flatnonzero(label != np.arange(n)).tolist()]


def _search(threshold: float, chosen: dict[int, tuple[int, int]]):
    """Cells in, rows (u, v, links) out: edges of a spanning forest (links 0), and (id, id, links).
    ``chosen``: the settings of each length that has pivots."""
    def solve(rows):
        ids, block, mult, pivot, cross, vec, prefix = zip(*rows)
        ids, mult = np.array(ids), np.array(mult)
        x = np.frombuffer(b"".join(vec), "<f8").reshape(len(ids), -1)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        p = np.frombuffer(b"".join(prefix), "<i2").reshape(len(ids), -1)
        i, j = _links(np.array(block), x, p, pivot[0], cross[0], threshold, *chosen.get(x.shape[1], (1, 1)))
        if not len(i):
            return None
        count = np.zeros(len(ids), np.int64)
        np.add.at(count, i, mult[j])
        np.add.at(count, j, mult[i])
        some = np.flatnonzero(count)
        edges = _forest(len(ids), i, j)
        u = np.concatenate([ids[some], ids[[e[0] for e in edges]]])
        v = np.concatenate([ids[some], ids[[e[1] for e in edges]]])
        return pa.RecordBatch.from_arrays(
            [pa.array(u), pa.array(v), pa.array(np.concatenate([count[some], np.zeros(len(edges), np.int64)]))],
            ["u", "v", "links"])

    def run(batches):
        held, at = [], None
        for b in batches:
            for key, row in zip(zip(*(b.column(c).to_pylist() for c in range(5))),
                                zip(*(b.column(c).to_pylist() for c in range(5, 12)))):
                if key != at:
                    if len(held) > 1 and (got := solve(held)) is not None:
                        yield got
                    held, at = [], key
                held.append(row)
        if len(held) > 1 and (got := solve(held)) is not None:
            yield got

    return run


def near_duplicates(rows: DataFrame, threshold: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of (vec_id, embedding, label)."""
    spark = rows.sparkSession
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding")
    valid = written(_vectors(rows).where("vec_id is not null").withColumn("h", F.md5("vec")), "vectors")
    nodes = (valid.groupBy("label", "h").agg(F.min("vec_id").alias("id"), F.count("*").alias("mult"),
                                             F.first("vec").alias("vec"), F.first("size").alias("size")))
    total = valid.count()
    wanted = min(MOST, max(PIVOTS, total // ROWS))
    sample = lowest(valid.select("vec", "size", F.xxhash64("vec_id").alias("r")), total, DRAWN * wanted, "r", "vec")
    of: dict[int, list[np.ndarray]] = {}
    for r in sample:
        v = np.frombuffer(bytes(r["vec"]), "<f8")
        v = v / np.abs(v).max()
        of.setdefault(r["size"], []).append(v / np.linalg.norm(v))
    units = {k: np.vstack(v) for k, v in of.items()}
    pivots = {k: choose_pivots(v, wanted, _apart(v, threshold)) for k, v in units.items()}
    chosen = {k: settings(v, pivots[k], threshold) for k, v in units.items()}
    index = written(_described(nodes, pivots, {k: v[0] for k, v in chosen.items()}), "pivot-index")
    lists = F.array_distinct(F.transform(F.sequence(F.lit(0), F.col("posts") - 1),
                                         lambda k: F.substring("prefix", 2 * k + 1, 2)))
    posted = index.select("label", "size", F.explode(lists).alias("pivot"), "id", "mult", "vec", "prefix")
    keys = ["label", "size", "pivot"]
    long = (posted.groupBy(*keys).agg(F.count("*").alias("c")).where(F.col("c") > BLOCK)
            .select(*keys, F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")))
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    placed = (posted.join(long, keys, "left").withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))))
    number = F.conv(F.hex(F.concat(F.substring("pivot", 2, 1), F.substring("pivot", 1, 1))), 16, 10).cast("int")
    cells = (placed.select(*keys, F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "id",
                           "own", "mult", number.alias("number"), (F.col("own") != F.col("other")).alias("x"),
                           "vec", "prefix")
             .withColumn("x", F.col("a") != F.col("b"))
             .repartition(partitions(spark), *keys, "a", "b").sortWithinPartitions(*keys, "a", "b", "id"))
    found = written(cells.mapInArrow(tidy(_search(threshold, chosen)), "u bigint, v bigint, links bigint"), "pivot-links")
    counts = found.where("links > 0").groupBy(F.col("u").alias("id")).agg(F.sum("links").alias("links"))
    groups = components(found.where("links = 0")).withColumnRenamed("node", "id")
    named = (nodes.select("label", "h", "id", "mult").join(counts, "id", "left").join(groups, "id", "left")
             .select("label", "h", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("links"),
                     F.coalesce("component", "id").alias("component")))
    linked = valid.select("vec_id", "label", "h").join(named, ["label", "h"]).select("vec_id", "links", "component")
    other = rows.select("vec_id").join(valid.select("vec_id").distinct(), "vec_id", "left_anti")
    return (linked.union(other.select("vec_id", F.lit(0).cast("bigint"), "vec_id"))
            .select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"),
                    F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept")))
