"""Helpers shared by the corpus operators: written intermediates, byte views of
Arrow text columns, packed exchange rows and connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_table_path, ship_package

M61 = np.uint64(0x9E3779B97F4A7C15)
M_A = np.uint64(0xBF58476D1CE4E5B9)
M_B = np.uint64(0x94D049BB133111EB)


def read(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols)


#: Arrow batches of whole documents: rows and bytes, in place of Spark's defaults for short rows.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def prepare(spark: SparkSession) -> None:
    """Make the package importable on the executors and keep Arrow batches of documents small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def tidy(run):
    """A batch function that gives its freed memory back to the system at the end of a task:
    workers live on, and what one operator kept would count against the next."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            libc = ctypes.CDLL(None)
            if hasattr(libc, "malloc_trim"):
                libc.malloc_trim(0)
    return tidied


def partitions(spark: SparkSession) -> int:
    """Partition count of packed exchanges: the session's shuffle setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder (spark.checkpoint.dir): cuts the
    lineage, and a lost executor costs a reread, not a recomputation."""
    path = scratch_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow text or binary column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        kind = col.type
        empty = b"" if pa.types.is_binary(kind) or pa.types.is_large_binary(kind) else ""
        col = col.fill_null(empty)
    col = col.cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8) if len(col) \
        else np.zeros(1, np.int64)
    if col.buffers()[2] is None:
        return np.zeros(0, np.uint8), off - off[0]
    data = np.frombuffer(col.buffers()[2], np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def spans(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64, in place."""
    h ^= h >> np.uint64(30)
    h *= M_A
    h ^= h >> np.uint64(27)
    h *= M_B
    h ^= h >> np.uint64(31)
    return h


_PACK = zstandard.ZstdCompressor(level=3)
_UNPACK = zstandard.ZstdDecompressor()


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one exchange row, compressed by byte planes; ``unpack`` gets their types."""
    parts = [np.ascontiguousarray(np.ascontiguousarray(a).reshape(-1).view(np.uint8)
                                  .reshape(-1, a.dtype.itemsize).T).tobytes() for a in arrays]
    head = np.array([len(p) for p in parts], np.int64).tobytes()
    return _PACK.compress(head + b"".join(parts))


def unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw = _UNPACK.decompress(blob)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    at, out = 8 * len(kinds), []
    for size, kind in zip(sizes.tolist(), kinds):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, size, at).reshape(width, -1)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += size
    return out


def zipped(text: bytes) -> bytes:
    return _PACK.compress(text)


def unzipped(col) -> tuple[np.ndarray, np.ndarray]:
    """Byte table of a binary column of ``zipped`` texts."""
    texts = [_UNPACK.decompress(x) for x in col.to_pylist()]
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=off[1:])
    return np.frombuffer(b"".join(texts), np.uint8), off


def word_cuts(data: np.ndarray, off: np.ndarray):
    """Words ``[^\\x20\\x09-\\x0D]+`` of a byte table: starts, ends (byte
    positions) and the row of each."""
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    inside = np.empty(len(data) + 1, bool)
    inside[:-1] = ~gap
    inside[-1] = False
    begin = inside.copy()
    begin[1:-1] &= gap[:-1]
    begin[-1] = False
    rows_at = off[:-1][off[:-1] < off[1:]]
    begin[rows_at] = inside[rows_at]
    starts = np.flatnonzero(begin)
    stop = np.zeros(len(data) + 1, bool)
    if len(data):
        stop[1:-1] = inside[:-2] & gap[1:]
        stop[-1] = inside[-2]
        last = off[1:][off[:-1] < off[1:]]
        stop[last] |= inside[last - 1]
    ends = np.flatnonzero(stop)
    row = np.searchsorted(off, starts, "right") - 1
    return starts, ends, row


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


_POW: dict[str, np.ndarray] = {}
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    have = _POW.get("p")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        for name, base in (("p", _BASE), ("i", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POW[name] = np.cumprod(steps)
    return _POW["p"][:n], _POW["i"][:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, the same wherever the word stands."""
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
        h = (total[ends] - total[starts]) * inverse[starts]
        h += (ends - starts).astype(np.uint64) * M61
    return mix(h)


def lowest(df: DataFrame, total: int, n: int, by: str, *ties: str) -> list:
    """The ``n`` rows with the smallest values of the 64-bit hash ``by``, on the driver. Of ``total`` rows only
    about 4 * n, those with the smallest hashes, are sorted and sent, however many tasks there are."""
    if total > 8 * n:
        cut = -(1 << 63) + (1 << 64) * 4 * n // total
        few = df.where(F.col(by) < cut).orderBy(by, *ties).limit(n).collect()
        if len(few) == n:
            return few
    return df.orderBy(by, *ties).limit(n).collect()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (u, v).

    Rounds of contraction: every node hooks to its smallest neighbour if that is smaller, the
    trees are jumped along to their roots, and the edges are rewritten to roots; those inside a
    tree drop out. Two rounds at least halve the nodes that still have edges, so a path of any length
    takes a number of steps in the square of its logarithm. Tables are written to the shared
    folder. Joins are on nodes, so a hub is spread by map-side aggregation and by Spark's
    skewed-join handling. Ends when no edge is left.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    both, labels = written(both.where("u <> v"), "edges"), None
    while True:
        trees = written(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
                        .select("node", F.least("node", "m").alias("label")), "trees")
        while True:
            up = trees.select(F.col("node").alias("label"), F.col("label").alias("up"))
            jumped = written(trees.join(up, "label").select("node", F.col("label").alias("old"), F.col("up").alias("label")),
                             "trees")
            trees = jumped.select("node", "label")
            if jumped.where("label <> old").isEmpty():
                break
        if labels is None:
            labels = trees
        else:
            step = trees.select(F.col("node").alias("label"), F.col("label").alias("up"))
            labels = written(labels.join(step, "label", "left").select("node", F.coalesce("up", "label").alias("label")),
                             "labels")
        both = written(both.join(trees.select(F.col("node").alias("u"), F.col("label").alias("a")), "u")
                       .join(trees.select(F.col("node").alias("v"), F.col("label").alias("b")), "v")
                       .where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "edges")
        if both.isEmpty():
            return labels.select("node", F.col("label").alias("component"))
