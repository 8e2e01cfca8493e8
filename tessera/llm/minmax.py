"""Operator 2: near-duplicate documents by min-max hashing.

A document's set is its distinct 5-word shingles (64-bit hashes). Under each of 32
permutations both the smallest and the largest value are kept: 64 signature
values from 32 evaluations for each shingle. Bands of four values give 16 keys;
a pair at the threshold of 0.85 misses all of them once in 130,000 cases.

Documents with equal sets are one node from the start, so copies never meet as
pairs. In every key's group the member that shares most keys with others is
the centre; all members are checked with it on their full sets. Only groups that
still hold several components after that are searched in full: cut into blocks, every
two blocks of a group meet in one task, which counts intersections of all full sets and
returns a spanning forest of the links it finds. So links that join components
are all found, and a large group of near copies never becomes all its pairs.

Defined cases: null or empty text, or text without words: size 0, linked with
nothing; fewer than five words: the whole sequence is the one shingle; rows with
equal ids are one document that has the links of any of them; a row with a null
id links with nothing and is kept. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (M61, components, lower_ascii, mix, partitions, spans, text_bytes, tidy, word_cuts,
                                word_hashes, written)

WORDS = 5
PERMUTATIONS = 32
ROWS = 4
BANDS = 2 * PERMUTATIONS // ROWS
#: Rows, and shingles, of a block of a group that is searched in full.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
CHUNK = 1 << 20
_RNG = np.random.RandomState(20)
_MUL = (_RNG.randint(0, 1 << 62, PERMUTATIONS).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_ADD = _RNG.randint(0, 1 << 62, PERMUTATIONS).astype(np.uint64)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): each row's distinct shingles, sorted."""
    starts, ends, row = word_cuts(data, off)
    words = word_hashes(lower_ascii(data), starts, ends)
    n = len(off) - 1
    first = np.searchsorted(row, np.arange(n + 1))
    parts, sizes = [], np.zeros(n + 1, np.int64)
    if len(words) >= WORDS:
        with np.errstate(over="ignore"):
            grams = words[:len(words) - WORDS + 1].copy()
            for k in range(1, WORDS):
                grams = grams * M61 + words[k:len(words) - WORDS + 1 + k]
            grams = mix(grams)
    for i in range(n):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= WORDS:
            g = np.sort(grams[a:b - WORDS + 1])
            g = g[np.concatenate([[True], g[1:] != g[:-1]])]
        elif b > a:
            with np.errstate(over="ignore"):
                g = np.array([b - a], np.uint64)
                for k in range(a, b):
                    g = g * M61 + words[k]
                g = mix(g)
        else:
            continue
        parts.append(g)
        sizes[i + 1] = len(g)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.cumsum(sizes)


def signatures(sets: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Minimum and maximum of every non-empty row under each permutation (high 32 bits)."""
    begin = off[:-1][np.diff(off) > 0]
    out = np.zeros((len(begin), 2 * PERMUTATIONS), ">u4")
    with np.errstate(over="ignore"):
        for k in range(PERMUTATIONS if len(begin) else 0):
            h = sets * _MUL[k]
            h += _ADD[k]
            out[:, 2 * k] = np.minimum.reduceat(h, begin) >> np.uint64(32)
            out[:, 2 * k + 1] = np.maximum.reduceat(h, begin) >> np.uint64(32)
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, s1, s2, sig): set size, two sums that identify the set, and the signature."""
    def run(batches):
        for b in batches:
            data, off = text_bytes(b.column(1))
            for i, j in spans(off, CHUNK):
                sets, cut = shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i])
                size = np.diff(cut)
                full = size > 0
                total = np.zeros((2, len(sets) + 1), np.uint64)
                with np.errstate(over="ignore"):
                    np.cumsum(sets, out=total[0, 1:])
                    np.cumsum(mix(sets * _MUL[0] + M61), out=total[1, 1:])
                    sums = (total[:, cut[1:]] - total[:, cut[:-1]]).view(np.int64)
                sig = np.full(len(size), None, object)
                sig[full] = [x.tobytes() for x in signatures(sets, cut)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(size), pa.array(sums[0]), pa.array(sums[1]),
                     pa.array(sig.tolist(), pa.binary())], ["doc_id", "n", "s1", "s2", "sig"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        tidy(run), "doc_id bigint, n bigint, s1 bigint, s2 bigint, sig binary")


def _sets(docs: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            data, off = text_bytes(b.column(1))
            for i, j in spans(off, CHUNK):
                sets, cut = shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i),
                     pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(sets.view(np.int64)))],
                    ["id", "hashes"])

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "id bigint, hashes array<bigint>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) linked by their full sets."""
    a = sets.select(F.col("id").alias("u"), F.col("hashes").alias("x"))
    b = sets.select(F.col("id").alias("v"), F.col("hashes").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.hint("merge").join(a, "u").hint("merge").join(b, "v")
            .where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("u", "v"))


def _search(percent: int):
    """Cells (key, a, b, id, label, own, hashes), in order, to edges (u, v) between labels."""
    def solve(held, cross):
        ids, labels, own, sets = (list(x) for x in zip(*held))
        size = np.array([len(x) for x in sets])
        row = np.repeat(np.arange(len(ids)), size)
        _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = often[column] > 1
        row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
        own = np.array(own)
        left, right = (np.flatnonzero(own == k) for k in (own.min(), own.max())) if cross else (np.arange(len(ids)),) * 2
        both = np.zeros((len(left), len(right)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            i, j = np.searchsorted(column, (start, start + 4096))
            bits = np.zeros((len(ids), 4096), np.float32)
            bits[row[i:j], column[i:j] - start] = 1
            both += bits[left] @ bits[right].T
        near = 100 * both >= percent * (size[left][:, None] + size[right][None, :] - both)
        number = np.unique(np.array(labels), return_inverse=True)[1]
        near &= number[left][:, None] != number[right][None, :]
        group = np.arange(number.max() + 1)

        def root(x):
            while group[x] != x:
                group[x] = group[group[x]]
                x = group[x]
            return x

        for i, j in zip(*np.nonzero(near)):
            x, y = root(number[left[i]]), root(number[right[j]])
            if x != y:
                group[x] = y
                yield ids[left[i]], ids[right[j]]

    def run(batches):
        held, at, out = [], None, []
        for b in batches:
            lists = b.column(6)
            flat, cut = lists.values.to_numpy(), np.asarray(lists.offsets)
            for k, row in enumerate(zip(*(b.column(c).to_pylist() for c in range(6)))):
                if row[:3] != at:
                    if len(held) > 1:
                        out += solve(held, at[1] != at[2])
                    held, at = [], row[:3]
                held.append((*row[3:], flat[cut[k]:cut[k + 1]]))
        if len(held) > 1:
            out += solve(held, at[1] != at[2])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["u", "v"])

    return run


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row; linked where 100 * intersection >=
    ``percent`` * union. The bands are set for percentages of 80 and more."""
    if percent < 80:
        raise ValueError("the bands are set for thresholds of 80 percent and more")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = written(sketches(docs), "minmax-sketch")
    nodes = (sketch.where("n > 0 and doc_id is not null").groupBy("s1", "s2", "n")
             .agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig")))
    nodes = written(nodes, "minmax-nodes")
    bands = F.array(*[F.xxhash64(F.lit(k), F.substring("sig", 4 * ROWS * k + 1, 4 * ROWS)) for k in range(BANDS)])
    keys = nodes.select("id", "n", F.explode(bands).alias("key"))
    size = keys.groupBy("key").agg(F.count("*").alias("c"), F.sum("n").alias("total")).where("c > 1")
    members = written(keys.hint("merge").join(size, "key"), "minmax-members")
    degree = members.groupBy("id").agg(F.sum("c").alias("degree"))
    ranked = members.join(degree, "id").select("key", "id", "n", "degree")
    centre = ranked.groupBy("key").agg(F.max(F.struct("degree", (-F.col("id")).alias("back"), "n")).alias("m"))
    star = (members.join(centre.select("key", (-F.col("m.back")).alias("centre"), F.col("m.n").alias("m")), "key")
            .where((F.col("id") != F.col("centre")) & (100 * F.least("n", "m") >= percent * F.greatest("n", "m")))
            .select(F.least("id", "centre").alias("u"), F.greatest("id", "centre").alias("v")).distinct())
    star = written(star, "minmax-pairs")
    wanted = members.select(F.col("id").alias("doc_id")).distinct()
    sets = written(_sets(docs.hint("merge").join(wanted, "doc_id")), "minmax-sets")
    edges = written(_confirmed(star, sets, percent), "minmax-links")
    groups = components(edges)

    labelled = (members.join(groups.withColumnRenamed("node", "id"), "id", "left")
                .select("key", "id", "c", "total", F.coalesce("component", "id").alias("label")))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    blocks = F.ceil(F.greatest(F.col("c") / BLOCK, F.col("total") / BLOCK_SHINGLES)).cast("int")
    placed = (labelled.join(mixed.select("key"), "key").withColumn("blocks", blocks)
              .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    cells = (placed.hint("merge").join(sets, "id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "id", "label",
                     "own", "hashes")
             .repartition(partitions(docs.sparkSession), "key", "a", "b").sortWithinPartitions("key", "a", "b"))
    more = written(cells.mapInArrow(tidy(_search(percent)), "u bigint, v bigint"), "minmax-links")
    if not more.isEmpty():
        groups = components(edges.union(more))

    classes = (nodes.select("s1", "s2", "n", "id")
               .join(groups.withColumnRenamed("node", "id"), "id", "left")
               .select("s1", "s2", "n", F.coalesce("component", "id").alias("component")))
    linked = sketch.where("n > 0 and doc_id is not null").hint("merge").join(classes, ["s1", "s2", "n"])
    alone = sketch.where("n = 0 or doc_id is null").select("s1", "s2", "n", "doc_id", F.col("doc_id").alias("component"))
    rows = linked.select("doc_id", "n", "component").union(alone.select("doc_id", "n", "component"))
    smallest = rows.groupBy("doc_id").agg(F.min("component").alias("component"), F.count("*").alias("c"))
    several = smallest.where("c > 1 and doc_id is not null").select("doc_id", F.col("component").alias("joint"))
    return (rows.join(several, "doc_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("joint", "component").alias("component_id"),
                    F.coalesce(F.col("doc_id") == F.coalesce("joint", "component"), F.lit(True)).alias("kept")))
