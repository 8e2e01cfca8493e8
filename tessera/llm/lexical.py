"""Operator 12: ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items make one automaton, which tasks run over whole texts; there is no index of the
documents and no table of (document, term) rows. Text is brought to one byte
alphabet first: A-Z become a-z, every ASCII byte outside a term becomes a space. Each term is guarded by a
space on both sides, so that only whole maximal matches count, and the automaton's outputs are the terms'
numbers, which map to their items.

Two passes over the documents: the first counts documents, term occurrences and, for the items'
terms, the documents holding them (a row of counts a task, summed by Spark); the second scores each document
against all items that share a term with it, in 64-bit integers, and keeps each item's best of a
task. Spark then ranks in two steps, by item and bucket of documents and by item, so no item's
candidates meet in one task before they are down to ``k`` a bucket.

The items are a query set of any size: they are dealt by hash into blocks whose terms' bytes are about
``TERM_BYTES`` at most (an item's own terms stay together), and each block is broadcast and scanned for by
itself. Memory of a task: an automaton, a batch of documents (``CHUNK`` bytes of text at a time, at least
one document), and ``k`` rows an item.

Scores: w = floor(1000 * ln((2N + 2) / (2df + 1))) in doubles; m = 100 - b + (b * n * N) div L with
b = 50; the sum of w * ((1000000000 * tf) div (1000 * tf + 20 * m)) over an item's terms.

Defined cases: a null text or one without a term has no terms and is not counted in N; an item
without terms gives no rows; rows with the same item id (nulls alike) are one item with the terms
of all of them; equal scores rank by ascending doc_id, nulls last; documents with equal ids are ranked each
on its own, in any order where the scores are equal too; empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import partitions, spans, text_bytes, tidy

#: Best documents an item; share of the length norm in hundredths.
K, LENGTH_SHARE = 50, 50
#: Bytes of the distinct terms of one automaton, and of text that a task looks at at once.
TERM_BYTES, CHUNK = 4 << 20, 2 << 20
#: The byte alphabet: letters in lower case, digits, all bytes of other code points; the rest is a space.
_ALPHABET = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_FOLD = np.frombuffer(_ALPHABET, np.uint8)


def folded(text: str | None) -> list[bytes]:
    """The terms of a text, in order, with repeats."""
    return (text or "").encode().translate(_ALPHABET).split()


def blocks(items: DataFrame, term_bytes: int = TERM_BYTES) -> Iterator[dict[int | None, list[bytes]]]:
    """The items with their distinct terms, in blocks of about ``term_bytes`` that the driver may hold."""
    item = items.select("item_id", F.col("text").cast("string"))
    size = item.agg(F.sum(F.octet_length("text")).alias("s")).first()["s"] or 0
    count = max(1, math.ceil(size / term_bytes))
    for b in range(count):
        some = item if count == 1 else item.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == b)
        terms: dict[int | None, set[bytes]] = {}
        for r in some.toLocalIterator():
            found = folded(r["text"])
            if found:
                terms.setdefault(r["item_id"], set()).update(found)
        if terms:
            yield {i: sorted(t) for i, t in terms.items()}


class Scan:
    """Automaton of a block's terms and the items of each term; built anew in each process that gets it."""

    def __init__(self, items: dict[int | None, list[bytes]]):
        self.items = list(items)
        self.terms = sorted({t for ts in items.values() for t in ts})
        number = {t: k for k, t in enumerate(self.terms)}
        pairs = sorted((number[t], i) for i, ts in enumerate(items.values()) for t in ts)
        self.item_of = np.array([i for _, i in pairs], np.int64)
        self.first = np.searchsorted([t for t, _ in pairs], np.arange(len(self.terms) + 1))
        self._automaton = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    @property
    def automaton(self):
        if self._automaton is None:
            made = ahocorasick.Automaton()
            for k, t in enumerate(self.terms):
                made.add_word(f" {t.decode('latin-1')} ", k)
            made.make_automaton()
            self._automaton = made
        return self._automaton

    def counts(self, data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, Counter]]:
        """(row, n, tf of the block's terms) of each document that has a term. ``data`` and ``off`` are texts
        in UTF-8."""
        flat = _FOLD[data]
        raw = flat.tobytes().decode("latin-1")
        inside = flat != 32
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        heads = off[:-1][off[:-1] < off[1:]]
        begin[heads] = inside[heads]
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(begin, out=total[1:])
        find, at = self.automaton.iter, off.tolist()
        for k, n in enumerate(np.diff(total[off]).tolist()):
            if n:
                yield k, n, Counter([t for _, t in find(f" {raw[at[k]:at[k + 1]]} ")])


def _texts(batches) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for b in batches:
        data, off = text_bytes(b.column(1))
        for i, j in spans(off, CHUNK):
            yield b.column(0).slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]


def _corpus(docs: DataFrame, scan) -> tuple[int, int, np.ndarray]:
    """N, L and the df of each term of the block."""
    def run(batches):
        block = scan.value
        df = np.zeros(len(block.terms), np.int64)
        n_docs = n_terms = 0
        for _, data, off in _texts(batches):
            for _, n, tf in block.counts(data, off):
                n_docs, n_terms = n_docs + 1, n_terms + n
                df[list(tf)] += 1
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *seen.tolist()], pa.int64()),
                                          pa.array([n_docs, n_terms, *df[seen].tolist()], pa.int64())], ["term", "c"])

    sums = docs.mapInArrow(tidy(run), "term bigint, c bigint").groupBy("term").agg(F.sum("c").alias("c")).collect()
    found = {r["term"]: r["c"] for r in sums}
    df = np.zeros(len(scan.value.terms), np.int64)
    for t, c in found.items():
        if t >= 0:
            df[t] = c
    return found.get(-2, 0), found.get(-1, 0), df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def scores(scan: Scan, weight: np.ndarray, n_docs: int, n_terms: int, found: list[tuple[int, int, Counter]]):
    """(row, item, score) arrays of all documents and items that share a term."""
    size = [len(tf) for _, _, tf in found]
    term = np.fromiter((t for _, _, tf in found for t in tf), np.int64, sum(size))
    tf = np.fromiter((c for _, _, tf in found for c in tf.values()), np.int64, len(term))
    # b * n * N may pass 64 bits: exact integers of any size for one number a document
    m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * n * n_docs // n_terms for _, n, _ in found], np.int64)
    part = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, size)))
    row = np.repeat(np.arange(len(found)), size)
    uses = scan.first[term + 1] - scan.first[term]
    step = np.arange(uses.sum()) - np.repeat(np.cumsum(uses) - uses, uses)
    item = scan.item_of[np.repeat(scan.first[term], uses) + step]
    key = np.repeat(row, uses) * len(scan.items) + item
    total = np.zeros(len(found) * len(scan.items), np.int64)
    np.add.at(total, key, np.repeat(part, uses))
    hit = np.flatnonzero(total > 0)
    row_of = np.array([r for r, _, _ in found], np.int64)
    return row_of[hit // len(scan.items)], hit % len(scan.items), total[hit]


def _best(item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray, k: int):
    """The rows of each item's ``k`` best, by score and then id, nulls last."""
    order = np.lexsort((doc, null, -score, item))
    first = np.flatnonzero(np.diff(item[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
    keep = order[place < k]
    return item[keep], score[keep], doc[keep], null[keep]


def _ranked(docs: DataFrame, scan, weight, n_docs: int, n_terms: int, k: int) -> DataFrame:
    def run(batches):
        block, w = scan.value, weight.value
        # documents at once: as many as give a bounded table of documents by items
        at_once = max(1, (1 << 20) // max(1, len(block.items)))
        have = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]
        held, fresh = 0, []

        def squeezed():
            return list(_best(*(np.concatenate(x) for x in zip(have, *fresh)), k))

        for ids, data, off in _texts(batches):
            null = np.asarray(ids.is_null())
            doc = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            some = []
            for x in block.counts(data, off):
                if x[2]:
                    some.append(x)
                if len(some) == at_once:
                    row, item, score = scores(block, w, n_docs, n_terms, some)
                    fresh.append((item, score, doc[row], null[row]))
                    held, some = held + len(row), []
            if some:
                row, item, score = scores(block, w, n_docs, n_terms, some)
                fresh.append((item, score, doc[row], null[row]))
                held += len(row)
            if held > max(1 << 20, 2 * len(have[0])):
                have, fresh, held = squeezed(), [], 0
        item, score, doc, null = squeezed() if fresh else have
        known = pa.array(block.items, pa.int64())
        for i in range(0, len(item), 50_000):
            j = slice(i, i + 50_000)
            yield pa.RecordBatch.from_arrays(
                [known.take(pa.array(item[j])), pa.array(doc[j], mask=null[j]), pa.array(score[j])],
                ["item_id", "doc_id", "score"])

    best = docs.mapInArrow(tidy(run), "item_id bigint, doc_id bigint, score bigint")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    bucket = F.pmod(F.xxhash64("doc_id", "score"), F.lit(partitions(docs.sparkSession)))
    few = best.withColumn("bucket", bucket).withColumn(
        "rank", F.row_number().over(Window.partitionBy("item_id", "bucket").orderBy(*order))).where(F.col("rank") <= k)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(
        F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, term_bytes: int = TERM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item. ``docs`` has doc_id and text, ``items``
    item_id and text."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    items = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    out = None
    for block in blocks(items, term_bytes):
        scan = spark.sparkContext.broadcast(Scan(block))
        n_docs, n_terms, df = _corpus(docs, scan)
        weight = spark.sparkContext.broadcast(weights(n_docs, df))
        part = _ranked(docs, scan, weight, n_docs, n_terms, k)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return out


#: DuckDB SQL of the same rows.
ORACLE_SQL = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
         c AS (SELECT count(*) AS n_docs, sum(len(terms)) AS n_terms FROM d WHERE len(terms) > 0),
         t AS (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
         q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
         f AS (SELECT doc_id, n, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
         w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
               FROM f, c GROUP BY term),
         s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms))))) AS BIGINT) AS score
               FROM q JOIN f USING (term) JOIN w USING (term), c GROUP BY item_id, doc_id),
         r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                   doc_id, score FROM s WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50"""
