"""Operator 10: quartile bucket digests of documents.

Three kinds of byte triplets inside a window of five bytes are hashed into 256
buckets; each bucket's count becomes a two-bit code by the quartiles of the
document's own counts, and the digest is the length code and those 256 codes in
hexadecimal. Two digests are compared by a bounded difference: the code
distance over all buckets, as a share of what digests with the same code
counts would differ by if their buckets were unrelated.

Defined cases: a null text counts as empty; a text under five bytes has the
all-zero codes and its length only; equal texts have equal digests. Rows are
ordered by (doc_id, text) with null ids first, so repeated ids have a defined
next row; a table of one row has itself as the next; ids may be any 64-bit integers. A range of rows
that comes without the row after it is an error, never a loss of rows. Columns other than doc_id
and text are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import partitions, spans, text_bytes, tidy

BUCKETS = 256
CHUNK = 2 << 20
#: Byte offsets of the triplets taken at every position.
TRIPLETS = ((0, 1, 2), (0, 2, 3), (0, 1, 4))
#: Distance of two codes; opposite quartiles count double, as in public locality-sensitive digests.
CODE_DISTANCE = np.array([[0, 1, 2, 6], [1, 0, 1, 2], [2, 1, 0, 1], [6, 2, 1, 0]], np.float64)
_SHUFFLED = np.random.RandomState(1234).permutation(256).astype(np.uint8)


def _counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    n = len(off) - 1
    out = np.zeros(n * BUCKETS, np.int64)
    if len(data) >= 5:
        row = np.repeat(np.arange(n, dtype=np.int32), np.diff(off))
        last = len(data) - 4
        fits = row[4:] == row[:last]
        base = row[:last][fits].astype(np.int64) * BUCKETS
        for kind, (a, b, c) in enumerate(TRIPLETS):
            h = _SHUFFLED[data[a:a + last] ^ np.uint8(29 * kind + 1)]
            h = _SHUFFLED[h ^ data[b:b + last]]
            h = _SHUFFLED[h ^ data[c:c + last]]
            out += np.bincount(base + h[fits], minlength=n * BUCKETS)
    return out.reshape(n, BUCKETS)


def codes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(length codes, bucket codes) of every row of a byte table."""
    parts = []
    for i, j in spans(off, CHUNK):
        count = _counts(data[off[i]:off[j]], off[i:j + 1] - off[i])
        rank = np.sort(count, axis=1)
        code = np.zeros(count.shape, np.uint8)
        for q in (BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1):
            code += count > rank[:, q:q + 1]
        parts.append(code)
    body = np.concatenate(parts) if parts else np.zeros((0, BUCKETS), np.uint8)
    length = np.minimum(255, np.round(8 * np.log2(np.diff(off) + 1.0))).astype(np.uint8)
    return length, body


def to_hex(length: np.ndarray, body: np.ndarray) -> list[str]:
    two = body.reshape(len(body), -1, 4)
    packed = two[:, :, 0] << 6 | two[:, :, 1] << 4 | two[:, :, 2] << 2 | two[:, :, 3]
    whole = np.concatenate([length[:, None], packed.astype(np.uint8)], axis=1)
    return [x.tobytes().hex() for x in whole]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 to 1 for paired rows: 1 for equal digests, near 0 for unrelated ones."""
    differ = CODE_DISTANCE[a[1], b[1]].sum(axis=1)
    share = [np.stack([(x == k).mean(axis=1) for k in range(4)], axis=1) for x in (a[1], b[1])]
    unrelated = np.einsum("ni,ij,nj->n", share[0], CODE_DISTANCE, share[1]) * BUCKETS
    body = np.where(unrelated > 0, differ / np.maximum(unrelated, 1e-9), 0.0)
    apart = np.abs(a[0].astype(np.int64) - b[0].astype(np.int64))
    return np.maximum(0.0, 1 - np.minimum(1.0, body)) * (1 - np.minimum(1.0, apart / 64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every text: a projection, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(to_hex(*codes(*text_bytes(b.column(1)))), pa.string())],
                ["id", "fingerprint"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
            .mapInArrow(tidy(run), f"id {kind}, fingerprint string").withColumnRenamed("id", id_col))


def _beside_next(docs: DataFrame) -> DataFrame:
    """Rows (bucket, extra, doc_id, text): ``bucket`` cuts the ids into ranges, and
    the first row of each range also stands, as ``extra``, at the end of the one before.

    Only range bounds (one id a partition) reach the driver."""
    spark = docs.sparkSession
    n = partitions(spark)
    ids = docs.select("doc_id")
    cut = ids.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    cuts = np.unique(np.array(cut, np.float64))

    # ids stay 64-bit integers; only their places among the bounds go by doubles, which keeps the order
    def ranges(ids: pa.Array) -> np.ndarray:
        near = pc.fill_null(pc.cast(ids, pa.float64(), safe=False), -math.inf)
        return np.searchsorted(cuts, near.to_numpy(zero_copy_only=False), "right").astype(np.int32)

    @F.arrow_udf("int")
    def bucket(x: pa.Array) -> pa.Array:
        return pa.array(ranges(x))

    firsts = sorted((r["b"], r["low"]) for r in ids.groupBy(bucket("doc_id").alias("b")).agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id"))["doc_id"].alias("low")).collect())
    before = {low: firsts[i - 1][0] for i, (_, low) in enumerate(firsts)}

    @F.arrow_udf("array<int>")
    def places(x: pa.Array) -> pa.Array:
        return pa.array([[2 * o, 2 * before[k] + 1] if k in before else [2 * o]
                         for o, k in zip(ranges(x).tolist(), x.to_pylist())], pa.list_(pa.int32()))

    at = docs.select("doc_id", "text", F.explode(places("doc_id")).alias("place"))
    return (at.select((F.col("place") / 2).cast("int").alias("bucket"),
                      (F.col("place") % 2).alias("extra"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .repartitionById(n, F.col("bucket"))
            .sortWithinPartitions("bucket", "extra", "doc_id", "text"))


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edited form (last quarter of the code
    points replaced by the start of the next document), with their likeness."""
    schema = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")

    def emit(ids, texts):
        """One row for each text but the last, which is only the next one."""
        whole = [t.encode() for t in texts]
        sizes = [len(t) for t in texts]
        edited = [(t[:n - n // 4] + nxt[:n // 4]).encode()
                  for t, nxt, n in zip(texts, texts[1:], sizes)]
        a = codes(*text_bytes(pa.array(whole, pa.binary())))
        e = codes(*text_bytes(pa.array(edited, pa.binary())))
        own, nxt = (a[0][:-1], a[1][:-1]), (a[0][1:], a[1][1:])
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(sizes[:-1], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in edited]), pa.array(to_hex(*own)),
            pa.array(to_hex(*e)), pa.array(likeness(own, e)), pa.array(likeness(own, nxt))],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"])

    def closed(at, done):
        if at is not None and not done:
            raise RuntimeError(f"fingerprints: the next document of range {at} is missing")

    def run(batches):
        ids, texts, at, done = [], [], None, False
        for b in batches:
            data, off = text_bytes(b.column(3))
            raw, size = data.tobytes(), 0
            for k, (bucket, extra, i) in enumerate(zip(*(b.column(c).to_pylist() for c in range(3)))):
                if bucket != at:
                    closed(at, done)
                    ids, texts, at, done = [], [], bucket, False
                if done:
                    continue
                t = raw[off[k]:off[k + 1]].decode("utf-8", "replace")
                texts.append(t)
                if extra:
                    done = True
                else:
                    ids.append(i)
                size += len(t)
                if len(texts) > 1 and (done or size > CHUNK):
                    yield emit(ids[:len(texts) - 1], texts)
                    ids, texts, size = ids[len(texts) - 1:], texts[-1:], 0
        closed(at, done)

    return _beside_next(docs.select(F.col("doc_id").cast("bigint"), "text")).mapInArrow(tidy(run), schema)
