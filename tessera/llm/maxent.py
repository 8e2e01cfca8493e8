"""Operator 4: language-model scores from a hashed maximum-entropy model.

p(word | context) is factored by word classes: a softmax over ``CLASSES`` classes whose weights are
sums over hashed features of the context (words and class n-grams before the place, and skips
over it), times the word's share of its class in the training text. Words that training has not
seen are one outcome with the Good-Turing mass of the words seen once; the rest is left to
the known words, so each place's probabilities sum to one.

Training: in each round every task takes gradient steps (AdaGrad) over its own texts, all of
them, from the last weights; Spark sums the weights, feature by feature and weighted by use, and a
table of fixed size comes back to the driver. Counts: each of the text's partitions sends its distinct
words to hash buckets, the buckets add them up, and every partition gets the counts of its own
words. Nothing of the corpus's vocabulary passes through the driver.

Defined cases: a null text is empty and has the end token alone; null ids are read as an
empty string by the fold; repeated rows are scored (and learned) each on its own; without
training text all scores are 0 (one outcome); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (M61, lower_ascii, mix, pack, partitions, spans, text_bytes, tidy, unpack, unzipped,
                                word_cuts, word_hashes, written, zipped)

CLASSES = 32
FEATURES = 1 << 14
BLOCKS = 16
ROUNDS = 2
#: The narrowest type of a feature number.
_SMALL = np.uint16 if FEATURES <= 1 << 16 else np.int32
BATCH = 1 << 15
#: Sums up to here have exponentials of floats that can be added up and divided by.
SAFE = 60.0
#: Rows of a run that are added up together with those of the other runs.
SIDE_BY_SIDE = 8
_ONES = np.ones(CLASSES, np.float32)
RATE = 0.5
CHUNK = 1 << 20
END = np.uint64(0x5EED)
FOLDS = 10
_MARK = np.ones(256, bool)
_MARK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def tokens(data: np.ndarray, off: np.ndarray):
    """(word, class, row, place in row) of all tokens, an end after each row. The class of
    a word is a hash of its last two letters; the end has class 0."""
    data = lower_ascii(data)
    starts, ends, row = word_cuts(data, off)
    h = word_hashes(data, starts, ends)
    e = ends.copy()
    for _ in range(2):
        e -= _MARK[data[e - 1]] & (e - 1 > starts) if len(e) else 0
    tail = (data[e - 1].astype(np.uint64) << np.uint64(8) | data[np.maximum(e - 2, starts)]) if len(e) else h
    with np.errstate(over="ignore"):
        kind = (1 + mix(tail + M61) % np.uint64(CLASSES - 1)).astype(np.uint8)
    n, rows = len(h), len(off) - 1
    word, cls = np.full(n + rows, END, np.uint64), np.zeros(n + rows, np.uint8)
    at = np.arange(n) + row
    word[at], cls[at] = h, kind
    first = np.searchsorted(row, np.arange(rows)) + np.arange(rows)
    size = np.diff(np.append(first, n + rows))
    owner = np.repeat(np.arange(rows), size)
    return word, cls, owner, np.arange(n + rows) - first[owner]


def features(word: np.ndarray, cls: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Feature numbers (token, feature): bias, word before, word skipped to, class pair, class triple."""
    def back(x, k):
        y = np.zeros_like(x)
        y[k:] = x[:-k] if k < len(x) else y[k:]
        y[place < k] = 0
        return y

    w1, w2 = back(word, 1), back(word, 2)
    c = cls.astype(np.uint64) + np.uint64(1)
    c1, c2, c3 = (back(c, k) for k in (1, 2, 3))
    out = np.zeros((len(word), 5), np.int32)
    with np.errstate(over="ignore"):
        for k, key in enumerate((w1, w2, c1 << np.uint64(8) | c2, c1 << np.uint64(16) | c2 << np.uint64(8) | c3), 1):
            out[:, k] = 1 + (mix(key + M61 * np.uint64(k)) % np.uint64(FEATURES - 1)).astype(np.int32)
    return out


def _sums(weights: np.ndarray, feats: np.ndarray) -> np.ndarray:
    """Feature sums of the classes, (token, class), shifted by a token's largest where a float's exponential could leave its
    range; the shift does not change a softmax."""
    z = np.take(weights, feats[:, 0], axis=0)
    for k in range(1, feats.shape[1]):
        z += np.take(weights, feats[:, k], axis=0)
    if z.size and max(z.max(), -z.min()) > SAFE:
        z -= z.max(axis=1, keepdims=True)
    return z


def class_logs(weights: np.ndarray, feats: np.ndarray) -> np.ndarray:
    """Natural log probabilities of the classes, (token, class)."""
    z = _sums(weights, feats)
    z -= np.log(np.exp(z) @ _ONES)[:, None]
    return z


def _totals(g: np.ndarray, order: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, size, sum of the rows of ``g``) of the runs of ``order`` that begin at ``cut``, long ones first. Most runs
    are short: the first rows of all runs are added up side by side, only what lies beyond is summed run by run."""
    size = np.diff(np.append(cut, len(order)))
    by = np.argsort((len(order) - size).astype(_SMALL), kind="stable")
    first, size = cut[by], size[by]
    total = np.take(g, order[first], axis=0)
    longer = np.searchsorted(-size, -np.arange(SIDE_BY_SIDE + 1), "left")  # runs of more than 0, 1, ... rows
    for p in range(1, SIDE_BY_SIDE):
        if longer[p]:
            total[:longer[p]] += np.take(g, order[first[:longer[p]] + p], axis=0)
    n = longer[SIDE_BY_SIDE]
    if n:
        rest = size[:n] - SIDE_BY_SIDE
        start = np.cumsum(rest) - rest
        at = np.repeat(first[:n] + SIDE_BY_SIDE - start, rest) + np.arange(rest.sum())
        # two classes at a time: a complex sum is that of its parts
        rows = np.take(g, order[at], axis=0).view(np.complex64)
        total[:n] += np.add.reduceat(rows, start, axis=0).view(np.float32)
    return first, size, total


class Steps:
    """Gradient steps over token batches from given weights."""

    def __init__(self, weights: np.ndarray):
        self.start = weights
        self.w = weights.copy()
        self.squares = np.full(weights.shape, 1.0, np.float32)
        self.used = np.zeros(len(weights), np.float32)

    def take(self, feats: np.ndarray, cls: np.ndarray) -> None:
        for i in range(0, len(cls), BATCH):
            f, c = feats[i:i + BATCH], cls[i:i + BATCH]
            g = _sums(self.w, f)
            np.exp(g, out=g)
            g *= (1 / (g @ _ONES))[:, None]
            g[np.arange(len(c)), c] -= 1
            # the bias is the same feature everywhere: one sum
            self._move(f[:1, 0], np.ones((1, len(c)), np.float32) @ g, np.full(1, len(c), np.float32))
            for k in range(1, f.shape[1]):
                # numbers of 16 bits are sorted by radix
                order = np.argsort(f[:, k].astype(_SMALL), kind="stable")
                ids = f[order, k]
                cut = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
                at, count, total = _totals(g, order, cut)
                self._move(ids[at], total, count.astype(np.float32))

    def _move(self, row: np.ndarray, total: np.ndarray, count: np.ndarray) -> None:
        total /= np.sqrt(count)[:, None]
        squares = np.take(self.squares, row, axis=0)
        squares += total * total
        self.squares[row] = squares
        np.sqrt(squares, out=squares)
        total *= np.float32(RATE)
        total /= squares
        moved = np.take(self.w, row, axis=0)
        moved -= total
        self.w[row] = moved
        self.used[row] += count

    def blocks(self):
        """(block, blob): change of each weight times its use, and the use."""
        change = (self.w - self.start) * self.used[:, None]
        size = FEATURES // BLOCKS
        for b in range(BLOCKS):
            s = slice(b * size, (b + 1) * size)
            some = np.flatnonzero(self.used[s])
            yield b, pack(some.astype(np.int32), self.used[s][some], change[s][some])


def _round(texts: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Weights after one pass over all rows of ``texts`` (one column)."""
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast(weights)

    def run(batches):
        steps = None
        for b in batches:
            data, off = text_bytes(b.column(0))
            for i, j in spans(off, CHUNK):
                word, cls, _, place = tokens(data[off[i]:off[j]], off[i:j + 1] - off[i])
                steps = steps or Steps(sent.value)
                steps.take(features(word, cls, place), cls)
        if steps is not None:
            ids, blobs = zip(*steps.blocks())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], ["block", "blob"])

    def add(batches):
        size = FEATURES // BLOCKS
        total: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for block, blob in zip(b.column(0).to_pylist(), b.column(1)):
                at, used, change = unpack(blob.as_py(), "<i4", "<f4", "<f4")
                sums = total.setdefault(block, [np.zeros(size), np.zeros((size, CLASSES))])
                sums[0][at] += used
                sums[1][at] += change.reshape(-1, CLASSES)
        for block, (used, change) in total.items():
            mean = (change / np.maximum(used, 1)[:, None]).astype("<f4")
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([mean.tobytes()], pa.binary())],
                                             ["block", "blob"])

    rows = (texts.mapInArrow(tidy(run), "block int, blob binary").repartitionById(BLOCKS, F.col("block"))
            .mapInArrow(tidy(add), "block int, blob binary").collect())
    out = weights.copy()
    size = FEATURES // BLOCKS
    for r in rows:
        out[r["block"] * size:(r["block"] + 1) * size] += np.frombuffer(bytes(r["blob"]), "<f4").reshape(size, CLASSES)
    sent.destroy()
    return out


def train(texts: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Class weights from all rows of ``texts`` (one text column)."""
    weights = np.zeros((FEATURES, CLASSES), np.float32)
    for _ in range(rounds):
        weights = _round(texts, weights)
    return weights


def _send_words(n: int):
    """Rows (bucket, g, blob): the distinct words of the partition with their training counts."""
    def run(batches):
        held, g = [], None

        def merged():
            h, c, k = (np.concatenate(x) for x in zip(*held))
            word, first, back = np.unique(h, return_index=True, return_inverse=True)
            return [(word, np.bincount(back, weights=c, minlength=len(word)).astype(np.int64), k[first])]

        for b in batches:
            learn = b.column(3).to_numpy(zero_copy_only=False)
            data, off = unzipped(b.column(4))
            if b.num_rows:
                g = b.column(0)[0].as_py()
            for i, j in spans(off, CHUNK):
                word, cls, row, _ = tokens(data[off[i]:off[j]], off[i:j + 1] - off[i])
                held.append((word, learn[i:j][row].astype(np.int64), cls))
                held = merged() if len(held) > 8 else held
        if held:
            word, count, cls = merged()[0]
            bucket = (word >> np.uint64(40)).astype(np.int64) % n
            order = np.argsort(bucket, kind="stable")
            size = np.bincount(bucket, minlength=n)
            cut = np.append(0, np.cumsum(size))
            for b in np.flatnonzero(size):
                p = order[cut[b]:cut[b + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([g], pa.int32()),
                     pa.array([pack(word[p], count[p], cls[p])], pa.binary())], ["bucket", "g", "blob"])

    return run


def _count_words(batches):
    """Rows (g, blob) of words and counts for each partition, and one row with g = -1 of totals."""
    parts, ids = [], []
    for b in batches:
        ids += b.column(1).to_pylist()
        parts += [unpack(x.as_py(), "<u8", "<i8", "u1") for x in b.column(2)]
    if not parts:
        return
    sizes = [len(p[0]) for p in parts]
    word, count, cls = map(np.concatenate, zip(*parts))
    known, first, back = np.unique(word, return_index=True, return_inverse=True)
    total = np.bincount(back, weights=count).astype(np.int64)
    by_class = np.bincount(cls[first], weights=total, minlength=CLASSES)
    blobs = [np.concatenate([[total.sum(), (total > 0).sum(), (total == 1).sum()], by_class]).astype("<f8").tobytes()]
    at = 0
    for size in sizes:
        blobs.append(pack(word[at:at + size], total[back[at:at + size]]))
        at += size
    yield pa.RecordBatch.from_arrays([pa.array([-1, *ids], pa.int32()), pa.array(blobs, pa.binary())], ["g", "blob"])


def _score(weights, totals):
    """Rows of a partition: first its word counts, then its texts."""
    n, v, once = totals[:3]
    by_class = totals[3:]
    unseen = min(0.5, max(once, 0.1) / n) if n else 1.0
    with np.errstate(divide="ignore"):
        class_log = np.log10(by_class)

    def run(batches):
        held, at, word_of, count_of = [], None, None, None
        for b in batches:
            g, kind = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i, j in _same(g, kind):
                if g[i] != at:
                    at, held, word_of = g[i], [], None
                part = b.slice(i, j - i)
                if kind[i] == 0:
                    held += [unpack(x.as_py(), "<u8", "<i8") for x in part.column(4)]
                    continue
                if word_of is None:
                    word_of, count_of = map(np.concatenate, zip(*held))
                    order = np.argsort(word_of)
                    word_of, count_of, held = word_of[order], count_of[order], []
                data, off = unzipped(part.column(4))
                for x, y in spans(off, CHUNK):
                    yield scored(part.slice(x, y - x), data[off[x]:off[y]], off[x:y + 1] - off[x], word_of, count_of)

    def scored(part, data, off, word_of, count_of):
        word, cls, row, place = tokens(data, off)
        c = count_of[np.searchsorted(word_of, word)].astype(np.float64)
        feats = features(word, cls, place)
        logs = np.empty(len(word))
        for i in range(0, len(word), BATCH):
            p = class_logs(sent.value, feats[i:i + BATCH])
            logs[i:i + BATCH] = p[np.arange(len(p)), cls[i:i + BATCH]]
        with np.errstate(divide="ignore", invalid="ignore"):
            known = logs / np.log(10) + np.log10(c) - class_log[cls] + np.log10(1 - unseen)
        model = np.where(c > 0, known, np.log10(unseen))
        base = np.log10((c + 0.1) / (n + 0.1 * (v + 1)))
        start = np.flatnonzero(place == 0)
        return pa.RecordBatch.from_arrays(
            [part.column(2), pa.array(~part.column(3).to_numpy(zero_copy_only=False)),
             pa.array(np.diff(np.append(start, len(word)))), pa.array(np.add.reduceat((c > 0).astype(np.int64), start)),
             pa.array(np.full(len(start), int(n), np.int64)), pa.array(np.add.reduceat(base, start)),
             pa.array(np.add.reduceat(model, start))],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    sent = weights
    return run


def _same(*columns: np.ndarray):
    n = len(columns[0])
    if n:
        new = np.zeros(n, bool)
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        start = np.flatnonzero(new).tolist()
        yield from zip(start, [*start[1:], n])


def scores(docs: DataFrame) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text), learned from the rows outside the held-out fold."""
    spark = docs.sparkSession
    n = partitions(spark)
    learn = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS != 0
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), learn.alias("learn"), text.alias("text"))
    weights = train(rows.where("learn").select("text"))

    def zip_texts(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array([zipped(x.encode()) for x in b.column(4).to_pylist()], pa.binary())],
                ["g", "kind", "doc_id", "learn", "blob"])

    shape = "g int, kind int, doc_id bigint, learn boolean, blob binary"
    packed = rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("g"),
                         F.lit(1).alias("kind"), "doc_id", "learn", "text").mapInArrow(tidy(zip_texts), shape)
    counts = written(packed.repartitionById(n, F.col("g")).mapInArrow(tidy(_send_words(n)), "bucket int, g int, blob binary")
                     .repartitionById(n, F.col("bucket")).mapInArrow(tidy(_count_words), "g int, blob binary"), "word-counts")
    totals = sum([np.frombuffer(bytes(r["blob"]), "<f8") for r in counts.where("g < 0").select("blob").collect()],
                 np.zeros(3 + CLASSES))
    sent = spark.sparkContext.broadcast(weights)
    asked = counts.where("g >= 0").select("g", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("doc_id"),
                                          F.lit(False).alias("learn"), "blob")
    return (packed.union(asked).repartitionById(n, F.col("g")).sortWithinPartitions("g", "kind")
            .mapInArrow(tidy(_score(sent, totals)), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
                                              "train_tokens bigint, base_score double, score double"))
