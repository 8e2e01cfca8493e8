"""Operator 1: language identification by a bidirectional gated recurrent network over bytes.

A text is read in windows of 128 bytes, all of them; two gated recurrent layers, one
in each direction, give every position a state, and a softmax over both states
labels the position. The probabilities of the positions that hold letters are averaged over
the document. Training is backpropagation through time with Adam in numpy on the driver,
over a bounded sample: ``SAMPLE_ROWS`` labelled rows (smallest hashes of the id), one window of
each at a hashed place, languages drawn evenly. The fitted arrays (about 50 kB)
go with the tasks; prediction is a projection.

Defined cases: a null text or one without a letter is ``und`` with score 0; without any labelled
row every text is ``und``; rows are predicted each on its own, so repeats and ties in id do
not matter. lang, source and doc_id are no inputs of a prediction; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lowest, spans, text_bytes, tidy

WINDOW = 128
UNITS = 8
#: Bound of the training sample.
SAMPLE_ROWS = 6000
STEPS = 400
BATCH = 128
RATE = 0.02
CHUNK = 1 << 19
PAD = 256
UNDECIDED = "und"

_LETTER = np.zeros(257, np.float32)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


class Layer:
    """One direction. Gates are kept, reset and candidate; a pad byte keeps the state."""

    def __init__(self, rng):
        self.x = (rng.standard_normal((3 * UNITS, 257)) * 0.3).astype(np.float32)
        self.u = (rng.standard_normal((3 * UNITS, UNITS)) / np.sqrt(UNITS)).astype(np.float32)
        self.hold()

    def hold(self) -> None:
        self.x[:, PAD] = 0
        self.x[:UNITS, PAD] = 60

    def states(self, text: np.ndarray, order, keep: bool = False):
        """States (position, unit, row) of windows (position, row); with what training needs."""
        n, rows = text.shape
        h = np.zeros((UNITS, rows), np.float32)
        out = np.empty((n, UNITS, rows), np.float32)
        saved = []
        part = np.empty((3 * UNITS, rows), np.float32)
        recur = np.empty((3 * UNITS, rows), np.float32)
        for t in order:
            np.take(self.x, text[t], axis=1, out=part, mode="clip")
            np.matmul(self.u, h, out=recur)
            gates = part[:2 * UNITS] + recur[:2 * UNITS]
            _sigmoid(gates)
            z, r = gates[:UNITS], gates[UNITS:]
            new = r * recur[2 * UNITS:]
            new += part[2 * UNITS:]
            np.tanh(new, out=new)
            if keep:
                saved.append((t, h, z, r, new, recur[2 * UNITS:].copy()))
            h = h - new
            h *= z
            h += new
            out[t] = h
        return out, saved

    def gradients(self, text: np.ndarray, saved, d_out: np.ndarray):
        """Gradients of the two arrays by backpropagation through time."""
        dx, du = np.zeros_like(self.x), np.zeros_like(self.u)
        dh = np.zeros_like(d_out[0])
        for t, h, z, r, new, pre in reversed(saved):
            dh = dh + d_out[t]
            d_new = dh * (1 - z) * (1 - new * new)
            d_z = dh * (h - new) * z * (1 - z)
            d_r = d_new * pre * r * (1 - r)
            d_in = np.concatenate([d_z, d_r, d_new])
            d_rec = np.concatenate([d_z, d_r, d_new * r])
            np.add.at(dx.T, text[t], d_in.T)
            du += d_rec @ h.T
            dh = dh * z + self.u.T @ d_rec
        dx[:, PAD] = 0
        return dx, du


class Network:
    """Both layers and the position softmax."""

    def __init__(self, languages: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.back = Layer(rng), Layer(rng)
        self.v = (rng.standard_normal((len(languages), 2 * UNITS)) * 0.3).astype(np.float32)
        self.c = np.zeros((len(languages), 1), np.float32)

    def _arrays(self):
        return [self.ahead.x, self.ahead.u, self.back.x, self.back.u, self.v, self.c]

    def _probabilities(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        p = self.v[:, :UNITS] @ a
        p += self.v[:, UNITS:] @ b
        p += self.c
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        return p

    def step(self, text: np.ndarray, target: np.ndarray):
        """(loss, gradients) of windows (position, row) with one language number a row."""
        n, rows = text.shape
        a, saved_a = self.ahead.states(text, range(n), True)
        b, saved_b = self.back.states(text, range(n - 1, -1, -1), True)
        real = (text != PAD).astype(np.float32)
        scale = 1 / real.sum()
        da, db = np.empty_like(a), np.empty_like(b)
        dv, dc, loss = np.zeros_like(self.v), np.zeros_like(self.c), 0.0
        for t in range(n):
            p = self._probabilities(a[t], b[t])
            loss -= float((np.log(p[target, np.arange(rows)] + 1e-9) * real[t]).sum()) * scale
            p[target, np.arange(rows)] -= 1
            p *= real[t] * scale
            dv[:, :UNITS] += p @ a[t].T
            dv[:, UNITS:] += p @ b[t].T
            dc += p.sum(axis=1, keepdims=True)
            da[t], db[t] = self.v[:, :UNITS].T @ p, self.v[:, UNITS:].T @ p
        return loss, [*self.ahead.gradients(text, saved_a, da), *self.back.gradients(text, saved_b, db), dv, dc]

    def fit(self, text: np.ndarray, target: np.ndarray, steps: int = STEPS, seed: int = 5) -> list[float]:
        """Adam over windows (row, position); every language is drawn equally often."""
        rng = np.random.default_rng(seed)
        of = [np.flatnonzero(target == k) for k in range(len(self.languages))]
        arrays = self._arrays()
        m, v = [np.zeros_like(x) for x in arrays], [np.zeros_like(x) for x in arrays]
        losses = []
        for step in range(1, steps + 1):
            pick = np.array([rng.choice(of[k]) for k in rng.integers(0, len(of), BATCH)])
            loss, grads = self.step(np.ascontiguousarray(text[pick].T), target[pick])
            losses.append(loss)
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            norm = min(1.0, 5 / (1e-9 + float(np.sqrt(sum((g * g).sum() for g in grads)))))
            for x, g, mean, square in zip(arrays, grads, m, v):
                g *= norm
                mean *= 0.9
                mean += 0.1 * g
                square *= 0.99
                square += 0.01 * g * g
                x -= rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-7)
            self.ahead.hold()
            self.back.hold()
        return losses

    def pooled(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probabilities, positions by label, letters) of every row of a byte table."""
        size = np.diff(off)
        count = -(-size // WINDOW)
        begin = np.cumsum(count) - count
        rows = int(count.sum())
        k = len(self.languages)
        mean, label = np.zeros((len(size), k)), np.zeros((len(size), k))
        letters = np.zeros(len(size))
        if not rows:
            return mean, label, letters
        text = np.full(rows * WINDOW, PAD, np.int16)
        at = np.arange(len(data)) + np.repeat(begin * WINDOW - off[:-1], size)
        text[at] = data
        text = np.ascontiguousarray(text.reshape(rows, WINDOW).T)
        a, _ = self.ahead.states(text, range(WINDOW))
        b, _ = self.back.states(text, range(WINDOW - 1, -1, -1))
        total, won, seen = np.zeros((k, rows), np.float32), np.zeros((k, rows), np.float32), np.zeros(rows, np.float32)
        for t in range(WINDOW):
            p = self._probabilities(a[t], b[t])
            weight = _LETTER[text[t]]
            won += (p == p.max(axis=0)) * weight
            p *= weight
            total += p
            seen += weight
        some = np.flatnonzero(count)
        mean[some] = np.add.reduceat(total.T.astype(np.float64), begin[some])
        label[some] = np.add.reduceat(won.T.astype(np.float64), begin[some])
        letters[some] = np.add.reduceat(seen.astype(np.float64), begin[some])
        return mean / np.maximum(letters, 1)[:, None], label, letters


def held_out(id_col: str = "doc_id", parts: int = 5):
    """True for the rows that training never sees."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts == 0


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, steps: int = STEPS) -> Network | None:
    """Fit a network on at most ``sample_rows`` labelled rows of ``docs`` (doc_id, text, lang);
    None if there are none."""
    raw = F.col("text").cast("string").cast("binary")
    room = F.greatest(F.octet_length("text") - WINDOW, F.lit(0)) + 1
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), room) + 1
    labelled = docs.where(F.col("lang").isNotNull())
    parts = (labelled.where(F.octet_length("text") > 0)
             .select(raw.substr(place.cast("int"), F.lit(WINDOW)).alias("part"), "lang", F.xxhash64("doc_id").alias("h")))
    rows = lowest(parts, labelled.count(), sample_rows, "h", "lang", "part")
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    text = np.full((len(rows), WINDOW), PAD, np.int16)
    for i, r in enumerate(rows):
        part = np.frombuffer(bytes(r["part"]), np.uint8)
        text[i, :len(part)] = part
    network = Network(languages)
    network.fit(text, np.array([languages.index(r["lang"]) for r in rows]), steps)
    return network


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def _verdicts(network: Network | None, data: np.ndarray, off: np.ndarray):
    """(language, score, share) of every row of a byte table."""
    n = len(off) - 1
    found, scores, shares = [UNDECIDED] * n, np.zeros(n), np.zeros(n)
    if network is None:
        return found, scores, shares
    for i, j in spans(off, CHUNK):
        part, cut = data[off[i]:off[j]], off[i:j + 1] - off[i]
        mean, label, letters = network.pooled(part, cut)
        best = mean.argmax(axis=1)
        ascii_letters = np.concatenate([[0], np.cumsum(_LETTER[:128][np.minimum(part, 127)] * (part < 128))])
        plain = ascii_letters[cut[1:]] > ascii_letters[cut[:-1]]
        for k in range(j - i):
            if plain[k] or (letters[k] and _has_letter(part[cut[k]:cut[k + 1]].tobytes())):
                found[i + k] = network.languages[best[k]]
                scores[i + k] = min(1.0, mean[k, best[k]])
                shares[i + k] = label[k, best[k]] / letters[k]
    return found, scores, shares


def _predicted(docs: DataFrame, network: Network | None, keep: list[str]) -> DataFrame:
    """Columns _k0, _k1, ... (``keep``), _lang_pred, _score and _share."""
    names = [f"_k{i}" for i in range(len(keep))]
    fields = "".join(f"{k} {docs.schema[c].dataType.simpleString()}, " for k, c in zip(names, keep))

    def run(batches):
        for b in batches:
            found, scores, shares = _verdicts(network, *text_bytes(b.column(0)))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(found, pa.string()), pa.array(scores), pa.array(shares)],
                                             [*names, "_lang_pred", "_score", "_share"])

    return docs.select(F.col("text").cast("string").alias("_text"), *[F.col(c).alias(k) for c, k in zip(keep, names)]
                       ).mapInArrow(tidy(run), f"{fields}_lang_pred string, _score double, _share double")


def predict(docs: DataFrame, network: Network | None, *keep: str) -> DataFrame:
    """``keep`` columns with lang_pred, score (pooled probability of that language) and
    share (of the letter positions labelled with it), which replace columns of those names."""
    keep = [c for c in keep if c not in ("lang_pred", "score", "share")]
    return _predicted(docs, network, keep).select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_lang_pred").alias("lang_pred"),
        F.col("_score").alias("score"), F.col("_share").alias("share"))


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, lang and any others) with the network's language of each text in ``lang``, without the rows
    that are in no language; the network is trained on the labelled rows not held out. Without labels, rows with a letter
    stay as they are."""
    network = train(docs.where(~held_out()))
    if network is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))

    def named(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            yield pa.array(_verdicts(network, *text_bytes(t))[0], pa.string())

    # only the texts go to Python, and only the verdicts come back; a plain function would be run a second time in the filter
    language = F.arrow_udf(named, "string").asNondeterministic()(F.col("text").cast("string"))
    return docs.withColumn("lang", language).where(F.col("lang") != UNDECIDED)


def report(docs: DataFrame) -> DataFrame:
    """Train on the rows not held out, predict all: (doc_id, held_out, lang_pred, score, share)."""
    network = train(docs.where(~held_out()))
    return predict(docs.withColumn("held_out", held_out()), network, "doc_id", "held_out")
