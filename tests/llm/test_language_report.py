"""Operator 1's whole report against a plain model: one byte at a time, in doubles, no batches and no pads."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import langid

SF = "/root/testdata/sf0.001"
ODD = [(10 ** 6, None, "en"), (10 ** 6 + 1, "", "en"), (10 ** 6 + 2, "12 + 30 = 42!", "de"), (10 ** 6 + 3, "é", None),
       (10 ** 6 + 4, "…", "fr"), (10 ** 6 + 5, "x" * 5000, "en"), (10 ** 6 + 6, "日本語の文章です。", None),
       (10 ** 6 + 6, "日本語の文章です。", None), (None, "a word or two", "en")]


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def states(layer, data):
    """The state after each byte, in reading order."""
    n = langid.UNITS
    x, u, h, out = layer.x.astype(float), layer.u.astype(float), np.zeros(n), []
    for byte in data:
        keep = sigmoid(x[:n, byte] + u[:n] @ h)
        reset = sigmoid(x[n:2 * n, byte] + u[n:2 * n] @ h)
        new = np.tanh(x[2 * n:, byte] + reset * (u[2 * n:] @ h))
        h = keep * h + (1 - keep) * new
        out.append(h)
    return out


def expected(net, text):
    """(language, score, share) of a text: the mean over its letters' positions, each in its own window."""
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0, 0.0
    data, found = text.encode(), []
    for at in range(0, len(data), langid.WINDOW):
        part = data[at:at + langid.WINDOW]
        ahead, back = states(net.ahead, part), states(net.back, part[::-1])[::-1]
        for byte, a, b in zip(part, ahead, back):
            if byte >= 128 or chr(byte).isalpha():
                e = np.exp(net.v.astype(float) @ np.concatenate([a, b]) + net.c[:, 0])
                found.append(e / e.sum())
    mean = np.mean(found, axis=0)
    best = int(mean.argmax())
    return net.languages[best], float(mean[best]), float(np.mean([p.argmax() == best for p in found]))


def crc_held(doc_id, parts=5):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts == 0


@pytest.fixture(scope="module")
def table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    short = docs.where(F.octet_length("text") < 1500).orderBy("doc_id").limit(60)
    return short.union(spark.createDataFrame(ODD, docs.schema)).repartition(4).cache()


def test_report_equals_the_plain_model(spark, table, monkeypatch):
    train, seen = langid.train, []

    def fitted(docs, *args):
        seen.append((docs, train(docs, steps=40)))
        return seen[-1][1]

    monkeypatch.setattr(langid, "train", fitted)
    got = langid.report(table).collect()
    rows = table.collect()
    assert len(got) == len(rows) and len(seen) == 1
    net = seen[0][1]
    # learned from the rows not held out, all of them and no others
    assert sorted(map(repr, (r["doc_id"] for r in seen[0][0].collect()))) == sorted(
        repr(r["doc_id"]) for r in rows if not crc_held(r["doc_id"]))

    def order(r):
        return repr(r[0]), r[1]

    want = sorted(((r["doc_id"], crc_held(r["doc_id"]), *expected(net, r["text"])) for r in rows), key=order)
    for g, w in zip(sorted(map(tuple, got), key=order), want):
        assert g[:3] == w[:3]
        assert abs(g[3] - w[3]) < 1e-4 and abs(g[4] - w[4]) < 0.02


def test_prediction_needs_only_the_text(spark, table):
    """Other languages, sources and ids beside the same texts change no prediction."""
    net = langid.train(table.where(~langid.held_out()), steps=20)
    plain = langid.predict(table, net, "text")
    other = table.select((-F.col("doc_id")).alias("doc_id"), "text", F.lit("zz").alias("lang"), F.lit("s").alias("source"))
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, langid.predict(other, net, "text").collect()),
                                                                   key=repr)
    assert net.languages == sorted({r["lang"] for r in table.collect() if r["lang"] and r["text"]
                                    and not crc_held(r["doc_id"])})
