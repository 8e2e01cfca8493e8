"""The next document of every row, whatever the ids."""
import hashlib

import pytest

from tessera.llm import fingerprint


def wanted(rows):
    """(doc_id, n_chars, edited_sha256) by the rule: nulls first, then ids, then texts; after the last the first."""
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        n = len(t) // 4
        out.append((i, len(t), hashlib.sha256((t[:len(t) - n] + nxt[:n]).encode()).hexdigest()))
    return sorted(out, key=repr)


def ids():
    big = 1 << 60
    yield "large with nulls", [(big + k, f"text number {k} of this table, word {k * k}") for k in range(40)] + [(None, "no id"), (None, None)]
    yield "beside 2**53", [((1 << 53) + k, f"row {k} and its words") for k in range(-20, 60)]
    yield "extremes", [((1 << 63) - 1, "the largest id"), (-(1 << 63), "the smallest"), (0, "zero"), (None, "none at all")]
    yield "equal at the bounds", [(k // 12, f"copy {k % 12} of id {k // 12}") for k in range(120)]
    yield "one id", [(7, f"text {k}") for k in range(50)]
    yield "nulls only", [(None, f"text {k}") for k in range(9)]
    yield "one row", [(3, "alone here")]


@pytest.mark.parametrize("name,rows", list(ids()))
def test_every_row_has_its_next(spark, name, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in fingerprint.edited_likeness(df).collect()]
    assert sorted(got, key=repr) == wanted(rows)


def test_missing_next_is_an_error(spark, monkeypatch):
    """A range without the row that closes it raises."""
    df = spark.createDataFrame([(k, f"text {k}") for k in range(30)], "doc_id bigint, text string")
    beside = fingerprint._beside_next
    monkeypatch.setattr(fingerprint, "_beside_next", lambda docs: beside(docs).where("extra = 0"))
    with pytest.raises(Exception, match="is missing"):
        fingerprint.edited_likeness(df).collect()
