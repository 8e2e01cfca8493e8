"""Byte-level BPE against the tiktoken library: plain, odd, long and random texts."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_tables import DOCS, ROWS, table
from tests_llm_help import same_rows

from tessera.llm import bytebpe, merging
from tessera.llm.bytebpe import Coder, PerfectHash, char_classes, public_path, read_ranks


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(public_path())


@pytest.fixture(scope="module")
def coder(ranks):
    return Coder(ranks, char_classes())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(library, text):
    return np.array(library.encode_ordinary(text), "<u4").tobytes()


def wanted(library, doc_id, text):
    ids = ids_of(library, text or "")
    return (doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_perfect_hash_is_minimal_and_exact(ranks):
    keys = list(ranks)
    table = PerfectHash(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert sorted(table.slots.tolist()) == list(range(len(keys)))
    others = [k + b"\x00\x01" for k in keys[:5000]]
    assert (table.find(others) == -1).all()
    assert (PerfectHash([]).find([b"a"]) == -1).all() and PerfectHash([b"a"]).find([b"a", b"b"]).tolist() == [0, -1]


def test_random_texts(coder, library):
    rng = random.Random(5)
    odd = [chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(400)]
    alphabet = [*"ab cdé'strevmld\t\n\r \x1c\x85    日本😀𝒳٣²½ⅷ<|>!?.--0123", "<|endoftext|>", "'re", " 'll", "'ve", *odd]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(50))) for _ in range(3000)]
    got = coder.encode([t.encode() for t in texts])
    assert got == [ids_of(library, t) for t in texts]
    assert coder.decode(got) == [t.encode() for t in texts]


def test_both_heaps_agree(coder):
    rng = random.Random(6)
    pieces = [bytes(rng.choice(b"etaoin shrdlu\xc3\xa9\xff") for _ in range(rng.randrange(1, 33))) for _ in range(3000)]
    assert coder.merges(pieces) == [coder.pairs.alone(coder.single[np.frombuffer(p, np.uint8)]) for p in pieces]


def test_long_texts(coder, library):
    texts = ["a" * 50_000, "word and 'twas " * 400_000, "日本語" * 30_000, " " * 100_000 + "x", "ab" * 20 + "\n" * 5000]
    assert coder.encode([t.encode() for t in texts]) == [ids_of(library, t) for t in texts]


def test_shared_hashes_do_not_mix(coder, library, monkeypatch):
    """Were all hashes equal, pre-tokens are still told apart by their bytes."""
    text = "some words and other words"
    coder.encode([text.encode()])  # the pre-tokens are in the store now
    monkeypatch.setattr(merging, "word_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    assert coder.encode([text.encode()]) == [ids_of(library, text)]


def test_bytes_outside_utf8(coder, library):
    raw = b"ok \xff\xfe bad \xc3"
    assert coder.encode([raw]) == [ids_of(library, raw.decode("utf-8", "replace"))]


def test_vocabulary_must_hold_all_bytes():
    with pytest.raises(ValueError, match="lacks the bytes"):
        Coder({b"a": 0}, char_classes())


def test_report(spark, awkward, clashing, empty, library):
    got = same_rows(bytebpe.report, awkward, clashing)
    assert got == sorted((wanted(library, r[0], r[1]) for r in ROWS), key=repr)
    assert bytebpe.report(empty).collect() == []


def test_whole_table(spark, library):
    docs = table(spark, "documents").select("doc_id", "text")
    got = {r[0]: tuple(r) for r in bytebpe.report(docs).collect()}
    assert got == {r["doc_id"]: wanted(library, r["doc_id"], r["text"]) for r in docs.collect()}


def test_encode_then_decode(spark, awkward, library):
    encoded = bytebpe.encode(awkward)
    back = bytebpe.decode(encoded).collect()
    assert sorted(bytes(r["data"]) for r in back) == sorted((r[1] or "").encode() for r in ROWS)
    assert spark.createDataFrame([], DOCS).transform(bytebpe.encode).collect() == []
