"""Lexical search against plain loops over regular expressions."""
import math
import re
from collections import Counter

import duckdb
import pytest
from llm_tables import DOCS, ROWS, SF_DIR, table
from tests_llm_help import same_rows

from tessera.llm import lexical

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = [(1, "The quick BROWN fox; the fox?"), (2, None), (3, ""), (4, "été NOËL où"), (5, "one two 123"), (6, "...!"),
         (None, "passage word"), (1, "lazy dogs dog"), (7, "日本語のテキスト aaaaaaaaaa"), (8, "word1 rest1 word")]


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k=50):
    found = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for i, wanted in asked.items():
        scored = []
        for d, c in found:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in wanted if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string").repartition(2)


def test_awkward_rows(awkward, clashing, items):
    got = same_rows(lambda df: lexical.search(df, items), awkward, clashing)
    assert got == brute([(r[0], r[1]) for r in ROWS], ITEMS)


def test_few_places_ties_and_blocks(awkward, items):
    """Two places an item, and items in many blocks of terms: the same ranking, cut."""
    want = brute([(r[0], r[1]) for r in ROWS], ITEMS, k=2)
    assert sorted(map(tuple, lexical.search(awkward, items, k=2).collect()), key=repr) == want
    assert sorted(map(tuple, lexical.search(awkward, items, k=2, term_bytes=20).collect()), key=repr) == want


def test_items_with_clashing_columns(awkward, items):
    more = items.selectExpr("*", "'x' as doc_id", "1 as score", "2 as rank", "3 as bucket")
    assert sorted(map(tuple, lexical.search(awkward, more).collect()), key=repr) == \
        brute([(r[0], r[1]) for r in ROWS], ITEMS)


def test_empty_tables(spark, awkward, empty, items):
    assert lexical.search(empty, items).collect() == []
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert lexical.search(awkward, none).collect() == []
    assert lexical.search(spark.createDataFrame([(1, None, None, None, 0)], DOCS), items).collect() == []


def test_many_equal_documents(spark):
    """A third of all documents is one text: the ties go by ascending id."""
    docs = [(k, "same words in every copy" if k % 3 == 0 else f"other text {k} words") for k in range(600)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    asked = [(1, "same copy"), (2, "words text")]
    got = lexical.search(df, spark.createDataFrame(asked, "item_id bigint, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, asked)


def test_best_keeps_what_a_task_drops_late(spark, monkeypatch):
    """Best rows kept over many chunks of one task are those of all chunks."""
    monkeypatch.setattr(lexical, "CHUNK", 64)
    docs = [(k, " ".join(["word"] * (k % 17 + 1) + [f"x{k}"])) for k in range(400)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    asked = [(1, "word"), (2, "x5 x7 x11")]
    got = lexical.search(df, spark.createDataFrame(asked, "item_id bigint, text string"), k=5)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, asked, 5)


def test_sql_and_loops_agree(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    docs, items = table(spark, "documents"), table(spark, "benchmark")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert sorted(con.execute(lexical.ORACLE_SQL).fetchall(), key=repr) == want
    assert sorted(map(tuple, lexical.search(docs, items).collect()), key=repr) == want
