"""Embeddings, pages, the pipeline and the registration."""

import gzip
import hashlib
import os
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import common, pivots, warc

VECTORS = "vec_id bigint, embedding array<float>, label int"


def link_truth(rows, threshold=0.93):
    """n_links and component of each row, by all pairs."""
    valid = [k for k, (_, e, lab) in enumerate(rows)
             if lab is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    near = defaultdict(list)
    for a in valid:
        for b in valid:
            x, y = (np.array(rows[k][1], np.float32).astype(float) for k in (a, b))
            if a != b and rows[a][2] == rows[b][2] and len(x) == len(y) \
                    and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                near[a].append(b)
    out = []
    for k, row in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        low = min(rows[b][0] for b in seen)
        out.append((row[0], len(near[k]), low, low == row[0]))
    return sorted(out)


def turned(rng, x, cos):
    n = rng.standard_normal(len(x))
    n -= (n @ x) / (x @ x) * x
    return cos * x / np.linalg.norm(x) + np.sqrt(1 - cos * cos) * n / np.linalg.norm(n)


def test_links_match_all_pairs(spark):
    """Random vectors, pairs around the threshold, a large group of near copies and equal vectors."""
    rng = np.random.default_rng(12)
    rows = [(k, rng.standard_normal(32).tolist(), k % 3) for k in range(300)]
    for k in range(300, 420):
        rows.append((k, turned(rng, np.array(rows[k - 300][1]), rng.uniform(0.90, 0.99)).tolist(), rows[k - 300][2]))
    rows += [(k, turned(rng, np.array(rows[5][1]), 0.985).tolist(), 2) for k in range(500, 560)]
    rows += [(k, rows[7][1], 1) for k in range(600, 630)]
    rows += [(700, None, 1), (701, [], 1), (702, [0.0] * 32, 1), (703, [float("nan")] * 32, 1), (704, [None] * 32, 1),
             (705, rows[0][1], None), (706, [1.0, 2.0], 0), (707, [2.0, 4.0], 0), (708, [float("inf")] + [1.0] * 31, 0)]
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    assert sorted(map(tuple, pivots.near_duplicates(df).collect())) == link_truth(rows)


def test_long_lists_are_cut(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.standard_normal(16)
    rows = [(k, turned(rng, base, 0.98).tolist(), 1) for k in range(90)]
    monkeypatch.setattr(pivots, "BLOCK", 20)
    df = spark.createDataFrame(rows, VECTORS)
    assert sorted(map(tuple, pivots.near_duplicates(df).collect())) == link_truth(rows)


def test_recall_at_the_threshold(spark):
    """Random pairs at cosine 0.932 in 64 dimensions, among others: recall of the index."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((2000, 64))
    rows = [(2 * k, x[k].tolist(), 0) for k in range(2000)] + \
           [(2 * k + 1, turned(rng, x[k], 0.932).tolist(), 0) for k in range(2000)]
    got = pivots.near_duplicates(spark.createDataFrame(rows, VECTORS)).where("n_links > 0").count()
    assert got >= 0.99 * 4000


def test_embeddings_with_clashing_columns_and_empty(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (None, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, VECTORS)
    extra = df.withColumns({c: F.lit("x") for c in ("vec", "size", "h", "id", "mult", "prefix", "links", "u")})
    want = [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 0, None, True)]
    for t in (df, extra):
        assert sorted(map(tuple, pivots.near_duplicates(t).collect()), key=repr) == sorted(want, key=repr)
    assert pivots.near_duplicates(df.limit(0)).count() == 0


# ---------------------------------------------------------------- 6 archives

PAGES = "page_id bigint, url string, html string"


def page_rows():
    big, trap = "<p>über</p>" * 300, "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40
    return [(1, "http://a/", big), (2, "http://b/", big), (3, None, big), (4, "http://c/\r\nX: y", "short"),
            (5, "http://d/", "short"), (6, "http://e/", None), (7, "http://f/", ""), (8, "http://g/", trap),
            (9, "http://h/", trap), (10, "http://i/", "y" * 999), (11, "http://j/", "y" * 999), (12, "http://k/", "z" * 1000),
            (13, "http://l/", "z" * 1000), (None, "http://m/", big), (2, "http://b/", big), (14, "http://n/", "\n\n end\r\n\r\n")]


def test_archive_round_trip(spark):
    rows = page_rows()
    got = sorted(map(tuple, warc.report(spark.createDataFrame(rows, PAGES).repartition(3)).collect()), key=repr)
    top = {}
    for i, _, h in rows:
        if i is not None:
            top[h or ""] = max(top.get(h or "", -1), i)
    want = []
    for i, _, h in set(rows):
        p = (h or "").encode()
        later = i is not None and len(p) >= 1000 and i != top[h]
        want.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if later else "response", top[h] if later else None))
    assert got == sorted(want, key=repr)
    assert warc.report(spark.createDataFrame([], PAGES)).count() == 0


def test_captures_are_nested(spark):
    df = spark.createDataFrame(page_rows(), PAGES).withColumn("digest", F.lit(1)).withColumn("payload", F.lit(2))
    caps = {r["page_id"]: r for r in warc.assemble(warc.round_trip(df)).collect()}
    one, two = caps[8], caps[9]
    assert bytes(two["response"]["payload"]).decode() == dict((r[0], r[2]) for r in page_rows())[9]
    assert one["response"]["payload"] is None and one["response"]["refers_to"] == 9
    assert caps[1]["request"]["block"].startswith("GET http://a/ HTTP/1.1\r\n") and "page-id: 1" in caps[1]["metadata"]["block"]


def test_plain_reader_reads_the_same(spark, tmp_path):
    df = spark.createDataFrame(page_rows(), PAGES)
    boundary, path = warc.new_boundary(), str(tmp_path / "w")
    warc.write_warc(df, path, boundary)

    def rows(t):
        return sorted((tuple(sorted((k, v) for k, v in r["headers"].items() if k != "WARC-Boundary")), bytes(r["block"]))
                      for r in t.collect())

    assert rows(warc.read_warc(spark, path)) == rows(warc.read_archive(spark, path, boundary))
    name = next(f for f in os.listdir(path) if f.endswith(".gz"))
    assert gzip.open(os.path.join(path, name)).read().startswith(b"WARC/1.1\r\n")


# ---------------------------------------------------------------- shared helpers

def test_words_and_hashes():
    import re
    import pyarrow as pa
    texts = ["", " a  bb\tccc\n", "x", "a", " ", "bb a", "é a", "a\x0bb\x0cc\rd"]
    data, off = common.text_bytes(pa.array(texts))
    starts, ends, row = common.word_cuts(data, off)
    got = defaultdict(list)
    for s, e, r in zip(starts, ends, row):
        got[r].append(data[s:e].tobytes().decode())
    assert [got[i] for i in range(len(texts))] == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    h = common.word_hashes(data, starts, ends)
    by = defaultdict(set)
    for s, e, x in zip(starts, ends, h):
        by[data[s:e].tobytes()].add(int(x))
    assert all(len(v) == 1 for v in by.values()) and len(set.union(*by.values())) == len(by)


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(1000, 1001 + k) for k in range(200)] + [(5000, 5000)]
    got = dict(map(tuple, common.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()))
    assert all(got[k] == 0 for k in range(61)) and all(got[1001 + k] == 1000 for k in range(200))


def test_components_of_paths_of_300_nodes(spark):
    """A path with random ids, and one whose smallest id is far from the others by steps of one."""
    order = np.random.default_rng(5).permutation(300).tolist()
    falling = [1000, *range(1299, 1000, -1)]
    edges = [*zip(order, order[1:]), *zip(falling, falling[1:])]
    got = dict(map(tuple, common.components(spark.createDataFrame(edges, "u bigint, v bigint").repartition(3)).collect()))
    assert got == {**{k: 0 for k in order}, **{k: 1000 for k in falling}}


def test_components_match_union_find(spark):
    """Sparse random graphs with stars whose centres have the largest ids, repeated edges and loops."""
    rng = np.random.default_rng(6)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] * 2
    edges += [(9000 + k % 3, 500 + k) for k in range(90)] + [(9000, 9001), (7, 7)]
    group = {x: x for e in edges for x in e}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        group[max(x, y)] = min(x, y)
    got = dict(map(tuple, common.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()))
    assert got == {x: root(x) for x in group if any(x in e and e[0] != e[1] for e in edges)}


def test_pack_round_trip():
    a, b = np.array([3, -1, 1 << 40]), np.array([1.5, 2.5], np.float32)
    x, y, z = common.unpack(common.pack(a, b, np.zeros(0, np.int32)), "<i8", "<f4", "<i4")
    assert (x == a).all() and (y == b).all() and len(z) == 0


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark, awkward, clashing):
    import corpus_pipeline
    docs = clashing.drop("probability", "sampled")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.written(stage(spark, docs, ""), "t")
        assert out.columns == docs.columns and out.count() <= docs.count()
        if name == "language":
            assert {r[0] for r in out.select("doc_id").collect()} >= {1, 5, 6, 8, 9, 11, 12, 13, 14, 15}
        if name == "near_duplicates":
            assert {r[0] for r in out.select("doc_id").collect()} & {7, 12, 14} == {14}
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= docs.count()


def test_pipeline_matches_its_stages(spark):
    """run() over the smallest table equals brute force up to the draw, and packs what was drawn."""
    import corpus_pipeline
    from tessera.llm import mixing, suffixdedup
    from test_documents import assert_packed, near_truth
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    texts = {i: r["text"] for i, r in rows.items() if r["text"] and any(c.isalpha() for c in r["text"])}
    kept = {i: texts[i] for i, v in near_truth(texts).items() if v[2]}
    cut = suffixdedup.brute_force(list(kept.items()))
    stages = dict(corpus_pipeline.STAGES)
    got = stages["repeats"](spark, stages["near_duplicates"](spark, stages["language"](spark, docs, sf), sf), sf)
    left = {r["doc_id"]: r["text"] for r in got.collect()}
    assert set(left) == {i for i, c in cut.items() if c[1] < c[0] or not c[0]}
    assert all(len(left[i].encode()) <= cut[i][0] - cut[i][1] for i in left)
    drawn = {r["doc_id"] for r in mixing.marked(got).where("sampled").collect()}
    final = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in final} == drawn
    assert_packed(final)


def test_registration():
    import __spark_entry__ as entry
    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names and "op8_mixing" in entry.oracle_sql() and "op6_warc" in entry.oracle_sql()


@pytest.mark.parametrize("op", ["op6_warc"])
def test_oracles(spark, op):
    import duckdb
    import __spark_entry__ as entry
    db = duckdb.connect()
    db.execute("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.001/pages.parquet'")
    want = db.execute(entry.oracle_sql()[op]).df()
    got = entry.queries()[op](spark, "/root/testdata/sf0.001").toPandas()[list(want.columns)]
    key = list(want.columns)
    assert sorted(map(repr, got[key].astype(object).where(got.notna(), None).values.tolist())) == \
        sorted(map(repr, want[key].astype(object).where(want.notna(), None).values.tolist()))
