"""Document operators against brute force, and on awkward, clashing and empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests_llm_help import same_rows
from tessera.llm import fingerprint, langid, licenses, maxent, minmax, mixing, packing, suffixdedup

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


# ---------------------------------------------------------------- 1 language

def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    net = langid.Network(["a", "b", "c"])
    text = rng.integers(0, 256, (7, 4)).astype(np.int16)
    text[5:, 1] = langid.PAD
    target = np.array([0, 1, 2, 1])
    for layer in (net.ahead, net.back):
        layer.x, layer.u = layer.x.astype(np.float64), layer.u.astype(np.float64)
    _, grads = net.step(text, target)
    for array, grad in zip(net._arrays(), grads):
        some = np.argwhere(np.abs(grad) > 1e-3)[:3]
        for at in map(tuple, some):
            array[at] += 1e-2
            up = net.step(text, target)[0]
            array[at] -= 2e-2
            down = net.step(text, target)[0]
            array[at] += 1e-2
            assert abs((up - down) / 2e-2 - grad[at]) < 2e-2 * max(1, abs(grad[at])) + 2e-3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = langid.train(docs.where(~langid.held_out()), steps=200)
    got = langid.predict(docs.where(langid.held_out()), net, "lang").where("lang is not null").toPandas()
    assert len(got) > 100 and (got.lang == got.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_prediction_ignores_layout_and_pads(docs):
    net = langid.Network(["a", "b"])
    text = "Ein Text von mehr als einem Fenster. " * 11
    parts = [text, "x", "", text + "y"]
    data, off = langid.text_bytes(pa.array(parts))
    together = net.pooled(data, off)[0]
    for i, p in enumerate(parts):
        alone = net.pooled(*langid.text_bytes(pa.array([p])))[0]
        assert np.allclose(alone[0], together[i], atol=1e-5)


def test_language_awkward(awkward, clashing, empty):
    got = same_rows(langid.report, awkward, clashing)
    assert len(got) == 18
    und = {r[0] for r in got if r[2] == "und"}
    assert und == {2, 3, 4, 10, None}
    assert all(r[3] == 0 for r in got if r[2] == "und")
    assert langid.report(empty).count() == 0
    kept = langid.identified(clashing)
    assert kept.columns == clashing.columns and kept.count() == 18 - 5
    assert langid.identified(awkward.withColumn("lang", F.lit(None).cast("string"))).count() == 13


# ---------------------------------------------------------------- 2 near-duplicates

def near_truth(texts, percent=85):
    sets = {}
    for i, t in texts.items():
        w = words(t)
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def test_near_duplicates_match_all_pairs(docs, texts):
    got = {r[0]: tuple(r)[1:] for r in minmax.near_duplicates(docs).collect()}
    assert got == near_truth(texts)


def test_chains_and_hot_groups(spark):
    """Copies of one base with own edits (base in the middle of the ids), a chain of steps, and copies."""
    rng = np.random.default_rng(8)
    base = [f"w{k}" for k in range(200)]
    made = {}
    for i in range(60):
        w = list(base)
        for _ in range(2):
            w[rng.integers(len(w))] = f"n{i}x{rng.integers(99)}"
        made[i] = " ".join(w)
    made[100] = " ".join(base)
    chain = [f"c{k}" for k in range(300)]
    for i in range(200, 215):
        chain[(i * 37) % 300] = f"z{i}"
        made[i] = " ".join(chain)
    made.update({i: "the very same text of more than five words" for i in range(300, 360)})
    df = spark.createDataFrame(list(made.items()), "doc_id bigint, text string").repartition(7)
    got = {r[0]: tuple(r)[1:] for r in minmax.near_duplicates(df).collect()}
    assert got == near_truth(made)


def test_signature_is_unbiased():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    b = np.concatenate([a[:300], rng.integers(0, 1 << 63, 100).astype(np.uint64)])
    shares = []
    for k in range(40):
        x, y = (np.sort(s * np.uint64(2 * k + 1)) for s in (a, b))
        sig = minmax.signatures(np.concatenate([x, y]), np.array([0, 400, 800]))
        shares.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(shares) - 300 / 500) < 0.04


def test_near_duplicates_awkward(awkward, clashing, empty):
    got = same_rows(minmax.near_duplicates, awkward, clashing)
    by = {r[0]: r[1:] for r in got if r[0] is not None}
    assert by[12] == (12, 1, False) and by[1][1:] == (1, True) and by[7] == (1, 6, False)
    assert by[2] == (0, 2, True) and by[4] == (0, 4, True)
    assert sum(r[0] == 12 for r in got) == 2 and len(got) == 18
    assert all(r[3] for r in got if r[0] is None)
    assert minmax.near_duplicates(empty).count() == 0


# ---------------------------------------------------------------- 4 language model

def test_scores_match_counts(docs, texts):
    got = {r["doc_id"]: r for r in maxent.scores(docs).collect()}
    tokens = {i: words(t) + [None] for i, t in texts.items()}
    fold = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    c = Counter(w for i, t in tokens.items() if not fold[i] for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in tokens.items():
        r = got[i]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (fold[i], len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
    assert sum(r["score"] for r in got.values() if r["held_out"]) > sum(r["base_score"] for r in got.values() if r["held_out"])


def test_class_probabilities_sum_to_one(docs):
    weights = maxent.train(docs.select("text"), rounds=1)
    data, off = maxent.text_bytes(pa.array(["some words of a text", "and others"]))
    word, cls, _, place = maxent.tokens(data, off)
    logs = maxent.class_logs(weights, maxent.features(word, cls, place))
    assert np.allclose(np.exp(logs).sum(axis=1), 1, atol=1e-4)
    assert np.abs(weights).max() > 0


def test_scores_awkward(awkward, clashing, empty):
    got = same_rows(maxent.scores, awkward, clashing, digits=6)
    assert len(got) == 18 and {r[2] for r in got if r[0] in (2, 3, 4)} == {1}
    assert maxent.scores(empty).count() == 0


# ---------------------------------------------------------------- 5 repeated strings

def test_repeats_match_brute_force(docs, texts):
    got = {r[0]: tuple(r)[1:] for r in suffixdedup.report(docs).collect()}
    assert got == suffixdedup.brute_force(list(texts.items()))


def test_repeats_of_hard_strings(spark):
    rng = np.random.default_rng(2)
    common = "".join(rng.choice(list("ab"), 120))
    made = [(i, "".join(rng.choice(list("ab"), 40)) + common[rng.integers(0, 60):rng.integers(60, 120)] +
             "".join(rng.choice(list("ab \0é"), 90))) for i in range(30)]
    made += [(40, "x" * 300), (41, "x" * 49), (42, "x" * 50), (43, "y" + "x" * 80 + "z"), (44, "ab" * 100), (45, "ba" * 60),
             (46, common), (47, common), (48, ""), (49, None)]
    df = spark.createDataFrame(made, "doc_id bigint, text string").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in suffixdedup.report(df).collect()}
    assert got == suffixdedup.brute_force(made)


def test_loser_tree_merges_and_measures():
    rng = np.random.default_rng(4)
    runs, every = [], []
    for k in range(5):
        keys = sorted(bytes(rng.integers(97, 99, suffixdedup.LENGTH).astype(np.uint8)) for _ in range(k * 7))
        common = [0] + [next((h for h in range(50) if a[h] != b[h]), 50) for a, b in zip(keys, keys[1:])]
        runs.append((keys, common[:len(keys)]))
        every += keys
    run, at, common = suffixdedup.merge_runs(runs)
    merged = [runs[r][0][p] for r, p in zip(run, at)]
    assert merged == sorted(every)
    assert common[1:] == [next((h for h in range(50) if a[h] != b[h]), 50) for a, b in zip(merged, merged[1:])]


def test_repeats_awkward(awkward, clashing, empty):
    got = same_rows(suffixdedup.report, awkward, clashing)
    by = {r[0]: r for r in got if r[0] is not None}
    assert len(got) == 18 and by[9][2] == 88 and by[14][2] == 300 and by[13][2] == 0
    assert all(r[2] == 0 for r in got if r[0] is None)
    kept = suffixdedup.remove_repeats(clashing)
    assert kept.columns == clashing.columns
    left = {r["doc_id"]: r for r in kept.collect()}
    assert left[9]["text"] == "Another start. " and left[9]["n_chars"] == 15 and 14 not in left and left[2]["text"] is None
    assert suffixdedup.report(empty).count() == 0


# ---------------------------------------------------------------- 7 licenses

def lcs(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
    return int(table[-1, -1])


def test_licenses_match_full_alignment(spark, docs, texts):
    """Every notice that stands in a text is found with full coverage; no text without four shared
    tokens is reported, and coverage is never above that of the unbanded alignment."""
    index = licenses.Index(licenses.TEMPLATES)
    got = defaultdict(list)
    for r in licenses.scan(docs).collect():
        got[r["doc_id"]].append(r)
    cut = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.translate(LOWER))
    for i, t in texts.items():
        for name, template in licenses.TEMPLATES.items():
            whole = " ".join(cut(t or ""))
            found = [r for r in got[i] if r["license"] == name]
            if f" {' '.join(cut(template))} " in f" {whole} ":
                assert any(r["coverage"] == 1 for r in found)
            for r in found:
                part = t.encode()[r["start"]:r["end"]].decode()
                assert lcs(cut(template), cut(part)) >= round(r["coverage"] * len(cut(template)))
    edited = licenses.TEMPLATES["MIT"].replace("free of charge", "at no cost").replace("modify, ", "")
    one = spark.createDataFrame([(1, "before " * 50 + edited + " after" * 50)], "doc_id bigint, text string")
    r, = licenses.scan(one).collect()
    a, b = cut(licenses.TEMPLATES["MIT"]), cut(edited)
    assert r["license"] == "MIT" and math.isclose(r["coverage"], lcs(a, b) / len(a)) and len(r["spans"]) >= 2
    assert len(index.tokens) == len(licenses.TEMPLATES)


def test_licenses_with_an_inserted_run(spark):
    """Whole texts with 9 to 40 tokens put in anywhere are found whole, two edited copies stay two."""
    made, want = [], {}
    for name in ("MIT", "Apache-2.0", "GPL-3.0-or-later", "BSD-2-Clause"):
        w = licenses.TEMPLATES[name].split()
        for share in (0.1, 0.3, 0.5, 0.7, 0.9):
            for extra in (9, 17, 40):
                at = int(share * len(w))
                made.append((len(made), " ".join(["before"] * 30 + w[:at] + [f"x{k}" for k in range(extra)] + w[at:] + ["after"] * 30)))
                want[made[-1][0]] = name
    w = licenses.TEMPLATES["MIT"].split()
    two = [*w[:20], "x1", "x2", *w[22:], *w[:70], "x3", "x4", *w[72:]]
    made.append((1000, " ".join(two)))
    got = defaultdict(list)
    for r in licenses.scan(spark.createDataFrame(made, "doc_id bigint, text string").repartition(4)).collect():
        got[r["doc_id"]].append(r)
    for i, name in want.items():
        r, = [x for x in got[i] if x["license"] == name]
        assert r["coverage"] == 1 and len(r["spans"]) >= 2
        assert not any(x in dict(made)[i].encode()[s["start"]:s["end"]].decode() for s in r["spans"] for x in ("before", "x0", "after"))
    assert [x["license"] for x in got[1000]] == ["MIT", "MIT"] and all(0.9 < x["coverage"] < 1 for x in got[1000])


def test_licenses_awkward(spark, awkward, clashing, empty):
    assert same_rows(licenses.scan, awkward, clashing) == []
    assert licenses.scan(empty).count() == 0
    twice = spark.createDataFrame([(1, "Released under the MIT License. x Released under the MIT License."),
                                   (1, "Released under the MIT License. x Released under the MIT License.")],
                                  "doc_id bigint, text string")
    assert licenses.scan(twice).count() == 4


# ---------------------------------------------------------------- 8 mixing

def test_mixing_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(db.execute(mixing.oracle_sql()).fetchall())
    assert sorted(tuple(r) for r in mixing.report(spark.read.parquet(f"{sf}/documents.parquet")).collect()) == want


def test_raked_weights_meet_the_targets(spark, docs):
    import pandas as pd
    targets = {"source": {f"src{k}": 1 + k % 3 for k in range(20)}, "language": {"en": 2, "de": 1, "fr": 1, "es": 1},
               "topic": {"prose": 3, "short": 1, "long": 2}}
    tables = {d: spark.createDataFrame([(k, float(v)) for k, v in t.items()], "value string, weight double")
              for d, t in targets.items()}
    # every combination has tokens, so all targets can be met
    cells = spark.createDataFrame([(s, g, t, 10 + (hash((s, g, t)) % 90)) for s in targets["source"]
                                   for g in targets["language"] for t in targets["topic"]],
                                  "source string, language string, topic string, tokens bigint")
    got = mixing.rake(cells, tables).toPandas()
    for d, t in targets.items():
        share = got.groupby(d).weight.sum() / got.weight.sum()
        want = pd.Series(t) / sum(t.values())
        assert (share - want).abs().max() < 1e-9


def test_one_tiny_source_does_not_shrink_the_sample(spark):
    rows = [(k, " ".join(["w"] * (40_000 if k == 0 else 2_000 + 100 * k)), "en" if k % 3 else "de", f"src{k}") for k in range(20)]
    tiny = (20, "one two three four five", "xx", "rare")

    def cells(rows):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
        return {r["doc_id"]: (r["n_tokens"], r["probability"]) for r in mixing.marked(docs).collect()}

    for got in (cells(rows), cells([*rows, tiny])):
        expected = sum(n * p for n, p in got.values())
        assert abs(expected / sum(n for n, _ in got.values()) - mixing.BUDGET) < 1e-9
        assert all(0 < p <= 1 for _, p in got.values())
    assert got[20] == (5, 1.0)


def test_filling_matches_bisection(spark):
    rng = np.random.default_rng(4)
    tokens, weight = rng.integers(1, 10_000, 200) ** 2, rng.random(200)
    weight[:5] = 0
    rated = spark.createDataFrame([(int(t), float(w), float(w / t)) for t, w in zip(tokens, weight)],
                                  "tokens bigint, weight double, ratio double")
    for budget in (0.001, 0.3, 0.9):
        low, high = 0.0, 1e20
        for _ in range(300):
            mid = (low + high) / 2
            low, high = (mid, high) if (tokens * np.minimum(1, mid * weight / tokens)).sum() < budget * tokens.sum() else (low, mid)
        assert abs(mixing.fill_scale(rated, budget) / low - 1) < 1e-6
    assert (mixing.fill_scale(rated, 1.0) * weight[5:] / tokens[5:] >= 1).all()


def test_shuffled_cells_give_the_same(docs, monkeypatch):
    small = sorted(map(tuple, mixing.report(docs).collect()))
    monkeypatch.setattr(mixing, "SMALL_CELLS", 0)
    assert sorted(map(tuple, mixing.report(docs).collect())) == small


def test_mixing_awkward(awkward, clashing, empty):
    got = same_rows(mixing.report, awkward, clashing)
    assert len(got) == 18 and all(0 <= r[5] <= 1 for r in got)
    assert {r[1] for r in got if r[0] == 4} == {"(none)"}
    assert mixing.report(empty).count() == 0
    assert mixing.sample(awkward).columns == awkward.columns


# ---------------------------------------------------------------- 9 packing

def whole_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.public_path())
    return {i: [*t.encode(x or "", add_special_tokens=False).ids, 0] for i, x in texts.items()}


def assert_packed(rows, capacity=packing.CAPACITY):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_is_whole_and_tight(docs, texts):
    rows = packing.pack(docs).collect()
    ids = whole_ids(texts)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(ids)
    for i, found in pieces.items():
        found.sort(key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(found):
            part = ids[i][at:at + 2048]
            assert (r["piece"], r["start"], r["length"]) == (k, at, len(part))
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += len(part)
        assert at == len(ids[i])
    total = sum(map(len, ids.values()))
    assert assert_packed(rows) <= -(-total // 2048) + 1


def exact_bins(sizes, capacity):
    """Fewest bins by trying all; for a few pieces."""
    best = [len(sizes)]

    def place(k, room):
        if len(room) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(room)
            return
        for i in range(len(room)):
            if room[i] >= sizes[k]:
                room[i] -= sizes[k]
                place(k + 1, room)
                room[i] += sizes[k]
        room.append(capacity - sizes[k])
        place(k + 1, room)
        room.pop()

    place(0, [])
    return best[0]


def test_plan_is_near_the_optimum():
    rng = np.random.default_rng(6)
    worse = 0
    for _ in range(40):
        sizes = sorted(rng.integers(1, 21, 9).tolist(), reverse=True)
        rows = packing.plan(Counter(sizes), 20)
        used = max(r[3] + (r[2] - r[1]) // r[4] for r in rows)
        assert sum(r[2] - r[1] for r in rows) == len(sizes)
        worse += used - exact_bins(sizes, 20)
    assert worse <= 2


def test_filling_is_the_best(spark):
    rng = np.random.default_rng(9)
    for _ in range(60):
        counts = np.zeros(31, np.int64)
        for s in rng.integers(2, 31, 6):
            counts[s] += 1
        room = int(rng.integers(5, 31))
        best, sums = 0, {0}
        for s in np.flatnonzero(counts):
            for _ in range(counts[s]):
                sums |= {x + int(s) for x in sums}
        best = max(x for x in sums if x <= room)
        got = packing.complete(counts, room)
        assert sum(s * k for s, k in got) == best and all(k <= counts[s] for s, k in got)


def test_word_ids_equal_the_tokenizer():
    odd = ["it's WE'LL !'s <|endoftext|> a<|endoftext|>b", "İstanbul ǅ z​q x́", "a\x1cb\x00c\x7f d\x85e f",
           "日本語 12³½ Ünï'S ﬁn", "", " \n "]
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.public_path())
    got = packing.word_ids(packing.public_path())([x.encode() for x in odd])
    assert got == [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in odd]


def test_packing_awkward(awkward, clashing, empty):
    got = same_rows(packing.pack, awkward, clashing, drop=("sequence_id", "offset"))
    assert sum(r[0] == 2 for r in got) == 1 and sum(r[0] == 12 for r in got) == 2
    assert_packed(packing.pack(awkward).collect())
    assert packing.pack(empty).count() == 0


# ---------------------------------------------------------------- 10 fingerprints

def test_edited_texts_follow_the_order(docs, texts):
    ids = sorted(texts)
    got = {r["doc_id"]: r for r in fingerprint.edited_likeness(docs.repartition(9)).collect()}
    plain = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(docs).collect()}
    for k, i in enumerate(ids):
        own, nxt = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        n = len(own)
        edited = own[:n - n // 4] + nxt[:n // 4]
        r = got[i]
        assert r["n_chars"] == n and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == plain[i]
        one = fingerprint.codes(*fingerprint.text_bytes(pa.array([edited])))
        assert r["edited_fingerprint"] == fingerprint.to_hex(*one)[0]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    long = [r for r in got.values() if r["n_chars"] > 400]
    assert np.mean([r["near_edited"] > r["near_next"] for r in long]) > 0.97


def test_counts_match_a_plain_loop():
    text = "Ein kleiner Text, ganz klein.".encode()
    data = np.frombuffer(text, np.uint8)
    want = np.zeros(256, int)
    box = fingerprint._SHUFFLED
    for kind, (a, b, c) in enumerate(fingerprint.TRIPLETS):
        for i in range(len(text) - 4):
            h = box[text[i + a] ^ (29 * kind + 1)]
            h = box[h ^ text[i + b]]
            want[box[h ^ text[i + c]]] += 1
    got = fingerprint._counts(np.concatenate([data, data[:3]]), np.array([0, len(data), len(data) + 3]))
    assert (got[0] == want).all() and got[1].sum() == 0


def test_fingerprints_awkward(awkward, clashing, empty):
    got = same_rows(fingerprint.edited_likeness, awkward, clashing)
    assert len(got) == 18
    by = {r[0]: r for r in got if r[0] is not None}
    assert by[6][3] == by[7][3] and by[2][3] == by[3][3]
    assert fingerprint.edited_likeness(empty).count() == 0
    one = awkward.where("doc_id = 8")
    assert fingerprint.edited_likeness(one).collect()[0]["near_next"] == 1.0
