"""Conversation repair against an exhaustive search and a plain one over whole letter strings."""
import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache
from itertools import product

import pytest
from llm_tables import table

from tessera.llm import conversations as conv
from tessera.llm.conversations import Search, _kind

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def exhaustive(kinds):
    """(cost, letters) of the best of all edits, with up to two inserts in each gap."""
    best = None
    gaps = [()] + [x for k in (1, 2) for x in product("ua", repeat=k)]
    for edits in product("DKua", repeat=len(kinds)):  # u and a: rerole to them
        if any(e != "D" and k[1] for e, k in zip(edits, kinds)):
            continue
        for inserts in product(gaps, repeat=len(kinds) + 1):
            roles, letters, cost = list(inserts[0]), "I" * len(inserts[0]), 5 * len(inserts[0])
            for e, k, more in zip(edits, kinds, inserts[1:]):
                cost += 5 * len(more) + (2 if e == "D" else (e != "K") + 5 * k[2])
                roles += ([] if e == "D" else [k[0] or "x"] if e == "K" else [e]) + list(more)
                letters += (e if e in "DK" else "R") + "I" * len(more)
            if LEGAL.match("".join(roles)) and (best is None or (cost, letters) < best):
                best = cost, letters
    return best


def plain(kinds):
    """The same with one whole string for each state: (cost, letters)."""
    def closed(have):
        for _ in range(3):
            for a, b in ((0, 2), (1, 2), (3, 2), (2, 3)):
                if a in have:
                    new = have[a][0] + 5, have[a][1] + "I"
                    if b not in have or new < have[b]:
                        have[b] = new
        return have

    have = closed({0: (0, "")})
    for letter, gone, truncated in kinds:
        after = {}

        def offer(state, cost, text):
            if state not in after or (cost, text) < after[state]:
                after[state] = cost, text

        for state, (cost, text) in have.items():
            offer(state, cost + 2, text + "D")
            if not gone:
                stay = cost + 5 * truncated
                if letter == "s" and state == 0:
                    offer(1, stay, text + "K")
                for to, froms in ((2, (0, 1, 3)), (3, (2,))):
                    if state in froms:
                        offer(to, stay + 1, text + "R")
                        if letter == " ua"[to - 1]:
                            offer(to, stay, text + "K")
        have = closed(after)
    return min(have[s] for s in (0, 3) if s in have)


def streamed(kinds):
    way, out = Search(), []
    out += way.resolved()
    widest = 0
    for k in kinds:
        way.add(k)
        out += way.resolved()
        widest = max(widest, len(way.back) - way.start)
    out += way.finish()
    return way.cost, "".join(out), widest


def random_kinds(rng, n, roles=("s", "u", "a", "")):
    return [_kind(rng.choice(roles), rng.random() < 0.2, rng.random() < 0.2) for _ in range(n)]


def test_plain_search_is_exhaustive():
    rng = random.Random(1)
    for _ in range(120):
        kinds = random_kinds(rng, rng.randrange(4))
        assert plain(kinds) == exhaustive(kinds), kinds


def test_stream_equals_plain_search():
    rng = random.Random(2)
    for n in list(range(9)) * 150 + [40] * 60:
        roles = rng.choice([("s", "u", "a", ""), ("u", "a"), ("",), ("s",), ("u",), ("a", ""), ("s", "")])
        kinds = random_kinds(rng, n, roles)
        assert streamed(kinds)[:2] == plain(kinds), kinds
    tied = [_kind("x", False, False)] * 301
    assert streamed(tied)[:2] == plain(tied)


def test_stream_is_bounded_where_survivors_meet():
    rng = random.Random(3)
    cost, letters, widest = streamed([_kind("ua"[k % 2], rng.random() < 0.05, False) for k in range(200_000)])
    assert len(letters) >= 200_000 and widest < 4 * 200


def test_tied_suffix_stays_until_the_end():
    """Rows of no legal role leave two ways open to the last row: 4 bytes a row are kept, no more."""
    n = 50_001
    cost, letters, widest = streamed([_kind("", False, False)] * n)
    assert (cost, letters[:2], len(letters)) == (n + 1, "DR", n) and widest <= 4 * (n + 1)


def crc(c, t):
    return zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20


def brute(rows):
    """The report by the rules, row after row."""
    ink = re.compile(r"[^\x20\x09-\x0D]")
    out = {r[0]: [] for r in rows}
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        f = crc(c, t)
        if f == 0:
            continue
        text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        out[c] += [(t, "user" if f == 4 else role, text)] * (2 if f == 3 else 1)
    report = []
    for c, found in out.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        kinds, counts, seen = [], defaultdict(int), set()
        for t, role, text in found:
            chars = ink.findall(text)
            fault = "blank" if not chars else "duplicate" if (role, text) in seen else \
                "truncated" if chars[-1] not in ".!?" else None
            seen.add((role, text))
            counts[fault] += 1
            kinds.append(_kind(role, fault in ("blank", "duplicate"), fault == "truncated"))
        cost, letters = plain(kinds)
        lines, state, rows_left = [], 0, iter(found)
        for e in letters:
            role, text = (None, "") if e == "I" else next(rows_left)[1:]
            if e == "D":
                continue
            if e == "K" and state == 0 and role[:1] == "s":
                state = 1
            else:
                state = 3 if state == 2 else 2
                role = role if e == "K" else "user" if state == 2 else "assistant"
            lines.append(f"{role}:{text}")
        turns = [r[0] for r in found if r[0] is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(found, found[1:])]
        report.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["blank"], counts["duplicate"],
                       counts["truncated"], sum(p not in ("su", "ua", "au") for p in pairs), cost, letters,
                       hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(report, key=repr)


@lru_cache
def awkward_rows():
    rng = random.Random(4)
    texts = ["Fine.", "Fine.", "no end", "", "  \t\n", None, "Odd?", "été!", "ends in space. \n", "a.b.", "word " * 20_000]
    roles = ["user", "assistant", "system", "tool", "", None, "unknown", "user", "assistant"]
    rows = [(c, rng.choice([t, t, t, t + 3, 1, None]), rng.choice(roles), rng.choice(texts))
            for c in range(60) for t in range(rng.randrange(1, 9))]
    rows += [(None, t, rng.choice(roles), rng.choice(texts)) for t in range(12)]
    rows += [(99, t, "user", "Same text again.") for t in range(400)]  # a third of all rows in one conversation
    rows += rows[:20]
    return rows


def got(df):
    return sorted((tuple(r) for r in conv.report(df).collect()), key=repr)


def test_awkward_rows(spark):
    df = spark.createDataFrame(awkward_rows(), SCHEMA).repartition(5)
    assert got(df) == brute(awkward_rows())


def test_clashing_columns(spark):
    df = spark.createDataFrame(awkward_rows()[:200], SCHEMA)
    more = df.selectExpr("*", *[f"'x' as {c}" for c in ("h", "copies", "first", "place", "blank", "cost", "id", "copy", "part")])
    assert got(more) == got(df) == brute(awkward_rows()[:200])


def test_empty_and_all_dropped(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    gone = next(t for t in range(1000) if crc(1, t) == 0)
    assert got(spark.createDataFrame([(1, gone, "user", "x.")], SCHEMA)) == [
        (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("partitions", [1, 6])
def test_whole_table(spark, partitions):
    rows = table(spark, "conversations").select("conv_id", "turn", "role", "text")
    assert got(rows.repartition(partitions)) == brute([tuple(r) for r in rows.collect()])


def test_repaired_rows_are_legal_and_complete(spark):
    df = spark.createDataFrame(awkward_rows(), SCHEMA)
    damaged = conv.damaged(df)
    by_conv = defaultdict(list)
    for r in conv.repaired(damaged).orderBy("conv_id", "place", "part").collect():
        by_conv[r["conv_id"]].append((r["role"], r["text"]))
    digests = {r[0]: r[-1] for r in brute(awkward_rows())}
    for c, turns in by_conv.items():
        assert LEGAL.match("".join(r[:1] for r, _ in turns))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest() == digests[c]
