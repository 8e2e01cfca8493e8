"""Operator 11: repair of conversation structure by a Viterbi search with survivor coalescence.

A conversation's rows are put in order, and the cheapest edits are found that leave the roles
``(s?(ua)+)?`` (by their first letters): Keep (0), Rerole to user or assistant (1), Delete (2), Insert an
empty user or assistant turn (5); blank and duplicate rows must go, a truncated row that stays costs 5
more. Of equally cheap ways the one whose letters are ASCII-least is taken.

The search is a stream over the ordered rows. Four states (nothing yet, after the system turn, after a user,
after an assistant) have one survivor each: a leaf of a tree of backpointers, a byte for each row and state.
The tree's nodes count their children; what no survivor descends from goes at once, and as soon as all
survivors share an ancestor, the edits up to it are final and are given out. A state that
another strictly beats whatever follows is dropped, so that a conversation's beginning does not
stay open. Equally cheap ways into a state are compared over all their unresolved letters: the survivors'
letters up to their last row are ranked, and the ranks are carried along row by row, which compares the
whole suffixes without reading them again. (Two survivors' letters up to a row's own
letter are equal or differ somewhere; only inserts after it can make one the beginning of another.)
The step from one set of survivors to the next depends on little (cost differences, ranks, the row's kind),
so each worker keeps the steps that it has met.

Only small rows take part: Spark finds first copies by (conversation, role, hash of the text), with sums
before the shuffle, and equal rows travel as one with a count. A conversation's rows pass
one task in order, as a stream that holds the unresolved rows alone (some 100 bytes each); texts are joined to the edits
afterwards by key. The digest of a repaired conversation is one SHA-256 and so a stream as well.

Defined cases: null roles and texts are one space; null turns come first; rows of one turn are ordered by
role and the text's hash; equal rows are copies, the first one counts; a null conversation id is an id of its
own; a role without a letter fits nowhere; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import tidy, written

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: White space of the rules.
_INK = r"[^\x20\x09-\x0D]"
START, SYSTEM, USER, ASSISTANT = range(4)
#: States from which a user (an assistant) turn may come, and the roles by the state they lead to.
_BEFORE = {USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
ROLES = {USER: "user", ASSISTANT: "assistant"}
_STEPS_KEPT = 100_000


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with the stated faults, by crc32 of ``conv_id:turn``; nulls are one space."""
    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(plain("text"), "[.!?]", "")).otherwise(plain("text"))
    return rows.where(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(plain("role")).alias("role"), text.alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
                       F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text")
                       ).withColumn("h", F.unhex(F.sha2("text", 256)))


def faults(rows: DataFrame) -> DataFrame:
    """The distinct rows (conv_id, turn, role, h: the text's SHA-256) with their number of ``copies``, whether they are
    blank, truncated, and whether the conversation has no such role and text ``first`` elsewhere before."""
    ink = F.col("text").rlike(_INK)
    ends = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    runs = _keyed(rows).select("conv_id", "turn", "role", "h", (~ink).alias("blank"), (ink & ~ends).alias("truncated")).groupBy(
        "conv_id", "turn", "role", "h", "blank", "truncated").agg(F.count("*").alias("copies"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    seen = runs.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("h").alias("t")).agg(
        F.min(place).alias("low"))
    return runs.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h") == F.col("t"))
                     ).withColumn("first", place == F.col("low")).drop("c", "r", "t", "low")


# ------------------------------------------------------------------ the search

#: A survivor: (state, cost above the least, rank of its letters up to the last row, inserts after it).
Survivors = tuple[tuple[int, int, int, int], ...]


def _closed(best: dict[int, tuple]) -> dict[int, tuple]:
    """The candidates (cost, rank, letters, inserts, from) by state, with inserts after them where those are better."""
    def insert(c):
        return (c[0] + INSERT, c[1], c[2], c[3] + 1, c[4])

    def better(state, froms, have):
        return min([*([have[state]] if state in have else []), *(insert(have[f]) for f in froms if f in have)], default=None)

    user = better(USER, (START, SYSTEM), best)
    out = dict(best)
    if user:
        out[USER] = user
    assistant = better(ASSISTANT, (USER,), out)
    user = better(USER, _BEFORE[USER], best)
    if assistant:
        out[ASSISTANT] = assistant
    if user:
        out[USER] = user
    return out


def _kept(best: dict[int, tuple]) -> dict[int, tuple]:
    """Without the states that another beats strictly, whatever follows. What may follow a system turn may follow an
    assistant too, and after a user with one insert; what may follow nothing may as well, if a system turn is deleted."""
    def beaten(state, extra):
        cost = best[state][0]
        return (ASSISTANT in best and best[ASSISTANT][0] + extra < cost) or \
            (USER in best and best[USER][0] + INSERT + extra < cost)

    return {s: c for s, c in best.items() if not (s == START and beaten(s, DELETE)) and not (s == SYSTEM and beaten(s, 0))}


def _survivors(best: dict[int, tuple]) -> tuple[int, Survivors, tuple[tuple[int, int, str], ...]]:
    least = min(c[0] for c in best.values())
    ranks = {k: r for r, k in enumerate(sorted({c[1:3] for c in best.values()}))}
    order = sorted(best)
    return (least, tuple((s, best[s][0] - least, ranks[best[s][1:3]], best[s][3]) for s in order),
            tuple((s, best[s][4], best[s][2].lstrip("I") + "I" * best[s][3]) for s in order))


#: Before the first row: nothing, or one or two inserts.
_FIRST = _survivors(_closed({START: (0, 0, "", 0, START)}))


def step(survivors: Survivors, kind: tuple[str, bool, bool]):
    """(cost added to all, the next survivors, their (state, state before, letters)) after a row of the given role
    letter, to be deleted or not, truncated or not."""
    letter, gone, truncated = kind
    best: dict[int, tuple] = {}

    def offer(state, cost, rank, letters, source):
        new = (cost, rank, letters, 0, source)
        if state not in best or new < best[state]:
            best[state] = new

    for state, cost, rank, inserts in survivors:
        before = "I" * inserts
        offer(state, cost + DELETE, rank, before + "D", state)
        if gone:
            continue
        stay = cost + (TRUNCATED if truncated else 0)
        if letter == "s" and state == START:
            offer(SYSTEM, stay, rank, before + "K", state)
        for to in (USER, ASSISTANT):
            if state in _BEFORE[to]:
                if letter == ROLES[to][0]:
                    offer(to, stay, rank, before + "K", state)
                offer(to, stay + REROLE, rank, before + "R", state)
    return _survivors(_kept(_closed(best)))


_STEPS: dict = {}


def _step(survivors: Survivors, kind):
    key = (survivors, kind)
    found = _STEPS.get(key)
    if found is None:
        if len(_STEPS) > _STEPS_KEPT:
            _STEPS.clear()
        found = _STEPS[key] = step(survivors, kind)
    return found


#: Letters that one row can have: its own edit and the inserts after it; before the first row, inserts only.
_LETTERS = ["", "I", "II", *(e + "I" * k for e in "DKR" for k in range(3))]
_NUMBER = {x: k for k, x in enumerate(_LETTERS)}


class Search:
    """The stream of one conversation: ``add`` a row's kind, then take the final edits with ``resolved``."""

    def __init__(self):
        self.cost, self.survivors, made = _FIRST
        #: Nodes of the unresolved layers, four bytes a layer: (state before, letters) and the number of children.
        self.back, self.children = bytearray(), bytearray()
        self.start = 0  # place of the first unresolved layer in the two arrays
        self._append(made)

    def _append(self, made) -> None:
        layer = [0xFF] * 4
        for state, source, letters in made:
            layer[state] = source << 4 | _NUMBER[letters]
        top = len(self.back) - 4
        self.back += bytes(layer)
        self.children += bytes(4)
        if top < self.start:
            return
        for _, source, _ in made:
            self.children[top + source] += 1
        # nodes of the layer before without a child go, and with them what only led to them
        for state in range(4):
            self._drop(top, state)

    def _drop(self, at: int, state: int) -> None:
        while at >= self.start and self.back[at + state] != 0xFF and not self.children[at + state]:
            source = self.back[at + state] >> 4
            self.back[at + state] = 0xFF
            at -= 4
            if at < self.start:
                return
            self.children[at + source] -= 1
            state = source

    def add(self, kind: tuple[str, bool, bool]) -> None:
        cost, self.survivors, made = _step(self.survivors, kind)
        self.cost += cost
        self._append(made)

    def resolved(self) -> Iterator[str]:
        """Letters of the layers that all survivors share, the first one those before the first row."""
        back = self.back
        while self.start < len(back):
            alive = [b for b in back[self.start:self.start + 4] if b != 0xFF]
            if len(alive) != 1:
                break
            yield _LETTERS[alive[0] & 0xF]
            self.start += 4
        if self.start > 1 << 16 and 2 * self.start > len(back):
            del self.back[:self.start], self.children[:self.start]
            self.start = 0

    def finish(self) -> Iterator[str]:
        """The remaining layers' letters, by the best survivor that may end a conversation."""
        cost, rank, inserts, state = min((c, r, k, s) for s, c, r, k in self.survivors if s in (START, ASSISTANT))
        self.cost += cost
        path = []
        for at in range(len(self.back) - 4, self.start - 4, -4):
            node = self.back[at + state]
            path.append(_LETTERS[node & 0xF])
            state = node >> 4
        yield from reversed(path)


def _kind(role: str, gone: bool, truncated: bool) -> tuple[str, bool, bool]:
    letter = role[:1]
    return (letter if letter in "sua" else "", gone, truncated and not gone)


class _Writer:
    """Edits of one conversation's runs, in order: puts each run's layers together and follows the roles."""

    def __init__(self):
        self.waiting: deque = deque()  # (run, layers still to come)
        self.lead, self.state, self.place = None, START, 0
        self.letters: list[str] = []

    def expect(self, run: tuple, layers: int) -> None:
        self.waiting.append((run, layers))

    def take(self, layers: Iterator[str]) -> Iterator[tuple]:
        for letters in layers:
            if self.lead is None:  # inserts before the first row go with it
                self.lead = letters
                continue
            self.letters.append(letters)
            run, count = self.waiting[0]
            if len(self.letters) == count:
                self.waiting.popleft()
                yield self._row(run, self.lead + "".join(self.letters))
                self.lead, self.letters = "", []

    def _row(self, run: tuple, edit: str) -> tuple:
        conv, turn, role, h, _, _, truncated, _ = run
        before, after, kept, cost = [], [], None, 0
        for e in edit:
            if e == "D":
                cost += DELETE
                continue
            cost += {"I": INSERT, "R": REROLE, "K": 0}[e] + (TRUNCATED if truncated and e in "KR" else 0)
            if e == "K" and self.state == START and role[:1] == "s":
                self.state, new = SYSTEM, role
            else:
                self.state = ASSISTANT if self.state == USER else USER
                new = role if e == "K" else ROLES[self.state]
            if e == "I":
                (before if kept is None else after).append(new)
            else:
                kept = new
        self.place += 1
        return conv, self.place, turn, role, h, edit, cost, before, kept, after


_EDITS = ("conv_id bigint, place bigint, turn bigint, role string, h binary, edit string, cost bigint, before array<string>, "
          "new_role string, after array<string>")


def _rows(batches, names) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(n).to_pylist() for n in names))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 5000) -> Iterator[pa.RecordBatch]:
    some = []
    for r in rows:
        some.append(r)
        if len(some) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)
            some = []
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def edits(found: DataFrame) -> DataFrame:
    """The cheapest edits of the rows of ``faults``: one row for each distinct row, in order by ``place``, with the letters
    of its ``copies`` and of the inserts beside them, their cost, the roles inserted before and after, and the new
    role of the copy that stays (null: none)."""
    names = ("conv_id", "turn", "role", "h", "blank", "first", "truncated", "copies")
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
                        ("h", pa.binary()), ("edit", pa.string()), ("cost", pa.int64()), ("before", pa.list_(pa.string())),
                        ("new_role", pa.string()), ("after", pa.list_(pa.string()))])

    def search(batches):
        for _, rows in groupby(_rows(batches, names), key=lambda r: r[0]):
            way, out = Search(), _Writer()
            yield from out.take(way.resolved())
            for run in rows:
                _, _, role, _, blank, first, truncated, copies = run
                out.expect(run, copies)
                way.add(_kind(role, blank or not first, truncated))
                yield from out.take(way.resolved())
                for _ in range(copies - 1):
                    way.add(_kind(role, True, truncated))
                    yield from out.take(way.resolved())
            yield from out.take(way.finish())

    ordered = found.select(*names).repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "h")
    return ordered.mapInArrow(tidy(lambda batches: _batches(search(batches), schema)), _EDITS)


def _with_texts(rows: DataFrame, done: DataFrame) -> DataFrame:
    """``done`` with the texts of the rows that stay. Those are the first of their role and text, so equal texts of
    a conversation are joined once."""
    texts = _keyed(rows).groupBy(F.col("conv_id").alias("c"), F.col("h").alias("t")).agg(F.first("text").alias("text"))
    stay = done.where("new_role IS NOT NULL").join(
        texts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("h") == F.col("t"))).drop("c", "t")
    return stay.unionByName(done.where("new_role IS NULL").withColumn("text", F.lit(None).cast("string")))


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place, part, role, text), in order by (place, part)."""
    full = _with_texts(rows, edits(faults(rows)))
    blank = F.lit("")
    turns = F.concat(F.transform("before", lambda r: F.struct(r.alias("role"), blank.alias("text"))),
                     F.when(F.col("new_role").isNull(), F.array().cast("array<struct<role:string,text:string>>"))
                     .otherwise(F.array(F.struct(F.col("new_role").alias("role"), F.col("text").alias("text")))),
                     F.transform("after", lambda r: F.struct(r.alias("role"), blank.alias("text"))))
    return full.select("conv_id", "place", F.posexplode(turns).alias("part", "turn")).select(
        "conv_id", "place", "part", "turn.role", "turn.text")


def _digests(full: DataFrame) -> DataFrame:
    """(conv_id, cost, audit, repaired_sha256) of each conversation's edits with texts, read in order."""
    names = ("conv_id", "edit", "cost", "before", "new_role", "after", "text")
    schema = pa.schema([("conv_id", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def digest(batches):
        for conv, rows in groupby(_rows(batches, names), key=lambda r: r[0]):
            sha, glue, audit, cost = hashlib.sha256(), "", [], 0
            for _, edit, paid, before, role, after, text in rows:
                audit.append(edit)
                cost += paid
                for line in (*(f"{r}:" for r in before), *([f"{role}:{text}"] if role is not None else []),
                             *(f"{r}:" for r in after)):
                    sha.update(f"{glue}{line}".encode())
                    glue = "\n"
            yield conv, cost, "".join(audit), sha.hexdigest()

    ordered = full.select("place", *names).repartition("conv_id").sortWithinPartitions("conv_id", "place").select(*names)
    return ordered.mapInArrow(tidy(lambda batches: _batches(digest(batches), schema)),
                              "conv_id bigint, cost bigint, audit string, repaired_sha256 string")


def illegal_pairs(found: DataFrame) -> DataFrame:
    """(conv_id, illegal): neighbours in order whose role letters are not su, ua or au."""
    letter = F.substring("role", 1, 1)
    pair = F.concat(F.lag(letter).over(Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), "role", "h")), letter)
    own = found.select("conv_id", (F.col("copies") - 1 + F.coalesce((~pair.isin("su", "ua", "au")).cast("bigint"), F.lit(0)))
                       .alias("x"))
    return own.groupBy("conv_id").agg(F.sum("x").alias("illegal"))


def report(conversations: DataFrame) -> DataFrame:
    """The digest of the repair of the damaged conversations, one row for every id of ``conversations``."""
    source = conversations.select("conv_id", "turn", "role", "text")
    rows = damaged(source)
    found = written(faults(rows), "faults")
    done = written(edits(found), "edits")
    copies = F.col("copies")
    gone = F.when(F.col("first"), copies - 1).otherwise(copies)
    count = F.countDistinct("turn")
    sums = found.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - count, F.lit(0)).alias("gaps"),
        F.sum(F.when(F.col("blank"), copies).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(gone)).alias("duplicate"),
        F.sum(F.when(F.col("truncated") & F.col("first"), 1).otherwise(0)).alias("truncated"))
    out = source.select(F.col("conv_id").cast("bigint").alias("id")).distinct()
    for part in (sums, illegal_pairs(found), _digests(_with_texts(rows, done))):
        out = out.join(part, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(F.col("id").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in longs],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
