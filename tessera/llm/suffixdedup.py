"""Operator 5: exact removal of repeated 50-byte strings by a distributed merge
sort of suffixes.

Which suffixes. Every 50-byte window is represented by one suffix: the one that
starts at the window's smallest 24-byte string (by hash, leftmost on ties).
Equal windows choose the same place, so they meet when the chosen suffixes are
sorted, and about one byte in 14 starts a suffix. A suffix carries its first 50
bytes, the 26 bytes before it and the range of windows it stands for.

Steps, all on Spark partitions:

1. Keys. Each task hashes the first 24 bytes of its suffixes. Keys that occur
   in two documents anywhere survive; all other suffixes cannot match. A key
   that a task has seen in two documents is sent once, however often it occurs.
2. Runs. Surviving suffixes are sorted in each task, equal ones (suffix, text
   before and range) are reduced to the smallest document, and the sorted runs are
   front-coded and exchanged, dealt out by a hash of the first 24 bytes.
3. Merge. A loser tree merges the runs of a partition. Each contender knows the
   length it has in common with the last winner; only on a tie are bytes compared,
   from there on, so no known prefix is looked at again. The merge yields
   the order and all common-prefix lengths.
4. Windows. Cutting the order where the common prefix is shorter than 50-o, and
   the order of the preceding bytes where theirs is shorter than o, gives the classes
   of equal windows at offset o; windows whose class has a smaller document go.
5. The removed ranges are joined back to the texts.

Defined cases: a null text counts as empty; texts under 50 bytes, and rows with a
null id (they compare with nothing), stay whole; rows with the same id never
remove from each other; repeated rows get equal results. Columns other than id
and text are ignored by :func:`repeated_spans` and kept by :func:`remove_repeats`.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import M61, mix, pack, partitions, spans, text_bytes, tidy, unpack, unzipped, zipped

LENGTH = 50
KMER = 24
LEFT = LENGTH - KMER
CHUNK = 1 << 20
#: Suffixes a task gathers before it sorts and sends a run.
RUN_KEYS, RUN_SUFFIXES = 1 << 20, 150_000
#: Bytes of a key that are sent, beside its bucket; a chance match only sends a suffix on in vain.
KEY_BYTES = 5
KEY_MASK = np.uint64((1 << 8 * KEY_BYTES) - 1)

_BYTE = np.random.RandomState(77).randint(1, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_B = [np.uint64(pow(0xD1342543DE82EF95, k, 1 << 64)) for k in (1, 2, 4, 8)]


def chosen_suffixes(data: np.ndarray, off: np.ndarray):
    """(start, first window, last window, key, row) of the chosen suffixes, by position."""
    n = len(data)
    if n < LENGTH:
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, np.uint64, np.int64))
    with np.errstate(over="ignore"):
        h = _BYTE[data]
        h = h[:-1] * _B[0] + h[1:]
        h = h[:-2] * _B[1] + h[2:]
        h8 = h[:-4] * _B[2] + h[4:]
        h = h8[:-8] * _B[3] + h8[8:]
        key = mix(h[:n - KMER + 1] * _B[3] + h8[16:16 + n - KMER + 1])
    low = np.uint64(0xFFFFFFFF)
    m = (key & ~low) | np.arange(len(key), dtype=np.uint64)
    for step in (1, 2, 4, 8):
        m = np.minimum(m[:-step], m[step:])
    windows = n - LENGTH + 1
    at = (np.minimum(m[:windows], m[LEFT + 1 - 16:LEFT + 1 - 16 + windows]) & low).astype(np.int64)
    row = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(off))
    valid = row[:windows] == row[LENGTH - 1:]
    new = np.empty(windows, bool)
    new[0] = True
    new[1:] = (at[1:] != at[:-1]) | ~valid[:-1]
    new &= valid
    end = np.empty(windows, bool)
    end[-1] = True
    end[:-1] = (at[1:] != at[:-1]) | ~valid[1:]
    end &= valid
    first, last = np.flatnonzero(new), np.flatnonzero(end)
    return at[first], first, last, key[at[first]], row[first].astype(np.int64)


#: Stands for a null id, which compares with nothing.
NO_ID = -(1 << 63)


def _grouped(doc: np.ndarray, rid: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
    """Rows (doc_id, rid, numbers) of packed numbers for each run of equal (doc, rid)."""
    start = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (rid[1:] != rid[:-1])])) \
        if len(doc) else np.zeros(0, np.int64)
    raw, width = np.ascontiguousarray(numbers).tobytes(), numbers.itemsize * (numbers.size // max(len(doc), 1))
    cut = (np.append(start, len(doc)) * width).astype(np.int32)
    packed = pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(cut), pa.py_buffer(raw)])
    return pa.RecordBatch.from_arrays([pa.array(doc[start]), pa.array(rid[start]), packed],
                                      ["doc_id", "rid", "numbers"])


def _homeward(n: int, doc, rid, *numbers) -> pa.RecordBatch:
    """Rows (home, blob) of results on their way back to their documents: one row for
    each partition of documents, not one for each document."""
    home = (doc.view(np.uint64) * M61 >> np.uint64(33)).astype(np.int64) % n
    order = np.lexsort((*[x for x in numbers[::-1]], rid, doc, home))
    homes, blobs = [], []
    for h, i, j in _runs(home[order]):
        p = order[i:j]
        homes.append(h)
        blobs.append(pack(np.diff(doc[p], prepend=0), rid[p], *[x[p].astype(np.int32) for x in numbers]))
    return pa.RecordBatch.from_arrays([pa.array(homes, pa.int32()), pa.array(blobs, pa.binary())], ["home", "blob"])


def _gather(columns: int):
    """One row (doc_id, rid, numbers) for each document; two columns are ranges and are merged."""
    def run(batches):
        parts = []
        for b in batches:
            for blob in b.column(1):
                doc, *rest = unpack(blob.as_py(), "<i8", *["<i4"] * (1 + columns))
                parts.append([np.cumsum(doc), *rest])
        if not parts:
            return
        doc, rid, *numbers = map(np.concatenate, zip(*parts))
        order = np.lexsort((numbers[0], rid, doc))
        doc, rid, *numbers = (x[order] for x in (doc, rid, *numbers))
        if columns == 2:
            doc, rid, *numbers = _merged(doc, rid, *[x.astype(np.int64) for x in numbers])
        yield _grouped(doc, rid, np.stack(numbers, axis=1).astype(np.int32))

    return run


# ---------------------------------------------------------------- 1. keys

def _send_keys(n: int):
    """Task side: rows (bucket, blob) of keys, and rows (-1 - bucket) of suffixes
    already known to survive."""
    def flush(key, doc, rid, num):
        order = np.argsort(key, kind="stable")
        key, doc, rid, num = key[order], doc[order], rid[order], num[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        many = (np.minimum.reduceat(doc, start) != np.maximum.reduceat(doc, start))
        each = np.repeat(many, size)
        # keys seen in one document: all their places; in several: one row of the key alone
        pick = np.concatenate([np.flatnonzero(~each), start[many]])
        flag = np.concatenate([np.zeros((~each).sum(), np.uint8), np.ones(many.sum(), np.uint8)])
        bucket = (key[pick] >> np.uint64(48)).astype(np.int64) % n
        order = np.lexsort((num[pick], rid[pick], doc[pick], bucket))
        pick, flag, bucket = pick[order], flag[order], bucket[order]
        ids, known, blobs = [], [], []
        for b, i, j in _runs(bucket):
            p = pick[i:j]
            low = (key[p] & KEY_MASK).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
            ids.append(b)
            known.append(False)
            blobs.append(pack(low, np.diff(doc[p], prepend=0), rid[p], num[p].astype(np.int32), flag[i:j]))
        keep = np.flatnonzero(each)
        keep = keep[np.lexsort((num[keep], rid[keep], doc[keep]))]
        home = doc[keep] % n
        order = np.argsort(home, kind="stable")
        for b, i, j in _runs(home[order]):
            p = keep[order[i:j]]
            ids.append(b)
            known.append(True)
            blobs.append(pack(np.diff(doc[p], prepend=0), rid[p], num[p].astype(np.int32)))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(known),
                                           pa.array(blobs, pa.binary())], ["bucket", "known", "blob"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            doc, rid = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            data, off = unzipped(b.column(2))
            for i, j in spans(off, CHUNK):
                at, _, _, key, row = chosen_suffixes(data[off[i]:off[j]], off[i:j + 1] - off[i])
                if (doc[i:j] == NO_ID).any():
                    named = doc[i:j][row] != NO_ID
                    at, key, row = at[named], key[named], row[named]
                if len(at):
                    num = np.arange(len(at)) - np.searchsorted(row, row)
                    held.append((key, doc[i:j][row], rid[i:j][row], num))
                    size += len(at)
                if size >= RUN_KEYS:
                    yield flush(*map(np.concatenate, zip(*held)))
                    held, size = [], 0
        if held:
            yield flush(*map(np.concatenate, zip(*held)))

    return run


def _runs(sorted_values: np.ndarray):
    if len(sorted_values):
        start = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
        for i, j in zip(start.tolist(), np.append(start[1:], len(sorted_values)).tolist()):
            yield int(sorted_values[i]), i, j


def _meet_keys(n: int):
    """Rows (home, blob): places of the suffixes whose key two documents have."""
    def run(batches):
        parts, settled = [], []
        for b in batches:
            for known, blob in zip(b.column(1).to_pylist(), b.column(2)):
                if known:
                    doc, *rest = unpack(blob.as_py(), "<i8", "<i4", "<i4")
                    settled.append([np.cumsum(doc), *rest])
                else:
                    low, doc, *rest = unpack(blob.as_py(), "u1", "<i8", "<i4", "<i4", "u1")
                    key = np.zeros((len(doc), 8), np.uint8)
                    key[:, :KEY_BYTES] = low.reshape(-1, KEY_BYTES)
                    parts.append([key.view("<u8").ravel(), np.cumsum(doc), *rest])
        if parts:
            key, doc, rid, num, many = map(np.concatenate, zip(*parts))
            del parts
            order = np.argsort(key, kind="stable")
            key, doc, many = key[order], doc[order], many[order]
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            hit = (np.minimum.reduceat(doc, start) != np.maximum.reduceat(doc, start))
            hit |= np.add.reduceat(many, start, dtype=np.int64) > 0
            keep = np.repeat(hit, np.diff(np.append(start, len(key)))) & (many == 0)
            settled.append([doc[keep], rid[order][keep], num[order][keep]])
        if settled:
            yield _homeward(n, *map(np.concatenate, zip(*settled)))

    return run


# ---------------------------------------------------------------- 2. runs

def _send_runs(n: int):
    def flush(held):
        key, ctx, low, high, doc, rid, pos = map(np.concatenate, zip(*held))
        order = np.lexsort((pos, rid, doc))
        order = order[np.argsort(ctx[order].view(f"S{ctx.shape[1]}").ravel(), kind="stable")]
        key, ctx, low, high, doc, rid, pos = (x[order] for x in (key, ctx, low, high, doc, rid, pos))
        same = (ctx[1:] == ctx[:-1]).all(axis=1)
        start = np.flatnonzero(np.concatenate([[True], ~same]))
        size = np.diff(np.append(start, len(key)))
        least = np.repeat(doc[start], size)
        done = doc != least
        # equal suffixes of larger documents are settled here: a smaller one has all their windows
        ids, known, blobs = [], [], []
        d = np.flatnonzero(done)
        if len(d):
            order = d[np.lexsort((pos[d], rid[d], doc[d]))]
            ids.append(int(doc[order[0]] % n))
            known.append(True)
            blobs.append(pack(*_merged(doc[order], rid[order], pos[order] - low[order],
                                       pos[order] + high[order])))
        left = ~done
        count = np.add.reduceat(left, start, dtype=np.int32)
        where = np.cumsum(count) - count
        pos, rid = pos[left], rid[left]
        key, ctx, low, high, doc = (x[start] for x in (key, ctx, low, high, doc))
        bucket = (key >> np.uint64(40)).astype(np.int64) % n
        order = np.argsort(bucket, kind="stable")
        for b, i, j in _runs(bucket[order]):
            p = order[i:j]
            right = ctx[p, :LENGTH]
            common = np.zeros(len(p), np.uint8)
            equal = right[1:] == right[:-1]
            common[1:] = np.where(equal.all(axis=1), LENGTH, equal.argmin(axis=1))
            tails = right[np.arange(LENGTH)[None, :] >= common[:, None]]
            c = count[p]
            places = np.repeat(where[p] - (np.cumsum(c) - c), c) + np.arange(c.sum())
            ids.append(b)
            known.append(False)
            blobs.append(pack(common, tails, ctx[p, LENGTH:LENGTH + LEFT], low[p], high[p], doc[p],
                              c, rid[places], pos[places].astype(np.int32)))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(known),
                                           pa.array(blobs, pa.binary())], ["bucket", "known", "blob"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            doc, rid = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            data, off = unzipped(b.column(2))
            places, cut = text_bytes(b.column(3))
            nums, cut = np.frombuffer(places.tobytes(), "<i4"), cut // 4
            for i, j in spans(off, CHUNK):
                part = data[off[i]:off[j]]
                at, first, last, key, row = chosen_suffixes(part, off[i:j + 1] - off[i])
                begin = np.searchsorted(row, np.arange(j - i))
                owner = np.repeat(np.arange(j - i), np.diff(cut[i:j + 1]))
                take = np.unique(begin[owner] + nums[cut[i]:cut[j]])
                if not len(take):
                    continue
                at, first, last, key, row = (x[take] for x in (at, first, last, key, row))
                place = at[:, None] + np.concatenate([np.arange(LENGTH), -1 - np.arange(LEFT)])[None, :]
                ctx = np.zeros((len(at), LENGTH + LEFT + 2), np.uint8)
                inside = (place >= first[:, None]) & (place < last[:, None] + LENGTH)
                ctx[:, :-2] = np.where(inside, part[np.clip(place, 0, len(part) - 1)], 0)
                ctx[:, -2] = 1 + at - first
                ctx[:, -1] = 1 + last + LENGTH - at
                held.append((key, ctx, (at - first).astype(np.uint8), (last + LENGTH - at).astype(np.uint8),
                             doc[i:j][row], rid[i:j][row], at - (off[i:j] - off[i])[row]))
                size += len(at)
                if size >= RUN_SUFFIXES:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return run


def _merged(doc, rid, start, end):
    """Union of byte ranges; sorted by (doc, rid, start)."""
    if not len(doc):
        return doc, rid, start.astype(np.int32), end.astype(np.int32)
    fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (rid[1:] != rid[:-1])])
    group = np.cumsum(fresh) - 1
    room = int(end.max()) + 2
    reach = np.maximum.accumulate(end + group * room) - group * room
    cut = fresh.copy()
    cut[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(cut)
    return (doc[first], rid[first], start[first].astype(np.int32),
            reach[np.append(first[1:], len(doc)) - 1].astype(np.int32))


# ---------------------------------------------------------------- 3. merge

def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """Loser tree over sorted runs (suffixes, common length with the one before in
    the run): run and place of each suffix in order, and its common length
    with the one before it in the merged order.

    A node keeps the loser of its match with the length it shares with that match's
    winner. All contenders of a replay share known lengths with the last winner:
    the longer one wins unseen, and only equal ones are compared, from there on."""
    k = 1
    while k < len(runs):
        k *= 2
    at = [0] * k
    keys = [r[0] for r in runs] + [[]] * (k - len(runs))
    commons = [r[1] for r in runs] + [[]] * (k - len(runs))
    sizes = [len(x) for x in keys]
    lost, known = [0] * k, [0] * k

    def play(a, ha, b, hb):
        """(winner, its length, loser, its length); a length of -1 is an ended run."""
        if ha != hb:
            return (a, ha, b, hb) if ha > hb else (b, hb, a, ha)
        if ha < 0:
            return a, ha, b, hb
        x, y, h = keys[a][at[a]], keys[b][at[b]], ha
        while x[h:h + 8] == y[h:h + 8]:
            h += 8
            if h >= LENGTH:
                return a, ha, b, LENGTH
        while x[h] == y[h]:
            h += 1
        return (a, ha, b, h) if x[h] < y[h] else (b, hb, a, h)

    def build(node):
        if node >= k:
            return node - k, 0 if sizes[node - k] else -1
        a, ha = build(2 * node)
        b, hb = build(2 * node + 1)
        w, hw, lost[node], known[node] = play(a, ha, b, hb)
        return w, hw

    out_run, out_at, out_common = [], [], []
    w, h = build(1) if k > 1 else (0, 0 if sizes[0] else -1)
    while h >= 0:
        out_run.append(w)
        place = at[w]
        out_at.append(place)
        out_common.append(h)
        place += 1
        at[w] = place
        h = commons[w][place] if place < sizes[w] else -1
        node = (w + k) >> 1
        while node:
            other = known[node]
            if other > h:
                lost[node], w = w, lost[node]
                known[node], h = h, other
            elif other == h and h >= 0:
                w, h, lost[node], known[node] = play(w, h, lost[node], other)
            node >>= 1
    return out_run, out_at, out_common


def _decode(blob: bytes):
    common, tails, left, low, high, doc, count, rid, pos = unpack(
        blob, "u1", "u1", "u1", "u1", "u1", "<i8", "<i4", "<i4", "<i4")
    raw, keys, prev, at = tails.tobytes(), [], b"", 0
    for c in common.tolist():
        prev = prev[:c] + raw[at:at + LENGTH - c]
        at += LENGTH - c
        keys.append(prev)
    return (keys, common.tolist()), left.reshape(-1, LEFT), low, high, doc, count, rid, pos


def _classes(common, left, low, high, doc):
    """Least and largest offset of the windows of each suffix (in order) that a
    smaller document has too; 99 and -1 for none."""
    m = len(doc)
    by_left = np.argsort(np.ascontiguousarray(left).view(f"S{LEFT}").ravel(), kind="stable")
    ordered = left[by_left]
    equal = ordered[1:] == ordered[:-1]
    left_common = np.zeros(m, np.int64)
    left_common[1:] = np.where(equal.all(axis=1), LEFT, equal.argmin(axis=1))
    by_doc = np.argsort(doc, kind="stable")
    low, high, common = low.astype(np.int64), high.astype(np.int64), common.astype(np.int64)
    least, most = np.full(m, 99, np.int64), np.full(m, -1, np.int64)
    left_rank = np.empty(m, np.int64)
    for o in range(LEFT + 1):
        own = by_doc[(low[by_doc] >= o) & (high[by_doc] >= LENGTH - o)]
        if len(own) < 2:
            continue
        left_rank[by_left] = np.cumsum(left_common < o)
        key = np.cumsum(common < LENGTH - o)[own] * (m + 1) + left_rank[own]
        order = np.argsort(key, kind="stable")
        key, ids = key[order], own[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        smallest = np.repeat(doc[ids[start]], np.diff(np.append(start, len(ids))))
        gone = ids[doc[ids] != smallest]
        least[gone] = np.minimum(least[gone], o)
        most[gone] = o
    return least, most


def _meet_runs(n: int):
    """Rows (home, blob): starts and ends of byte ranges to remove."""
    def run(batches):
        runs, settled = [], []
        for b in batches:
            for known, blob in zip(b.column(1).to_pylist(), b.column(2)):
                if known:
                    settled.append(unpack(blob.as_py(), "<i8", "<i4", "<i4", "<i4"))
                else:
                    runs.append(_decode(blob.as_py()))
        if runs:
            which, place, common = map(np.array, merge_runs([r[0] for r in runs]))
            sizes = np.array([len(r[4]) for r in runs])
            at = (np.cumsum(sizes) - sizes)[which] + place
            left, low, high, doc, count, rid, pos = (np.concatenate([r[c] for r in runs]) for c in range(1, 8))
            del runs
            least, most = _classes(common, left[at], low[at], high[at], doc[at])
            first = np.cumsum(count) - count
            hit = most >= 0
            at, least, most = at[hit], least[hit], most[hit]
            c = count[at]
            places = np.repeat(first[at] - (np.cumsum(c) - c), c) + np.arange(c.sum())
            doc, rid, pos = np.repeat(doc[at], c), rid[places], pos[places].astype(np.int64)
            start, end = pos - np.repeat(most, c), pos - np.repeat(least, c) + LENGTH
            order = np.lexsort((start, rid, doc))
            settled.append(_merged(doc[order], rid[order], start[order], end[order]))
        if settled:
            yield _homeward(n, *map(np.concatenate, zip(*settled)))

    return run


# ---------------------------------------------------------------- 4. whole job

def _fields(docs: DataFrame, keep: tuple[str, ...]) -> str:
    return "".join(f", _k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))


def _texts(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, rid, text, kept columns) with zipped texts, dealt out by row. ``rid``, a hash of
    the text, tells rows with the same id apart. All steps read this one exchange."""
    names = [f"_k{i}" for i in range(len(keep))]

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([zipped(x) for x in b.column(2).to_pylist()], pa.binary()),
                 *b.columns[3:]], ["doc_id", "rid", "text", *names])

    n = partitions(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.hash(text).alias("rid"),
                       text.cast("binary").alias("text"), *[F.col(c).alias(k) for c, k in zip(keep, names)]).mapInArrow(
        tidy(run), "doc_id bigint, rid int, text binary" + _fields(docs, keep))
    return rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"),
                       F.coalesce("rid", F.lit(0)).alias("rid"), "text", *names).repartition(n, "doc_id", "rid")


def _spans(texts: DataFrame) -> DataFrame:
    """(doc_id, rid, numbers): removed byte ranges, maybe overlapping."""
    n = partitions(texts.sparkSession)
    blobs, home = "bucket int, known boolean, blob binary", "home int, blob binary"
    numbers = "doc_id bigint, rid int, numbers binary"
    nums = (texts.mapInArrow(tidy(_send_keys(n)), blobs).repartitionById(n, F.col("bucket"))
            .mapInArrow(tidy(_meet_keys(n)), home).repartitionById(n, F.col("home")).mapInArrow(tidy(_gather(1)), numbers))
    return (texts.join(nums, ["doc_id", "rid"])
            .select("doc_id", "rid", "text", "numbers", *[c for c in texts.columns if c.startswith("_k")])
            .mapInArrow(tidy(_send_runs(n)), blobs).repartitionById(n, F.col("bucket"))
            .mapInArrow(tidy(_meet_runs(n)), home).repartitionById(n, F.col("home")).mapInArrow(tidy(_gather(2)), numbers))


def _kept(batches):
    """Rows with the text that is left."""
    for b in batches:
        data, off = unzipped(b.column(2))
        raw = data.tobytes()
        numbers, cut = text_bytes(b.column(3))
        numbers, cut = np.frombuffer(numbers.tobytes(), "<i4"), cut // 4
        out = []
        for k in range(b.num_rows):
            text = raw[off[k]:off[k + 1]]
            if cut[k] == cut[k + 1]:
                out.append((len(text), 0, 0, text))
                continue
            both = numbers[cut[k]:cut[k + 1]].reshape(-1, 2).astype(np.int64)
            both = both[np.argsort(both[:, 0], kind="stable")]
            zero = np.zeros(len(both), np.int64)
            _, _, start, end = _merged(zero, zero, both[:, 0], both[:, 1])
            parts, at = [], 0
            for x, y in zip(start.tolist(), end.tolist()):
                parts.append(text[at:x])
                at = y
            parts.append(text[at:])
            out.append((len(text), int((end - start).sum()), len(start), b"".join(parts)))
        size, removed, count, kept = zip(*out) if out else ((), (), (), ())
        ids = [None if i == NO_ID else i for i in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), b.column(1), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(count, pa.int64()), pa.array(kept, pa.binary()), *b.columns[4:]],
            ["doc_id", "rid", "n_bytes", "n_removed", "n_spans", "kept", *b.schema.names[4:]])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of ``docs``: (doc_id, rid, n_bytes, n_removed, n_spans, kept) and the
    ``keep`` columns; ``kept`` is the remaining bytes and ``rid`` a hash of the text."""
    texts = _texts(docs, id_col, text_col, keep)
    names = [f"_k{i}" for i in range(len(keep))]
    done = (texts.join(_spans(texts), ["doc_id", "rid"], "left")
            .select("doc_id", "rid", "text", "numbers", *names)
            .mapInArrow(tidy(_kept), "doc_id bigint, rid int, n_bytes bigint, n_removed bigint, "
                               "n_spans bigint, kept binary" + _fields(docs, keep)))
    return done.withColumnsRenamed(dict(zip(names, keep)))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and any others) with the repeated strings taken out of the texts; a
    character that a removed range cuts through goes too, a null text and a text without
    repeats stay as they are, and documents of which nothing is left go. n_chars follows
    the text where the table has it."""
    keep = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    renamed = docs.select("doc_id", "text", *[F.col(c).alias(f"_c{i}") for i, c in enumerate(keep)],
                          F.col("text").isNull().alias("_null"))
    done = repeated_spans(renamed, keep=(*[f"_c{i}" for i in range(len(keep))], "_null"))

    @F.pandas_udf("string")
    def decoded(x: pd.Series) -> pd.Series:
        return x.map(lambda b: b.decode("utf-8", "ignore"))

    text = F.when(~F.col("_null"), decoded("kept"))
    out = done.where((F.col("n_removed") < F.col("n_bytes")) | (F.col("n_bytes") == 0)).withColumn("text", text)
    out = out.select("doc_id", "text", *[F.col(f"_c{i}").alias(c) for i, c in enumerate(keep)])
    out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in keep else out
    return out.select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """Digest columns of :func:`repeated_spans`."""
    return repeated_spans(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                       F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, int, str]]:
    """The same result for a few distinct ids, by dictionary; for tests."""
    least: dict[bytes, int] = {}
    texts = {i: (t or "").encode() for i, t in rows}
    for i, t in texts.items():
        for p in range(len(t) - LENGTH + 1):
            w = t[p:p + LENGTH]
            least[w] = min(least.get(w, i), i)
    out = {}
    for i, t in texts.items():
        gone = bytearray(len(t))
        for p in range(len(t) - LENGTH + 1):
            if least[t[p:p + LENGTH]] < i:
                gone[p:p + LENGTH] = b"\1" * LENGTH
        runs = len([x for x in bytes(gone).split(b"\0") if x])
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out[i] = (len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out
