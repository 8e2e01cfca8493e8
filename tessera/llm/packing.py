"""Operator 9: best-fit packing of tokenized documents by bin completion.

A document is its token ids and one end id; only longer ones than a sequence are cut.
Pieces of equal length are interchangeable, so the search works on the table
of piece counts by length, at most ``capacity`` rows whatever the corpus holds. For the
largest length left it enumerates the undominated fillings of the rest of the sequence
(larger lengths first; an exact fit ends the search), prunes by the waste
that a branch cannot get below, with the best-fit filling as first incumbent, and
applies the result as often as the counts allow. Each application uses up a length, so the
plan has at most ``capacity`` patterns. Spark then ranks the pieces of a length, in
parallel by hash buckets, and the rank gives sequence and offset.

Defined cases: a null or empty text has the end id alone; repeated rows are packed
each on its own; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import partitions, text_bytes, tidy, written
from tessera.llm.merging import Merges, Store, distinct, laid_out

CAPACITY = 2048
END_ID = 0
#: Pieces of words whose ids a worker keeps from task to task (about 200 bytes each).
KEPT_WORDS = 300_000
#: Branches looked at for one filling before sums of bits give the best one.
BRANCHES = 4000
#: Fillings tried, and branches looked at in all, in one search for a plan below the incumbent, whatever the number of
#: sequences; README gives the gap that this leaves.
NODES, WORK = 4000, 40_000
#: What sends a word the tokenizer's whole way; its lower case may lie in either range.
_ODD = regex.compile("[\u0250-\U0010ffff\u0130]|<\\|")


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others, in order, for
    the code points from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: 256 + k for k, b in enumerate(rest)}


_LETTERS = _byte_letters()


def public_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary on the machine that asks."""
    import public_tokenizers
    return public_tokenizers.path(name)


class WordIds:
    """Ids of texts, piece by piece. The word-end vocabulary drops white space and never
    joins across its pattern's pieces, so a text's ids are those of its pieces in order. The distinct pieces of a batch are
    looked up in a bounded store; new ones take the vocabulary's merges side by side, and words with characters
    from U+0250 on take the tokenizer's whole way."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            form = json.load(file)["model"]
        vocab, end = form["vocab"], form["end_of_word_suffix"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in form["merges"]]
        self.merges = Merges({(vocab[a], vocab[b]): r for r, (a, b) in enumerate(merges)},
                             np.array([vocab[a + b] for a, b in merges], np.int64))
        self.inner = np.array([vocab[chr(_LETTERS.get(b, b))] for b in range(256)], np.int64)
        self.last = np.array([vocab[chr(_LETTERS.get(b, b)) + end] for b in range(256)], np.int64)
        self.words = Store(self._learn, KEPT_WORDS)

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.model.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _merge(self, pieces: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b"".join(pieces), np.uint8)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        tokens = self.inner[data]
        tail = np.cumsum(size) - 1
        tokens[tail] = self.last[data[tail]]
        return self.merges(tokens, size)

    def _learn(self, words: list[bytes]) -> list[bytes]:
        odd = [k for k, w in enumerate(words) if not (w.isascii() and b"<|" not in w) and _ODD.search(w.decode())]
        strange = dict(zip(odd, self._encode([words[k].decode() for k in odd])))
        plain = [k for k in range(len(words)) if k not in strange]
        merged = dict(zip(plain, self._merge([words[k] for k in plain])))
        return [strange[k] if k in strange else merged[k] for k in range(len(words))]

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        try:
            whole = [t.decode() for t in texts]
        except UnicodeDecodeError:
            whole = [t.decode("utf-8", "replace") for t in texts]
        data, start, stop, owner = cut(whole)
        which, first = distinct(data, start, stop - start)
        raw = data.tobytes()
        found = self.words([raw[a:b] for a, b in zip(start[first].tolist(), stop[first].tolist())])
        ids, end = laid_out(found, which)
        at = (4 * end[np.searchsorted(owner, np.arange(len(texts) + 1))]).tolist()
        return [ids[a:b] for a, b in zip(at, at[1:])]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower case of the plain characters, those below U+0250."""
    kind, lower = np.zeros(0x250, np.uint8), np.arange(0x250, dtype=np.uint32)
    for c in range(0x250):
        x = chr(c)
        kind[c] = 1 if regex.match(r"\p{L}", x) else 2 if regex.match(r"\p{N}", x) else 3 if regex.match(r"\s", x) else 0
        if len(x.lower()) == 1:
            lower[c] = ord(x.lower())
    return kind, lower


_KIND, _LOWER = _tables()


def cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the texts in lower case, and the pieces in them (start, stop, text) as the vocabulary's pattern cuts
    them: contractions, runs of letters, single numbers, runs of others. A word between white space that holds a character
    from U+0250 on, one whose lower case is two, or the mark of a special token is one piece, as it stands."""
    size = np.array([len(t) for t in texts], np.int64)
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    n = len(chars)
    if not n:
        return np.zeros(0, np.uint8), *[np.zeros(0, np.int64)] * 3
    head = np.zeros(n + 1, bool)  # a text begins here
    head[np.cumsum(size) - size] = True
    head[n] = True
    odd = (chars >= 0x250) | (chars == 0x130)
    odd[:-1] |= (chars[:-1] == ord("<")) & (chars[1:] == ord("|")) & ~head[1:n]
    blank = (chars == 32) | ((chars >= 9) & (chars <= 13))
    word = np.cumsum(head[:n] | blank)  # a word's characters share a number, with the blank before them
    if odd.any():
        strange = np.zeros(int(word[-1]) + 1, bool)
        strange[word[odd]] = True
        odd = strange[word] & ~blank
    small = np.where(odd, 0, chars)
    kind = np.where(odd, 4, _KIND[small])
    chars = np.where(odd, chars, _LOWER[small])
    run = head[:n].copy()
    run[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    run[1:] |= (kind[1:] == 4) & blank[:-1]
    begins = run.copy()
    # an apostrophe by itself before s, t, re, ve, m, ll or d takes those letters out of their run
    mark = np.flatnonzero((chars[:-1] == 39) & run[:-1] & run[1:] & ~head[1:n] & (kind[:-1] == 0) & (kind[1:] == 1))
    one, after = chars[mark + 1], np.minimum(mark + 2, n - 1)
    two = np.where((mark + 2 < n) & ~run[after], chars[after], 0)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ~short & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
    begins[mark[short | long] + 1] = False
    rest = np.concatenate([mark[short] + 2, mark[long] + 3])
    begins[rest[rest < n]] = True
    data = np.frombuffer(chars.astype(np.uint32).tobytes().decode("utf-32-le").encode(), np.uint8)
    place = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    first = np.flatnonzero(begins)
    last = np.append(first[1:], n)
    real = kind[first] != 3
    first, last = first[real], last[real]
    return data, place[first], place[last], np.searchsorted(np.cumsum(size), first, "right")


_MODELS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _MODELS:
        _MODELS[path] = WordIds(path)
    return _MODELS[path]


def pieces(docs: DataFrame, tokenizer: Callable[[], str] = public_path, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document; ``tokenizer`` gives
    the vocabulary's path on the executor."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        yield from rows(word_ids(tokenizer()), batches)

    def rows(ids_of, batches):
        for b in batches:
            data, off = text_bytes(b.column(1))
            raw = data.tobytes()
            ids = b.column(0).to_pylist()
            for i in range(0, len(ids), 500):
                j = min(i + 500, len(ids))
                out = []
                for doc, found in zip(ids[i:j], ids_of([raw[off[k]:off[k + 1]] for k in range(i, j)])):
                    found += end
                    for p, at in enumerate(range(0, len(found), 4 * capacity)):
                        part = found[at:at + 4 * capacity]
                        out.append((doc, p, at // 4, len(part) // 4, zlib.crc32(part)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), *[pa.int64()] * 3))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        tidy(run), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def complete(counts: np.ndarray, room: int, spare: int = 0) -> list[tuple[int, int]]:
    """Lengths (with how often) that fill ``room`` best, from ``counts`` by length; a filling that
    wastes at most ``spare`` ends the search."""
    sizes = np.flatnonzero(counts[:room + 1])[::-1].tolist()
    if not sizes:
        return []
    # fits[r]: place in ``sizes`` of the largest length that still fits into r
    fits = np.searchsorted(-np.array(sizes), -np.arange(room + 1), "left").tolist()
    best: list[tuple[int, int]] = []
    waste, looked = room, 0
    chosen: list[tuple[int, int]] = []
    # (next length, room, depth, copies of the length before); the top of the stack has
    # the most copies of the largest length, so the first leaf is the best-fit filling
    stack = [(0, room, 0, 0)]
    while stack and waste > spare and looked < BRANCHES:
        at, left, depth, copies = stack.pop()
        del chosen[depth:]
        if copies:
            chosen.append((sizes[at - 1], copies))
            depth += 1
        looked += 1
        at = max(at, fits[left])
        if at >= len(sizes):
            if left < waste:
                best, waste = list(chosen), left
            continue
        # what lies below cannot fill more than all that is left of the lengths
        if left - _all_below(counts, sizes, at, left) >= waste:
            continue
        size = sizes[at]
        stack.append((at + 1, left, depth, 0))
        for k in range(1, min(left // size, int(counts[size])) + 1):
            stack.append((at + 1, left - k * size, depth, k))
    return fullest(counts, room) if stack and waste > spare else best


def fullest(counts: np.ndarray, room: int) -> list[tuple[int, int]]:
    """Lengths (with how often) of the largest sum up to ``room``, by the set of all sums as the bits of one number:
    exact, whatever the number of fillings."""
    mask, sums, steps = (1 << (room + 1)) - 1, 1, []
    for size in np.flatnonzero(counts[:room + 1])[::-1].tolist():
        most, copies = min(int(counts[size]), room // size), 1
        while most:
            k = min(copies, most)
            steps.append((size, k, sums))
            sums |= sums << size * k & mask
            most -= k
            copies *= 2
    at, uses = sums.bit_length() - 1, {}
    for size, k, before in reversed(steps):
        if not before >> at & 1:
            uses[size] = uses.get(size, 0) + k
            at -= size * k
    return sorted(uses.items(), reverse=True)


def undominated(counts: np.ndarray, room: int, most_waste: int, branches: int | None = None,
                spent: list[int] | None = None) -> list[tuple[int, list[tuple[int, int]]]]:
    """(waste, lengths) of the fillings of ``room`` that waste at most ``most_waste``, least waste first. One in which a
    longer piece that is left over could stand for one or two of its pieces is dominated and left out."""
    have = counts.tolist()
    sizes = np.flatnonzero(counts[:room + 1])[::-1].tolist()
    out, looked, branches = [], 0, BRANCHES if branches is None else branches

    def dominated(chosen, waste):
        used = dict(chosen)
        ones = list(used)
        pairs = {a + b for i, a in enumerate(ones) for b in ones[i:] if a != b or used[a] > 1}
        return any(have[x] > used.get(x, 0) for part, least in [(0, 1), *((a, 1) for a in ones), *((t, 0) for t in pairs)]
                   for x in range(part + least, min(part + waste, room) + 1))

    def grow(at, left, chosen):
        nonlocal looked
        looked += 1
        if left <= most_waste and not dominated(chosen, left):
            out.append((left, chosen))
        for j in range(at, len(sizes)):
            size = sizes[j]
            if size > left:
                continue
            if looked > branches or left - _all_below(have, sizes, j, left) > most_waste:
                return
            for k in range(min(left // size, have[size]), 0, -1):
                grow(j + 1, left - k * size, [*chosen, (size, k)])

    grow(0, room, [])
    if spent is not None:
        spent.append(looked)
    return sorted(out, key=lambda x: x[0])


def fewer(counts: dict[int, int], capacity: int, fewest: int) -> list[tuple[dict[int, int], int]] | None:
    """Fillings (length: how often) with the number of sequences that take them, together fewer sequences than ``fewest``,
    by branch and bound, or None if there are none (or none within ``NODES`` fillings tried and ``WORK`` branches). Each
    branch fills a sequence around the largest piece left, as often as the counts allow, half as often and so on
    down to once, so a way to the end does not grow with the number of pieces; a branch ends when the waste so far is
    more than any plan with one sequence less could have."""
    left = np.zeros(capacity + 1, np.int64)
    for size, c in counts.items():
        left[size] = c
    total = int((left * np.arange(capacity + 1)).sum())
    allowed = (fewest - 1) * capacity - total
    if allowed < 0:
        return None
    stack, chosen, looked, spent = [({}, 0, 0, 0)], [], 0, []
    while stack and looked < NODES and sum(spent) < WORK:
        use, times, depth, waste = stack.pop()
        while len(chosen) > depth:
            undone, n = chosen.pop()
            for size, k in undone.items():
                left[size] += k * n
        if use:
            for size, k in use.items():
                left[size] -= k * times
            chosen.append((use, times))
        looked += 1
        kinds = np.flatnonzero(left)
        if not len(kinds):
            return list(chosen)
        top = int(kinds[-1])
        left[top] -= 1
        ways = undominated(left, capacity - top, allowed - waste, min(BRANCHES, WORK), spent)
        left[top] += 1
        for lost, lengths in reversed(ways):
            use = {top: 1}
            for size, k in lengths:
                use[size] = use.get(size, 0) + k
            most = min(int(left[size]) // k for size, k in use.items())
            if lost:
                most = min(most, (allowed - waste) // lost)
            for halved in range(most.bit_length() - 1, -1, -1):
                stack.append((use, most >> halved, len(chosen), waste + lost * (most >> halved)))
    return None


def improved(counts: dict[int, int], capacity: int, fewest: int, bound: int) -> list[dict[int, int]] | None:
    """The sequences of :func:`fewer` one by one, if ``fewest`` lies above the lower bound."""
    found = fewer(counts, capacity, fewest) if fewest > bound else None
    return None if found is None else [use for use, times in found for _ in range(times)]


def shortened(steps: list[tuple[dict[int, int], int]], capacity: int) -> list[tuple[dict[int, int], int]] | None:
    """A plan with fewer sequences than ``steps``, or None: its last sequences are searched anew, 4 of them, then 16 and so
    on up to all, for the waste of best fillings lies at the end."""
    n, window = sum(times for _, times in steps), 4
    while True:
        head, tail, room = list(steps), [], min(window, n)
        while room:
            use, times = head.pop()
            taken = min(times, room)
            tail.append((use, taken))
            if times > taken:
                head.append((use, times - taken))
            room -= taken
        counts: dict[int, int] = {}
        for use, times in tail:
            for size, k in use.items():
                counts[size] = counts.get(size, 0) + k * times
        found = fewer(counts, capacity, min(window, n))
        if found is not None:
            return head + found
        if window >= n:
            return None
        window *= 4


def _all_below(counts: np.ndarray, sizes: list[int], at: int, enough: int) -> int:
    """Sum of all pieces from place ``at`` on, as far as it matters."""
    total = 0
    for s in sizes[at:]:
        total += s * int(counts[s])
        if total >= enough:
            return enough
    return total


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, lo, hi, sequence, uses, offset): the pieces of a length with ranks lo to hi - 1
    stand ``uses`` in a sequence from ``sequence`` on, the first at ``offset``.

    Where exact fillings from the start would use up the small pieces that the rest needs, fillings
    within the spare room that even the lower bound leaves do better: a few such allowances give the
    incumbent. While it lies above the lower bound, branch and bound looks for a plan with fewer sequences."""
    total = sum(s * c for s, c in counts.items())
    bound = max(-(-total // capacity), sum(c for s, c in counts.items() if 2 * s > capacity))
    spare = (bound * capacity - total) // max(bound, 1)
    best, fewest = [], None
    for allowance in dict.fromkeys((0, spare, 2 * spare, 4 * spare, 8, 32)):
        steps = _plan(counts, capacity, allowance)
        used = sum(times for _, times in steps)
        if fewest is None or used < fewest:
            best, fewest = steps, used
        if fewest <= bound:
            return _as_rows(best)
    while fewest > bound:
        better = shortened(best, capacity)
        if better is None:
            break
        best, fewest = better, sum(times for _, times in better)
    return _as_rows(best)


def _as_rows(steps: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """The plan rows of fillings and the number of sequences that take them."""
    rows, used, sequence = [], {}, 0
    for uses, times in steps:
        at = 0
        for size, k in uses.items():
            lo = used.get(size, 0)
            rows.append((size, lo, lo + k * times, sequence, k, at))
            used[size] = lo + k * times
            at += k * size
        sequence += times
    return rows


def _plan(counts: dict[int, int], capacity: int, spare: int) -> list[tuple[dict[int, int], int]]:
    left = np.zeros(capacity + 1, np.int64)
    for size, c in counts.items():
        left[size] = c
    steps = []
    for size in range(capacity, 0, -1):
        while left[size]:
            left[size] -= 1
            rest = complete(left, capacity - size, spare)
            left[size] += 1
            uses: dict[int, int] = {size: 1}
            for s, k in rest:
                uses[s] = uses.get(s, 0) + k
            times = min(int(left[s]) // k for s, k in uses.items())
            for s, k in uses.items():
                left[s] -= k * times
            steps.append((uses, times))
    return steps


def pack(docs: DataFrame, tokenizer: Callable[[], str] = public_path, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and place: (doc_id, piece, start, length, ids_crc32,
    sequence_id, offset)."""
    spark = docs.sparkSession
    table = written(pieces(docs, tokenizer, capacity), "pieces")
    counts = {r["length"]: r["c"] for r in table.groupBy("length").agg(F.count("*").alias("c")).collect()}
    rows = plan(counts, capacity)
    # at most 63 different lengths fit into 2048, so the plan is bounded by the capacity alone
    steps = spark.createDataFrame(rows, "length bigint, lo bigint, hi bigint, seq0 bigint, uses bigint, at bigint")
    dealt = table.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(partitions(spark))).cast("int"))
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("c"))
    before = sizes.withColumn("before", F.sum("c").over(Window.partitionBy("length").orderBy("bucket")) - F.col("c"))
    ranked = (dealt.withColumn("row", F.row_number().over(
        Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")))
        .join(before.select("length", "bucket", "before"), ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.col("row") - 1))
    placed = ranked.join(F.broadcast(steps), "length").where((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    turn = F.col("rank") - F.col("lo")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (F.col("seq0") + F.expr("(rank - lo) div uses")).alias("sequence_id"),
                         (F.col("at") + (turn % F.col("uses")) * F.col("length")).alias("offset"))
