"""Operator 13: byte-level BPE encoding and decoding by a two-tier lookup.

A text is cut into pre-tokens by the public pattern, each encoded separately as the tiktoken
library does. First tier: a minimal perfect hash over the vocabulary (one slot a token, a
displacement a bucket) answers whole pre-tokens that are tokens themselves, a batch of distinct
ones at a time; every answer is confirmed on the bytes. Second tier: the others start as linked
bytes, and a heap of (rank, place) gives the next merge (``merging.py``); ties go to the leftmost. Pre-tokens of up to 32 bytes
take their steps side by side, their heaps being tournaments of pairwise minima in the rows of an array.
Decoding joins the tokens' bytes.

The letter, number and space classes of the pattern are those of the tiktoken library's own
Unicode tables: the driver asks it once for all code points, and tasks get the ranges (some 800
pairs). Texts are encoded ``CHUNK`` bytes at a time, longer ones in parts that end before a space and a
letter, so what a worker holds besides a batch of texts and their ids is bounded: the vocabulary and ``KEPT``
encoded pre-tokens.

Defined cases: a null or empty text has no tokens (the hash of nothing); repeated rows and null
ids pass as they are; an empty table gives no rows; bytes that are not UTF-8 count as
U+FFFD. Special tokens' strings are ordinary text. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import M61, mix, spans, text_bytes, tidy, word_hashes
from tessera.llm.merging import Merges, Store, distinct, laid_out

#: Pre-tokens whose ids a worker keeps from task to task (about 200 bytes each), and the most a text block adds.
KEPT = 400_000
#: Bytes of texts encoded at once.
CHUNK = 2 << 20
#: Keys a bucket of the hash on average.
BUCKET = 3
Ranges = list[tuple[int, int]]
_SPLIT = re.compile(rb" (?=[A-Za-z])")


def public_path(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    """Place of a public vocabulary on the machine that asks."""
    import public_tokenizers
    return public_tokenizers.path(name)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def char_classes() -> tuple[Ranges, Ranges, Ranges]:
    """Letters, numbers and white space as code point ranges, by the tiktoken library's tables."""
    import tiktoken
    plain = {bytes([b]): b for b in range(256)}
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = []
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        coder = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=plain, special_tokens={})
        ranges: list[list[int]] = []
        for c in map(ord, coder.decode_bytes(coder.encode_ordinary(every)).decode()):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
        out.append([(a, b) for a, b in ranges])
    return tuple(out)


#: Classes of a character; everything else is OTHER. SPACE is white space, the space itself included.
OTHER, LETTER, NUMBER, SPACE = range(4)


def class_table(classes: tuple[Ranges, Ranges, Ranges]) -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for kind, ranges in zip((LETTER, NUMBER, SPACE), classes):
        for a, b in ranges:
            table[a:b + 1] = kind
    return table


def cut(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Byte places where the pre-tokens of UTF-8 texts begin, in order; together they cover all bytes.

    The public pattern, side by side for all characters: a run of letters, numbers or others is a pre-token,
    with the space before it; white space before something else gives up its last character, which
    stands alone unless it is that space; an apostrophe that has no space before it and
    stands alone before s, t, re, ve, m, ll or d takes those letters out of their run."""
    chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(chars)
    if not n:
        return np.zeros(0, np.int64)
    place = np.flatnonzero((data & 0xC0) != 0x80)
    kind = table[chars]
    head = np.zeros(n + 1, bool)  # a text begins here
    head[np.searchsorted(place, off)] = True
    run = head[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    begins = run.copy()
    # the last white space before something else of the same text
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~head[1:n])
    begins[last] = True
    begins[last[chars[last] == 32] + 1] = False
    # contractions
    mark = np.flatnonzero((chars[:-1] == 39) & begins[:-1] & run[1:] & ~head[1:n] & (kind[1:] == LETTER))
    one, two = chars[mark + 1], chars[np.minimum(mark + 2, n - 1)]
    two = np.where((mark + 2 < n) & ~run[np.minimum(mark + 2, n - 1)], two, 0)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ~short & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
    begins[mark[short | long] + 1] = False
    rest = np.concatenate([mark[short] + 2, mark[long] + 3])
    begins[rest[rest < n]] = True
    return place[begins]


def _table(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets and 64-bit hashes of byte strings."""
    off = np.zeros(len(keys) + 1, np.int64)
    np.cumsum([len(k) for k in keys], out=off[1:])
    data = np.frombuffer(b"".join(keys), np.uint8)
    return data, off, word_hashes(data, off[:-1], off[1:])


class PerfectHash:
    """A minimal perfect hash of distinct byte strings: ``len(keys)`` slots, each with one key.

    Keys fall into buckets; the buckets of a size, from the largest on, all try one displacement after the
    other, and those whose keys all get free slots that no earlier bucket takes stay there. A bucket
    of one key names its slot directly."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.data, self.off, hashes = _table(keys)
        self.buckets = n // BUCKET + 1
        self.moves = np.zeros(self.buckets, np.int64)
        self.slots = np.zeros(max(n, 1), np.int64)
        of = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        sizes = np.bincount(of, minlength=self.buckets)
        first = np.cumsum(sizes) - sizes
        free = np.ones(n, bool)
        for size in range(int(sizes.max(initial=0)), 1, -1):
            left = np.flatnonzero(sizes == size)
            mine = order[first[left][:, None] + np.arange(size)]
            move = 0
            while len(left):
                at = self._place(hashes[mine], np.full(1, move, np.uint64), n)
                ordered = np.sort(at, axis=1)
                fits = np.flatnonzero(free[at].all(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1))
                if len(fits):
                    taken, where = np.unique(at[fits], return_index=True)
                    won = np.bincount(where // size, minlength=len(fits)) == size
                    fits = fits[won]
                    self.moves[left[fits]] = move
                    self.slots[at[fits]] = mine[fits]
                    free[at[fits]] = False
                    stay = np.ones(len(left), bool)
                    stay[fits] = False
                    left, mine = left[stay], mine[stay]
                move += 1
        single = np.flatnonzero(sizes == 1)
        slot = np.flatnonzero(free)
        self.moves[single] = -1 - slot
        self.slots[slot] = order[first[single]]

    @staticmethod
    def _place(hashes: np.ndarray, moves: np.ndarray, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(hashes + (moves + np.uint64(1)) * M61) % np.uint64(n)).astype(np.int64)

    def find(self, words: list[bytes]) -> np.ndarray:
        """Place of each word among the keys, -1 where it is none."""
        if not words or not len(self.off) - 1:
            return np.full(len(words), -1, np.int64)
        data, off, hashes = _table(words)
        moves = self.moves[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        slot = np.where(moves < 0, -1 - moves, 0)
        far = moves >= 0
        slot[far] = self._place(hashes[far], moves[far].astype(np.uint64), len(self.slots))
        key = self.slots[slot]
        size = np.diff(off)
        same = size == self.off[key + 1] - self.off[key]
        # confirm on the bytes: the candidates' bytes side by side
        rows = np.flatnonzero(same)
        size = size[rows]
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        equal = data[np.repeat(off[rows], size) + step] == self.data[np.repeat(self.off[key[rows]], size) + step]
        wrong = np.repeat(rows, size)[~equal]
        same[wrong] = False
        return np.where(same, key, -1)


class Coder:
    """Encodes and decodes with one rank file; an id is its token's rank."""

    def __init__(self, ranks: dict[bytes, int], classes: tuple[Ranges, Ranges, Ranges]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"byte BPE: the vocabulary lacks the bytes {missing[:5]}")
        self.classes = class_table(classes)
        keys = list(ranks)
        self.whole = PerfectHash(keys)
        self.ids = np.array([ranks[k] for k in keys], "<u4")
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # every way in which two tokens make a third; a token's id is its rank
        self.pairs = Merges({(ranks[k[:c]], ranks[k[c:]]): i for k, i in ranks.items()
                             for c in range(1, len(k)) if k[:c] in ranks and k[c:] in ranks},
                            np.arange(max(ranks.values()) + 1))
        # tokens' bytes by id, for decoding
        ordered = sorted(ranks, key=ranks.get)
        self.text = np.frombuffer(b"".join(ordered), np.uint8)
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        self.size[[ranks[k] for k in ordered]] = [len(k) for k in ordered]
        self.start = np.cumsum(self.size) - self.size
        self.store = Store(self._learn, KEPT)

    def merges(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token: linked bytes, merged in the order of a heap of (rank, place)."""
        return self.pairs(self.single[np.frombuffer(b"".join(pieces), np.uint8)],
                          np.fromiter(map(len, pieces), np.int64, len(pieces)))

    def _learn(self, words: list[bytes]) -> list[bytes]:
        place = self.whole.find(words)
        ids = self.ids[place].tobytes()
        far = np.flatnonzero(place < 0).tolist()
        merged = dict(zip(far, self.merges([words[k] for k in far])))
        return [merged[k] if k in merged else ids[4 * k:4 * k + 4] for k in range(len(words))]

    def _encode(self, data: np.ndarray, off: np.ndarray) -> list[bytes]:
        start = cut(data, off, self.classes)
        if not len(start):
            return [b""] * (len(off) - 1)
        size = np.diff(start, append=len(data))
        which, first = distinct(data, start, size)
        raw = data.tobytes()
        found = self.store([raw[a:a + n] for a, n in zip(start[first].tolist(), size[first].tolist())])
        out, end = laid_out(found, which)
        at = (4 * end[np.searchsorted(start, off)]).tolist()
        return [out[a:b] for a, b in zip(at, at[1:])]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of UTF-8 texts as little-endian 32-bit integers."""
        parts, owner = [], []
        for k, t in enumerate(texts):
            try:
                t.decode()
            except UnicodeDecodeError:
                t = t.decode("utf-8", "replace").encode()
            at = 0
            while len(t) - at > CHUNK:
                # a space before a plain letter always begins a pre-token
                found = _SPLIT.search(t, at + CHUNK // 2)
                if not found:
                    break
                parts.append(t[at:found.start()])
                owner.append(k)
                at = found.start()
            parts.append(t[at:])
            owner.append(k)
        off = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) for p in parts], out=off[1:])
        out: list[list[bytes]] = [[] for _ in texts]
        for i, j in spans(off, CHUNK):
            data = np.frombuffer(b"".join(parts[i:j]), np.uint8)
            for k, ids in zip(owner[i:j], self._encode(data, off[i:j + 1] - off[i])):
                out[k].append(ids)
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def decode(self, texts: list[bytes]) -> list[bytes]:
        """Bytes of little-endian 32-bit ids."""
        ids = np.frombuffer(b"".join(texts), "<u4").astype(np.int64)
        if len(ids) and ids.max() >= len(self.size):
            raise ValueError(f"byte BPE: no token has the id {ids.max()}")
        size = self.size[ids]
        end = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(size, out=end[1:])
        raw = self.text[np.repeat(self.start[ids] - end[:-1], size) + np.arange(end[-1])].tobytes()
        off = end[np.cumsum([0] + [len(t) // 4 for t in texts])].tolist()
        return [raw[a:b] for a, b in zip(off, off[1:])]


_CODERS: dict[str, Coder] = {}


def _coder(path: str, classes: tuple[Ranges, Ranges, Ranges]) -> Coder:
    if path not in _CODERS:
        _CODERS[path] = Coder(read_ranks(path), classes)
    return _CODERS[path]


def _mapped(docs: DataFrame, kind: str, schema: str, rows: Callable, vocabulary: Callable[[], str]) -> DataFrame:
    """``rows(coder, values)`` gives a row of columns for each value of the second column of ``docs``."""
    classes = char_classes()

    def run(batches):
        coder = _coder(vocabulary(), classes)
        for b in batches:
            data, off = text_bytes(b.column(1))
            raw = data.tobytes()
            for i, j in spans(off, CHUNK):
                found = rows(coder, [raw[off[k]:off[k + 1]] for k in range(i, j)])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *found], names=["doc_id", *names])

    names = [c.split()[0] for c in schema.split(", ")]
    return docs.select(F.col(docs.columns[0]).cast("bigint"), F.col(docs.columns[1]).cast(kind)).mapInArrow(
        tidy(run), f"doc_id bigint, {schema}")


def encode(docs: DataFrame, vocabulary: Callable[[], str] = public_path) -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers in a binary column, from the columns
    ``doc_id`` and ``text``; ``vocabulary`` gives the rank file's path on the executor."""
    def rows(coder, texts):
        return [pa.array(coder.encode(texts), pa.binary())]
    return _mapped(docs.select("doc_id", "text"), "string", "ids binary", rows, vocabulary)


def decode(encoded: DataFrame, vocabulary: Callable[[], str] = public_path) -> DataFrame:
    """(doc_id, data): the bytes that the ids of ``encode`` stand for."""
    def rows(coder, ids):
        return [pa.array(coder.decode(ids), pa.binary())]
    return _mapped(encoded.select("doc_id", "ids"), "binary", "data binary", rows, vocabulary)


def report(docs: DataFrame, vocabulary: Callable[[], str] = public_path) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): texts encoded and their ids decoded again, in one pass."""
    def rows(coder, texts):
        found = coder.encode(texts)
        return [pa.array([len(x) // 4 for x in found], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in found]),
                pa.array([hashlib.sha256(x).hexdigest() for x in coder.decode(found)])]
    return _mapped(docs.select("doc_id", "text"), "string",
                   "n_tokens bigint, ids_sha256 string, decoded_sha256 string", rows, vocabulary)
