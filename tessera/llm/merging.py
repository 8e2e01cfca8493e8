"""Helpers of the tokenizing operators: distinct words of byte tables, and pair merges by heap."""

from __future__ import annotations

from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd

from tessera.llm.common import M61, word_hashes

#: Longest word that is merged in a row beside others; a heap entry above all others; rows merged at once.
ROW, NONE, TOGETHER = 32, 1 << 62, 20_000


def distinct(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each word's string, and the first place of each number. Equal hashes are confirmed
    on the bytes; if two strings share one, every word counts by itself."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    which, _ = pd.factorize(word_hashes(data, start, start + size))
    first = np.full(which.max() + 1, len(start), np.int64)
    np.minimum.at(first, which, np.arange(len(start)))
    of = first[which]
    if (size == size[of]).all():
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        if np.array_equal(data[np.repeat(start, size) + step], data[np.repeat(start[of], size) + step]):
            return which, first
    return np.arange(len(start)), np.arange(len(start))


def laid_out(found: list[bytes], which: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The little-endian 32-bit ids of all places, by those of the distinct words, and where each place begins."""
    ids = np.frombuffer(b"".join(found), "<u4")
    count = np.fromiter(map(len, found), np.int64, len(found)) // 4
    begin = np.cumsum(count) - count
    each = count[which]
    end = np.zeros(len(each) + 1, np.int64)
    np.cumsum(each, out=end[1:])
    return ids[np.repeat(begin[which] - end[:-1], each) + np.arange(end[-1])].tobytes(), end


class Store:
    """Ids of words, kept from task to task. It has two halves: a full one becomes the older, and what
    is still used moves over."""

    def __init__(self, learn, most: int):
        self.learn, self.most = learn, most
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def __call__(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words; ``learn`` gives those of new ones."""
        if len(self.known) + len(words) > self.most // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = [w for w in words if w not in known]
        known.update((w, older[w]) for w in new if w in older)
        new = [w for w in new if w not in known]
        known.update(zip(new, self.learn(new)))
        return [known[w] for w in words]


class Merges:
    """Merges of token pairs, those of the least rank first and of equal ones the leftmost, by a heap of (rank,
    place) over linked tokens. ``pairs`` maps (left, right) to the rank, ``made`` a rank to the new token."""

    def __init__(self, pairs: dict[tuple[int, int], int], made: np.ndarray):
        self.made = made.astype(np.int64)
        self.made_list = self.made.tolist()
        self.shift = max([int(self.made.max(initial=0)), *(max(p) for p in pairs)], default=0).bit_length()
        self.pairs = {a << self.shift | b: r for (a, b), r in pairs.items()}
        # the pairs once more as an open-addressing table of arrays, for lookups of many at once
        keys, values = (np.fromiter(x, np.int64, len(pairs)) for x in (self.pairs, self.pairs.values()))
        size = 1 << max(4, (4 * len(keys)).bit_length())
        self.keys, self.values = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        at, rows = self._home(keys), np.arange(len(keys))
        while len(rows):
            _, first = np.unique(at, return_index=True)
            won = np.zeros(len(rows), bool)
            won[first] = True
            won &= self.keys[at] < 0
            self.keys[at[won]], self.values[at[won]] = keys[rows[won]], values[rows[won]]
            rows, at = rows[~won], (at[~won] + np.uint64(1)) & np.uint64(size - 1)

    def _home(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * M61) >> np.uint64(40)) & np.uint64(len(self.keys) - 1)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, -1 where the two make none."""
        key = left << self.shift | right
        at = self._home(key)
        out = np.full(len(key), -1, np.int64)
        rows = np.arange(len(key))
        while len(rows):
            found = self.keys[at]
            hit = found == key[rows]
            out[rows[hit]] = self.values[at[hit]]
            go = ~hit & (found >= 0)
            rows, at = rows[go], (at[go] + np.uint64(1)) & np.uint64(len(self.keys) - 1)
        return out

    def __call__(self, tokens: np.ndarray, size: np.ndarray) -> list[bytes]:
        """Little-endian 32-bit ids of words, given as their first tokens side by side and their sizes.

        Words of up to ``ROW`` tokens are merged side by side, those of one length class in the rows
        of one array; longer ones have a heap of their own."""
        out: list[bytes | None] = [None] * len(size)
        start = np.cumsum(size) - size
        low = 0
        for width in (8, 16, ROW):
            rows = np.flatnonzero((size > low) & (size <= width))
            for k in range(0, len(rows), TOGETHER):
                some = rows[k:k + TOGETHER]
                for i, ids in zip(some.tolist(), self.side_by_side(tokens, start[some], size[some], width)):
                    out[i] = ids
            low = width
        for i in np.flatnonzero(size > low).tolist():
            out[i] = self.alone(tokens[start[i]:start[i] + size[i]])
        for i in np.flatnonzero(size == 0).tolist():
            out[i] = b""
        return out

    def side_by_side(self, tokens: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> list[bytes]:
        """A row of ``width`` slots a word. The slots' entries are the leaves of the row's heap, a
        tournament of pairwise minima whose root is the next merge; all rows take a step at once."""
        m = len(size)
        slot = np.arange(width)
        inside = slot < size[:, None]
        tok = np.full((m, width), -1, np.int64)
        tok[inside] = tokens[(start[:, None] + slot)[inside]]
        heap = np.full((m, width), NONE, np.int64)
        pair = inside[:, 1:]
        rank = self.ranks(tok[:, :-1][pair], tok[:, 1:][pair])
        heap[:, :-1][pair] = np.where(rank >= 0, rank << 8 | np.nonzero(pair)[1], NONE)
        # links have a slot more on either side, so that the ends need no special case
        after = np.tile(np.arange(1, width + 3), (m, 1))
        before = np.tile(np.arange(-1, width + 1), (m, 1))
        live = np.arange(m)
        flat_tok, flat_heap, flat_after, flat_before = (x.reshape(-1) for x in (tok, heap, after, before))
        while len(live):
            level = heap[live]
            while level.shape[1] > 1:
                half = level.shape[1] // 2
                level = np.minimum(level[:, :half], level[:, half:])
            top = level[:, 0]
            live, top = live[top < NONE], top[top < NONE]
            at, new = top & 0xFF, self.made[top >> 8]
            base, link = live * width, live * (width + 2) + 1
            right = flat_after[link + at] - 1
            beyond = flat_after[link + right] - 1
            flat_tok[base + at] = new
            flat_tok[base + right] = -1
            flat_heap[base + right] = NONE
            flat_after[link + at] = beyond + 1
            flat_before[link + beyond] = at + 1
            left = flat_before[link + at] - 1
            there = beyond < size[live]
            following = np.full(len(live), -1, np.int64)
            following[there] = self.ranks(new[there], flat_tok[(base + beyond)[there]])
            flat_heap[base + at] = np.where(following >= 0, following << 8 | at, NONE)
            there = left >= 0
            prior = self.ranks(flat_tok[(base + left)[there]], new[there])
            flat_heap[(base + left)[there]] = np.where(prior >= 0, prior << 8 | left[there], NONE)
        keep = tok >= 0
        raw = tok[keep].astype("<u4").tobytes()
        end = (4 * np.cumsum(keep.sum(axis=1))).tolist()
        return [raw[i:j] for i, j in zip([0, *end], end)]

    def alone(self, tokens: np.ndarray) -> bytes:
        """The same for one word of any length: a heap whose stale entries are dropped when met."""
        pairs, shift, made, n = self.pairs.get, self.shift, self.made_list, len(tokens)
        tok = tokens.tolist()
        rank_at = [*self.ranks(tokens[:-1], tokens[1:]).tolist(), -1]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r << 32 | k for k, r in enumerate(rank_at) if r >= 0]
        heapify(heap)
        while heap:
            top = heappop(heap)
            at, rank = top & 0xFFFFFFFF, top >> 32
            if rank_at[at] != rank:  # either end has been merged into another since
                continue
            right = after[at]
            after[at] = beyond = after[right]
            tok[at] = new = made[rank]
            tok[right] = rank_at[right] = rank_at[at] = -1
            if beyond < n:
                before[beyond] = at
                r = pairs(new << shift | tok[beyond])
                if r is not None:
                    rank_at[at] = r
                    heappush(heap, r << 32 | at)
            left = before[at]
            if left >= 0:
                rank_at[left] = r = pairs(tok[left] << shift | new, -1)
                if r >= 0:
                    heappush(heap, r << 32 | left)
        return array("I", [t for t in tok if t >= 0]).tobytes()
