"""Bin completion: fillings against all sums, plans against all packings of a few pieces."""
from collections import Counter

import numpy as np
import pytest
from test_documents import exact_bins

from tessera.llm import packing


def used(rows):
    return max((r[3] + (r[2] - r[1]) // r[4] for r in rows), default=0)


@pytest.mark.parametrize("seed", [6, 7, 8, 9])
def test_plans_of_a_few_pieces_are_optimal(seed):
    rng = np.random.default_rng(seed)
    for _ in range(40):
        sizes = sorted(rng.integers(1, 21, 9).tolist(), reverse=True)
        rows = packing.plan(Counter(sizes), 20)
        assert used(rows) == exact_bins(sizes, 20) and sum(r[2] - r[1] for r in rows) == len(sizes)


def test_search_beats_a_poor_incumbent():
    counts = {6: 2, 5: 2, 4: 4, 3: 2, 2: 2}  # 48 in capacity 12: four sequences, no waste
    found = packing.improved(counts, 12, 6, 4)
    assert found is not None and len(found) <= 5
    total = Counter()
    for s in found:
        assert sum(size * k for size, k in s.items()) <= 12
        total.update(s)
    assert total == Counter(counts)
    assert packing.improved(counts, 12, 4, 4) is None  # nothing below the bound


def test_fullest_by_all_sums():
    rng = np.random.default_rng(1)
    for _ in range(200):
        counts = np.zeros(41, np.int64)
        for x in rng.integers(1, 41, 8):
            counts[x] += rng.integers(1, 4)
        room, sums = int(rng.integers(1, 41)), {0}
        for x in np.flatnonzero(counts):
            for _ in range(counts[x]):
                sums |= {y + int(x) for y in sums}
        got = packing.fullest(counts, room)
        assert sum(a * b for a, b in got) == max(x for x in sums if x <= room) and all(b <= counts[a] for a, b in got)


def test_branch_limit_does_not_change_the_filling(monkeypatch):
    """Past the limit on branches the sums of bits give the same waste."""
    rng = np.random.default_rng(2)
    monkeypatch.setattr(packing, "BRANCHES", 1)
    for _ in range(60):
        counts = np.zeros(61, np.int64)
        for x in rng.integers(7, 61, 9):
            counts[x] += 1
        got = packing.complete(counts, 60)
        assert sum(a * b for a, b in got) == sum(a * b for a, b in packing.fullest(counts, 60))


def test_dominated_fillings_are_left_out():
    counts = np.zeros(11, np.int64)
    counts[[3, 4, 7]] = 1
    # 7 may stand for 3 and 4 together, and any less full one may take more
    assert [x for _, x in packing.undominated(counts, 7, 7)] == [[(7, 1)]]
    assert [w for w, _ in packing.undominated(counts, 10, 10)] == [0]


def test_search_does_not_depend_on_the_number_of_sequences():
    """The same search below the incumbent, whether 14 sequences are left or 5000 full ones stand beside them."""
    counts = {7: 2, 8: 1, 11: 1, 13: 2, 14: 4, 15: 2, 16: 1, 17: 3, 19: 4, 20: 1, 24: 3, 25: 1, 26: 2, 27: 2, 28: 1, 31: 1,
              33: 1, 35: 1}
    assert used(packing.plan(counts, 50)) == 13
    assert used(packing.plan({**counts, 50: 5000}, 50)) == 5013
    many = {6: 4000, 5: 4000, 4: 8000, 3: 4000, 2: 4000}
    found = packing.improved(many, 12, 8002, 8000)
    assert found is not None and len(found) <= 8001
    total = Counter()
    for use, times in packing.fewer(many, 12, 8002):
        assert sum(size * k for size, k in use.items()) <= 12
        total.update({size: k * times for size, k in use.items()})
    assert total == Counter(many)
