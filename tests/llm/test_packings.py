"""Whole packings against the fewest bins."""

from __future__ import annotations

import random
import time
from collections import Counter

from layerloom.llm import packing
from test_operators import best_bins


def bins_of(sizes: list[int], capacity: int) -> int:
    places = packing.plan_bins(dict(Counter(sizes)), capacity)
    assert Counter({n: sum(p[2] * p[4] for p in places if p[0] == n) for n in set(sizes)}) == Counter(sizes)
    filled = Counter()
    for n, _, copies, offset, bins, first in places:
        for k in range(first, first + bins):
            assert filled[k] == offset
            filled[k] += n * copies
    assert max(filled.values()) <= capacity
    return len(filled)


def test_a_packing_of_three_bins_is_found():
    assert bins_of([12, 11, 10, 7, 7, 6, 4, 2], 20) == 3


def test_large_pieces_take_the_fewest_bins():
    rng = random.Random(12)
    for _ in range(300):
        sizes = sorted((rng.randint(2, 14) for _ in range(9)), reverse=True)
        assert bins_of(sizes, 20) == best_bins(sizes, 20)
        assert packing.best_blocks(dict(Counter(sizes)), 20)[1]


def test_the_search_ends():
    rng = random.Random(13)
    counts = Counter({n: rng.randint(1, 10**6) for n in rng.sample(range(500, 2049), 700)})
    start = time.time()
    blocks, _ = packing.best_blocks(counts)
    assert time.time() - start < 60
    packed = Counter()
    for filling, bins in blocks:
        packed.update({n: c * bins for n, c in filling.items()})
    assert packed == counts
