"""Memory of a task of operator 1: what it holds for hashing does not follow the size of an Arrow batch."""

import tracemalloc

import numpy as np

from portal_metrics.llm import suffix_dedup as S


def test_runs_are_found_in_small_slices():
    rng = np.random.default_rng(7)
    data = rng.integers(97, 123, 8 << 20).astype(np.uint8)
    # short texts, and one longer than a part
    offsets = np.concatenate([np.arange(0, 3 << 20, 4000), [3 << 20, 8 << 20]])
    tracemalloc.start()
    found = 0
    for i, j, parts in S._parts(offsets, S.LENGTH):
        for s, e, skipped in parts:
            assert e - s <= S.SLICE or j - i == 1 and e - s < S.PART + S.LENGTH
            own = np.array([0, e - s]) if j - i == 1 else offsets[i:j + 1] - s
            found += int(S.runs_of(data[s:e], own, S.LENGTH, S.GRAM)[2].sum())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == int(np.maximum(np.diff(offsets) - S.LENGTH + 1, 0).sum())     # every window is in one run
    assert peak < 250e6, peak
