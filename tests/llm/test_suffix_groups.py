"""Groups of equal windows, held against a dictionary."""

import numpy as np
import pytest

from tilewright.llm import suffix_dedup as sd


@pytest.mark.parametrize("collide", [False, True])
def test_groups_of_equal_windows(monkeypatch, collide):
    """Also if strings that differ have one hash."""
    rng = np.random.default_rng(3)
    parts = [rng.integers(97, 99, 70).astype(np.uint8) for _ in range(12)]
    text = np.concatenate([parts[i] for i in rng.integers(0, 12, 60)])
    starts = np.arange(len(text) - sd.LENGTH + 1)
    if collide:
        monkeypatch.setattr(sd, "_BYTE", np.ones(256, np.uint64))
    at, first = sd.suffix_groups(text, starts)
    wanted = {}
    for s in starts.tolist():
        wanted.setdefault(text[s : s + sd.LENGTH].tobytes(), set()).add(s)
    found = [set(x.tolist()) for x in np.split(at, first[1:])]
    assert sorted(map(sorted, found)) == sorted(sorted(v) for v in wanted.values() if len(v) > 1)


def test_nothing_is_sorted_by_bytes(monkeypatch):
    """Seven sorts by eight bytes once; now one of hashes."""
    text = np.random.default_rng(1).integers(0, 255, 4000).astype(np.uint8)
    text = np.concatenate([text, text])
    monkeypatch.setattr(sd.np, "lexsort", None)
    at, first = sd.suffix_groups(text, np.arange(len(text) - sd.LENGTH + 1))
    assert len(first) == 4000 - sd.LENGTH + 1 and len(at) == 2 * len(first)
