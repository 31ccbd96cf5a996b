"""Passages: what is left undone where it can't lead to a passage, and that the short ways give what the long ones do."""

import numpy as np
import pytest

from tidelake.llm import passages


def test_stretches_that_cannot_be_similar_are_not_aligned(monkeypatch):
    def never(*_):
        raise AssertionError("aligned, or hashed again, in vain")

    x = np.arange(200, dtype=np.uint64)
    y = np.where(np.arange(200) % 3 > 0, 10_000 + x, x).astype(np.uint64)  # every third one in common
    monkeypatch.setattr(passages, "_chain", never)
    monkeypatch.setattr(passages, "_long_runs", never)
    assert passages.passages(x, y, (0, 199, 0, 199), 46, 80) == []
    monkeypatch.undo()
    (start, end, start2, end2, _), *more = passages.passages(x, np.concatenate([x[:46], y[46:]]), (0, 199, 0, 199), 46, 80)
    assert start == start2 == 0 and end >= 45 and end2 >= 45 and not more


@pytest.mark.parametrize("similarity", [50, 80, 95])
def test_what_may_be_similar_equals_brute_force(similarity):
    rng, seen = np.random.default_rng(similarity), set()
    for share in np.linspace(0.3, 1, 200):
        at = np.flatnonzero(rng.random(60) < share) + 7
        want = any(100 * (j - i + 1) >= similarity * (at[j] - at[i] + 1) for i in range(len(at)) for j in range(i, len(at)) if at[j] - at[i] + 1 >= 20)
        assert passages._may_be_similar(at, 20, similarity) == want
        seen.add(want)
    assert seen == {True, False} and not passages._may_be_similar(np.zeros(0, np.int64), 20, similarity)


def plain_chain(x, y):
    """One place after another."""
    at, where, shift = [], [], 0
    for i, code in enumerate(x.tolist()):
        own = np.flatnonzero(y == code)
        if len(own):
            at.append(i)
            where.append(int(own[np.argmin(np.abs(own - i - shift))]))
            shift = where[-1] - i
    at, where, gap = np.array(at, np.int64), np.array(where, np.int64), passages.GAP
    while len(at):
        shifts = where - at
        cut = np.flatnonzero(np.append(True, np.abs(np.diff(shifts)) > 2 * gap))
        ends, stray = np.append(cut[1:], len(at)), np.zeros(len(at), bool)
        for k in range(1, len(cut) - 1):
            if ends[k] - cut[k] <= gap and abs(shifts[cut[k] - 1] - shifts[ends[k]]) <= 2 * gap and not stray[cut[k] - 1]:
                stray[cut[k] : ends[k]] = True
        if not stray.any():
            break
        at, where = at[~stray], where[~stray]
    return at, where


def test_chains_equal_those_taken_place_by_place():
    rng = np.random.default_rng(5)
    for codes in (3, 30, 150, 400) * 20:
        x = rng.integers(0, codes, 150)
        y = np.concatenate([rng.integers(0, codes, int(rng.integers(0, 90))), np.where(rng.random(150) < 0.2, codes + 1, x), x[:40]])
        for one, two in ((x, y), (y, x), (x, y[:0]), (x[:0], y)):
            assert [g.tolist() for g in passages._chain(one, two)] == [w.tolist() for w in plain_chain(one, two)]


def test_first_rows_and_repeated_values():
    rng = np.random.default_rng(6)
    for n in (0, 1, 2, 300):
        a, b = rng.integers(0, 9, n), rng.integers(0, 9, n).astype(np.uint64)
        assert sorted(passages._firsts(a, b)) == sorted(np.unique(np.stack([a.astype(np.uint64), b], 1), axis=0, return_index=True)[1])
        assert passages._repeated(a * 40).tolist() == [i for i in range(n) if np.count_nonzero(a == a[i]) > 1]
