"""Passages: which members of a crowded run are looked up again."""

import numpy as np

from tidelake.llm import passages


def test_only_members_without_a_root_are_looked_up(spark):
    span = lambda *parts: np.concatenate([np.arange(*p) for p in parts]).astype(np.uint64).tobytes()
    rows = [  # run, id, rest, need, span
        (1, 1, False, 40, span((0, 60))), (1, 2, False, 40, span((900, 960))),  # have a root: stay, whatever they share
        (1, 3, True, 40, span((0, 40), (300, 320))),  # 40 in common with 1
        (1, 4, True, 40, span((0, 39), (400, 421))),  # 39 only
        (1, 5, True, 40, span((0, 20), (900, 920))),  # 20 with each of two others
        (1, 6, True, 40, span((0, 20), (0, 20), (500, 520))),  # 20, twice each
        (2, 7, True, 40, span((0, 60))), (2, 8, True, 40, span((1000, 1060))), (2, 9, True, 40, span((1000, 1060))),  # another run
        (3, 10, True, 40, span((0, 60))), (3, 10, True, 40, span((0, 60))),  # one text twice
    ]
    d = spark.createDataFrame([(r[0], i, *r[1:]) for i, r in enumerate(rows)], "__band long, __node long, __id long, __rest boolean, __need long, __span binary")
    got = passages._promising(d)
    assert set(got.columns) == set(d.columns) and sorted(r["__id"] for r in got.collect()) == [1, 2, 3, 5, 8, 9]
