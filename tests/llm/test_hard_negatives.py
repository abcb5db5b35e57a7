import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from breachscope.llm import hard_negatives as hn

FIELDS = "vec_id long, embedding array<double>, label int"


def plain(rows, every=100, rule=hn.Rule()):
    """By definition, from all pairs."""
    used = []
    for i, v, label in rows:
        if label is not None and v and all(c is not None and math.isfinite(c) for c in v):
            used.append((i, label, [math.floor(256 * c) for c in v]))
    last = float("inf")
    out = []
    for n, (i, label, q) in enumerate(used):
        if i is None or i % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(q, x)), last if j is None else j, same_row, lab == label)
            for same_row, (j, lab, x) in enumerate(used)
            if same_row != n
        ]
        scored.sort()
        for s, p, *_ in [x for x in scored if x[3]][: rule.positives]:
            inside = [x for x in scored if not x[3] and rule.low * -s <= 100 * -x[0] <= rule.high * -s]
            for rank, (t, j, *_) in enumerate(inside[: rule.negatives], 1):
                out.append((i, None if p == last else p, rank, None if j == last else j, -s, -t))
    return sorted(out, key=str)


def mined(spark, rows, every=100, **options):
    frame = spark.createDataFrame(rows, FIELDS).selectExpr("*", "1 AS place", "'x' AS q", "2 AS node", "3 AS w", "4 AS rank")
    found = hn.mine(frame, F.col("vec_id") % every == 0, **options).collect()
    return sorted((tuple(r) for r in found), key=str)


def test_all_pairs_agree_over_many_chunks_and_blocks(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(6) * rng.uniform(0.2, 2)).tolist(), int(rng.integers(4))) for i in range(700)]
    hot = rng.standard_normal(6).tolist()
    rows += [(700 + i, hot, 1 + i % 2) for i in range(300)]  # one vector, two labels
    rows += [(1100 + i, [0.0] * 6, 1) for i in range(30)]  # ties at zero
    rows += [(1200, None, 1), (1201, [], 1), (1202, [1.0] * 5 + [None], 1), (1203, [float("nan")] * 6, 2), (1300, hot, None)]
    rows += [(None, rng.standard_normal(6).tolist(), 1), (None, hot, 1), (800, hot, 3), (100, rows[100][1], rows[100][2])]
    expected = plain(rows, 50)
    assert len(expected) > 500
    assert mined(spark, rows, 50, chunk_rows=64, block_anchors=7) == expected
    assert mined(spark, rows, 50) == expected


def test_few_rows_none_and_one_label(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 0.1], 1), (2, [-1.0, 0.0], 1), (3, [0.25, 0.5], 2), (100, [0.5, 0.5], 2)]
    assert mined(spark, rows) == plain(rows) != []
    assert mined(spark, rows[:3]) == []
    assert mined(spark, []) == []
    assert mined(spark, [(0, None, 1)]) == []
    with pytest.raises(ValueError, match="1 to 2 entries"):
        mined(spark, [(0, [1.0], 1), (1, [1.0, 2.0], 1)])


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 300), st.integers(1, 5), st.integers(1, 4))
def test_descent_finds_what_a_full_scan_finds(seed, n, dims, spread):
    rng = np.random.default_rng(seed)
    points = rng.integers(-spread, spread + 1, (n, dims))
    labels, places = rng.integers(0, 3, n), np.arange(n)
    length = max(float(np.sqrt((points * points).sum(axis=1).max())), 1.0)
    tree = hn.Tree.built(points, labels, places, length)
    tree = hn.Tree.unpacked(tree.pack(), length)
    anchors = rng.integers(-spread, spread + 1, (6, dims))
    low = rng.integers(-4, 3, (6, 2))
    high = low + rng.integers(-1, 6, (6, 2))
    for same in (True, False):
        got = set(zip(*(c.tolist() for c in hn.descend(tree, anchors, labels[:1].repeat(6), np.arange(6), low, high, 4, same))))
        expected = set()
        for a in range(6):
            scores = points @ anchors[a]
            for w in range(2):
                ok = (low[a, w] <= scores) & (scores <= high[a, w]) & ((labels == labels[0]) == same) & (places != a)
                by = sorted(np.flatnonzero(ok), key=lambda j: (-scores[j], j))[:4]
                expected |= {(a, w, int(scores[j]), int(j)) for j in by}
        assert got == expected


def test_nodes_bound_what_lies_below_them():
    rng = np.random.default_rng(6)
    points = rng.integers(-50, 50, (900, 8))
    length = float(np.sqrt((points * points).sum(axis=1).max()))
    tree = hn.Tree.built(points, np.zeros(900, int), np.arange(900), length)
    assert len(tree.levels) > 2 and len(tree.centres) == 29
    anchors = rng.integers(-50, 50, (20, 8))
    theta, scale = hn.angles_to(anchors, points[tree.centres], length)
    leaf = np.repeat(np.arange(len(tree.centres)), np.diff(tree.first))
    node = leaf
    for parent, radius in reversed(tree.levels):
        up, down = hn.bounds(theta[:, : len(radius)], radius, scale)
        score = anchors @ points[tree.order].T
        assert (score <= up[:, node]).all() and (score >= down[:, node]).all()
        node = parent[node]
    # Where vectors lie close together, most nodes are left out.
    close = np.repeat(rng.integers(-300, 300, (30, 8)), 60, axis=0) + rng.integers(-2, 3, (1800, 8))
    length = float(np.sqrt((close * close).sum(axis=1).max()))
    tree = hn.Tree.built(close, np.arange(1800) % 2, np.arange(1800), length)
    looked = []
    scores = hn._scores
    hn._scores = lambda a, b, exact: looked.append(len(a) * len(b)) or scores(a, b, exact)
    try:
        any_score = np.full((20, 1), hn._NO_LIMIT)
        hn.descend(tree, close[:20], np.zeros(20, int), np.arange(20), -any_score, any_score, 5, True)
    finally:
        hn._scores = scores
    assert sum(looked) < 0.3 * 20 * 1800
    with pytest.raises(OverflowError):
        big = np.full((2, 1), 2**31)
        t = hn.Tree.built(big, np.zeros(2, int), np.arange(2), 2.0**31)
        hn.descend(t, big, np.zeros(2, int), np.arange(2), -any_score[:2], any_score[:2], 1, True)
