import math

import numpy as np
import pytest

from breachscope.llm import whitening

FIELDS = "vec_id long, embedding array<float>, label int"


def frame(spark, vectors, first=0):
    rows = [(first + i, None if v is None else [None if c is None else float(c) for c in v], 1) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, FIELDS)


def plain(vectors):
    """Whole vectors, their distinct list, and its covariance by definition."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    distinct = np.array(sorted(set(map(tuple, x))))
    off = distinct - distinct.mean(axis=0)
    return np.array(x), distinct, off.T @ off / len(distinct)


def checked(spark, vectors, extra=(), components=16):
    rows = frame(spark, [*vectors, *extra])
    found = whitening.whiten(rows, whitening.fit(rows, components=components)).collect()
    x, distinct, cov = plain(vectors)
    n, sums = len(distinct), [int(s) for s in distinct.sum(axis=0)]
    values, directions = np.linalg.eigh(cov)
    order = np.argsort(-values)
    k = min(components, int((values > 1e-9 * values.max()).sum()))
    values, directions = values[order[:k]], directions[:, order[:k]]
    assert len(found) == len(vectors) * k
    expected = (x - distinct.mean(axis=0)) @ directions / np.sqrt(values)
    got = np.zeros((len(vectors), k))
    for r in found:
        i, c = r["vec_id"], r["component"] - 1
        got[i, c] = r["whitened"]
        assert r["n"] == n
        assert r["deviation"] == sum((n * int(a) - s) ** 2 for a, s in zip(x[i], sums))
        assert r["explained"] == pytest.approx(values[c] / np.trace(cov), rel=1e-9)
        assert r["identity_error"] < 1e-8
    return got, expected, values


def test_components_agree_with_a_dense_solver(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((120, 24)) * np.linspace(0.2, 1, 24)
    vectors = np.concatenate((vectors, vectors[:30], vectors[:1].repeat(50, axis=0)))  # copies count once
    bad = [None, [], [1.0] * 23 + [None], [1.0] * 23 + [float("nan")], [float("-inf")] + [1.0] * 23]
    got, expected, _ = checked(spark, vectors, bad)
    sign = np.sign((got * expected).sum(axis=0))
    assert np.allclose(got * sign, expected, atol=1e-9)


def test_a_low_rank_and_values_of_equal_size(spark):
    rng = np.random.default_rng(2)
    low = np.round(rng.standard_normal((80, 3)) * 64) / 64 @ np.array([[1, 0, 0, 1, 2, 0], [0, 1, 0, 1, 0, 3], [0, 0, 1, 0, 1, 1.0]])
    got, expected, values = checked(spark, low)
    assert got.shape[1] == 3
    assert np.allclose(got * np.sign((got * expected).sum(axis=0)), expected, atol=1e-8)
    # Every sign pattern once: all variances are equal, any basis is right.
    cube = np.array([[(i >> b & 1) * 2 - 1 for b in range(6)] for i in range(64)], float)
    got, expected, values = checked(spark, cube)
    assert got.shape[1] == 6 and np.allclose(values, values[0])
    assert np.allclose(got @ got.T, expected @ expected.T, atol=1e-8)


def test_stops_early_where_the_rest_cannot_matter(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((200, 40)) * np.concatenate(([60, 40, 25], np.full(37, 1 / 64)))
    passes = []
    sums = whitening._sums
    monkeypatch.setattr(whitening, "_sums", lambda *a: passes.append(1) or sums(*a))
    got, expected, _ = checked(spark, vectors, components=2)
    assert np.allclose(got * np.sign((got * expected).sum(axis=0)), expected, atol=1e-8)
    assert len(passes) < 30


def test_nothing_one_vector_and_null_ids(spark):
    empty = frame(spark, [])
    assert whitening.whiten(empty, whitening.fit(empty)).count() == 0
    same = frame(spark, [[1.0, 2.0]] * 3)
    assert whitening.whiten(same, whitening.fit(same)).count() == 0
    rows = spark.createDataFrame(
        [(None, [0.0, 1.0], 1), (7, [1.0, 0.5], 2), (7, [1.0, 0.5], 2)], FIELDS
    ).selectExpr("*", "1 AS component", "2 AS n", "'x' AS x", "0 AS i", "0 AS v")
    found = whitening.whiten(rows, whitening.fit(rows)).collect()
    assert sorted((str(r["vec_id"]), r["component"], r["n"]) for r in found) == [("7", 1, 2), ("7", 1, 2), ("None", 1, 2)]
    with pytest.raises(ValueError, match="1 to 2 entries"):
        whitening.fit(frame(spark, [[1.0], [1.0, 2.0]]))


def test_deviations_beyond_64_bits_are_not_wrapped():
    x = np.array([[2**40, 0]], dtype=np.int64)
    with pytest.raises(OverflowError):
        import pyarrow as pa

        pa.array(whitening._deviations(x, 10**6, np.array([0, 0])), pa.int64())
    assert whitening._deviations(np.array([[3, 5]]), 4, np.array([2, 2])) == [100 + 324]
