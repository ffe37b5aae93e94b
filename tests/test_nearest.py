"""Nearest centre: the same answer from both strategies, whatever the offset."""

import numpy as np
import pytest
from pyspark.errors import PySparkException

from vigil.operators import clustering
from vigil.operators.clustering import Centers, assign_clusters, nearest_rows


def exact(x, c):
    d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


@pytest.mark.parametrize("k", [32, 33, 150])
@pytest.mark.parametrize("offset", [0.0, 1e9, -1e12])
def test_rows_near_large_values(k, offset):
    rng = np.random.default_rng(k)
    c = offset + 3.0 * rng.permutation(np.arange(2 * k, dtype=float)).reshape(k, 2)
    x = c[rng.integers(k, size=200)] + rng.integers(-1, 2, size=(200, 2))
    sq, best = nearest_rows(x, c)
    want, dist = exact(x, c)
    assert (best == want).all() and np.allclose(sq, dist, rtol=1e-12)


def test_mixed_scales_and_ties():
    c = np.array([[1e9, 0.0], [1e9, 2.0], [-1e9, 0.0], [1e9, 0.0]])
    x = np.array([[1e9, 1.0], [1e9, 0.4], [-1e9, 5.0], [0.0, 0.0]])
    assert nearest_rows(x, c)[1].tolist() == exact(x, c)[0].tolist() == [0, 0, 2, 0]


def test_strategies_agree(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [((1e9 + rng.integers(0, 60, 2)).tolist(),) for _ in range(90)] + [(None,), ([None, 1.0],), ([float("nan"), 1.0],)]
    df = spark.createDataFrame(rows, "features ARRAY<DOUBLE>")
    centers = Centers(1e9 + 3.0 * np.arange(32).reshape(16, 2))
    got = []
    for limit in (64, 0):
        monkeypatch.setattr(clustering, "EXPRESSION_LIMIT", limit)
        got.append([(r["cluster"], r["distance"]) for r in assign_clusters(df, centers, distance_col="distance").collect()])
    assert got[0] == got[1]
    assert got[0][-3:] == [(None, None)] * 3
    bad = spark.createDataFrame([([1.0],)], "features ARRAY<DOUBLE>")
    for limit in (64, 0):
        monkeypatch.setattr(clustering, "EXPRESSION_LIMIT", limit)
        with pytest.raises(PySparkException):
            assign_clusters(bad, centers).collect()
