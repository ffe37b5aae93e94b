"""The sweeps of k on one-hot records run as many iterations as the original jobs' fits."""

import hashlib

import numpy as np
import pytest

from vigil.plans import catalog
from vigil.sources import records

ITERATIONS = 20  # of a fit of the original jobs, at most


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """1,500 line items of 400 orders."""
    root = str(tmp_path_factory.mktemp("sweeps"))
    rng = np.random.default_rng(11)
    items = [(int(o), float(q), "ANR"[o % 3], "FO"[o % 2], int(n), round(float(p), 2), float(d) / 100, float(t) / 100)
             for o, q, n, p, d, t in zip(rng.integers(0, 400, 1500), rng.integers(1, 51, 1500), rng.integers(1, 8, 1500),
                                         rng.uniform(900, 99000, 1500), rng.integers(0, 11, 1500), rng.integers(0, 9, 1500))]
    spark.createDataFrame(items, "l_orderkey long, l_quantity double, l_returnflag string, l_linestatus string, l_linenumber int, "
                          "l_extendedprice double, l_discount double, l_tax double").write.parquet(f"{root}/lineitem.parquet")
    orders = [(o, "FOP"[int(rng.integers(0, 3))]) for o in range(400)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string").write.parquet(f"{root}/orders.parquet")
    return root


def fitted(spark, tables, k):
    """(labels, cluster of each row, mean distance) after the Lloyd steps, in numpy."""
    rows = catalog._z_one_hot(records.record_lines(spark, tables)).collect()
    x = np.array([r["features"] for r in rows])
    first = {}
    for i, r in enumerate(rows):
        first.setdefault(r["value"], i)
    starts = sorted(first, key=lambda v: hashlib.md5(v.encode()).hexdigest())[:k]
    centers = x[[first[v] for v in starts]]
    for _ in range(ITERATIONS):
        best = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        centers = np.array([x[best == c].mean(axis=0) if (best == c).any() else centers[c] for c in range(k)])
    d2 = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2)
    return np.array([r["label"] for r in rows]), d2.argmin(axis=1), np.sqrt(d2.min(axis=1)).mean()


def test_entropy_is_that_of_whole_fits(spark, tables):
    got = {r["k"]: r["score"] for r in catalog.QUERIES["sweep_records_entropy"](spark, tables).collect()}
    assert sorted(got) == list(range(80, 161, 10))
    for k in (80, 160):
        labels, cluster, _ = fitted(spark, tables, k)
        total = 0.0
        for c in np.unique(cluster):
            _, n = np.unique(labels[cluster == c], return_counts=True)
            total -= (n * np.log(n / n.sum())).sum()
        assert got[k] == pytest.approx(total / len(labels), abs=2e-6)


def test_mean_distance_is_that_of_whole_fits(spark, tables):
    got = {r["k"]: r["score"] for r in catalog.QUERIES["sweep_records_one_hot"](spark, tables).collect()}
    assert sorted(got) == list(range(80, 161, 10))
    for k in (80, 160):
        assert got[k] == pytest.approx(fitted(spark, tables, k)[2], abs=2e-6)
