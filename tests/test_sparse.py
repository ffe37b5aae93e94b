"""Sparse one-hot rows against the dense ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators import clustering, features, sparse
from vigil.operators.clustering import Centers


def lines_of(spark, n=300, seed=3):
    rng = random.Random(seed)
    rows = [f"{rng.choice([0, 1.5, -2])},{rng.choice('ab')},s{rng.randrange(40)},{rng.choice('xyz')},{rng.randrange(3)},7,{rng.choice('lm')}" for _ in range(n)]
    return spark.createDataFrame([(r,) for r in rows], "value STRING").repartition(3)


def densified(rows, dim):
    out = []
    for r in rows:
        x = np.zeros(dim)
        x[r["idx"]] = r["val"]
        assert list(r["idx"]) == sorted(r["idx"]) and all(v != 0 for v in r["val"])
        out.append((r["value"], r["label"], tuple(x)))
    return sorted(out)


def test_cells_are_those_of_the_dense_rows(spark):
    lines = lines_of(spark)
    index = sparse.category_index(lines)
    assert sorted(map(tuple, index.collect())) == sorted(map(tuple, features.category_dictionary(lines).collect()))
    rows, layout = sparse.sparse_one_hot(lines, index, keep_line=True)
    dense = features.one_hot_features(lines, keep_line=True).collect()
    assert layout.dim == len(dense[0]["features"])
    assert densified(rows.collect(), layout.dim) == sorted((r["value"], r["label"], tuple(r["features"])) for r in dense)


@pytest.mark.parametrize("limit", [10**9, 0])
def test_statistics_and_distances_are_those_of_the_dense_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(sparse, "TASK_CELLS", limit)
    lines = lines_of(spark)
    rows, layout = sparse.sparse_one_hot(lines, sparse.category_index(lines), keep_line=True)
    dense = features.one_hot_features(lines, keep_line=True)
    stats = features.Stats.fit(dense)
    mean, sd = np.zeros(layout.dim), np.zeros(layout.dim)
    for r in sparse.sparse_stats(rows).collect():
        mean[r["dim"]], sd[r["dim"]] = r["mean"], r["sd_pop"]
        assert r["n"] == 300
    assert np.allclose(mean, stats.mean) and np.allclose(sd, stats.sd, atol=1e-9)
    z = features.zscore(dense, stats)
    centers = Centers(np.array([r["features"] for r in z.limit(9).collect()]) + 0.01)
    want = {r["value"]: (r["cluster"], r["d"]) for r in clustering.assign_clusters(z, centers, distance_col="d").collect()}
    got = sparse.sparse_assign(rows, layout, centers, stats.mean, stats.sd).collect()
    assert len(got) == 300
    for r in got:
        assert r["cluster"] == want[r["value"]][0] and r["distance"] == pytest.approx(want[r["value"]][1], abs=1e-6)


def test_unseen_categories_and_bad_numbers(spark):
    index = sparse.category_index(spark.createDataFrame([("1,a,b,c,2,l",)], "value STRING"))
    lines = spark.createDataFrame([("1,a,b,c,2,l",), ("0,a,new,c,3,l",), ("x,a,b,c,0,l",)], "value STRING")
    with pytest.raises(Exception, match="unseen category in field 2: new"):
        sparse.sparse_one_hot(lines, index, mode="permissive")[0].collect()
    kept, layout = sparse.sparse_one_hot(lines, index, mode="permissive", handle_invalid="keep", keep_line=True)
    got = {r["value"]: (r["idx"], r["val"]) for r in kept.collect()}
    assert layout.dim == 5 and got["0,a,new,c,3,l"] == ([1, 3, 4], [1.0, 1.0, 3.0])
    assert got["x,a,b,c,0,l"] == ([0, 1, 2, 3], [None, 1.0, 1.0, 1.0])
    left, _ = sparse.sparse_one_hot(lines, index, mode="permissive", handle_invalid="skip", keep_line=True)
    assert {r["value"] for r in left.collect()} == {"1,a,b,c,2,l", "x,a,b,c,0,l"}
    out = sparse.sparse_assign(kept, layout, Centers(np.zeros((2, 5))), [0.0] * 5, [1.0] * 5).collect()
    assert {r["value"]: r["cluster"] for r in out}["x,a,b,c,0,l"] is None
    with pytest.raises(Exception, match="not 6 fields"):
        sparse.sparse_one_hot(spark.createDataFrame([("1,a,b,c,2,l",), ("1,a,b,c,2,9,l",)], "value STRING"), index)[0].collect()


def test_a_million_categories_in_one_field(spark):
    n = 1_000_000
    lines = spark.range(0, n, 1, 8).select(F.concat(F.lit("1,a,s"), F.lpad(F.col("id").cast("string"), 7, "0"), F.lit(",c,2,l")).alias("value"))
    index = sparse.category_index(lines)
    wrong = index.filter("field = 2").filter(F.substring("category", 2, 7).cast("int") != F.col("idx"))
    assert index.filter("field = 2").count() == n and wrong.count() == 0
    rows, layout = sparse.sparse_one_hot(lines, index)
    assert layout.dim == n + 4
    assert rows.agg(F.min(F.size("idx")), F.max(F.size("idx")), F.countDistinct(F.col("idx")[2])).first() == (5, 5, n)
