"""Clustering, evaluation and anomaly micro-cases and invariants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from vigil.operators import anomaly, clustering, evaluation
from vigil.operators.clustering import Centers
from vigil.sources.records import embedding_vectors


def test_lloyd_step_sizes(spark):
    emb = embedding_vectors(spark, SF0001)
    c5 = Centers.from_rows(emb, "vec_id", k=5)
    sizes = dict(clustering.assign_clusters(emb, c5).groupBy("cluster").count().collect())
    assert [sizes[i] for i in range(5)] == [90, 93, 120, 101, 96]
    sums = clustering.cluster_sums(emb, c5)
    assert sums.filter(F.col("dim") == 0).agg(F.sum("m")).first()[0] == 500


@pytest.mark.parametrize("k", [2, 4])
def test_numpy_kernel_matches_expression(spark, k):
    emb = embedding_vectors(spark, SF0001).withColumn("features", F.slice("features", 1, 16))
    centers = Centers.from_rows(emb, "vec_id", k=k)
    old = clustering.EXPRESSION_LIMIT
    try:
        clustering.EXPRESSION_LIMIT = 64
        a = {r[0]: (r[1], r[2]) for r in clustering.distance_to_centroid(emb, centers)
             .select("vec_id", "cluster", "distance").collect()}
        clustering.EXPRESSION_LIMIT = 0
        b = {r[0]: (r[1], r[2]) for r in clustering.distance_to_centroid(emb, centers)
             .select("vec_id", "cluster", "distance").collect()}
    finally:
        clustering.EXPRESSION_LIMIT = old
    assert a.keys() == b.keys()
    for key in a:
        assert a[key][0] == b[key][0]
        assert a[key][1] == pytest.approx(b[key][1], rel=1e-12, abs=1e-12)


def test_nearest_is_argmin_by_brute_force(spark):
    emb = embedding_vectors(spark, SF0001)
    centers = Centers.from_rows(emb, "vec_id", k=7)
    rows = clustering.assign_clusters(emb, centers, distance_col="distance").collect()
    for r in rows[:100]:
        d = np.sqrt(((centers.values - np.array(r["features"])) ** 2).sum(axis=1))
        assert r["cluster"] == int(d.argmin())
        assert r["distance"] == pytest.approx(d.min())


def test_lloyd_matches_numpy(spark):
    emb = embedding_vectors(spark, SF0001)
    start = Centers.from_rows(emb, "vec_id", k=5)
    got = clustering.lloyd(emb, start, 2).values
    x = np.array([r[0] for r in emb.select("features").collect()])
    c = start.values.copy()
    for _ in range(2):
        a = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
        c = np.array([x[a == j].mean(axis=0) if (a == j).any() else c[j] for j in range(len(c))])
    assert np.allclose(got, c, atol=1e-12)


def test_kmeans_fit_invariants(spark):
    emb = embedding_vectors(spark, SF0001)
    fit = clustering.kmeans_fit(emb, k=4, runs=2, tol=1e-6, seed=3)
    assert fit.centers.k <= 4
    one = Centers(np.array([np.array([r[0] for r in emb.select("features").collect()]).mean(axis=0)]))
    sq = lambda c: clustering.assign_clusters(emb, c, distance_col="d").agg(
        F.sum(F.col("d") * F.col("d"))).first()[0]
    assert sq(fit.centers) <= sq(one) + 1e-9
    assert fit.cost == pytest.approx(sq(fit.centers), rel=1e-6)
    again = clustering.kmeans_fit(emb, k=4, runs=2, tol=1e-6, seed=3)
    assert np.allclose(again.centers.values, fit.centers.values)


def test_degenerate_fit(spark):
    df = spark.createDataFrame([([1.0, 2.0],)] * 4, "features ARRAY<DOUBLE>")
    assert clustering.kmeans_fit(df, k=3).centers.k == 1


def test_sweep_k(spark):
    emb = embedding_vectors(spark, SF0001)
    out = clustering.sweep_k(emb, [2, 4], lambda df, k: Centers.from_rows(df, "vec_id", k=k),
                             clustering.mean_distance_score(), parallelism=2).collect()
    assert [r["k"] for r in out] == [2, 4]
    assert out[1]["score"] <= out[0]["score"]


def test_entropy_helpers(spark):
    assert evaluation.entropy_of_counts([1, 1]) == pytest.approx(math.log(2))
    assert evaluation.entropy_of_counts([4]) == 0.0
    df = spark.createDataFrame([(0, "a"), (0, "b"), (1, "a"), (1, "a")], "cluster INT, label STRING")
    assert evaluation.weighted_entropy(df).first()[0] == pytest.approx(0.346574, abs=1e-6)


def test_precision_by_threshold(spark):
    df = spark.createDataFrame([(0.9, 1), (0.9, 0), (0.5, 1), (0.1, 0)], "score DOUBLE, positive INT")
    expected = [(0.9, 0.5), (0.5, 2 / 3), (0.1, 0.5)]
    for rows_per_bucket in (2_000_000, 1):  # one bucket, and one score per bucket
        got = [(r[0], r[1]) for r in evaluation.precision_by_threshold(
            df, rows_per_bucket=rows_per_bucket).collect()]
        assert [g[0] for g in got] == [e[0] for e in expected]
        assert [g[1] for g in got] == pytest.approx([e[1] for e in expected])


def test_precision_buckets_agree_on_table(spark):
    emb = embedding_vectors(spark, SF0001)
    d = clustering.distance_to_centroid(emb, Centers.from_rows(emb, "vec_id", k=5))
    scored = d.select(F.round("distance", 3).alias("score"), (F.col("label") == 0).alias("positive"))
    one = [tuple(r) for r in evaluation.precision_by_threshold(scored).collect()]
    many = [tuple(r) for r in evaluation.precision_by_threshold(scored, rows_per_bucket=7).collect()]
    assert [a for a, _ in one] == [a for a, _ in many]
    assert [b for _, b in one] == pytest.approx([b for _, b in many])


def test_kth_largest(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (2.0,)], "distance DOUBLE")
    assert anomaly.kth_largest(df, rank=100).first()[0] == 1.0
    df = spark.createDataFrame([(5.0,), (4.0,), (4.0,), (3.0,)], "distance DOUBLE")
    t = anomaly.kth_largest(df, rank=2).first()[0]
    assert t == 4.0
    assert [r[0] for r in df.filter(F.col("distance") > t).collect()] == [5.0]


def test_anomaly_detector_flags_at_most_rank_minus_one(spark):
    lines = spark.createDataFrame(
        [(f"{i % 7},{'tcp' if i % 3 else 'udp'},http,SF,{(i * 37) % 11},{i % 5},lbl",)
         for i in range(300)], "value STRING")
    det = anomaly.fit_anomaly_detector(lines, k=3, rank=10, runs=1)
    flagged = anomaly.detect_anomalies(lines, det).collect()
    assert len(flagged) <= 9
    assert all(r["distance"] > det.threshold for r in flagged)
    top = anomaly.detect_anomalies(lines, det, top_n=2).collect()
    assert len(top) == min(2, len(flagged))


def test_lloyd_step_matches_mllib(spark):
    from pyspark.mllib.clustering import KMeans as MLlibKMeans
    from pyspark.mllib.clustering import KMeansModel as MLlibModel
    from pyspark.mllib.linalg import Vectors

    emb = embedding_vectors(spark, SF0001)
    start = Centers.from_rows(emb, "vec_id", k=5)
    ours = clustering.lloyd_step(emb, start).values
    rdd = emb.select("features").rdd.map(lambda r: Vectors.dense(r[0]))
    model = MLlibKMeans.train(rdd, 5, maxIterations=1,
                              initialModel=MLlibModel([Vectors.dense(c) for c in start.values]))
    theirs = np.array([np.asarray(c) for c in model.centers])
    assert np.abs(ours - theirs).max() < 1e-12


def test_fit_sizes_sum_and_seeded_matrix(spark):
    from vigil.operators import features

    emb = embedding_vectors(spark, SF0001)
    fit = clustering.kmeans_fit(emb, k=6, runs=2, seed=11)
    sizes = clustering.assign_clusters(emb, fit.centers).groupBy("cluster").count()
    assert {r[0]: r[1] for r in sizes.collect()} == fit.sizes and sum(fit.sizes.values()) == emb.count()
    a = features.projection_matrix(64, 3, seed=5)
    assert np.array_equal(a, features.projection_matrix(64, 3, seed=5))
    assert not np.array_equal(a, features.projection_matrix(64, 3, seed=6))


def test_precision_ignores_null_scores(spark):
    df = spark.createDataFrame([(0.9, 1), (None, 1), (0.5, 0)], "score DOUBLE, positive INT")
    for rows_per_bucket in (2_000_000, 1):
        got = [tuple(r) for r in evaluation.precision_by_threshold(
            df, rows_per_bucket=rows_per_bucket).collect()]
        assert got == [(0.9, 1.0), (0.5, 0.5)]


def test_lloyd_empty_cluster_keeps_centre(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([2.0, 0.0],)], "features ARRAY<DOUBLE>")
    start = Centers(np.array([[1.0, 1.0], [100.0, 100.0]]))
    step = clustering.lloyd_step(df, start).values
    assert step[0].tolist() == [1.0, 0.0]
    assert step[1].tolist() == [100.0, 100.0]
