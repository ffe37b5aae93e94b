"""Registered queries: one per operator family, each over whole test tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names and types match the oracle SQL in ``vigil.plans.oracle``.
Computed doubles are rounded (6 places; sums of 2-decimal money values to
2 places) so that engines summing in a different order agree.

Fixed test parameters (used by the oracle SQL as well):
- ``C5``: the embeddings with the five smallest ``vec_id`` are centres 0-4.
- records ``R``: ``lineitem ⨝ orders`` lines, label = ``o_orderstatus``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.defaults import DEFAULT_MAX_ITER
from vigil.functions.vectors import explode_dims
from vigil.operators import anomaly, clustering, evaluation, features, manyfit, modeling, online, parsing, sparse
from vigil.operators.clustering import Centers
from vigil.session import cached, shared_dir
from vigil.sources import records
from vigil.sources.models import ModelBundle, load_bundle, refresh_stats, save_bundle
from vigil.streaming import (
    StreamingKMeans,
    read_stream_assignments,
    skip_existing,
    stage_slice,
    stream_lines,
    stream_predict,
    stream_predict_latest,
    stream_table,
    stream_word_count,
    stream_write_assignments,
)
from vigil.streaming.sources import run_available, write_batch

# Fixed values shared with the oracle SQL.
CENTRES_K = 5
LLOYD_ITERATIONS = 3
SWEEP_KS = (2, 4, 6, 8)
SWEEP_PARALLELISM = 4  # fits of different k run as concurrent Spark jobs
# the original jobs' values of k on raw, z-scored and one-hot + z-scored records
RAW_KS = (5, 10, 15, 20, 25, 30, 40, 50, 60, 70, 80, 90, 100)
Z_KS = (60, 70, 80, 90, 100, 110, 120)
ONE_HOT_KS = (80, 90, 100, 110, 120, 130, 140, 150, 160)
SWEEP_ITERATIONS = 1
# the sweeps on one-hot rows run as long as the jobs' fits: MLlib's default of 20 iterations
ONE_HOT_ITERATIONS = DEFAULT_MAX_ITER
ANOMALY_RANK = 100
ONLINE_WEIGHT = 10.0
ONLINE_DECAY_BATCHES = 0.5
ONLINE_DECAY_POINTS = 0.999
STREAM_BATCHES = 3
BATCH_TICKS = (0, 1, 4)  # intervals in which the batches of the idle replay come
RANDOM_CENTRES = 10
TOP_ANOMALIES = 10
SAMPLE_K = 100
# Seeded fits, checked by what any fit must satisfy: the model of the original jobs is
# k=150, ten runs, epsilon 1e-6.
FIT_K = 10
FIT_RUNS = 3
BUILD_K = 150
BUILD_RUNS = 10
FIT_TOL = 1e-6
SAMPLE_FRACTION = 0.05
SEED = 1

QueryFn = Callable[[SparkSession, str], DataFrame]


def _r6(c):
    return F.round(c, 6)


def _embeddings(spark, sf_dir):
    return records.embedding_vectors(spark, sf_dir)


def _c5(emb: DataFrame) -> Centers:
    return Centers.from_rows(emb, "vec_id", k=CENTRES_K)


# --- records: parsing, dictionary, one-hot, statistics, scaling --------------------

def q_label_histogram(spark, sf_dir):
    return evaluation.label_histogram(records.record_lines(spark, sf_dir))


def q_parse_numeric(spark, sf_dir):
    parsed = parsing.parse_numeric(records.record_lines(spark, sf_dir))
    return parsed.select("label", *[F.col("features")[i].alias(f"f{i}") for i in range(4)])


def q_category_dictionary(spark, sf_dir):
    return features.category_dictionary(records.record_lines(spark, sf_dir))


def q_one_hot_features(spark, sf_dir):
    encoded = features.one_hot_features(records.record_lines(spark, sf_dir))
    cells = encoded.select("label", explode_dims("features")).filter(F.col("dim").isNotNull())
    return cells.groupBy("label", F.col("dim").cast("int").alias("dim")).agg(
        F.round(F.sum("x"), 2).alias("total"))


def q_one_hot_sparse(spark, sf_dir):
    """Every non-zero cell of the sparse one-hot rows, counted by label, dimension and value."""
    lines = records.stored_lines(spark, sf_dir)
    rows, _ = sparse.sparse_one_hot(lines, sparse.category_index(lines))
    return sparse.sparse_cells(rows, "label").groupBy("label", "dim", "x").agg(F.count("*").alias("cnt"))


def q_sparse_assign(spark, sf_dir):
    """Nearest of the (returnflag, linestatus) mean centres in z-scored space, from sparse
    rows: cluster × label counts."""
    lines = records.stored_lines(spark, sf_dir)
    rows, layout = sparse.sparse_one_hot(lines, sparse.category_index(lines), keep_line=True)
    with cached(rows.withColumn("group", F.slice(parsing.fields_of("value"), 2, 2))) as rows:
        mean, sd = np.zeros(layout.dim), np.zeros(layout.dim)
        for r in sparse.sparse_stats(rows).collect():  # a row a dimension
            mean[r["dim"]], sd[r["dim"]] = r["mean"], r["sd_pop"]
        sizes = {tuple(r["group"]): r["count"] for r in rows.groupBy("group").count().collect()}
        raw = {g: np.zeros(layout.dim) for g in sorted(sizes)}
        for r in sparse.sparse_cells(rows, "group").groupBy("group", "dim").agg(F.sum("x").alias("total")).collect():
            raw[tuple(r["group"])][r["dim"]] = r["total"] / sizes[tuple(r["group"])]
        centers = Centers((np.array(list(raw.values())) - mean) / np.where(sd > 0, sd, 1.0))
        counts = evaluation.cluster_label_counts(sparse.sparse_assign(rows.select("label", "idx", "val"), layout, centers, mean, sd)).collect()
    return spark.createDataFrame([tuple(r) for r in counts], "cluster INT, label STRING, cnt BIGINT")


def q_column_stats(spark, sf_dir):
    parsed = parsing.parse_numeric(records.record_lines(spark, sf_dir))
    stats = features.column_stats(parsed)
    return stats.select("dim", "n", F.round("mean", 4).alias("mean"),
                        F.round("sd_pop", 4).alias("sd_pop"))


def q_parse_vectors(spark, sf_dir):
    vectors = parsing.parse_vectors(records.record_lines(spark, sf_dir))
    return vectors.select(*[F.col("features")[i].alias(f"f{i}") for i in range(4)])


def q_column_moments(spark, sf_dir):
    moments = features.column_moments(parsing.parse_numeric(records.record_lines(spark, sf_dir)))
    return moments.select("dim", "n", F.round("total", 2).alias("total"), F.round("squares", -4).alias("squares"))


def q_merged_stats(spark, sf_dir):
    """A model published with the statistics of the odd line numbers, refreshed with those
    of the even ones: the statistics it then holds are those of all records."""
    lines = records.record_lines(spark, sf_dir)
    odd = parsing.fields_of("value")[3].cast("int") % 2 == 1
    path = shared_dir(spark, "model")
    first = features.Stats.fit(parsing.parse_numeric(lines.filter(odd)))
    save_bundle(spark, ModelBundle(Centers([first.mean]), None, first), path)
    refresh_stats(spark, path, parsing.parse_numeric(lines.filter(~odd)))
    stats = load_bundle(spark, path).stats
    rows = [(i, stats.n, m, sd) for i, (m, sd) in enumerate(zip(stats.mean, stats.sd))]
    out = spark.createDataFrame(rows, "dim INT, n BIGINT, mean DOUBLE, sd_pop DOUBLE")
    return out.select("dim", "n", F.round("mean", 4).alias("mean"), F.round("sd_pop", 4).alias("sd_pop"))


def _z_columns(df):
    return df.select("label", *[_r6(F.col("features")[i]).alias(f"z{i}") for i in range(4)])


def q_zscore(spark, sf_dir):
    parsed = parsing.parse_numeric(records.record_lines(spark, sf_dir))
    return _z_columns(features.zscore(parsed))


def q_standard_scale(spark, sf_dir):
    parsed = parsing.parse_numeric(records.record_lines(spark, sf_dir))
    return _z_columns(features.standard_scale(parsed))


# --- clustering with the C5 centres --------------------------------------------------

def q_assign_clusters(spark, sf_dir):
    emb = _embeddings(spark, sf_dir)
    return clustering.assign_clusters(emb, _c5(emb)).select("vec_id", "cluster")


def q_distance_to_centroid(spark, sf_dir):
    emb = _embeddings(spark, sf_dir)
    out = clustering.distance_to_centroid(emb, _c5(emb))
    return out.select("vec_id", "cluster", _r6("distance").alias("distance"))


def q_clustering_score(spark, sf_dir):
    emb = _embeddings(spark, sf_dir)
    return clustering.clustering_score(emb, _c5(emb)).select(_r6("score").alias("score"))


def q_cluster_label_counts(spark, sf_dir):
    emb = _embeddings(spark, sf_dir)
    return evaluation.cluster_label_counts(clustering.assign_clusters(emb, _c5(emb)))


def q_weighted_entropy(spark, sf_dir):
    emb = _embeddings(spark, sf_dir)
    out = evaluation.weighted_entropy(clustering.assign_clusters(emb, _c5(emb)))
    return out.select(_r6("entropy").alias("entropy"))


def q_lloyd_3(spark, sf_dir):
    emb = _embeddings(spark, sf_dir)
    centers = clustering.lloyd(emb, _c5(emb), LLOYD_ITERATIONS)
    table = clustering.centers_table(spark, centers)
    return table.select("cluster", "dim", _r6("value").alias("value"))


def _sweep(spark, sf_dir, score):
    emb = _embeddings(spark, sf_dir)

    def fit(df, k):
        return clustering.lloyd(df, Centers.from_rows(df, "vec_id", k=k), LLOYD_ITERATIONS)

    out = clustering.sweep_k(emb, SWEEP_KS, fit, score, parallelism=SWEEP_PARALLELISM)
    return out.select("k", _r6("score").alias("score"))


def q_sweep_k(spark, sf_dir):
    return _sweep(spark, sf_dir, clustering.mean_distance_score())


def q_sweep_k_entropy(spark, sf_dir):
    def entropy_score(df, centers):
        assigned = clustering.assign_clusters(df, centers)
        return evaluation.weighted_entropy(assigned).first()["entropy"]

    return _sweep(spark, sf_dir, entropy_score)


def q_kth_largest(spark, sf_dir):
    emb = _embeddings(spark, sf_dir)
    dists = clustering.distance_to_centroid(emb, _c5(emb))
    return anomaly.kth_largest(dists, "distance", ANOMALY_RANK).select(
        _r6("threshold").alias("threshold"))


def q_precision_by_threshold(spark, sf_dir):
    emb = _embeddings(spark, sf_dir)
    dists = clustering.distance_to_centroid(emb, _c5(emb))
    scored = dists.select(_r6("distance").alias("score"),
                          (F.col("label") == 0).alias("positive"))
    out = evaluation.precision_by_threshold(scored, "score", "positive")
    return out.select("threshold", _r6("precision").alias("precision"))


def q_random_projection(spark, sf_dir):
    emb = _embeddings(spark, sf_dir)
    dim = len(emb.select("features").first()[0])
    matrix = features.projection_matrix(dim, 3, matrix=features.trig_matrix(dim, 3))
    out = features.random_projection(emb.select("vec_id", "features"), matrix)
    return out.select("vec_id", _r6("x").alias("x"), _r6("y").alias("y"), _r6("z").alias("z"))


def q_random_projection_seeded(spark, sf_dir):
    """The projection by seeded normal numbers, rows of unit length."""
    emb = _embeddings(spark, sf_dir)
    dim = len(emb.select("features").first()[0])
    out = features.random_projection(emb.select("vec_id", "features"), features.projection_matrix(dim, 3, seed=SEED))
    return out.select("vec_id", _r6("x").alias("x"), _r6("y").alias("y"), _r6("z").alias("z"))


def q_cluster_count(spark, sf_dir):
    emb = _embeddings(spark, sf_dir)
    return evaluation.cluster_count(clustering.assign_clusters(emb, _c5(emb)))


# --- many models in one scan, on the records -----------------------------------------

def _z_one_hot(lines: DataFrame) -> DataFrame:
    """(label, features), one-hot encoded and z-scored."""
    return features.zscore(features.one_hot_features(lines, keep_line=True))


def _first_lines(lines: DataFrame, n: int) -> DataFrame:
    """The ``n`` distinct lines whose md5 comes first. A task hands on its own first ``n``
    only, so the lines are not shuffled to find the distinct ones."""
    keyed = lines.select(F.md5(F.col("value").cast("binary")).alias("at"), "value")

    def first(batches):
        held = pa.table({"at": pa.array([], pa.string()), "value": pa.array([], pa.string())})
        for batch in batches:
            new = pa.Table.from_batches([batch]).cast(held.schema)
            if len(held) == n:
                new = new.filter(pa.compute.less_equal(new["at"], held["at"][n - 1]))
            if len(new):
                held = pa.concat_tables([held, new]).group_by(["at", "value"]).aggregate([]).sort_by("at").slice(0, n)
        yield from held.combine_chunks().to_batches()

    return keyed.mapInArrow(first, keyed.schema).distinct().orderBy("at").limit(n).select("value")


def _records_sweep(lines: DataFrame, vectors: DataFrame, ks, iterations: int = SWEEP_ITERATIONS):
    """Nested given starts (the records whose md5 comes first), at most ``iterations`` Lloyd
    steps of all k together, fewer where no centre moves any more. ``vectors``: value,
    label, features."""
    first = _first_lines(lines, max(ks))
    rows = vectors.join(F.broadcast(first), "value").select("value", "features").distinct()  # max(ks) rows
    rows = rows.withColumn("at", F.md5(F.col("value").cast("binary")))
    seeds = Centers.from_rows(rows, "at", k=max(ks))
    return manyfit.fit_ks(vectors, ks, 0.0, iterations, seeds=seeds)


def _scores(spark, models):
    return spark.createDataFrame([(k, m.mean_distance) for k, m in models.items()], "k INT, score DOUBLE").select("k", _r6("score").alias("score"))


def q_sweep_records_raw(spark, sf_dir):
    lines = records.stored_lines(spark, sf_dir)
    with cached(parsing.parse_numeric(lines, keep_line=True)) as vectors:
        return _scores(spark, _records_sweep(lines, vectors, RAW_KS))


def q_sweep_records_z(spark, sf_dir):
    lines = records.stored_lines(spark, sf_dir)
    with cached(features.zscore(parsing.parse_numeric(lines, keep_line=True))) as vectors:
        return _scores(spark, _records_sweep(lines, vectors, Z_KS))


def q_sweep_records_one_hot(spark, sf_dir):
    lines = records.stored_lines(spark, sf_dir)
    with cached(_z_one_hot(lines)) as vectors:
        return _scores(spark, _records_sweep(lines, vectors, ONE_HOT_KS, ONE_HOT_ITERATIONS))


def q_sweep_records_entropy(spark, sf_dir):
    """The same models; one more pass gives the crosstab of all of them."""
    lines = records.stored_lines(spark, sf_dir)
    with cached(_z_one_hot(lines)) as vectors:
        models = _records_sweep(lines, vectors, ONE_HOT_KS, ONE_HOT_ITERATIONS)
        table = manyfit.crosstab_many(vectors, {k: m.centers for k, m in models.items()})
        rows = [tuple(r) for r in manyfit.entropy_of_crosstab(table).collect()]  # a row a k
    return spark.createDataFrame(rows, "k INT, score DOUBLE").select("k", _r6("score").alias("score"))


def q_kmeans_many_runs(spark, sf_dir):
    """Three runs of different starts (a centre a value of each categorical field), moved
    together: the centres of the run of the lowest cost, and every run's cost."""
    vectors = _z_one_hot(records.stored_lines(spark, sf_dir))
    with cached(vectors.withColumn("fields", parsing.fields_of("value")).select("features", *[F.col("fields")[i].alias(f"c{i}") for i in (1, 2, 3)])) as rows:
        starts = [Centers.from_group_means(rows, [f"c{i}"]) for i in (1, 2, 3)]
        done = manyfit.lloyd_many(rows, starts, LLOYD_ITERATIONS)
    best = min(range(len(done)), key=lambda r: done[r].cost)
    cells = [(r, d.centers.k, d.cost / int(sum(d.sizes)), r == best, c, i, float(v)) for r, d in enumerate(done)
             for c, centre in enumerate(d.centers.values) for i, v in enumerate(centre)]
    out = spark.createDataFrame(cells, "run INT, k INT, cost DOUBLE, best BOOLEAN, cluster INT, dim INT, value DOUBLE")
    return out.withColumn("cost", _r6("cost")).withColumn("value", _r6("value"))


# --- anomalies on the records ------------------------------------------------------

def group_mean_centres(normalized: DataFrame) -> Centers:
    """One centre per (returnflag, linestatus): the mean normalised vector."""
    fields = parsing.fields_of("value")
    keyed = normalized.select(fields[1].alias("rf"), fields[2].alias("ls"), "features")
    return Centers.from_group_means(keyed, ["rf", "ls"])


def anomaly_detector(spark, sf_dir, lines: DataFrame | None = None, flag_training=False):
    """Detector over one-hot + z-scored records with one centre per
    (returnflag, linestatus) group (deterministic stand-in for the k-means fit)."""
    lines = lines if lines is not None else records.record_lines(spark, sf_dir)
    return anomaly.fit_anomaly_detector(lines, rank=ANOMALY_RANK, centers=group_mean_centres,
                                        flag_training=flag_training)


def q_detect_anomalies(spark, sf_dir):
    """Fit on the records and flag the records themselves; the flagged lines
    (at most ANOMALY_RANK - 1) come from the fit's cache."""
    lines = records.stored_lines(spark, sf_dir)
    _, out = anomaly.training_anomalies(lines, rank=ANOMALY_RANK, centers=group_mean_centres)
    return out.select("value", _r6("distance").alias("distance"))


def q_detect_lines(spark, sf_dir):
    """Fit on the records, then flag all lines anew through the fitted detector."""
    lines = records.stored_lines(spark, sf_dir)
    out = anomaly.detect_anomalies(lines, anomaly_detector(spark, sf_dir, lines))
    return out.select("value", _r6("distance").alias("distance"))


def q_top_anomalies(spark, sf_dir):
    """The ten most distant of the flagged lines."""
    lines = records.stored_lines(spark, sf_dir)
    out = anomaly.detect_anomalies(lines, anomaly_detector(spark, sf_dir, lines), top_n=TOP_ANOMALIES)
    return out.select("value", _r6("distance").alias("distance"))


def q_anomalies_kmeans(spark, sf_dir):
    """The full detector of the original jobs: one-hot + z-score, k=150 k-means
    (best of BUILD_RUNS seeds, ε=1e-6), threshold = 100th largest training
    distance. What any such fit must satisfy: the records scored, whether fewer
    than ANOMALY_RANK are flagged, and whether all flagged are above the threshold."""
    lines = records.stored_lines(spark, sf_dir)
    detector = anomaly.fit_anomaly_detector(lines, k=BUILD_K, rank=ANOMALY_RANK, runs=BUILD_RUNS,
                                            tol=FIT_TOL, seed=SEED)
    scored = detector.score(lines)
    above = F.col("distance") > F.lit(detector.threshold)
    return scored.agg(F.count("distance").alias("records"),
                      (F.sum(above.cast("long")) < ANOMALY_RANK).alias("few"),
                      (F.min(F.when(above, F.col("distance"))) > detector.threshold).alias("above"),
                      (F.sum((F.col("distance") >= F.lit(detector.threshold)).cast("long")) >= ANOMALY_RANK).alias("ranked"))


# --- online k-means on a static table ------------------------------------------------

def _online(spark, sf_dir, decay, unit):
    emb = _embeddings(spark, sf_dir)
    c5 = _c5(emb)
    state = online.streaming_kmeans_init(CENTRES_K, c5.dim, weight=ONLINE_WEIGHT,
                                         decay=decay, time_unit=unit, centers=c5.values)
    return emb, online.online_update(emb, state)


def _state_out(spark, state):
    table = online.state_table(spark, state)
    return table.select("cluster", "dim", _r6("value").alias("value"),
                        _r6("weight").alias("weight"))


def q_online_update(spark, sf_dir):
    _, state = _online(spark, sf_dir, ONLINE_DECAY_BATCHES, online.BATCHES)
    return _state_out(spark, state)


def q_online_update_points(spark, sf_dir):
    _, state = _online(spark, sf_dir, ONLINE_DECAY_POINTS, online.POINTS)
    return _state_out(spark, state)


def q_online_score(spark, sf_dir):
    emb, state = _online(spark, sf_dir, ONLINE_DECAY_BATCHES, online.BATCHES)
    return online.online_score(emb, state).select(_r6("score").alias("score"))


def q_online_crosstab(spark, sf_dir):
    """Cluster × label counts under the model after one update."""
    emb, state = _online(spark, sf_dir, ONLINE_DECAY_BATCHES, online.BATCHES)
    return online.online_crosstab(emb, state)


def q_online_random_start(spark, sf_dir):
    """Seeded N(0, 1) centres of weight 0, updated once by all embeddings (with the rule
    for dying clusters: a centre that no row is near takes half of the largest cluster)."""
    emb = _embeddings(spark, sf_dir)
    dim = len(emb.select("features").first()[0])
    state = online.streaming_kmeans_init(RANDOM_CENTRES, dim, seed=SEED)
    return _state_out(spark, online.online_update(emb, state))


# --- seeded fits, model store, export ----------------------------------

def q_kmeans_fit(spark, sf_dir):
    """Fit and assign; within- plus between-cluster sum of squares, which is the
    total whatever the fit, and the rows over all clusters."""
    emb = _embeddings(spark, sf_dir)
    fit = clustering.kmeans_fit(emb, k=FIT_K, runs=FIT_RUNS, tol=FIT_TOL, seed=SEED)
    cells = (clustering.assign_clusters(emb, fit.centers).select("cluster", explode_dims("features"))
             .filter(F.col("dim").isNotNull()))
    per = cells.groupBy("cluster", "dim").agg(F.count("x").alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    dims = per.groupBy("dim").agg((F.sum(F.col("m") * F.col("n")) / F.sum("n")).alias("mean"))
    parts = per.join(F.broadcast(dims), "dim")
    return parts.agg(F.sum(F.when(F.col("dim") == 0, F.col("n"))).alias("rows"),
                     (F.countDistinct("cluster") <= FIT_K).alias("at_most_k"),
                     F.round(F.sum(F.col("n") * (F.col("v") + (F.col("m") - F.col("mean")) ** 2)), 3).alias("total_ss"))


def q_build_model(spark, sf_dir):
    """Train and publish on the records (saved to the shared folder, k=150, ten
    runs); the rows over all clusters, whether there are at most k, and whether the
    stored centres are those of the fit."""
    path = shared_dir(spark, "model")
    bundle, _score = modeling.build_model(records.stored_lines(spark, sf_dir), k=BUILD_K,
                                          runs=BUILD_RUNS, tol=FIT_TOL, seed=SEED, path=path)
    stored = load_bundle(spark, path)
    sizes = spark.createDataFrame(sorted(bundle.cluster_sizes.items()), "cluster INT, cnt BIGINT")
    return sizes.agg(F.sum("cnt").alias("rows"), (F.count("*") <= BUILD_K).alias("at_most_k"),
                     F.lit(bool((stored.centers.values == bundle.centers.values).all())).alias("stored"))


def q_apply_saved_model(spark, sf_dir):
    """Publish a model with one centre per (returnflag, linestatus), load it and tag
    every record line with it."""
    lines = records.stored_lines(spark, sf_dir)
    detector = anomaly_detector(spark, sf_dir, lines)
    path = shared_dir(spark, "model")
    save_bundle(spark, ModelBundle(detector.centers, detector.dictionary, detector.stats), path)
    tagged = modeling.apply_saved_model(lines, path)
    return evaluation.cluster_label_counts(tagged)


def q_profile_clusters(spark, sf_dir):
    """The profile of the record lines: label histogram, default fit, crosstab. For
    each label its count by the histogram and summed over the crosstab."""
    profile = modeling.profile_clusters(records.stored_lines(spark, sf_dir), seed=SEED)
    crosstab = profile["crosstab"].groupBy("label").agg(F.sum("cnt").alias("clustered"))
    return profile["labels"].join(crosstab, "label").select("label", "cnt", "clustered")


def q_sample_assignments(spark, sf_dir):
    emb = _embeddings(spark, sf_dir)
    out = modeling.sample_assignments(emb, _c5(emb), SAMPLE_FRACTION, SEED,
                                      path=shared_dir(spark, "sample"), key=["vec_id"])
    return out.select("cluster", *[_r6(F.col("features")[i]).alias(f"f{i}") for i in range(3)])


def q_sample_fitted(spark, sf_dir):
    """The exported sample of a fitted model (k=100, ten runs): which rows are in it, and
    that every one carries a cluster of the fit, is the same whatever the fit."""
    emb = _embeddings(spark, sf_dir)
    fit = clustering.kmeans_fit(emb, k=SAMPLE_K, runs=BUILD_RUNS, tol=FIT_TOL, seed=SEED)
    out = modeling.sample_assignments(emb, fit.centers, SAMPLE_FRACTION, SEED,
                                      path=shared_dir(spark, "sample"), key=["vec_id"])
    nearest = clustering.assign_clusters(out, fit.centers, prediction="again")
    return nearest.select((F.col("cluster") == F.col("again")).alias("nearest"),
                          *[_r6(F.col("features")[i]).alias(f"f{i}") for i in range(3)])


# --- streaming ---------------------------------------------------------------------

def stream_slice_of(key: str, max_id: int):
    """Arrival order of a replayed stream: contiguous ranges of ``key``; a row
    without one, or with a negative one, comes with the first."""
    at = F.floor(F.col(key) * STREAM_BATCHES / F.lit(max_id + 1)).cast("int")
    return F.greatest(F.coalesce(at, F.lit(0)), F.lit(0))


def run_stream_kmeans(spark, sf_dir) -> str:
    """Replay ``embeddings`` as STREAM_BATCHES micro-batches through the
    streaming k-means (C5 start, weight 0, decay 1); returns the output folder.

    Each slice is appended to a watched folder and picked up by one
    ``availableNow`` run of the same checkpointed query, so batch N is exactly
    slice N.
    """
    emb = _embeddings(spark, sf_dir)
    c5 = _c5(emb)
    initial = online.streaming_kmeans_init(CENTRES_K, c5.dim, weight=0.0, decay=1.0,
                                           centers=c5.values)
    root = shared_dir(spark, "stream-kmeans")
    incoming, out, checkpoint = f"{root}/incoming", f"{root}/out", f"{root}/checkpoint"
    max_id = emb.agg(F.max("vec_id")).first()[0]
    slice_of = stream_slice_of("vec_id", max_id)
    model = StreamingKMeans(initial, out)
    for b in range(STREAM_BATCHES):
        stage_slice(emb.filter(slice_of == b), incoming)
        run_available(model.writer(stream_table(spark, incoming, emb.schema)), checkpoint)
    return out


def q_stream_kmeans(spark, sf_dir):
    out = run_stream_kmeans(spark, sf_dir)
    centres = spark.read.parquet(f"{out}/centers").filter(F.col("phase") == "after")
    return centres.select(F.col("batch_id").cast("int").alias("batch_id"), "cluster", "dim",
                          _r6("value").alias("value"))


def q_stream_centers(spark, sf_dir):
    """Centres before and after each micro-batch's update."""
    out = run_stream_kmeans(spark, sf_dir)
    centres = spark.read.parquet(f"{out}/centers")
    return centres.select(F.col("batch_id").cast("int").alias("batch_id"), "phase", "cluster",
                          "dim", _r6("value").alias("value"), _r6("weight").alias("weight"))


def q_stream_cluster_label_counts(spark, sf_dir):
    out = run_stream_kmeans(spark, sf_dir)
    counts = spark.read.parquet(f"{out}/counts")
    return counts.select(F.col("batch_id").cast("int").alias("batch_id"), "cluster", "label",
                         "cnt")


def q_stream_mean_distance(spark, sf_dir):
    out = run_stream_kmeans(spark, sf_dir)
    means = spark.read.parquet(f"{out}/mean_distance")
    return means.select(F.col("batch_id").cast("int").alias("batch_id"),
                        _r6("mean_distance").alias("mean_distance"))


def q_stream_idle_ticks(spark, sf_dir):
    """The replay with decay 0.5 and batches in intervals 0, 1 and 4: two intervals without
    rows age the weights before the third batch."""
    emb = _embeddings(spark, sf_dir)
    c5 = _c5(emb)
    initial = online.streaming_kmeans_init(CENTRES_K, c5.dim, weight=0.0, decay=ONLINE_DECAY_BATCHES, centers=c5.values)
    root = shared_dir(spark, "stream-idle")
    seconds = iter(BATCH_TICKS)
    model = StreamingKMeans(initial, f"{root}/out", interval=10, clock=lambda: 10.0 * next(seconds))
    _replay(spark, emb, "vec_id", root, lambda stream: model.writer(stream))
    centres = spark.read.parquet(f"{root}/out/centers").filter(F.col("phase") == "after")
    return centres.select(F.col("batch_id").cast("int").alias("batch_id"), "cluster", "dim",
                          _r6("value").alias("value"), _r6("weight").alias("weight"))


def _replay(spark, df: DataFrame, key: str, root: str, writer) -> None:
    """``df`` as STREAM_BATCHES micro-batches of one checkpointed query."""
    max_id = df.agg(F.max(key)).first()[0]
    for b in range(STREAM_BATCHES):
        stage_slice(df.filter(stream_slice_of(key, max_id) == b), f"{root}/incoming")
        run_available(writer(stream_table(spark, f"{root}/incoming", df.schema)), f"{root}/checkpoint")


def q_stream_write_assignments(spark, sf_dir):
    """Each micro-batch's rows as tagged text lines, read back by the commits."""
    emb = _embeddings(spark, sf_dir)
    centers, root = _c5(emb), shared_dir(spark, "stream-assignments")
    _replay(spark, emb, "vec_id", root, lambda stream: stream_write_assignments(stream, centers, f"{root}/out"))
    out = read_stream_assignments(spark, f"{root}/out")
    return out.select(F.col("batch_id").cast("int").alias("batch_id"), "cluster", *[_r6(F.col("features")[i]).alias(f"f{i}") for i in range(3)])


def _line_slices(lines: DataFrame) -> list[DataFrame]:
    """The record lines by line number modulo STREAM_BATCHES."""
    at = parsing.fields_of("value")[3].cast("int") % STREAM_BATCHES
    return [lines.filter(at == b) for b in range(STREAM_BATCHES)]


def q_stream_new_files(spark, sf_dir):
    """Text files of record lines in a watched folder, the first slice of them there before
    the query starts and skipped: parsed per batch, label counts and sums of the first
    field by batch."""
    root = shared_dir(spark, "stream-files")
    for b, lines in enumerate(_line_slices(records.stored_lines(spark, sf_dir))):
        stage_slice(lines, f"{root}/incoming", "text")
        stream = stream_lines(spark, f"{root}/incoming")
        skip_existing(stream, f"{root}/checkpoint")
        if b:
            parsed = parsing.parse_numeric(stream).withColumn("at", F.col("features")[0])
            run_available(parsed.writeStream.foreachBatch(
                lambda batch, batch_id: write_batch(batch.groupBy("label").agg(F.count("*").alias("cnt"), F.round(F.sum("at"), 2).alias("total")),
                                                    f"{root}/out", batch_id)), f"{root}/checkpoint")
    counts = spark.read.parquet(f"{root}/out")
    return counts.select(F.dense_rank().over(Window.orderBy("batch_id")).alias("batch"), "label", "cnt", "total")


def q_stream_saved_model(spark, sf_dir):
    """Lines on a stream tagged with the newest saved model; before the second batch the
    model is saved anew with its centres in reverse order."""
    lines = records.stored_lines(spark, sf_dir)
    detector = anomaly_detector(spark, sf_dir, lines)
    root = shared_dir(spark, "stream-model")
    for b, part in enumerate(_line_slices(lines)):
        if b < 2:
            centers = Centers(detector.centers.values[::-1] if b else detector.centers.values)
            save_bundle(spark, ModelBundle(centers, detector.dictionary, detector.stats), f"{root}/model")
        stage_slice(part, f"{root}/incoming", "text")
        run_available(stream_predict_latest(stream_lines(spark, f"{root}/incoming"), f"{root}/model", f"{root}/out"), f"{root}/checkpoint")
    tagged = spark.read.parquet(f"{root}/out/tagged")
    first = tagged.filter("batch_id = 0").select("model").distinct().first()[0]
    return (tagged.groupBy(F.col("batch_id").cast("int").alias("batch_id"), (F.col("model") == first).alias("first_model"), "cluster", "label")
            .agg(F.count("*").alias("cnt")))


def q_stream_predict(spark, sf_dir):
    """Stateless prediction on a stream of the embeddings file (C5 model)."""
    emb = _embeddings(spark, sf_dir)
    centers = _c5(emb)
    raw = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    stream = stream_table(spark, f"{sf_dir}/embeddings.parque[t]", raw.schema)  # a file, or a folder of them
    stream = stream.select("vec_id", F.col("embedding").cast("array<double>").alias("features"))
    root = shared_dir(spark, "stream-predict")
    predicted = stream_predict(stream, centers).select("vec_id", "cluster")
    run_available(predicted.writeStream.format("parquet").option("path", f"{root}/out"),
                  f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


def q_stream_word_count(spark, sf_dir):
    """Each micro-batch's own word counts (not cumulative) over ``documents.text``,
    which arrives in STREAM_BATCHES slices."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    max_id = docs.agg(F.max("doc_id")).first()[0]
    root = shared_dir(spark, "stream-words")
    for b in range(STREAM_BATCHES):
        stage_slice(docs.filter(stream_slice_of("doc_id", max_id) == b), f"{root}/incoming")
        stream = stream_table(spark, f"{root}/incoming", docs.schema)
        run_available(stream_word_count(stream.select("text"), f"{root}/out", "text"), f"{root}/checkpoint")
    counts = spark.read.parquet(f"{root}/out")
    return counts.select(F.col("batch_id").cast("int").alias("batch_id"), "word", "cnt")


QUERIES: dict[str, QueryFn] = {
    "label_histogram": q_label_histogram,
    "parse_numeric": q_parse_numeric,
    "parse_vectors": q_parse_vectors,
    "category_dictionary": q_category_dictionary,
    "one_hot_features": q_one_hot_features,
    "one_hot_sparse": q_one_hot_sparse,
    "sparse_assign": q_sparse_assign,
    "column_stats": q_column_stats,
    "column_moments": q_column_moments,
    "merged_stats": q_merged_stats,
    "zscore": q_zscore,
    "standard_scale": q_standard_scale,
    "assign_clusters": q_assign_clusters,
    "distance_to_centroid": q_distance_to_centroid,
    "clustering_score": q_clustering_score,
    "cluster_label_counts": q_cluster_label_counts,
    "weighted_entropy": q_weighted_entropy,
    "cluster_count": q_cluster_count,
    "lloyd_3": q_lloyd_3,
    "sweep_k": q_sweep_k,
    "sweep_k_entropy": q_sweep_k_entropy,
    "kmeans_many_runs": q_kmeans_many_runs,
    "sweep_records_raw": q_sweep_records_raw,
    "sweep_records_z": q_sweep_records_z,
    "sweep_records_one_hot": q_sweep_records_one_hot,
    "sweep_records_entropy": q_sweep_records_entropy,
    "kth_largest": q_kth_largest,
    "precision_by_threshold": q_precision_by_threshold,
    "random_projection": q_random_projection,
    "random_projection_seeded": q_random_projection_seeded,
    "detect_anomalies": q_detect_anomalies,
    "detect_lines": q_detect_lines,
    "top_anomalies": q_top_anomalies,
    "anomalies_kmeans": q_anomalies_kmeans,
    "online_update": q_online_update,
    "online_update_points": q_online_update_points,
    "online_score": q_online_score,
    "online_crosstab": q_online_crosstab,
    "online_random_start": q_online_random_start,
    "stream_kmeans": q_stream_kmeans,
    "stream_centers": q_stream_centers,
    "stream_cluster_label_counts": q_stream_cluster_label_counts,
    "stream_mean_distance": q_stream_mean_distance,
    "stream_idle_ticks": q_stream_idle_ticks,
    "stream_predict": q_stream_predict,
    "stream_write_assignments": q_stream_write_assignments,
    "stream_new_files": q_stream_new_files,
    "stream_saved_model": q_stream_saved_model,
    "stream_word_count": q_stream_word_count,
    "kmeans_fit": q_kmeans_fit,
    "build_model": q_build_model,
    "apply_saved_model": q_apply_saved_model,
    "profile_clusters": q_profile_clusters,
    "sample_assignments": q_sample_assignments,
    "sample_fitted": q_sample_fitted,
}
