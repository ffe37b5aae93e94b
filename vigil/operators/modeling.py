"""End-to-end model operations: train-and-publish, apply a saved model,
cluster profiling and the sampled assignment export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.defaults import (
    DEFAULT_K,
    PRODUCTION_EPSILON,
    PRODUCTION_K,
    PRODUCTION_RUNS,
    SAMPLE_FRACTION,
)
from vigil.operators.clustering import (
    FitResult,
    assign_clusters,
    centers_table,
    distance_to_centroid,
    kmeans_fit,
)
from vigil.operators.evaluation import cluster_label_counts, label_histogram
from vigil.operators.features import Dictionary, Stats, one_hot_features, zscore_column
from vigil.operators.parsing import parse_numeric
from vigil.sources.models import Layout, ModelBundle, load_bundle, save_bundle
from vigil.sources.records import read_assignments, write_assignments


def encode(lines: DataFrame, bundle: ModelBundle, value: str = "value",
           keep_line: bool = False) -> DataFrame:
    """Raw lines → (label, features) with the bundle's layout, dictionary and
    statistics. Nothing is fitted here: a bundle without a dictionary takes the
    numeric fields alone."""
    layout = bundle.layout
    if bundle.dictionary is None:
        feats = parse_numeric(lines, value, layout.categorical, layout.mode, keep_line, layout.sep)
    else:
        feats = one_hot_features(lines, bundle.dictionary, value, layout.mode, keep_line=keep_line, sep=layout.sep)
    if bundle.stats is not None:
        feats = feats.withColumn("features", zscore_column("features", bundle.stats))
    return feats


def build_model(lines: DataFrame, k: int = PRODUCTION_K, runs: int = PRODUCTION_RUNS,
                tol: float = PRODUCTION_EPSILON,
                seed: int = 1, value: str = "value", path: str | None = None,
                layout: Layout = Layout()) -> tuple[ModelBundle, float]:
    """Parse + one-hot + z-score + k-means + mean-distance score (+ save).

    Returns the bundle and its clustering score on the training data.
    """
    dictionary = Dictionary.fit(lines, value, layout.categorical, layout.sep)
    feats = one_hot_features(lines, dictionary, value, layout.mode, sep=layout.sep).select("features")
    stats = Stats.fit(feats)
    normalized = feats.select(zscore_column("features", stats).alias("features"))
    if runs == 1:  # a fit of several runs reads the rows once and knows score and sizes
        normalized.persist()
    try:
        fit: FitResult = kmeans_fit(normalized, k=k, runs=runs, tol=tol, seed=seed)
        sizes, score = fit.sizes, fit.mean_distance
        if sizes is None:
            # One pass over the cached rows gives both the score and the cluster
            # sizes: per-cluster count and distance sum (at most k rows).
            per = (distance_to_centroid(normalized, fit.centers).groupBy("cluster")
                   .agg(F.count(F.lit(1)).alias("cnt"), F.sum("distance").alias("dsum"))
                   .collect())
            sizes = {int(r["cluster"]): int(r["cnt"]) for r in per}
            score = sum(float(r["dsum"]) for r in per) / max(sum(sizes.values()), 1)
    finally:
        if runs == 1:
            normalized.unpersist()
    bundle = ModelBundle(fit.centers, dictionary, stats, fit.model, sizes, layout)
    if path is not None:
        save_bundle(lines.sparkSession, bundle, path)
    return bundle, float(score)


def apply_saved_model(lines: DataFrame, path: str, value: str = "value") -> DataFrame:
    """Load a saved bundle and tag every line: (label, cluster, distance)."""
    bundle = load_bundle(lines.sparkSession, path)
    return assign_clusters(encode(lines, bundle, value), bundle.centers,
                           distance_col="distance").drop("features")


def profile_clusters(lines_or_vectors: DataFrame, k: int = DEFAULT_K, seed: int = 1,
                     parsed: bool = False) -> dict[str, DataFrame]:
    """The "take 0" profile: label histogram, a default k-means fit, its
    centres and the cluster × label crosstab."""
    spark = lines_or_vectors.sparkSession
    data = lines_or_vectors if parsed else parse_numeric(lines_or_vectors)
    out: dict[str, DataFrame] = {}
    if not parsed:
        out["labels"] = label_histogram(lines_or_vectors)
    fit = kmeans_fit(data, k=k, seed=seed, solver="block")  # dense rows
    out["centers"] = centers_table(spark, fit.centers)
    out["crosstab"] = cluster_label_counts(assign_clusters(data, fit.centers))
    return out


def hash_draw(key: list[str], seed: int) -> Column:
    """A number in [0, 1) from the md5 of the key columns as text and the seed."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def sample_assignments(vectors: DataFrame, centers, fraction: float = SAMPLE_FRACTION,
                       seed: int = 1, path: str | None = None,
                       key: list[str] | None = None) -> DataFrame:
    """Tag rows with their cluster, keep a Bernoulli sample, optionally export
    it as ``cluster,f0,f1,…`` text and read it back.

    A row's draw is a hash of ``key`` (all columns by default) and the seed, so
    the sample does not depend on partitions or cores; rows with equal keys are
    kept or left together.
    """
    tagged = assign_clusters(vectors, centers)
    sample = tagged.filter(hash_draw(key or vectors.columns, seed) < fraction).select("cluster", "features")
    if path is None:
        return sample
    write_assignments(sample, path)
    return read_assignments(vectors.sparkSession, path)


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("cnt"))
