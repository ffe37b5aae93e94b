"""Cluster quality and detection metrics as grouped aggregates.

Counts, crosstabs and entropies are partial-then-final hash aggregates: a
hot label or cluster holding a third of all rows is reduced to one row per
task before any shuffle, so skew never reaches a single task. Precision by
threshold adds a running sum, windowed per range bucket of distinct scores.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.parsing import label_of
from vigil.session import cached


def label_histogram(lines: DataFrame, value: str = "value", sep: str = ",") -> DataFrame:
    """(label, cnt) of the last field, by count descending then label."""
    return (lines.groupBy(label_of(value, sep).alias("label"))
            .agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), "label"))


def cluster_label_counts(assigned: DataFrame, cluster: str = "cluster",
                         label: str = "label") -> DataFrame:
    """(cluster, label, cnt) sorted by cluster then label."""
    return (assigned.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(cluster, label))


def cluster_count(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    """One row ``n_clusters``: distinct clusters present."""
    return assigned.agg(F.countDistinct(cluster).alias("n_clusters"))


def entropy_of_counts(counts: list[int]) -> float:
    """Shannon entropy (natural log) of positive counts (driver helper)."""
    values = [c for c in counts if c > 0]
    n = float(sum(values))
    return sum(-(v / n) * math.log(v / n) for v in values)


def cluster_entropy(assigned: DataFrame, cluster: str = "cluster",
                    label: str = "label") -> DataFrame:
    """(cluster, n, entropy) of the label distribution inside each cluster.

    With c_l the label counts and n = Σ c_l: H = ln n − Σ c_l ln c_l / n.
    """
    counts = assigned.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("c"))
    per = counts.groupBy(cluster).agg(
        F.sum("c").alias("n"), F.sum(F.col("c") * F.ln("c")).alias("clnc"))
    return per.select(cluster, "n",
                      (F.ln("n") - F.col("clnc") / F.col("n")).alias("entropy"))


def weighted_entropy(assigned: DataFrame, cluster: str = "cluster",
                     label: str = "label") -> DataFrame:
    """One row: ``entropy`` = Σ_c n_c·H_c / n (cluster-size weighted)."""
    per = cluster_entropy(assigned, cluster, label)
    return per.agg((F.sum(F.col("n") * F.col("entropy")) / F.sum("n")).alias("entropy"))


def precision_by_threshold(df: DataFrame, score: str = "score",
                           positive: str = "positive",
                           rows_per_bucket: int = 2_000_000,
                           max_buckets: int = 100_000) -> DataFrame:
    """(threshold, precision): for every distinct score t, descending,
    precision = positives with score ≥ t / rows with score ≥ t.

    Scalable running sum, with no window over all rows: the distinct scores
    are range-bucketed by approximate quantiles; each bucket's scores get a
    windowed running sum inside their own task, plus the bucket's offset
    (totals of all higher buckets). The offsets are computed in a pre-pass
    over the cached per-score table (at most ``max_buckets`` rows reach the
    driver) and joined back as a small broadcast table; with one bucket
    (at most ``rows_per_bucket`` distinct scores) one task runs the window
    and there is nothing to join.
    """
    by_score = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(F.col(positive).cast("long")).alias("tp"),
        F.count(F.lit(1)).alias("n"))
    splits: list[float] = []
    offsets: list[tuple[int, int, int]] = []
    with cached(by_score) as table:
        distinct = table.count()
        buckets = max(1, min(max_buckets, math.ceil(distinct / rows_per_bucket)))
        if buckets > 1:
            probs = [i / buckets for i in range(1, buckets)]
            cuts = table.approxQuantile("threshold", probs, 1.0 / (4 * buckets))
            splits = sorted(set(float(c) for c in cuts))
        if splits:
            totals = (_bucketize(table, splits).groupBy("bucket")
                      .agg(F.sum("tp").alias("btp"), F.sum("n").alias("bn"))
                      .orderBy(F.desc("bucket")).limit(max_buckets + 1).collect())
            otp = on = 0
            for r in totals:  # highest scores first; the NULL-score row has no bucket
                if r["bucket"] is None:
                    continue
                offsets.append((int(r["bucket"]), otp, on))
                otp += int(r["btp"])
                on += int(r["bn"])
    inside = Window.partitionBy("bucket").orderBy(F.desc("threshold")).rowsBetween(
        Window.unboundedPreceding, 0)
    bucketed = _bucketize(by_score, splits) if splits else by_score.withColumn("bucket", F.lit(0))
    running = bucketed.select(
        "bucket", "threshold",
        F.sum("tp").over(inside).alias("rtp"), F.sum("n").over(inside).alias("rn"))
    if offsets:
        table = df.sparkSession.createDataFrame(offsets, "bucket INT, otp BIGINT, on BIGINT")
        # Left join: every bucket has an offset row, and an inner join would
        # make the optimizer infer ``bucket IS NOT NULL`` and push it, with the
        # score expression inlined, below the aggregate.
        running = running.join(F.broadcast(table), "bucket", "left")
        tp, n = F.col("otp") + F.col("rtp"), F.col("on") + F.col("rn")
    else:
        tp, n = F.col("rtp"), F.col("rn")
    # Rows without a score have no threshold. Dropping them here, above the
    # window, keeps the predicate from being pushed below the aggregate (where
    # it would evaluate the score expression a second time).
    return (running.select("threshold", (tp / n).alias("precision"))
            .filter(F.col("threshold").isNotNull()).orderBy(F.desc("threshold")))


def _bucketize(df: DataFrame, splits: list[float]) -> DataFrame:
    """Bucket index (INT) of ``threshold`` by the sorted ``splits``."""
    out = Bucketizer(splits=[-math.inf] + splits + [math.inf], inputCol="threshold",
                     outputCol="__bucket", handleInvalid="keep").transform(df)
    return out.withColumn("bucket", F.col("__bucket").cast("int")).drop("__bucket")
