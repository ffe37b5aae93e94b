"""Online k-means (the MLlib streaming k-means update rule) on DataFrames.

State is (centres, weights). One update is a single Spark pass: assign each
row to its nearest current centre and aggregate per (cluster, dim) sums and
counts with a partial aggregate; the O(k × d) merge then runs on the driver.

Rule for cluster i with centre c, weight n, batch count m, batch sum s:
discount d = a (time unit "batches") or a^(rows in batch) ("points");
n' = n·d + m; λ = m / max(n', 1e-16); c' = (1 − λ)·c + (λ/m)·s when m > 0.
Afterwards, if the smallest weight is below 1e-8 of the largest, the largest
cluster is split: both get weight (max + min)/2 and the centres
x ± 1e-14·max(|x|, 1) around the largest centre.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.defaults import ONLINE_DECAY, ONLINE_RANDOM_WEIGHT
from vigil.functions.random import normal_matrix
from vigil.operators.clustering import Centers, assign_clusters, cluster_sums, collect_sums
from vigil.operators.evaluation import cluster_label_counts

BATCHES = "batches"
POINTS = "points"


@dataclass(frozen=True)
class OnlineState:
    centers: np.ndarray
    weights: np.ndarray
    decay: float = 1.0
    time_unit: str = BATCHES

    def __post_init__(self):
        if self.time_unit not in (BATCHES, POINTS):
            raise ValueError("time_unit must be 'batches' or 'points'")
        Centers(self.centers)  # a 2-d array

    @property
    def model(self) -> Centers:
        return Centers(self.centers)

    def to_table(self, spark: SparkSession) -> DataFrame:
        """(cluster INT, weight DOUBLE, center ARRAY<DOUBLE>)."""
        rows = [(i, float(w), [float(v) for v in c])
                for i, (w, c) in enumerate(zip(self.weights, self.centers))]
        return spark.createDataFrame(rows, "cluster INT, weight DOUBLE, center ARRAY<DOUBLE>")

    @classmethod
    def from_table(cls, table: DataFrame, decay: float, time_unit: str) -> "OnlineState":
        rows = sorted(table.select("cluster", "weight", "center").collect())
        return cls(np.array([r[2] for r in rows], dtype=float),
                   np.array([r[1] for r in rows], dtype=float), decay, time_unit)


def streaming_kmeans_init(k: int, dim: int, weight: float = ONLINE_RANDOM_WEIGHT, seed: int = 0,
                          decay: float = ONLINE_DECAY, time_unit: str = BATCHES,
                          centers=None, weights=None) -> OnlineState:
    """Seeded N(0, 1) centres with a constant weight, or given centres/weights."""
    if centers is None:
        centers = normal_matrix(k, dim, seed)
    centers = np.asarray(centers, dtype=float)
    if weights is None:
        weights = np.full(centers.shape[0], float(weight))
    return OnlineState(centers, np.asarray(weights, dtype=float), decay, time_unit)


def merge_update(state: OnlineState, sums: np.ndarray, counts: np.ndarray) -> OnlineState:
    """Apply the update rule to per-cluster batch sums and counts."""
    centers = state.centers.copy()
    weights = state.weights.copy()
    if state.time_unit == POINTS:
        discount = state.decay ** float(counts.sum())
    else:
        discount = state.decay
    weights *= discount
    for i in np.nonzero(counts > 0)[0]:
        m = counts[i]
        updated = weights[i] + m
        lam = m / max(updated, 1e-16)
        weights[i] = updated
        centers[i] = (1.0 - lam) * centers[i] + (lam / m) * sums[i]
    largest = int(np.argmax(weights))
    smallest = int(np.argmin(weights))
    if weights[smallest] < 1e-8 * weights[largest]:
        w = (weights[largest] + weights[smallest]) / 2.0
        weights[largest] = w
        weights[smallest] = w
        x = centers[largest].copy()
        p = 1e-14 * np.maximum(np.abs(x), 1.0)
        centers[largest] = x + p
        centers[smallest] = x - p
    return OnlineState(centers, weights, state.decay, state.time_unit)


def idle_ticks(state: OnlineState, ticks: int) -> OnlineState:
    """``ticks`` intervals without rows: each discounts the weights (time unit "batches")
    and then looks for a dying cluster, like an update with no rows."""
    nothing = np.zeros(state.centers.shape), np.zeros(len(state.weights))
    while ticks > 0:
        after = merge_update(state, *nothing)
        ticks -= 1
        if np.array_equal(after.centers, state.centers):
            # no cluster died; all weights shrink alike, so none will in the ticks left
            left = state.decay**ticks if state.time_unit == BATCHES else 1.0
            return OnlineState(after.centers, after.weights * left, state.decay, state.time_unit)
        state = after
    return state


def online_update(df: DataFrame, state: OnlineState, features: str = "features") -> OnlineState:
    """One update of the online model with all rows of ``df`` (one batch)."""
    sums, counts = collect_sums(cluster_sums(df, state.model, features),
                                state.centers.shape[0], state.centers.shape[1])
    return merge_update(state, sums, counts)


def online_score(df: DataFrame, state: OnlineState, features: str = "features") -> DataFrame:
    """One row ``score``: mean distance to the nearest centre of the online model."""
    scored = assign_clusters(df, state.model, features, distance_col="distance")
    return scored.agg(F.avg("distance").alias("score"))


def online_crosstab(df: DataFrame, state: OnlineState, label: str = "label", features: str = "features") -> DataFrame:
    """Cluster × label counts under the online model, sorted."""
    return cluster_label_counts(assign_clusters(df, state.model, features), label=label)


def state_table(spark: SparkSession, state: OnlineState) -> DataFrame:
    """Long rows (cluster, dim, value, weight) of an online model."""
    rows = [(int(c), int(i), float(v), float(state.weights[c]))
            for c, row in enumerate(state.centers) for i, v in enumerate(row)]
    return spark.createDataFrame(rows, "cluster INT, dim INT, value DOUBLE, weight DOUBLE")
