"""vigil: clustering and anomaly detection on Spark DataFrames and streams.

Every operator takes and returns DataFrames (or driver-side model objects that
do not grow with the rows), so the heavy work stays in Spark jobs.
"""

from vigil.operators.anomaly import (
    AnomalyDetector,
    detect_anomalies,
    fit_anomaly_detector,
    kth_largest,
)
from vigil.operators.clustering import (
    Centers,
    assign_clusters,
    clustering_score,
    distance_to_centroid,
    kmeans_fit,
    lloyd,
    sweep_k,
)
from vigil.operators.evaluation import (
    cluster_label_counts,
    label_histogram,
    precision_by_threshold,
    weighted_entropy,
)
from vigil.operators.features import (
    Dictionary,
    Stats,
    category_dictionary,
    column_stats,
    one_hot_features,
    random_projection,
    standard_scale,
    zscore,
)
from vigil.operators.manyfit import crosstab_many, entropy_of_crosstab, fit_ks, fit_runs, lloyd_many
from vigil.operators.modeling import apply_saved_model, build_model
from vigil.operators.online import OnlineState, online_update, streaming_kmeans_init
from vigil.operators.parsing import label_of, parse_numeric, valid_rows
from vigil.operators.sparse import category_index, sparse_assign, sparse_one_hot, sparse_stats
from vigil.session import get_session, shared_dir, spread

__all__ = [
    "AnomalyDetector", "Centers", "Dictionary", "OnlineState", "Stats",
    "apply_saved_model", "assign_clusters", "build_model", "category_dictionary",
    "category_index", "cluster_label_counts", "clustering_score", "column_stats",
    "crosstab_many", "detect_anomalies", "distance_to_centroid", "entropy_of_crosstab",
    "fit_anomaly_detector", "fit_ks", "fit_runs", "get_session", "kmeans_fit",
    "kth_largest", "label_histogram", "label_of", "lloyd", "lloyd_many",
    "one_hot_features", "online_update", "parse_numeric", "precision_by_threshold",
    "random_projection", "shared_dir", "sparse_assign", "sparse_one_hot", "sparse_stats",
    "spread", "standard_scale", "streaming_kmeans_init", "sweep_k", "valid_rows",
    "weighted_entropy", "zscore",
]
