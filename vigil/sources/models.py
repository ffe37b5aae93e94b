"""Model store: k-means models and fitted feature state, saved with Spark.

A bundle folder holds one sub-folder a save (``v-…``) with ``centers/`` and, where
the bundle has them, ``dictionary/``, ``stats/`` (small Parquet tables) and
``kmeans/`` (the ``pyspark.ml`` model), and a ``manifest/`` table. A save writes its
parts first and appends one manifest row last, which names the folder, the parts
and the record layout; loading takes the newest row. So a reader never mixes parts
of two saves, and a part that the manifest names but that is missing is an error.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vigil.defaults import CATEGORICAL_POSITIONS, FIELD_SEPARATOR
from vigil.operators.clustering import Centers
from vigil.operators.features import Dictionary, Stats

MANIFEST = "saved_at BIGINT, folder STRING, parts ARRAY<STRING>, layout STRING"


def save_model(model, path: str) -> None:
    """Save a ``pyspark.ml`` KMeansModel, replacing what is at ``path``."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """Load a ``pyspark.ml`` KMeansModel."""
    from pyspark.ml.clustering import KMeansModel

    return KMeansModel.load(path)


@dataclass(frozen=True)
class Layout:
    """How a record line is read; saved with the model."""

    categorical: tuple[int, ...] = CATEGORICAL_POSITIONS
    sep: str = FIELD_SEPARATOR
    mode: str = "strict"


@dataclass
class ModelBundle:
    centers: Centers
    dictionary: Dictionary | None = None
    stats: Stats | None = None
    kmeans: object | None = None  # pyspark.ml KMeansModel
    cluster_sizes: dict[int, int] | None = None  # training rows per cluster (not saved)
    layout: Layout = field(default_factory=Layout)


def save_bundle(spark: SparkSession, bundle: ModelBundle, path: str) -> None:
    """Write the bundle as the newest of ``path``; earlier saves stay until deleted."""
    path = path.rstrip("/")
    folder = f"v-{uuid.uuid4().hex[:12]}"
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(bundle.centers.values)]
    tables = {"centers": (rows, "cluster INT, center ARRAY<DOUBLE>")}
    if bundle.dictionary is not None:
        tables["dictionary"] = (bundle.dictionary.to_rows(), "field INT, category STRING, idx INT")
    if bundle.stats is not None:
        s = bundle.stats
        tables["stats"] = ([(i, s.n, m, sd) for i, (m, sd) in enumerate(zip(s.mean, s.sd))],
                           "dim INT, n BIGINT, mean DOUBLE, sd_pop DOUBLE")
    for name, (values, schema) in tables.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{path}/{folder}/{name}")
    parts = list(tables)
    if bundle.kmeans is not None:
        save_model(bundle.kmeans, f"{path}/{folder}/kmeans")
        parts.append("kmeans")
    layout = json.dumps({"categorical": list(bundle.layout.categorical), "sep": bundle.layout.sep, "mode": bundle.layout.mode})
    (spark.createDataFrame([(time.time_ns(), folder, parts, layout)], MANIFEST).coalesce(1)
     .write.mode("append").parquet(f"{path}/manifest"))


def _saves(spark: SparkSession, path: str):
    return spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/manifest")


def newest_save(spark: SparkSession, path: str) -> str:
    """The folder name of the newest save of ``path``."""
    newest = _saves(spark, path).orderBy(F.desc("saved_at")).first()
    if newest is None:
        raise ValueError(f"no model has been saved to {path}")
    return newest["folder"]


def refresh_stats(spark: SparkSession, path: str, vectors, features: str = "features") -> ModelBundle:
    """Merge the statistics of new rows (encoded, not scaled) into those of the newest
    save and save the bundle anew: the scaling then is that of all rows, and none of the
    earlier ones is read. The centres stay as they were fitted."""
    bundle = load_bundle(spark, path)
    if bundle.stats is None:
        raise ValueError("the saved model has no statistics")
    bundle.stats = bundle.stats.merge(Stats.fit(vectors, features))
    save_bundle(spark, bundle, path)
    return bundle


def load_bundle(spark: SparkSession, path: str, save: str | None = None) -> ModelBundle:
    """The newest bundle saved to ``path``, or the one of a given save."""
    path = path.rstrip("/")
    save = save or newest_save(spark, path)
    newest = _saves(spark, path).filter(F.col("folder") == save).first()
    if newest is None:
        raise ValueError(f"{path} holds no save {save}")
    folder, parts, layout = f"{path}/{newest['folder']}", set(newest["parts"]), json.loads(newest["layout"])
    rows = sorted(spark.read.parquet(f"{folder}/centers").collect())
    return ModelBundle(
        Centers(np.array([r["center"] for r in rows], dtype=float)),
        Dictionary.from_table(spark.read.parquet(f"{folder}/dictionary")) if "dictionary" in parts else None,
        Stats.from_table(spark.read.parquet(f"{folder}/stats")) if "stats" in parts else None,
        load_model(f"{folder}/kmeans") if "kmeans" in parts else None,
        layout=Layout(tuple(layout["categorical"]), layout["sep"], layout["mode"]),
    )
