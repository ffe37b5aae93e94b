"""Prediction on a stream: with fixed centres, with a saved model, with the newest of the
saved models of each batch, and as tagged text lines a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators.clustering import Centers, assign_clusters
from vigil.streaming.sources import noted, write_batch


def stream_predict(stream: DataFrame, model: Centers | str, features: str = "features",
                   value: str = "value", distance: bool = False) -> DataFrame:
    """Add ``cluster`` (and ``distance``) to every row of a streaming DataFrame.

    ``model`` is either centres (rows already carry ``features``) or the
    path of a saved bundle, in which case raw ``value`` lines are encoded
    with the bundle's dictionary and statistics first. A narrow projection:
    no state, no shuffle.
    """
    if isinstance(model, str):
        from vigil.operators.modeling import encode
        from vigil.sources.models import load_bundle

        bundle = load_bundle(stream.sparkSession, model)
        rows = encode(stream, bundle, value, keep_line=True)
        return assign_clusters(rows, bundle.centers, "features",
                               distance_col="distance" if distance else None).drop("features")
    return assign_clusters(stream, model, features,
                           distance_col="distance" if distance else None)


def stream_predict_latest(stream: DataFrame, path: str, out: str, value: str = "value"):
    """A stream writer (not started): each micro-batch of raw lines is tagged with the
    newest model that ``path`` holds when the batch begins, to ``out/tagged``
    (value, label, cluster, distance, model). ``model`` names the save. The choice is
    written down first, so a replayed batch takes the same model again."""
    from vigil.operators.modeling import encode
    from vigil.sources.models import load_bundle, newest_save

    loaded: dict[str, object] = {}

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        save = noted(spark, f"{out}/models", batch_id, lambda: newest_save(spark, path))
        if save not in loaded:
            loaded.clear()
            loaded[save] = load_bundle(spark, path, save)
        bundle = loaded[save]
        tagged = assign_clusters(encode(batch, bundle, value, keep_line=True), bundle.centers, distance_col="distance")
        write_batch(tagged.drop("features").withColumn("model", F.lit(save)), f"{out}/tagged", batch_id)

    return stream.writeStream.foreachBatch(each)


def stream_write_assignments(stream: DataFrame, model: Centers, out: str, features: str = "features"):
    """A stream writer (not started): the rows of each micro-batch as ``cluster,f0,f1,…``
    text lines in ``out/lines/batch_id=N``, and when they are all written one row
    (rows) in ``out/commits/batch_id=N``. A replayed batch overwrites both, and a reader
    that goes by the commits sees each batch once and whole."""
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tagged = assign_clusters(batch.select(features), model, features)
        line = F.concat_ws(",", F.col("cluster").cast("string"),
                           F.array_join(F.transform(features, lambda x: x.cast("string")), ","))
        write_batch(tagged.select(line.alias("value")), f"{out}/lines", batch_id, "text")
        rows = spark.read.text(f"{out}/lines/batch_id={int(batch_id)}").count()
        write_batch(spark.createDataFrame([(rows,)], "rows BIGINT").coalesce(1), f"{out}/commits", batch_id)

    return stream.writeStream.foreachBatch(each)


def read_stream_assignments(spark: SparkSession, out: str) -> DataFrame:
    """(batch_id, cluster, features) of the committed batches."""
    lines = spark.read.schema("value STRING, batch_id BIGINT").text(f"{out}/lines")
    commits = spark.read.parquet(f"{out}/commits").select(F.col("batch_id").cast("bigint").alias("batch_id"))
    parts = F.split("value", ",")
    return lines.join(commits, "batch_id", "left_semi").select(
        "batch_id", parts[0].cast(T.IntegerType()).alias("cluster"),
        F.transform(F.slice(parts, 2, F.size(parts) - 1), lambda x: x.cast("double")).alias("features"))
