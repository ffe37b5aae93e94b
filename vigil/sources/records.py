"""Text-line sources/sinks and the record views built from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.vectors import as_double_array
from vigil.session import spread, stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line: ``value STRING`` (``sc.textFile``)."""
    return spread(spark.read.text(path))


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma-separated record lines from ``lineitem ⨝ orders``.

    Layout (label last, categoricals at positions 1-3)::

        l_quantity, l_returnflag, l_linestatus, l_linenumber,
        l_extendedprice, l_discount, l_tax, o_orderstatus

    The join is an ordinary equi-join on the order key; AQE picks the join strategy
    from runtime sizes (sort-merge at scale, no unchecked broadcast). The line item's
    fields are put together before it, so that it sorts and shuffles one short text a
    row besides the key. The line-item scan is spread over the cores when its file gives
    fewer splits than that (small inputs only).
    """
    li = table(spark, sf_dir, "lineitem")
    li = spread(li.select("l_orderkey", _joined_fields(
        "l_quantity", "l_returnflag", "l_linestatus", "l_linenumber", "l_extendedprice", "l_discount", "l_tax").alias("item")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
    return joined.select(_joined_fields("item", "o_orderstatus").alias("value"))


def _joined_fields(*columns: str) -> Column:
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``record_lines`` as a written table, for queries that pass over the lines more than
    once: the join then runs once."""
    return stored(record_lines(spark, sf_dir), "lines")


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as (vec_id, label, features ARRAY<DOUBLE>)."""
    return spread(table(spark, sf_dir, "embeddings").select(
        "vec_id", "label",
        as_double_array("embedding").alias("features"),
    ))


def write_assignments(df: DataFrame, path: str, cluster: str = "cluster",
                      features: str = "features") -> None:
    """Write ``cluster,f0,f1,…`` lines (no header), one part file a task."""
    line = F.concat_ws(
        ",", F.col(cluster).cast("string"),
        F.array_join(F.transform(F.col(features), lambda x: x.cast("string")), ","))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    """Read the exported lines back: (cluster INT, features ARRAY<DOUBLE>).

    All part files are read (the first line is data, there is no header).
    """
    parts = F.split(F.col("value"), ",")
    return spark.read.text(path).select(
        parts[0].cast(T.IntegerType()).alias("cluster"),
        F.transform(F.slice(parts, 2, F.size(parts) - 1),
                    lambda x: x.cast("double")).alias("features"),
    )
