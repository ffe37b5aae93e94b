"""Plan-shape checks: the properties the scale design relies on."""

import contextlib
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF0001
from vigil.operators import anomaly, clustering, evaluation, features
from vigil.operators.clustering import Centers
from vigil.sources.records import embedding_vectors, record_lines
from vigil.streaming.wordcount import word_counts


def physical(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="extended")
    text = buf.getvalue()
    return text[text.index("== Physical Plan =="):]


def test_partial_aggregation_before_shuffle(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    assert "partial_count" in physical(word_counts(docs, "text"))
    emb = embedding_vectors(spark, SF0001)
    sums = clustering.cluster_sums(emb, Centers.from_rows(emb, "vec_id", k=5))
    assert "partial_sum" in physical(sums)
    assert "partial_count" in physical(evaluation.label_histogram(record_lines(spark, SF0001)))


def test_scans_are_pruned(spark):
    plan = physical(record_lines(spark, SF0001))
    assert "l_shipdate" not in plan and "o_totalprice" not in plan
    emb = embedding_vectors(spark, SF0001)
    plan = physical(clustering.clustering_score(emb, Centers.from_rows(emb, "vec_id", k=3)))
    assert "ReadSchema: struct<embedding:array<float>>" in plan


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_nested_loop_or_cartesian_join(spark, name):
    plan = physical(entry.queries()[name](spark, SF0001))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_anomaly_filter_stays_above_scoring(spark):
    lines = record_lines(spark, SF0001)
    d = features.Dictionary.fit(lines)
    det = anomaly.AnomalyDetector(d, features.Stats(tuple([0.0] * 16), tuple([1.0] * 16), 1),
                                  Centers(np.zeros((4, 16))), 3.0)
    plan = physical(anomaly.detect_anomalies(lines, det))
    join_lines = [ln for ln in plan.splitlines() if "Join" in ln]
    assert join_lines and all("aggregate(" not in ln and "split(" not in ln for ln in join_lines)


def test_arrow_kernel_evaluated_once(spark):
    emb = embedding_vectors(spark, SF0001)
    d = clustering.distance_to_centroid(emb, Centers.from_rows(emb, "vec_id", k=40))
    scored = d.select(F.col("distance").alias("score"), (F.col("label") == 0).alias("positive"))
    for rows_per_bucket in (2_000_000, 50):
        plan = physical(evaluation.precision_by_threshold(scored, rows_per_bucket=rows_per_bucket))
        assert plan.count("ArrowEvalPython") == 1
