"""Online k-means rule, streaming per-batch semantics, replay safety, model store."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from vigil.operators import online
from vigil.operators.clustering import Centers
from vigil.sources.records import embedding_vectors
from vigil.streaming import StreamingKMeans, stage_slice, stream_lines, stream_table
from vigil.streaming.sources import run_available
from vigil.streaming.wordcount import stream_word_count, word_counts


def points(spark, *xs):
    return spark.createDataFrame([([float(x)],) for x in xs], "features ARRAY<DOUBLE>")


def state(centres, weights, decay, unit=online.BATCHES):
    return online.streaming_kmeans_init(len(centres), 1, decay=decay, time_unit=unit,
                                        centers=[[c] for c in centres], weights=weights)


def test_update_batches(spark):
    s = online.online_update(points(spark, 1, 3), state([0, 10], [4, 4], 0.5))
    assert s.centers[:, 0].tolist() == pytest.approx([1.0, 10.0])
    assert s.weights.tolist() == pytest.approx([4.0, 2.0])


def test_update_points(spark):
    s = online.online_update(points(spark, 1, 3), state([0, 10], [4, 4], 0.5, online.POINTS))
    assert s.centers[:, 0].tolist() == pytest.approx([4 / 3, 10.0])
    assert s.weights.tolist() == pytest.approx([3.0, 1.0])


def test_dying_cluster(spark):
    s = online.online_update(points(spark, 1, 3), state([0, 1e6], [0, 0], 1.0))
    assert s.weights.tolist() == [1.0, 1.0]
    assert s.centers[0, 0] == 2 + 2e-14 and s.centers[1, 0] == 2 - 2e-14


def test_update_matches_mllib(spark):
    from pyspark.mllib.clustering import StreamingKMeansModel
    from pyspark.mllib.linalg import Vectors

    emb = embedding_vectors(spark, SF0001)
    c5 = Centers.from_rows(emb, "vec_id", k=5)
    ours = online.online_update(emb, online.streaming_kmeans_init(
        5, c5.dim, weight=3.0, decay=0.7, centers=c5.values))
    model = StreamingKMeansModel([Vectors.dense(c) for c in c5.values], [3.0] * 5)
    rdd = emb.select("features").rdd.map(lambda r: Vectors.dense(r[0]))
    model = model.update(rdd, 0.7, "batches")
    assert np.allclose(np.array([np.asarray(c) for c in model.centers]), ours.centers, atol=1e-12)
    assert np.allclose(np.array(model.clusterWeights), ours.weights)


def _staged_stream_run(spark, root, model, emb, slices):
    schema = emb.schema
    for sl in slices:
        stage_slice(sl, f"{root}/in")
        run_available(model.writer(stream_table(spark, f"{root}/in", schema)), f"{root}/ckpt")


def test_stream_equals_sequential_updates(spark, scratch):
    emb = embedding_vectors(spark, SF0001)
    c5 = Centers.from_rows(emb, "vec_id", k=5)
    init = online.streaming_kmeans_init(5, c5.dim, weight=1.0, decay=0.9, centers=c5.values)
    slices = [emb.filter(F.col("vec_id") < 200), emb.filter(F.col("vec_id") >= 200)]
    _staged_stream_run(spark, scratch, StreamingKMeans(init, f"{scratch}/out"), emb, slices)
    expected = init
    for sl in slices:
        expected = online.online_update(sl, expected)
    after = (spark.read.parquet(f"{scratch}/out/centers")
             .filter((F.col("phase") == "after") & (F.col("batch_id") == 1)))
    got = Centers.from_table(after).values
    assert np.allclose(got, expected.centers, atol=1e-12)
    counts = spark.read.parquet(f"{scratch}/out/counts")
    assert dict(counts.groupBy("batch_id").agg(F.sum("cnt")).collect()) == {0: 200, 1: 300}


def test_replayed_batch_is_idempotent(spark, scratch):
    emb = embedding_vectors(spark, SF0001)
    c5 = Centers.from_rows(emb, "vec_id", k=5)
    init = online.streaming_kmeans_init(5, c5.dim, weight=1.0, decay=1.0, centers=c5.values)
    first = emb.filter(F.col("vec_id") < 250)
    second = emb.filter(F.col("vec_id") >= 250)
    model = StreamingKMeans(init, f"{scratch}/out")
    model.process(first, 0)
    model.process(second, 1)
    expected = spark.read.parquet(f"{scratch}/out/state").filter("batch_id = 1").collect()
    # A new driver replays batch 1 (e.g. after a failure before the commit).
    fresh = StreamingKMeans(init, f"{scratch}/out")
    fresh.process(second, 1)
    again = spark.read.parquet(f"{scratch}/out/state").filter("batch_id = 1").collect()
    assert sorted(map(tuple, expected)) == sorted(map(tuple, again))


def test_per_batch_word_count(spark, scratch):
    src = f"{scratch}/text"
    os.makedirs(src)
    out = f"{scratch}/out"
    for i, text in enumerate(["a b a", "a"]):
        path = f"{src}/part-{i}.txt"
        with open(path, "w") as fh:
            fh.write(text + "\n")
        os.utime(path, (time.time() + i, time.time() + i))
        run_available(stream_word_count(stream_lines(spark, src), out), f"{scratch}/ckpt")
    rows = sorted(tuple(r) for r in spark.read.parquet(out).select("batch_id", "word", "cnt").collect())
    assert rows == [(0, "a", 2), (0, "b", 1), (1, "a", 1)]


def test_complete_word_count(spark, scratch):
    src = f"{scratch}/text"
    os.makedirs(src)
    out = f"{scratch}/out"
    for i, text in enumerate(["a b a", "a"]):
        with open(f"{src}/part-{i}.txt", "w") as fh:
            fh.write(text + "\n")
        run_available(stream_word_count(stream_lines(spark, src), out, mode="complete"),
                      f"{scratch}/ckpt")
    last = spark.read.parquet(out).filter("batch_id = 1").select("word", "cnt").collect()
    assert sorted(map(tuple, last)) == [("a", 3), ("b", 1)]


def test_word_counts_batch(spark):
    df = spark.createDataFrame([("x y x",), ("y\nz x",)], "value STRING")
    assert dict(word_counts(df).collect()) == {"x": 3, "y": 1, "y\nz": 1}


def test_model_round_trip(spark, scratch):
    from vigil.operators import modeling
    from vigil.sources.models import load_bundle

    lines = spark.createDataFrame(
        [(f"{i % 5},{'tcp' if i % 2 else 'udp'},http,SF,{i % 3},{'n' if i % 4 else 'a'}",)
         for i in range(200)], "value STRING")
    bundle, score = modeling.build_model(lines, k=3, runs=1, path=f"{scratch}/m")
    loaded = load_bundle(spark, f"{scratch}/m")
    assert np.allclose(loaded.centers.values, bundle.centers.values)
    assert loaded.dictionary == bundle.dictionary
    assert np.allclose(loaded.stats.mean, bundle.stats.mean)
    assert loaded.kmeans is not None
    # saving again to the same path replaces the model
    modeling.build_model(lines, k=2, runs=1, path=f"{scratch}/m")
    assert load_bundle(spark, f"{scratch}/m").centers.k <= 2
    tagged = modeling.apply_saved_model(lines, f"{scratch}/m")
    assert tagged.count() == 200 and score >= 0


def test_sample_assignments_subset(spark, scratch):
    from vigil.operators import modeling

    emb = embedding_vectors(spark, SF0001)
    c = Centers.from_rows(emb, "vec_id", k=3)
    sample = modeling.sample_assignments(emb, c, 0.2, seed=5, path=f"{scratch}/s")
    full = {tuple(r[1]): r[0] for r in
            __import__("vigil.operators.clustering", fromlist=["x"]).assign_clusters(emb, c)
            .select("cluster", "features").collect()}
    rows = sample.collect()
    assert 0 < len(rows) < 500
    assert all(full[tuple(r["features"])] == r["cluster"] for r in rows)


def test_stream_predict_with_saved_model(spark, scratch):
    from vigil.operators import modeling
    from vigil.streaming import stream_predict

    rows = [f"{i % 5},{'tcp' if i % 2 else 'udp'},http,SF,{i % 3},{'n' if i % 4 else 'a'}"
            for i in range(120)]
    lines = spark.createDataFrame([(r,) for r in rows], "value STRING")
    modeling.build_model(lines, k=3, runs=1, path=f"{scratch}/m")
    src = f"{scratch}/in"
    os.makedirs(src)
    with open(f"{src}/part-0.txt", "w") as fh:
        fh.write("\n".join(rows) + "\n")
    predicted = stream_predict(stream_lines(spark, src), f"{scratch}/m", distance=True)
    run_available(predicted.select("value", "cluster", "distance").writeStream
                  .format("parquet").option("path", f"{scratch}/out"), f"{scratch}/ckpt")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/out").collect())
    batch = modeling.apply_saved_model(lines, f"{scratch}/m").select("label", "cluster", "distance")
    assert len(got) == 120
    assert sorted((r[1], round(r[2], 9)) for r in got) == sorted(
        (r[1], round(r[2], 9)) for r in batch.collect())


def test_echo_and_cluster_count(spark, scratch, capsys):
    from vigil.operators.evaluation import cluster_count

    src = f"{scratch}/text"
    os.makedirs(src)
    with open(f"{src}/p.txt", "w") as fh:
        fh.write("a b a\n")
    run_available(stream_word_count(stream_lines(spark, src), f"{scratch}/out", echo_rows=10),
                  f"{scratch}/ckpt")
    assert "batch 0" in capsys.readouterr().out
    df = spark.createDataFrame([(0,), (2,), (2,)], "cluster INT")
    assert cluster_count(df).first()[0] == 2


def test_streaming_kmeans_random_init_on_text_lines(spark, scratch):
    from conftest import SF0001 as sf
    from vigil.operators import parsing
    from vigil.sources.records import record_lines

    lines = record_lines(spark, sf)
    lines.filter(F.substring("value", 1, 1) < "3").write.text(f"{scratch}/in")
    vectors = parsing.parse_numeric(stream_lines(spark, f"{scratch}/in"))
    init = online.streaming_kmeans_init(k=10, dim=4, weight=0.0, decay=1.0, seed=1)
    skm = StreamingKMeans(init, out=f"{scratch}/online")
    run_available(skm.writer(vectors), f"{scratch}/ckpt")
    lines.filter(F.substring("value", 1, 1) >= "3").write.mode("append").text(f"{scratch}/in")
    run_available(skm.writer(vectors), f"{scratch}/ckpt")
    state = spark.read.parquet(f"{scratch}/online/state")
    assert sorted(r[0] for r in state.select("batch_id").distinct().collect()) == [0, 1]
    weights = [r[0] for r in state.filter("batch_id = 1").select("weight").collect()]
    assert len(weights) == 10 and all(w >= 0 for w in weights)
    counts = spark.read.parquet(f"{scratch}/online/counts")
    assert counts.agg(F.sum("cnt")).first()[0] == lines.count()


def test_word_count_stream_sums_to_batch_answer(spark, scratch):
    from conftest import SF0001 as sf
    from vigil.sources.records import table

    docs = table(spark, sf, "documents").select("doc_id", "text")
    for part in range(3):  # three arrivals, three micro-batches
        stage_slice(docs.filter(F.col("doc_id") % 3 == part), f"{scratch}/in")
        stream = stream_table(spark, f"{scratch}/in", docs.schema)
        run_available(stream_word_count(stream, f"{scratch}/out", "text"), f"{scratch}/ckpt")
    per_batch = spark.read.parquet(f"{scratch}/out")
    assert per_batch.select("batch_id").distinct().count() == 3
    summed = dict(per_batch.groupBy("word").agg(F.sum("cnt")).collect())
    assert summed == dict(word_counts(docs, "text").collect())


def test_start_stream_processing_time(spark, scratch):
    from vigil.streaming.sources import start_stream

    src = f"{scratch}/text"
    os.makedirs(src)
    with open(f"{src}/p.txt", "w") as fh:
        fh.write("x y x\n")
    query = start_stream(stream_word_count(stream_lines(spark, src), f"{scratch}/out"),
                         f"{scratch}/ckpt", "1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    got = dict(spark.read.parquet(f"{scratch}/out").select("word", "cnt").collect())
    assert got == {"x": 2, "y": 1}


def test_socket_source_is_a_text_stream(spark):
    # Building the reader opens nothing; no query is started here.
    df = stream_lines(spark, fmt="socket", host="localhost", port=9999)
    assert df.isStreaming and df.columns == ["value"]


def test_restart_resumes_from_stored_state(spark, scratch):
    emb = embedding_vectors(spark, SF0001)
    c5 = Centers.from_rows(emb, "vec_id", k=5)
    init = online.streaming_kmeans_init(5, c5.dim, weight=1.0, decay=0.8, centers=c5.values)
    first, second = emb.filter(F.col("vec_id") < 300), emb.filter(F.col("vec_id") >= 300)
    _staged_stream_run(spark, scratch, StreamingKMeans(init, f"{scratch}/out"), emb, [first])
    # "Restarted driver": a new object whose own initial model is wrong on purpose.
    wrong = online.streaming_kmeans_init(5, c5.dim, weight=0.0, decay=0.8, seed=9)
    _staged_stream_run(spark, scratch, StreamingKMeans(wrong, f"{scratch}/out"), emb, [second])
    expected = online.online_update(second, online.online_update(first, init))
    after = (spark.read.parquet(f"{scratch}/out/centers")
             .filter((F.col("phase") == "after") & (F.col("batch_id") == 1)))
    assert np.allclose(Centers.from_table(after).values, expected.centers, atol=1e-12)


def test_empty_batch_only_decays(spark):
    empty = spark.createDataFrame([], "features ARRAY<DOUBLE>")
    s = online.online_update(empty, state([0, 10], [4, 2], 0.5))
    assert s.centers[:, 0].tolist() == [0.0, 10.0]
    assert s.weights.tolist() == [2.0, 1.0]
