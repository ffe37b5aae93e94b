"""Per-batch sinks, new files only, idle intervals, following a saved model, moments."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from vigil.functions.random import normal_matrix, seeded_normal
from vigil.operators import clustering, features, online
from vigil.operators.clustering import Centers
from vigil.operators.features import Stats
from vigil.sources.models import ModelBundle, load_bundle, newest_save, refresh_stats, save_bundle
from vigil.sources.records import embedding_vectors
from vigil.streaming import (
    StreamingKMeans,
    read_stream_assignments,
    skip_existing,
    stage_slice,
    stream_lines,
    stream_predict_latest,
    stream_table,
    stream_write_assignments,
)
from vigil.streaming.sources import noted, run_available, write_batch


def test_tagged_lines_are_read_once_and_whole(spark, scratch):
    emb = embedding_vectors(spark, SF0001)
    centers, out = Centers.from_rows(emb, "vec_id", k=3), f"{scratch}/out"
    writers = []
    for b in range(2):
        stage_slice(emb.filter(F.col("vec_id") % 2 == b), f"{scratch}/in")
        writers.append(stream_write_assignments(stream_table(spark, f"{scratch}/in", emb.schema), centers, out))
        run_available(writers[-1], f"{scratch}/ckpt")
    want = sorted((r["vec_id"] % 2, r["cluster"], tuple(r["features"])) for r in clustering.assign_clusters(emb, centers).collect())

    def got():
        return sorted((r["batch_id"], r["cluster"], tuple(r["features"])) for r in read_stream_assignments(spark, out).collect())

    assert got() == want
    # a batch that wrote its lines but not its commit is not seen; a replay writes both again
    write_batch(spark.createDataFrame([("0,1.0",)], "value STRING"), f"{out}/lines", 7, "text")
    assert got() == want
    replay = stream_write_assignments(stream_table(spark, f"{scratch}/in", emb.schema), centers, out)
    run_available(replay, f"{scratch}/fresh")  # another checkpoint: both slices come as batch 0
    again = read_stream_assignments(spark, out)
    assert again.filter("batch_id = 0").count() == 500 and again.filter("batch_id = 1").count() == 250


def test_files_already_there_are_skipped_once(spark, scratch):
    seen = []

    def run():
        stream = stream_lines(spark, f"{scratch}/in")
        skip_existing(stream, f"{scratch}/ckpt")
        run_available(stream.writeStream.foreachBatch(lambda batch, i: seen.extend(r[0] for r in batch.collect())), f"{scratch}/ckpt")

    stage_slice(spark.createDataFrame([("old",)], "value STRING"), f"{scratch}/in", "text")
    run()
    assert seen == []
    stage_slice(spark.createDataFrame([("new",)], "value STRING"), f"{scratch}/in", "text")
    run()  # a restart: what came since the last stop is read, once
    run()
    assert seen == ["new"]


def test_idle_intervals_age_the_weights(spark, scratch):
    rows = spark.createDataFrame([([0.0],), ([2.0],), ([10.0],)], "features ARRAY<DOUBLE>")
    start = online.streaming_kmeans_init(2, 1, decay=0.5, centers=[[1.0], [10.0]], weights=[8.0, 4.0])
    ticks = iter([3, 6, 99])
    model = StreamingKMeans(start, f"{scratch}/out", label=None, interval=10, clock=lambda: 10.0 * next(ticks) + 4)
    model.process(rows, 0)
    model.process(rows.limit(0), 1)  # two intervals lie between
    state = model.state_before(rows, 2)
    # 8 -> 8/2+2 = 6 and 4 -> 4/2+1 = 3; idle twice and the batch itself: an eighth of it
    assert state.weights.tolist() == pytest.approx([0.75, 0.375]) and state.centers.ravel().tolist() == pytest.approx([1.0, 10.0])
    model._memo = None
    model.process(rows.limit(0), 1)  # a replay takes the interval that was written down
    assert model.state_before(rows, 2).weights.tolist() == pytest.approx([0.75, 0.375]) and next(ticks) == 99


def test_idle_ticks_equal_updates_without_rows():
    state = online.OnlineState(np.array([[0.0], [5.0], [9.0]]), np.array([1e9, 3.0, 2.0]), 0.5)
    slow = state
    for _ in range(7):
        slow = online.merge_update(slow, np.zeros((3, 1)), np.zeros(3))
    fast = online.idle_ticks(state, 7)
    assert np.allclose(fast.weights, slow.weights) and np.array_equal(fast.centers, slow.centers)
    assert online.idle_ticks(state, 0) is state


def test_a_stream_follows_the_newest_model(spark, scratch):
    lines = [f"{i},a,b,c,{2 * i},l" for i in range(6)]

    def save(values):
        save_bundle(spark, ModelBundle(Centers(values)), f"{scratch}/model")
        return newest_save(spark, f"{scratch}/model")

    saves = []
    for b, values in enumerate(([[0.0, 0.0], [5.0, 10.0]], [[5.0, 10.0], [0.0, 0.0]])):
        saves.append(save(values))
        stage_slice(spark.createDataFrame([(x,) for x in lines[3 * b: 3 * b + 3]], "value STRING"), f"{scratch}/in", "text")
        run_available(stream_predict_latest(stream_lines(spark, f"{scratch}/in"), f"{scratch}/model", f"{scratch}/out"), f"{scratch}/ckpt")
    got = {r["value"]: (r["cluster"], r["model"], r["batch_id"]) for r in spark.read.parquet(f"{scratch}/out/tagged").collect()}
    assert got[lines[0]] == (0, saves[0], 0) and got[lines[2]] == (0, saves[0], 0) and got[lines[5]] == (0, saves[1], 1)
    # a replayed batch keeps the model it had
    assert noted(spark, f"{scratch}/out/models", 0, lambda: "other") == saves[0]
    assert load_bundle(spark, f"{scratch}/model", saves[0]).centers.values.tolist() == [[0.0, 0.0], [5.0, 10.0]]
    with pytest.raises(ValueError):
        load_bundle(spark, f"{scratch}/model", "v-none")


def test_merged_statistics_are_those_of_all_rows(spark, scratch):
    rng = np.random.default_rng(2)
    x = rng.normal(1000.0, 0.001, size=(300, 3))
    parts = [spark.createDataFrame([(r.tolist(),) for r in x[a:b]], "features ARRAY<DOUBLE>") for a, b in ((0, 1), (1, 90), (90, 300))]
    fits = [Stats.fit(p) for p in parts]
    whole = fits[0].merge(fits[1]).merge(fits[2])
    assert whole.n == 300 and np.allclose(whole.mean, x.mean(axis=0)) and np.allclose(whole.sd, x.std(axis=0), rtol=1e-6)
    assert np.allclose(whole.totals, x.sum(axis=0)) and np.allclose(whole.squares, (x * x).sum(axis=0))
    moments = {r["dim"]: r for r in features.column_moments(parts[1].union(parts[2])).collect()}
    assert moments[1]["n"] == 299 and moments[1]["total"] == pytest.approx(x[1:, 1].sum()) and moments[1]["squares"] == pytest.approx((x[1:, 1] ** 2).sum())
    empty = Stats((), (), 0)
    assert empty.merge(whole) is whole and whole.merge(empty) is whole
    save_bundle(spark, ModelBundle(Centers(x[:2]), None, fits[1]), f"{scratch}/m")
    refresh_stats(spark, f"{scratch}/m", parts[2])
    assert np.allclose(load_bundle(spark, f"{scratch}/m").stats.sd, x[1:].std(axis=0), rtol=1e-6)


def test_seeded_normals():
    m = normal_matrix(400, 25, seed=3)
    assert abs(m.mean()) < 0.03 and abs(m.std() - 1) < 0.03 and np.array_equal(m[:7, :2], normal_matrix(7, 2, seed=3))
    assert m[3, 4] == seeded_normal(3, 3, 4) != seeded_normal(4, 3, 4) and len(np.unique(m)) == m.size
