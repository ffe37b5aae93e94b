"""Queries that pass over the record lines several times make them once; what several
passes need is found without shuffling all lines."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from vigil.operators import clustering, manyfit
from vigil.plans import catalog
from vigil.sources import records

ONCE = """
anomalies_kmeans
build_model
sweep_records_entropy
sweep_records_one_hot
stream_new_files
stream_saved_model
one_hot_sparse
kmeans_many_runs
sparse_assign
top_anomalies
apply_saved_model
detect_anomalies
detect_lines
sweep_records_raw
sweep_records_z
profile_clusters
""".split()


@pytest.mark.parametrize("name", ONCE)
def test_record_lines_are_made_once(spark, monkeypatch, name):
    made, plain = spark.sparkContext.accumulator(0), records.record_lines
    want = plain(spark, SF0001).count()

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(records, "record_lines", lambda s, d: plain(s, d).mapInArrow(counted, "value string"))
    catalog.QUERIES[name](spark, SF0001).collect()
    assert made.value == want


def test_blocks_of_near_rows_meet_few_centres_and_find_the_nearest():
    rng = np.random.default_rng(5)
    x = np.hstack([np.eye(6)[rng.integers(0, 6, 20_000)] * 3.0, rng.normal(size=(20_000, 3))])
    models = [x[rng.choice(len(x), k, replace=False)] for k in (90, 60, 90)]
    every = manyfit._Models(models)
    blocks = list(every.blocks(x))
    assert sorted(np.concatenate(blocks)) == list(range(len(x))) and max(map(len, blocks)) <= manyfit.BLOCK
    met = 0
    for rows in blocks:
        kept, _, _ = every.block(x[rows])
        met += len(kept) * len(rows)
        for j, best, d2 in every.nearest(x[rows]):
            exact = ((x[rows][:, None, :] - models[j][None]) ** 2).sum(axis=2)
            assert np.allclose(d2, exact.min(axis=1), rtol=1e-10, atol=0)
            assert np.allclose(exact[np.arange(len(rows)), best], exact.min(axis=1), rtol=1e-10, atol=0)
    assert met < len(x) * 240 / 4


def test_vectors_that_are_cached_are_not_cached_again(spark, monkeypatch):
    df = spark.range(40).select(F.array(F.col("id").cast("double")).alias("features")).persist()
    df.count()
    held, seen, collect = spark.sparkContext._jsc.getPersistentRDDs, [], manyfit._collect
    before = held().size()
    monkeypatch.setattr(manyfit, "_collect", lambda d, m, f: (collect(d, m, f), seen.append(held().size()))[0])
    clustering.kmeans_fit(df, k=2, runs=2, max_iter=1)
    df.unpersist()
    assert set(seen) == {before}


def test_stream_predict_reads_a_table_of_several_files(spark, scratch):
    emb = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    emb.repartition(3).write.parquet(f"{scratch}/embeddings.parquet")
    want = {tuple(r) for r in catalog.q_stream_predict(spark, SF0001).collect()}
    assert len(want) == 500 and {tuple(r) for r in catalog.q_stream_predict(spark, scratch).collect()} == want


def test_first_lines_are_those_of_a_sort_of_the_distinct(spark):
    lines = spark.range(3000).select((F.col("id") % 700).cast("string").alias("value")).repartition(5)
    want = lines.distinct().orderBy(F.md5(F.col("value").cast("binary"))).limit(40).collect()
    assert sorted(catalog._first_lines(lines, 40).collect()) == sorted(want)
    few = spark.createDataFrame([("a",), ("b",), ("a",)], "value STRING")
    assert {r[0] for r in catalog._first_lines(few, 40).collect()} == {"a", "b"}
    assert catalog._first_lines(few.limit(0), 40).count() == 0
