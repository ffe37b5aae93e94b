import random

import pytest

import corpus_pipeline

CLASH = ("keep", "score", "text_", "n_lines", "n_dropped", "map_id", "map_hash", "doc_", "hash_", "row", "gone_id", "text_hash", "n_items", "coverage")


def tables(spark, path, docs, labels, items):
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars int")
    frame.selectExpr("*", *[f"concat('{c}', doc_id) AS {c}" for c in CLASH]).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def test_clashing_columns_and_shared_ids_survive_every_stage(spark, tmp_path):
    rng = random.Random(1)
    words = [f"word{i}" for i in range(300)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    shared = prose(12)
    docs = [(i, f"{prose(30)}\n{shared}\n{prose(20)}", "en", "s", 1) for i in range(30)]
    docs += [(5, prose(50), "en", "s", 1), (100, docs[3][1], "en", "s", 1), (101, None, "en", None, None), (None, prose(40), None, "s", 1)]
    labels = [(i, 1, 0) for i in range(30)]
    frame = tables(spark, str(tmp_path), docs, labels, [(1, prose(20))])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == frame.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        frame = spark.read.parquet(f"{tmp_path}/{name}")
    rows = frame.collect()
    for r in rows:
        assert all(r[c] == (None if r.doc_id is None else f"{c}{r.doc_id}") for c in CLASH)
    # the copy 100 of 3 goes; both texts of id 5 stay, and the rows without a text or an id
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((d[0] is None, d[0] or 0) for d in docs if d[0] != 100)
    assert sum(shared in (r.text or "") for r in rows) == 1
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path))
    assert packed.count() == len(rows)


@pytest.mark.parametrize("docs, labels, items", [([], [], []), ([(1, "a b c", "en", "s", 5), (2, None, None, None, None)], [], []), ([(1, "", "en", "s", 0)], [(1, 1, 1)], [(1, None)])])
def test_empty_tables(spark, tmp_path, docs, labels, items):
    tables(spark, str(tmp_path), docs, labels, items)
    # without both classes among the labels nothing tells toxic from clean
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(docs)
