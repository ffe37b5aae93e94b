import random

import corpus_pipeline
from conftest import SF0001


def test_stages_keep_the_columns_and_the_clean_documents(spark, tmp_path):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(400)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage, near = prose(60), prose(80)
    item = "Which of these seven rivers flows north through the old stone city"
    rows, kind, labels = [], {}, []

    def add(what, text):
        i = len(rows)
        rows.append((i, text, "en", "src", None if text is None else len(text)))
        kind[i] = what
        return i

    for _ in range(150):
        labels.append((add("clean", prose(50)), 1, 0))
    for _ in range(60):
        labels.append((add("toxic", prose(30) + " insulta insultb " + prose(10)), 1, 1))
    for _ in range(15):
        add("passage", prose(30) + "\n" + passage + "\n" + prose(30))
    for i in range(9):
        add("near", near + (f" tail{i}" if i else ""))
    for _ in range(4):
        add("leak", prose(20) + ". " + item + " " + prose(20))
    add("null", None)
    add("empty", "")
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")

    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, path)
        if name != "packing":
            assert out.columns == columns
        out.write.parquet(f"{path}/{k}")
        docs = spark.read.parquet(f"{path}/{k}")
        seen[name] = {r.doc_id: r for r in docs.collect()}

    def left(stage, what):
        return [i for i in seen[stage] if kind[i] == what]

    assert len(left("toxicity", "clean")) == 150 and not left("toxicity", "toxic")
    with_passage = [i for i in left("line_dedup", "passage") if passage in seen["line_dedup"][i].text]
    assert len(left("line_dedup", "passage")) == 15 and with_passage == [min(i for i in kind if kind[i] == "passage")]
    assert all(r.n_chars == len(r.text) for r in seen["line_dedup"].values() if r.text is not None)
    assert len(left("minhash_near_dedup", "near")) == 1 and len(left("minhash_near_dedup", "clean")) == 150
    assert not left("benchmark_decontamination", "leak")
    packed = seen["packing"]
    assert set(packed) == set(seen["benchmark_decontamination"])
    assert len([i for i in packed if kind[i] == "clean"]) == 150 and left("packing", "null") and left("packing", "empty")


def test_run_covers_the_given_tables(spark):
    rows = corpus_pipeline.run(spark, SF0001).collect()
    assert 0 < len(rows) == len({r.doc_id for r in rows})
