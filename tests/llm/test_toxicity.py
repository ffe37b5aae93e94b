import random

import numpy as np
import pytest
import xxhash

from vigil.llm.toxicity import Machine, fit_machine, score_toxicity, terms_of, train


def h(word):
    return xxhash.xxh3_64_intdigest(word.encode()) - (1 << 63)


def corpus(n=700, seed=2):
    rng = random.Random(seed)
    plain = [f"plain{i}" for i in range(60)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(3, 40))]
        toxic = i % 5 == 0 or i % 7 == 0
        if toxic:
            words += rng.sample(["insulta", "insultb", "insultc", "insultd"], 2)
        rng.shuffle(words)
        docs.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_edge_rows(spark, frame):
    docs, labels = corpus()
    extra = [(5000, None), (5001, ""), (None, "insulta insultb"), (5002, "insulta insultb " + "plain1 " * 30_000), docs[0]]
    label_rows = labels + [(None, 1), (5001, None), (labels[1][0], labels[1][1])]
    table = frame(docs + extra)
    model = train(table, spark.createDataFrame(label_rows, "doc_id long, toxic int"))
    got = score_toxicity(table, model).selectExpr("*", "crc32(cast(cast(doc_id as string) as binary)) % 5 AS fold").collect()
    assert len(got) == len(docs) + len(extra) and all(0 <= r.score <= 1 for r in got)
    truth = dict(labels)
    held = [(truth[r.doc_id], r.score >= 0.5) for r in got if r.doc_id in truth and r.fold == 0]
    assert len(held) > 100 and np.mean([a == b for a, b in held]) > 0.97
    by = {r.doc_id: r.score for r in got}
    assert by[None] > 0.5 and by[5002] > 0.5 and by[5000] == by[5001] < 0.5


def test_pairs_count_that_no_sum_of_weights_can():
    rng = random.Random(1)
    docs, labels = [], []
    for _ in range(1200):  # toxic only if both terms are there, or neither
        a, b = rng.random() < 0.5, rng.random() < 0.5
        docs.append(np.asarray([h("x")] * a + [h("y")] * b + [h(f"n{rng.randrange(20)}")], np.int64))
        labels.append(float(a == b))
    terms = np.sort(np.asarray([h("x"), h("y"), *[h(f"n{i}") for i in range(20)]], np.int64))
    model = fit_machine(docs, np.asarray(labels), np.ones(len(docs)), terms)
    rows = [model.rows_of(d) for d in docs]
    z = model.logits(np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows]), len(rows))
    assert np.mean((z > 0) == np.asarray(labels)) > 0.95


def test_logits_equal_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    model = Machine(np.arange(6), 0.3, np.append(rng.normal(size=6), 0), np.vstack((rng.normal(size=(6, 3)), np.zeros((1, 3)))))
    rows = np.asarray([0, 2, 5])
    want = 0.3 + model.linear[rows].sum() + sum(model.factors[i] @ model.factors[j] for i in rows for j in rows if i < j)
    assert model.logits(rows, np.zeros(3, int), 1)[0] == pytest.approx(want)
    assert terms_of("A a, b-C é!") == {b"a", b"b", b"c", "é".encode()} and terms_of(None) == set()


def test_without_labels(spark, frame):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for rows in ([], [(1, "a"), (2, None)]):
        got = score_toxicity(frame(rows), train(frame(rows), none)).collect()
        assert [r.score for r in got] == [0.5] * len(rows)


def test_train_keeps_terms_that_tell_nothing_alone(spark, frame):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(1500):  # toxic only if both terms are there, or neither
        a, b = i % 2, i // 2 % 2
        docs.append((i, " ".join(["groupx"] * a + ["wordy"] * b + [f"plain{rng.randrange(20)}"])))
        labels.append((i, int(a == b)))
    table = frame(docs)
    model = train(table, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {h("groupx"), h("wordy")} <= set(model.terms.tolist())
    truth = dict(labels)
    assert np.mean([(r.score >= 0.5) == bool(truth[r.doc_id]) for r in score_toxicity(table, model).collect()]) > 0.95


def test_the_driver_gets_small_places_of_known_terms(spark, frame, monkeypatch):
    from vigil.llm import toxicity

    docs, labels = corpus(300)
    got, fit = [], toxicity.fit_machine
    monkeypatch.setattr(toxicity, "fit_machine", lambda *a: got.append(a) or fit(*a))
    model = train(frame(docs), spark.createDataFrame(labels, "doc_id long, toxic int"))
    (places, sizes), truth, weights, terms = got[0]
    assert places.dtype == np.int32 and len(places) == sizes.sum() and len(sizes) == len(truth)
    hashes = np.split(terms[places], np.cumsum(sizes)[:-1])
    assert all((x[1:] > x[:-1]).all() for x in hashes)
    same = fit(hashes, truth, weights, terms)
    assert same.bias == model.bias and (same.linear == model.linear).all() and (same.factors == model.factors).all()
