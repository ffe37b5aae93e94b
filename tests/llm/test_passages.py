import random
from collections import Counter

import numpy as np
import pytest

from vigil.llm import passages
from vigil.llm.common import WordHash
from vigil.llm.passages import Windows, drop_repeated_passages, levels


def brute(texts, size):
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for t, w in zip(texts, split):
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                gone.update(range(i, i + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out.append((len(w), len(gone), None if t is None else kept))
    return out


def texts(size, seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "A", "a", "x y"]
    passage = [rng.choice(words) for _ in range(3 * size)]
    out = []
    for i in range(60):
        t = [rng.choice(words) for _ in range(rng.randrange(0, 6 * size))]
        if i % 3 == 0:  # a shared passage, whole or a part about as long as a window
            a = rng.randrange(0, size)
            t[len(t) // 2:len(t) // 2] = passage[a:a + rng.choice([size - 1, size, size + 1, 2 * size])]
        out.append(rng.choice([" ", "\n", " \t "]).join(t))
    out += [None, None, "", " \n", "one", " ".join(["again"] * (size - 1)), " ".join(["again"] * (size + 1)),
            " ".join(["ab cd"] * (2 * size)), out[3], out[3], "long " * 20_000 + " ".join(passage)]
    return out


@pytest.mark.parametrize("size", [1, 2, 9, 12, 35])
def test_against_brute_force(spark, size, monkeypatch):
    monkeypatch.setattr(passages, "CHUNK", 3000)
    rows = texts(size)
    docs = spark.createDataFrame([(None if i % 9 == 5 else i % 50, t, i, "x") for i, t in enumerate(rows)],
                                 "doc_id long, text string, n_words int, t1 string").repartition(4)
    got = drop_repeated_passages(docs.withColumnRenamed("n_words", "n").withColumn("n_removed", docs.t1), words=size)
    assert got.columns == ["doc_id", "text", "n", "t1", "n_words", "n_removed"]
    by = {r.n: r for r in got.collect()}
    assert len(by) == len(rows) == got.count()
    want = brute(rows, size)
    assert [(by[i].n_words, by[i].n_removed, by[i].text) for i in range(len(rows))] == want
    assert all(by[i].doc_id == (None if i % 9 == 5 else i % 50) and by[i].t1 == "x" for i in range(len(rows)))


def test_empty_table_and_only_a_text_column(spark):
    assert drop_repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = spark.createDataFrame([("a " * 40,), (None,)], "text string")
    assert sorted(map(tuple, drop_repeated_passages(one).collect()), key=repr) == [("", 40, 40), (None, 0, 0)]


def test_a_level_ends_windows_that_stand_nowhere_else():
    rng = random.Random(2)
    text = " ".join(f"u{rng.randrange(10**9)}" for _ in range(500))
    w = Windows([text], [False], 35, WordHash())
    names, _, several = w.counted(9)
    assert len(names) < 120 and not several.any()  # about two names of nine words for 27 windows
    w.keep(9, 4, {})
    assert not w.open.any() and levels(35) == [9, 18, 35] and levels(5) == [5] and levels(100) == [7, 13, 25, 50, 100]


def test_names_depend_on_the_order_and_length():
    memo, a, b = WordHash(), b"a", b"b"
    w = Windows(["a b b a", "b a b a"], [False, False], 2, memo)
    names = w.names(2)
    assert names[0] != names[2] and names[2] == names[4] == names[6] and len(np.unique(w.names(4)[[0, 4]])) == 2
    assert memo[a] != memo[b]
