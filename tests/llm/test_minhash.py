import random

import pytest

from vigil.llm.minhash import drop_near_duplicates, near_duplicates


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(rows, n, percent=80):
    sets = [(d, shingles(t, n)) for d, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (a, s) in enumerate(sets):
        for b, t in sets[:x]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return [(d, len(s), None if d is None else find(d) if s else d, d is None or not s or find(d) == d) for d, s in sets]


def documents():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for base in range(14):
        text = [rng.choice(words) for _ in range(rng.choice([3, 8, 40, 120]))]
        for _ in range(rng.choice([1, 2, 5, 40])):
            copy = list(text)
            for _ in range(rng.randrange(0, max(1, len(text) // 7))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    rows += [(9000, None), (9001, ""), (9002, " \t\n"), (9003, "Solo"), (9004, "solo"), (None, rows[0][1]), rows[5],
             (9005, "long " * 30_000 + "end"), (9006, "LONG " * 29_999 + "long\nend")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n", [2, 5])
def test_against_brute_force(spark, frame, n):
    rows = documents()
    got = near_duplicates(frame(rows), n=n).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows, n), key=repr)


def test_one_document_of_a_group_stays(spark, frame):
    rows = [(i, "the same five or more words again") for i in range(50)] + [(99, "something else with five words"), (None, "x")]
    left = drop_near_duplicates(frame(rows))
    assert left.columns == frame(rows).columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted([0, 99, None], key=repr)
    assert near_duplicates(frame([])).count() == 0


def test_rows_that_share_an_id_across_groups(spark, frame):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, a), (5, a), (5, b), (7, b), (9, b), (20, "x " * 30), (20, "y " * 30), (21, "Y " * 30), (3, None), (3, b)]
    got = near_duplicates(frame(rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows, 5), key=repr)
    assert {r.doc_id: r.component_id for r in got if r.n_shingles} == {1: 1, 5: 1, 7: 1, 9: 1, 20: 20, 21: 20, 3: 1}
    docs = frame(rows).selectExpr("*", "1 AS text_hash", "2 AS gone_id", "3 AS row", "4 AS node")
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    # each class of texts leaves its row of the smallest id
    assert sorted((r.doc_id, r.text) for r in left.collect() if r.text) == sorted([(1, a), (3, b), (20, "x " * 30), (20, "y " * 30)])


def test_random_rows_with_shared_ids(spark, frame):
    rng = random.Random(9)
    rows = [(i if i is None else i % 40, t) for i, t in documents()]
    rng.shuffle(rows)
    got = near_duplicates(frame(rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows, 5), key=repr)
    left = [(r.doc_id, r.text) for r in drop_near_duplicates(frame(rows)).collect()]
    sets = [shingles(t, 5) for _, t in left]
    near = [any(s and t and 100 * len(s & t) >= 80 * len(s | t) for t in sets) for s in (shingles(t, 5) for _, t in rows)]
    linked = brute([(i, t) for i, (_, t) in enumerate(rows)], 5)
    kept = {linked[rows.index(x)][2] for x in left if x[0] is not None and shingles(x[1], 5)}
    assert all(c in kept for (d, t), (_, n, c, _), in zip(rows, linked) if n and d is not None) and any(near)
