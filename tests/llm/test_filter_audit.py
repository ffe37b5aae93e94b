import random
import re
from itertools import permutations

import pytest

from vigil.llm.filter_audit import RULES, Diagram, adjacent_swaps, audit_filters, audit_part

SCHEMA = "doc_id long, source string, text string"


def fails(rows):
    """The failed filters of each row, E against the whole table."""
    out = []
    for doc, _, text in rows:
        t = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        f = ("A" if len(words) < 50 else "") + ("B" if 100 * len(set(words)) < 65 * len(words) else "")
        f += "C" if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else ""
        f += "D" if re.search("[#$%&*|]", t) else ""
        if doc is not None and any(d is not None and d < doc and (x or "") == t for d, _, x in rows):
            f += "E"
        out.append(f)
    return out


def brute(rows, good, toxic):
    bad, out = fails(rows), {}
    for part in {s or "" for _, s, _ in rows}:
        mine = [(f, r[0]) for r, f in zip(rows, bad) if (r[1] or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [x for x in left if c in x[0]]
                left = [x for x in left if c not in x[0]]
                total[c] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(c in f for f, _ in mine) - len(gone), sum(f == c for f, _ in mine),
                    sum(d in good for _, d in gone), sum(d in toxic for _, d in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def table():
    rng = random.Random(5)
    rows = []
    for i in range(120):
        words = [f"w{rng.randrange(rng.choice([20, 400]))}" for _ in range(rng.choice([10, 60, 90]))]
        words += ["LOUD"] * rng.choice([0, 0, 8]) + ["#tag"] * rng.choice([0, 0, 1])
        rows.append((i, rng.choice(["a", "b", None, ""]), rng.choice([" ", "\n", "  "]).join(words)))
    rows += [(200 + i, "hot", "the same text") for i in range(50)] + [(3, "a", "the same text"), (None, "b", "the same text"), (None, "hot", "the same text")]
    rows += [(300, "a", None), (301, "b", ""), (302, "hot", " \n"), (303, "a", "Long " * 30_000), rows[0], rows[0], (400, "hot", rows[7][2]), (-1, "new", "x")]
    return rows


def test_against_brute_force(spark):
    rows = table()
    good, toxic = {3, 200, 7, 0, 303, 201}, {1, 2, 3, 204, 302}
    labels = [(i, int(i in good), int(i in toxic)) for i in list(range(60)) + list(range(195, 310))]
    labels += [(3, 0, None), (None, 1, 1), (999, 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'c' AS part", "'c' AS mask", "0 AS n", "'c' AS good").repartition(4)
    got = audit_filters(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS id"))
    assert got.dtypes[:4] == [("part", "string"), ("filter_order", "string"), ("step", "int"), ("kept", "bigint")]
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got.collect()}
    assert len(got) == 5 * 600 and got == brute(rows, good, toxic)


def test_empty_tables_and_fewer_filters(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(spark.createDataFrame([], SCHEMA), none).count() == 0
    one = spark.createDataFrame([(1, "s", "a # b"), (2, "s", "a # b")], SCHEMA)
    got = audit_filters(one, none, {"short": RULES["A"], "signs": RULES["D"]}, duplicates=None, sep=">").collect()
    assert {(r.filter_order, r.step, r.removed, r.redundant, r.shapley) for r in got} == {
        ("short>signs", 1, 2, 0, 2), ("short>signs", 2, 0, 2, 2), ("signs>short", 1, 2, 0, 2), ("signs>short", 2, 0, 2, 2)}
    with pytest.raises(ValueError):
        audit_filters(one, none, {str(i): RULES["A"] for i in range(9)})


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_swaps_visit_every_order_once_and_keep_every_count(k):
    rng = random.Random(k)
    counts = {m: (rng.randrange(4), rng.randrange(2), 0) for m in range(1 << k) if rng.random() < 0.7}
    diagram, seen = Diagram(counts, k), []
    for place in [*adjacent_swaps(k), None]:
        seen.append(tuple(diagram.order))
        left = set(counts)
        for f, gone, kept in diagram.steps():
            out = {m for m in left if m >> f & 1}
            left -= out
            assert gone == tuple(sum(counts[m][i] for m in out) for i in range(3))
            assert kept == tuple(sum(counts[m][i] for m in left) for i in range(3))
        if place is not None:
            diagram.swap(place)
    assert sorted(seen) == sorted(permutations(range(k)))


def test_equal_functions_are_one_node():
    flat = Diagram({m: (2, 1, 0) for m in range(32)}, 5)
    assert [len(x) for x in flat.levels] == [1] * 6 and flat.weights[0] == [(64, 32, 0)]
    assert len(audit_part({}, list("ABCDE"))) == 600
