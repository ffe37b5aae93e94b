import random

import pytest

from vigil.llm import common
from vigil.llm.minhash import near_duplicates


def least_of(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


@pytest.fixture()
def tables(monkeypatch):
    """The names of the tables written in a test."""
    names, write = [], common.written
    monkeypatch.setattr(common, "written", lambda df, name: names.append(name) or write(df, name))
    return names


def test_any_graph(spark):
    rng = random.Random(4)
    path = [(i, i + 1) for i in range(100, 140)]
    edges = path + [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    rng.shuffle(edges)
    got = common.connected_components(spark.createDataFrame(edges + [(None, 1)], "a long, b long")).collect()
    want = {x: c for x, c in least_of(edges).items() if any(a != b and x in (a, b) for a, b in edges)}
    assert sorted((r.node, r.component) for r in got) == sorted(want.items())


def test_stars_are_not_gone_over_again(spark, tables):
    edges = [(i, i // 10 * 10) for i in range(60) if i % 10] + [(1, 0), (2, 0)]
    got = common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {i: i // 10 * 10 for i in range(60)} and len(got) == 60
    assert tables == ["edges"]


def test_no_edges(spark, tables):
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
    assert tables == ["edges"]


def test_an_id_joins_classes_through_inner_members(spark, frame):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(9**6)}" for _ in range(60)) for _ in range(4)]
    near = [[t] + [f"{t} end{k}{i}" for i in range(4)] for k, t in enumerate(texts)]
    rows = [(10 * (k + 1) + i, t) for k, group in enumerate(near) for i, t in enumerate(group)]
    rows += [(99, near[0][2]), (99, near[1][3]), (98, near[1][1]), (98, near[2][4])]
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(rows)).collect()}
    assert got == {i: 40 if 40 <= i < 50 else 10 for i, _ in rows}
