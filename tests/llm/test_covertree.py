import re

import numpy as np
import pyarrow as pa

from vigil.llm import covertree
from vigil.llm.covertree import near_vectors


def brute(rows, cosine):
    ok = {i: np.asarray(v, float) / np.abs(v).max() for i, v in rows if i is not None and v is not None and len(v)
          and all(c is not None for c in v) and np.isfinite(v).all() and np.any(v)}
    links, parent = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(ok)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            if len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] / np.sqrt((ok[i] @ ok[i]) * (ok[j] @ ok[j])) >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (links[i], find(i)) for i, _ in rows}


def make(rng, n, dim):
    base = rng.normal(size=(max(2, n // 12), dim))
    return [(int(i), (base[rng.integers(len(base))] + rng.choice([0.0, 0.05, 0.15, 0.3, 0.5]) * rng.normal(size=dim)).tolist()) for i in rng.permutation(n)]


def check(spark, rows, cosine=0.9):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS cell", "'x' AS block").repartition(4)
    got = near_vectors(df, cosine=cosine).collect()
    want = brute(rows, cosine)
    assert len(got) == len(rows)
    for r in got:
        links, component = want[r.vec_id]
        assert (r.n_links, r.component_id, r.kept) == (links, component, r.vec_id == component or r.vec_id is None)


def test_small_blocks_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK", 60)
    rng = np.random.default_rng(4)
    rows = make(rng, 400, 6) + [(1000 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 1e-3 * i]) for i in range(90)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 6), (2003, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2004, [float("nan")] * 6), (2005, [float("inf")] + [0.0] * 5),
             (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (2008, [1e200, 2e200]), (None, [1.0] + [0.0] * 5)]
    check(spark, rows)


def test_one_block_and_empty_table(spark):
    check(spark, make(np.random.default_rng(5), 250, 12), 0.8)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_vectors(empty).count() == 0


def test_no_cell_pair_within_reach_is_pruned():
    lost = 0
    for seed in range(6):
        rng = np.random.default_rng(seed)
        base = rng.normal(size=(40, 4))
        x = base[rng.integers(40, size=3000)] + 0.15 * rng.normal(size=(3000, 4))
        x /= np.linalg.norm(x, axis=1)[:, None]
        pivots = x[covertree.farthest_first(x, 300)]
        radius, t = np.full(len(pivots), 0.02), np.sqrt(2 - 2 * 0.9)
        radius[::17] = -1
        d = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))
        due = {(i, j) for i, j in zip(*np.nonzero(d <= t + 0.04)) if i < j and radius[i] >= 0 and radius[j] >= 0}
        lost += len(due - {(a, b) for a, b in covertree._kept_cells(pivots, radius, t)})
    assert lost == 0


def test_vectors_without_structure_need_few_exact_products(monkeypatch):
    """Pairs at cosine 0.6, too far apart to link, gave roots so wide that half of all
    other points were multiplied with their points one by one."""
    rng, t = np.random.default_rng(8), np.sqrt(0.2)
    x = rng.normal(size=(800, 64))
    x[400:480] = x[:80] + 0.9 * rng.normal(size=(80, 64))
    x[480:500] = x[:20] + 0.1 * rng.normal(size=(20, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    table = pa.table({"vec_id": np.arange(800), "block": ["b"] * 800, "unit": [v.tobytes() for v in x]})
    block, products, points = covertree._Block(covertree._plant(t)(None, table).to_pylist()[0]), [], covertree._points

    def counted(a, b, i, j, *rest):
        products.append(int(((a.end[i] - a.start[i]) * (b.end[j] - b.start[j])).sum()))
        return points(a, b, i, j, *rest)

    monkeypatch.setattr(covertree, "_points", counted)
    links, _, _ = covertree.block_links(block, block, True, 0.9)
    want = (x @ x.T >= 0.9).sum(axis=1) - 1
    assert links.tolist() == want[block.ids].tolist() and want.sum() >= 40
    assert sum(products) < 5 * 800


def test_vectors_do_not_travel_with_the_pairs_of_blocks(spark, monkeypatch):
    """Each pair of blocks once shuffled both blocks' vectors."""
    monkeypatch.setattr(covertree, "BLOCK", 25)
    plans, plain = {}, covertree.written
    monkeypatch.setattr(covertree, "written", lambda df, name: (plans.setdefault(name, (df.columns, df._jdf.queryExecution().toString())), plain(df, name))[1])
    rng = np.random.default_rng(6)
    check(spark, [(i, rng.normal(size=9).tolist()) for i in range(300)])
    assert not re.search(r"\b(points|unit|raw)#", plans["links"][1])
    assert [name for name, (columns, _) in plans.items() if {"points", "unit", "raw"} & set(columns)] == ["cells"]


def test_many_vectors_of_one_id_and_rows_that_repeat(spark, monkeypatch):
    """Ids that share a block leave others of the cell without rows; a vector and its
    double under one id are one."""
    monkeypatch.setattr(covertree, "BLOCK", 10)
    rng = np.random.default_rng(7)
    near = (np.array([1.0, 0, 0, 0]) + 0.2 * rng.normal(size=(60, 4))).astype(np.float32)
    rows = [(1 + (i > 55), v.tolist()) for i, v in enumerate(near)]
    unit = near.astype(float) / np.linalg.norm(near.astype(float), axis=1)[:, None]
    links = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    df = spark.createDataFrame(rows + rows[:30] + [(i, [2 * x for x in v]) for i, v in rows[10:40]], "vec_id long, embedding array<float>")
    got = {(r.vec_id, r.n_links) for r in near_vectors(df.repartition(3)).collect()}
    assert got == {(1, int(links[:56].sum())), (2, int(links[56:].sum()))}


def test_a_tie_of_pivots_goes_one_way_wherever_the_row_stands():
    rng = np.random.default_rng(9)
    pivots = np.concatenate((np.eye(12), -np.eye(12)))
    x = np.repeat(covertree.units_of(rng.integers(0, 2, size=(40, 12)) + np.eye(40, 12)), 7, axis=0)
    alone = [int(covertree.nearest_pivot(v[None], pivots)[0][0]) for v in x]
    for order in (np.arange(len(x)), rng.permutation(len(x))):
        assert covertree.nearest_pivot(x[order], pivots)[0].tolist() == [alone[i] for i in order]
