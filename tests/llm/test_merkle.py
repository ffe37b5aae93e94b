import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from vigil.llm.merkle import dataset_manifest, fold, leaf_hash, path_hash


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(hashes, fanout):
    """(top, siblings by leaf and level as (left, right))."""
    places, sides = list(range(len(hashes))), [[] for _ in hashes]
    while len(hashes) > 1:
        runs = [hashes[i:i + fanout] for i in range(0, len(hashes), fanout)]
        for i, p in enumerate(places):
            run, at = runs[p // fanout], p % fanout
            sides[i].append(("".join(run[:at]), "".join(run[at + 1:])))
            places[i] = p // fanout
        hashes = [sha(*run) for run in runs]
    return hashes[0], sides


def brute(rows, fanout):
    """One (doc_id, leaf, subroot, root, proof, siblings) a row."""
    parts = {}
    for row in rows:
        parts.setdefault(row[1], []).append((row[0], leaf_of(row)))
    names = sorted(parts, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        parts[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    tops = {s: climb([h for _, h in parts[s]], fanout) for s in names}
    root, above = climb([tops[s][0] for s in names], fanout) if names else (None, [])
    out = []
    for s, up in zip(names, above):
        for (doc, leaf), side in zip(parts[s], tops[s][1]):
            path = side + up
            out.append((doc, leaf, tops[s][0], root, sha(*[x for pair in path for x in pair]), tuple(path)))
    return out


def table():
    rows = [(i, "hot", "en", i % 7, f"Text {i} é" * (i % 3)) for i in range(300)]
    rows += [(1000 + i, f"part{i}", None if i % 2 else "de", None, "Same") for i in range(40)]
    rows += [(None, "hot", None, None, None), (None, "hot", "en", 1, "A"), (5, "hot", "en", 5, "again"), (7, None, "en", 3, "x"), (8, None, "en", 3, ""),
             (9, "", "en", 0, "long " * 40_000), rows[4], rows[4], (10, "é", "en", 0, None), (11, "z", "en", 0, "y")]
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("fanout", [2, 16])
def test_against_brute_force(spark, fanout):
    rows = table()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'c' AS leaf", "'c' AS place", "'c' AS part", "0 AS n").repartition(5)
    got = dataset_manifest(docs, fanout=fanout).withColumn("proof", path_hash(F.col("path"))).withColumn("again", fold(F.col("path"), F.col("leaf")))
    got = got.collect()
    have = sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof, tuple((s.left, s.right) for s in r.path)) for r in got), key=repr)
    assert have == sorted(brute(rows, fanout), key=repr)
    assert all(r.again == r.root for r in got)


def test_tampering_shows(spark):
    docs = spark.createDataFrame(table(), SCHEMA)
    changed = F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))
    docs = docs.withColumn("now", leaf_hash(*[changed if c == "text" else F.col(c) for c in docs.columns]))
    got = dataset_manifest(docs, carry=["now"]).withColumn("ok", fold(F.col("path"), F.col("now")) == F.col("root")).collect()
    assert all(r.ok == (r.now == r.leaf) for r in got) and 0 < sum(not r.ok for r in got) < len(got)


def test_few_rows(spark):
    assert dataset_manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    row = dataset_manifest(spark.createDataFrame([(1, "s", "en", 1, "a")], SCHEMA)).first()
    assert row.leaf == row.subroot == row.root == leaf_of((1, "s", "en", 1, "a")) and row.path == [] and row["rank"] == 0


def test_the_query(spark, tmp_path):
    from vigil.llm.queries import op12_merkle_manifest

    rows = table()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = op12_merkle_manifest(spark, str(tmp_path)).collect()
    want = {(doc, leaf): (subroot, root, proof) for doc, leaf, subroot, root, proof, _ in brute(rows, 16)}
    assert len(got) == len(rows)
    texts = {leaf_of(r): r[4] for r in rows}
    for r in got:
        assert want[r.doc_id, r.leaf] == (r.subroot, r.root, r.proof_sha256)
        text = texts[r.leaf]
        touched = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and text is not None and text != text.lower()
        assert r.verified == (not touched) == (r.folded_root == r.root)
