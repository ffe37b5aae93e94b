"""Near-duplicate documents by tensored MinHash banding.

A document's shingles are hashed by two small collections of ``m`` sub-signatures
of ``k`` minhashes each. Table (i, j) is keyed by sub-signature i of the first
and j of the second collection: m * m tables of 2k-hash keys cost 2 * m * k
minhashes in place of 2 * m * m * k. Two documents of similarity s share a table
with probability (1 - (1 - s^k)^m)^2; at s = 0.8, k = 2, m = 10 they are missed
once in 14,000, and a copy in a group has many ways to be found.

Every link is confirmed on the full sets. Work per bucket is kept linear:

1. documents with equal sets stand as one node;
2. in each bucket every member is compared with one centre, first only the
   centre that comes first for it, then, across classes that are still apart,
   the others;
3. of buckets that still hold several classes, those with the same largest class
   are taken together; members outside it are compared with all members, in blocks
   of bounded size, inside tasks; only links leave a task. After that no two
   documents that share a bucket are left unlinked by omission.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import WordHash, chunks, connected_components, mix, opened, sealed, words_of, written

HASHES, TABLES = 2, 10
#: Ids up to this many are broadcast (16 MB); more are joined by a shuffle.
BROADCAST_IDS = 500_000
QUERY_BLOCK, MEMBER_BLOCK = 256, 512


def shingle_hashes(words: list[bytes], n: int, memo: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; fewer words: the whole
    sequence as one; no word: none."""
    if not words:
        return np.empty(0, np.uint64)
    w = memo.of(words)
    size = min(n, len(w))
    with np.errstate(over="ignore"):
        h = mix(w[: len(w) - size + 1] + np.uint64(size))
        for k in range(1, size):
            h = mix(h ^ w[k: len(w) - size + 1 + k])
    return np.unique(h)


def _seeds(m: int, k: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(2 * m * k, dtype=np.uint64)) | np.uint64(1)


def _minhashes(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    least = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, len(shingles), 8192):
            part = shingles[start: start + 8192]
            np.minimum(least, (seeds[:, None] * part[None, :]).min(axis=1), out=least)
    return least


def _signatures(n: int, m: int, k: int):
    def run(batches):
        memo, seeds = WordHash(), _seeds(m, k)
        salts = [np.uint64(0x1234567), np.uint64(0xABCDEF01)]
        for batch in chunks(batches):
            size, f1, f2, subs = [], [], [], []
            for text in batch["text"].to_pylist():
                s = shingle_hashes(words_of(text), n, memo)
                size.append(len(s))
                if not len(s):
                    f1.append(0), f2.append(0), subs.append(None)
                    continue
                with np.errstate(over="ignore"):
                    f1.append(int(mix(s ^ salts[0]).sum().view(np.int64)))
                    f2.append(int(mix(s ^ salts[1]).sum().view(np.int64)))
                    h = _minhashes(s, seeds).reshape(2 * m, k)
                    sub = h[:, 0]
                    for c in range(1, k):
                        sub = mix(sub ^ h[:, c])
                subs.append(sub.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.array(size, pa.int64()), pa.array(f1, pa.int64()),
                 pa.array(f2, pa.int64()), pa.array(subs, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "f1", "f2", "subs"])
    return run


def _sets(n: int):
    def run(batches):
        memo = WordHash()
        for batch in chunks(batches):
            sets = [shingle_hashes(words_of(t), n, memo).view(np.int64) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array(sets, pa.list_(pa.int64()))],
                                             names=["id", "shingles"])
    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough by their full sets."""
    x = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = (F.size("x") + F.size("y"))
    # a first look at the sizes: the smaller set must reach `percent` of the larger
    near = (F.lit(100) * F.least(F.size("x"), F.size("y")) >= F.lit(percent) * F.greatest(F.size("x"), F.size("y")))
    shared = F.size(F.array_intersect("x", "y"))
    return (pairs.join(y, "b").join(x, "a").filter(near)
            .filter(F.lit(100) * shared >= F.lit(percent) * (both - shared)).select("a", "b"))


def _block_links(percent: int):
    """Links between the queries and the members of one block pair."""
    def run(table: pa.Table) -> pa.Table:
        out_a, out_b = [], []
        side = np.asarray(table["query"])
        ids, classes = np.asarray(table["id"]), np.asarray(table["component"])
        lists = table["shingles"].combine_chunks()
        flat, offsets = np.asarray(lists.flatten()), np.concatenate(([0], np.cumsum(np.asarray(lists.value_lengths()))))
        sizes = np.diff(offsets)
        owner = np.repeat(np.arange(len(ids)), sizes)
        q, m = np.flatnonzero(side), np.flatnonzero(~side)
        common = np.intersect1d(flat[side[owner]], flat[~side[owner]])
        shared = np.zeros((len(q), len(m)), np.float32)
        place = np.empty(len(ids), np.int64)
        place[q], place[m] = np.arange(len(q)), np.arange(len(m))
        where = np.searchsorted(common, flat)
        hit = where < len(common)
        hit[hit] = common[where[hit]] == flat[hit]
        order = np.argsort(where[hit], kind="stable")
        col, row = where[hit][order], owner[hit][order]
        for start in range(0, len(common), 4096):
            lo, hi = np.searchsorted(col, [start, start + 4096])
            c, r = col[lo:hi] - start, row[lo:hi]
            width, isq = min(4096, len(common) - start), side[r]
            dense_q, dense_m = np.zeros((len(q), width), np.float32), np.zeros((len(m), width), np.float32)
            dense_q[place[r[isq]], c[isq]] = 1
            dense_m[place[r[~isq]], c[~isq]] = 1
            shared += dense_q @ dense_m.T  # whole numbers below 2^24: exact
        inter = shared.astype(np.int64)
        union = sizes[q][:, None] + sizes[m][None, :] - inter
        links = (100 * inter >= percent * union) & (classes[q][:, None] != classes[m][None, :])
        for i in np.flatnonzero(links.any(axis=1)):  # one link to each class is enough
            _, first = np.unique(classes[m][links[i]], return_index=True)
            out_b.extend(ids[m][links[i]][first].tolist())
            out_a.extend([ids[q[i]]] * len(first))
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})
    return run


def _leftover_links(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across the classes that still meet in a bucket (see the module text)."""
    named = members.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left") \
        .withColumn("component", F.coalesce("component", "rep"))
    mark = F.xxhash64("rep").cast("decimal(38,0)")
    per_class = named.groupBy("i", "key", "component").agg(F.count("*").alias("c"), F.sum(mark).alias("mark"))
    contested = (per_class.groupBy("i", "key")
                 .agg(F.sum("c").alias("size"), F.sum("mark").alias("mark"), F.count("*").alias("classes"),
                      F.max("c").alias("most"))
                 .filter("classes > 1 and size > 2"))
    # tables often hold the same members again: one of them is enough
    once = contested.groupBy("size", "mark").agg(F.min(F.struct("i", "key", "most")).alias("x"))
    contested = once.select("x.i", "x.key", "x.most", "size")
    main = (per_class.join(contested, ["i", "key"]).filter("c = most")
            .groupBy("i", "key", "most", "size").agg(F.min("component").alias("main")))
    # all buckets with the same main class are looked at together, each document once
    work = written(named.join(main, ["i", "key"]).select("main", "rep", "component").distinct()
                   .withColumn("query", F.col("component") != F.col("main")), "contested")
    sizes = work.groupBy("main").agg(F.count("*").alias("size"), F.sum(F.col("query").cast("long")).alias("queries"))
    work = work.join(sizes, "main")
    spot = F.abs(F.xxhash64("rep"))
    q_blocks = F.ceil(F.col("queries") / QUERY_BLOCK).cast("int")
    m_blocks = F.ceil(F.col("size") / MEMBER_BLOCK).cast("int")
    as_query = (work.filter("query").withColumn("qb", (spot % q_blocks).cast("int"))
                .withColumn("mb", F.explode(F.sequence(F.lit(0), m_blocks - 1))))
    as_member = (work.withColumn("mb", (spot % m_blocks).cast("int")).withColumn("query", F.lit(False))
                 .withColumn("qb", F.explode(F.sequence(F.lit(0), q_blocks - 1))))
    units = as_query.unionByName(as_member).select("main", "qb", "mb", "query", "component", F.col("rep").alias("id"))
    return (units.join(sets, "id").groupBy("main", "qb", "mb")
            .applyInArrow(_block_links(percent), "a long, b long"))


def _classes(base: DataFrame, n: int, percent: int, m: int, k: int, by_id: bool) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id) of each row of ``base`` (doc_id, text):
    the least id among the rows of its class. With ``by_id``, rows of one id are one node;
    else each set of shingles is one."""
    base = base.withColumn("text_hash", F.xxhash64("text"))
    features = written(base.mapInArrow(
        _signatures(n, m, k), "doc_id long, text_hash long, n_shingles long, f1 long, f2 long, subs array<long>"), "minhash")
    usable = features.filter("n_shingles > 0 and doc_id is not null")
    finger = ["n_shingles", "f1", "f2"]
    # numbered once, as the table is written
    groups = written(usable.groupBy(*finger).agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.first("subs").alias("subs"))
                     .withColumn("node", F.monotonically_increasing_id()), "reps")

    table = F.col("t")
    keys = (groups.select(F.col("node").alias("rep"), "subs", F.explode(F.sequence(F.lit(0), F.lit(m * m - 1))).alias("t"))
            .select("rep", F.floor(table / m).cast("int").alias("i"),
                    F.xxhash64(table, F.get("subs", F.floor(table / m).cast("int")),
                               F.get("subs", (table % m + m).cast("int"))).alias("key")))
    # centre: the member whose scrambled number is least (xor is its own inverse)
    scramble = 0x5DEECE66D1234ABC
    shared = (keys.groupBy("i", "key").agg(F.count("*").alias("size"),
                                           F.min(F.col("rep").bitwiseXOR(F.lit(scramble))).alias("c"))
              .filter("size > 1"))
    members = written(keys.join(shared, ["i", "key"])
                      .select("i", "key", "rep", F.col("c").bitwiseXOR(F.lit(scramble)).alias("centre")), "buckets")
    pairs = written(members.filter("rep <> centre").groupBy("rep", "centre").agg(F.count("*").alias("tables"))
                    .select(F.col("rep").alias("a"), F.col("centre").alias("b"), "tables"), "pairs")

    met = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    needed = written(groups.join(met, "node", "left_semi").select("rep.doc_id", "rep.text_hash", "node"), "needed")
    if needed.count() <= BROADCAST_IDS:
        needed = F.broadcast(needed)
    # a repeated row stands for its node more than once, which changes nothing
    sets = written(base.join(needed, ["doc_id", "text_hash"]).select("node", "text")
                   .mapInArrow(_sets(n), "id long, shingles array<long>"), "sets")

    # first for each document the centre it shares most tables with ...
    best = pairs.groupBy("a").agg(F.max("tables").alias("tables"))
    best = pairs.join(best, ["a", "tables"]).groupBy("a").agg(F.min("b").alias("b"))
    links = written(_confirmed(best, sets, percent), "links")
    # ... then the other centres, but for those that two steps along the links show to be
    # of the same class
    roots = links
    for _ in range(2):
        up = links.select(F.col("a").alias("b"), F.col("b").alias("up"))
        roots = roots.join(up, "b", "left").select("a", F.coalesce("up", "b").alias("b"))
    rest = _apart(pairs.join(best, ["a", "b"], "left_anti").select("a", "b"), written(roots.select(F.col("a").alias("node"), F.col("b").alias("component")), "roots"))
    more = written(_confirmed(rest, sets, percent), "links")
    labels = written(connected_components(links.union(more)), "labels")
    last = written(_leftover_links(members, labels, sets, percent), "links")
    if by_id:  # the nodes that rows of one id are in
        several = usable.groupBy("doc_id").agg(F.min("text_hash").alias("x"), F.max("text_hash").alias("y")).filter("x <> y")
        nodes = (usable.join(several, "doc_id", "left_semi").select("doc_id", *finger).join(groups.select(*finger, "node"), finger)
                 .select("doc_id", "node").distinct())
        least = nodes.groupBy("doc_id").agg(F.min("node").alias("b"))
        last = last.union(nodes.join(least, "doc_id").filter("node <> b").select(F.col("node").alias("a"), "b"))
    # each class is one node for the links that are left
    joined = written(connected_components(_apart(last, labels).select(F.col("ca").alias("a"), F.col("cb").alias("b"))), "labels")
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("joined"))

    named = (groups.select(*finger, "rep.doc_id", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
             .join(joined, "component", "left").withColumn("component", F.coalesce("joined", "component")))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    classes = named.join(least, "component").select(*finger, "component_id")
    return (features.select("doc_id", "text_hash", *finger).join(classes, finger, "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                    percent: int = 80, m: int = TABLES, k: int = HASHES) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of ``docs``.

    Two documents link when 100 * |intersection| >= percent * |union| of their sets
    of distinct ``n``-word shingles; component_id is the smallest id reachable.
    Null or wordless texts have an empty set, link with nothing and are kept. A row
    without an id keeps a null component and is kept. Rows with words that share an id
    are one node: a link of any of them counts for the id. An empty table gives an empty result.
    Other columns are not read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = _classes(base, n, percent, m, k, by_id=True)
    return (found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
            .select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", "kept"))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b, ca, cb): the pairs of nodes in different classes, and those classes."""
    for end in ("a", "b"):
        pairs = (pairs.join(labels.select(F.col("node").alias(end), F.col("component").alias(f"c{end}")), end, "left")
                 .withColumn(f"c{end}", F.coalesce(f"c{end}", end)))
    return pairs.filter("ca <> cb").select("a", "b", "ca", "cb")


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                         percent: int = 80, m: int = TABLES, k: int = HASHES) -> DataFrame:
    """The rows of ``docs`` that carry the smallest id of their class; all columns stay.

    Classes are of texts here: rows that share an id but not a class are judged apart, so
    each class leaves at least one row. Rows with equal ids and texts stay or go together;
    a row without an id, or without words, stays.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    gone = (_classes(base, n, percent, m, k, by_id=False).filter("doc_id <> component_id")
            .select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct())
    left = sealed(docs, id_col, text_col).join(gone, (F.col(id_col).cast("long") == F.col("gone_id"))
                                               & (F.xxhash64(F.col(text_col).cast("string")) == F.col("gone_hash")), "left_anti")
    return opened(left, docs.columns, id_col, text_col)
