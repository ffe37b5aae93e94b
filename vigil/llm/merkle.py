"""A Merkle manifest of a dataset, by nested-interval labels.

Every row is a leaf; a part's leaves are ranked by id, and a node carries the interval
of leaf ranks that it covers. A node's ancestors are the intervals that contain its own:
levels are joined on (part, bucket), the bucket being the place of the interval on the
upper level, and on containment. What a parent's children cover beside the node's own
interval are its siblings. The parts' roots are the leaves of one more such tree.

Texts never leave their scan: only hashes are shuffled. Ranks come from a range
partitioning and the partitions' counts, so a part that holds a third of all rows is
ranked by many tasks. The side strings of a leaf's upper levels are made once a parent
and handed down, so a leaf's own row stays small until its last join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16
PATH = "array<struct<left:string,right:string>>"


def hash_of(*texts: Column) -> Column:
    """Lowercase hex sha256 of the texts put together."""
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def leaf_hash(*fields: Column) -> Column:
    """Hash of the fields, each `-` if null, else its UTF-8 length, a colon and its text."""
    def spelled(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return hash_of(*map(spelled, fields))


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf hash and its siblings lead to."""
    return F.aggregate(path, leaf, lambda h, side: F.sha2(F.concat(side["left"], h, side["right"]).cast("binary"), 256))


def path_hash(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def ranked(rows: DataFrame, part: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with rank (from 0, long) and n (the part's number of rows), as a written
    table. ``part`` columns must not be null."""
    ranged = rows.repartitionByRange(*part, *order).withColumn("range", F.spark_partition_id())
    ranged = written(ranged, name)
    counts = ranged.groupBy(*part, "range").count()  # partitions + parts rows at most
    before = Window.partitionBy(*part).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*part, "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"),
                            F.sum("count").over(Window.partitionBy(*part)).alias("n"))
    here = F.row_number().over(Window.partitionBy(*part, "range").orderBy(*order)) - 1
    return written(ranged.withColumn("here", here).join(offsets, [*part, "range"])
                   .withColumn("rank", F.col("here") + F.col("offset")).drop("range", "here", "offset"), name)


def _tree(leaves: DataFrame, part: Sequence[str], fanout: int, name: str, keep: Sequence[str] = ()) -> list[DataFrame]:
    """Nodes by level, from the leaves up: (part, place, lo, hi, n, hash, children), and
    ``keep`` of the leaves. A part ends at the level where one node is left."""
    kids = "array<struct<lo:bigint,hi:bigint,hash:string>>"
    levels = [leaves.select(*part, F.col("rank").alias("place"), F.col("rank").alias("lo"), F.col("rank").alias("hi"), "n",
                            "hash", F.lit(None).cast(kids).alias("children"), *keep)]
    most, width = leaves.agg(F.max("n")).first()[0] or 0, 1
    while width < most:
        below = levels[-1].filter(F.col("n") > width)
        up = (below.groupBy(*part, F.floor(F.col("place") / fanout).cast("long").alias("place"))
              .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("n").alias("n"),
                   F.array_sort(F.collect_list(F.struct("lo", "hi", "hash"))).alias("children")))
        joined = F.array_join(F.transform("children", lambda c: c["hash"]), "")
        levels.append(written(up.select(*part, "place", "lo", "hi", "n", F.sha2(joined.cast("binary"), 256).alias("hash"), "children"), name))
        width *= fanout
    return levels


def _tops(levels: list[DataFrame], fanout: int) -> DataFrame:
    """The one node that is left of each part."""
    out = None
    for k, nodes in enumerate(levels):
        top = nodes.filter((F.col("n") <= fanout**k) & (F.col("n") > (fanout ** (k - 1) if k else 0)))
        top = top.select(*levels[-1].columns)
        out = top if out is None else out.unionByName(top)
    return out


def _paths(levels: list[DataFrame], part: Sequence[str], fanout: int, crown: DataFrame, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """(part, rank, *keep, path, and what ``crown`` has) of the leaves. ``crown`` gives every
    part (part, path, ...) the siblings beyond its own root. The leaves' own paths are made
    by the last join and shuffled no more."""
    more = [c for c in crown.columns if c not in (*part, "path")]
    above = None
    for k in range(len(levels) - 1, -1, -1):
        nodes, kept = levels[k], list(keep) if k == 0 else []
        top = (nodes.filter((F.col("n") <= fanout**k) & (F.col("n") > (fanout ** (k - 1) if k else 0)))
               .join(crown, [*part]).select(*part, "place", "lo", "hi", "children", *kept, "path", *more))
        if above is not None:
            over = above.select(*part, F.col("place").alias("bucket"), F.col("lo").alias("from"), F.col("hi").alias("to"),
                                F.col("children").alias("kin"), F.col("path").alias("beyond"), *more)
            inside = nodes.withColumn("bucket", F.floor(F.col("place") / fanout).cast("long"))
            held = inside.join(over, [*part, "bucket"]).filter("from <= lo and hi <= to")

            def side(test):
                return F.array_join(F.transform(F.filter("kin", test), lambda c: c["hash"]), "")

            here = F.struct(side(lambda c: c["hi"] < F.col("lo")).alias("left"), side(lambda c: c["lo"] > F.col("hi")).alias("right"))
            top = top.unionByName(held.select(*part, "place", "lo", "hi", "children", *kept,
                                              F.concat(F.array(here), "beyond").cast(PATH).alias("path"), *more))
        above = written(top, name) if k else top
    return above.select(*part, F.col("lo").alias("rank"), *keep, "path", *more)


def dataset_manifest(docs: DataFrame, *, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", part_col: str = "source",
                     fanout: int = FANOUT, carry: Sequence[str] = ()) -> DataFrame:
    """(id, *carry, rank, leaf, subroot, root, path) of every row of ``docs``; ``carry``
    names narrow columns to keep, none of those names.

    leaf: ``leaf_hash`` of ``fields``. Within a part, leaves ascend by id, a null id first,
    equal ids by their leaf hash (equal rows are interchangeable). While several nodes are
    left, every ``fanout`` consecutive ones (at last fewer, even one) become the hash of
    their hashes put together; what is left is the part's subroot (a lone leaf itself).
    Subroots, a null part first and the others bytewise, lead to the root in the same way.
    path: left and right siblings, level by level, up to the root. Null and empty texts are
    told apart by the leaf; a text of any length is one hash; an empty table has no rows
    and no root; other columns are not read, whatever they are called.
    """
    part = ["has", "part"]
    quoted = [F.col(f"`{c}`") for c in fields]
    where = F.col(f"`{part_col}`").cast("string")
    rows = docs.select(where.isNotNull().alias("has"), F.coalesce(where, F.lit("")).alias("part"), F.col(f"`{id_col}`").alias("id"),
                       leaf_hash(*quoted).alias("hash"), F.struct(F.lit(0), *[F.col(f"`{c}`") for c in carry]).alias("carried"))
    leaves = ranked(rows, part, ["id", "hash"], "leaves")
    kept = ["id", "carried", "leaf"]
    levels = _tree(leaves.withColumn("leaf", F.col("hash")), part, fanout, "nodes", kept)

    # the parts' roots are the leaves of a tree of one part
    subroots = ranked(_tops(levels, fanout).select(F.lit(0).alias("all"), *part, F.col("hash")), ["all"], part, "subroots")
    upper = _tree(subroots, ["all"], fanout, "subnodes")
    crown = _tops(upper, fanout).select("all", F.array().cast(PATH).alias("path"), F.col("hash").alias("root"))
    crown = (subroots.join(_paths(upper, ["all"], fanout, crown, "subpaths"), ["all", "rank"])
             .select(*part, "path", "root", F.col("hash").alias("subroot")))
    crown = written(crown, "crown")

    paths = _paths(levels, part, fanout, crown, "paths", kept)
    return paths.select(F.col("id").alias(id_col), *[F.col("carried").getField(c).alias(c) for c in carry], "rank",
                        "leaf", "subroot", "root", "path")
