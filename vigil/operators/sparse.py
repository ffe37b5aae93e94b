"""One-hot features of any number of categories, as sparse rows.

A row is (idx ARRAY<INT>, val ARRAY<DOUBLE>), its non-zero cells by ascending index, in
the same order of dimensions as the dense form: every categorical field replaced in place
by its block of categories. Categories get their indexes from a table, by a join a
field, so neither the dictionary nor a dense row is ever in one place; the driver sees a
number a field (the size of its block) and no more. Spark broadcasts a dictionary that
is small by its own measure and else sorts, where adaptive execution splits the rows of
a category that a third of all records have.

Distances to z-scored centres need the non-zero cells of the category blocks only. With
s = 1/sd and t = -(mean s + c), these add Σ t² + Σ over cells (x² s² + 2 x s t): the first
sum is one number a centre, the mean shift is folded into t. The few numeric dimensions,
whose means may be large beside their deviations, are compared directly.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators.clustering import Centers
from vigil.operators.features import distinct_categories
from vigil.operators.parsing import DEFAULT_CATEGORICAL, FIELDS, _to_double, numeric_segments, with_fields
from vigil.session import shared_dir

#: Centre cells (k × d) up to which they travel with the tasks (256 MB); more are joined.
TASK_CELLS = 32_000_000


def category_index(lines: DataFrame, value: str = "value", categorical: Sequence[int] = DEFAULT_CATEGORICAL,
                   sep: str = ",") -> DataFrame:
    """(field INT, category STRING, idx INT): categories numbered alphabetically inside
    their field, as a written table. A field of any number of categories is numbered by
    many tasks: a range partitioning, numbers inside each range, and the ranges' counts."""
    spark = lines.sparkSession

    def written(df: DataFrame) -> DataFrame:
        path = shared_dir(spark, "categories")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    pairs = distinct_categories(lines, value, categorical, sep).filter(F.col("category").isNotNull())
    ranged = written(pairs.repartitionByRange("field", "category").withColumn("range", F.spark_partition_id()))
    counts = ranged.groupBy("field", "range").count()  # ranges + fields rows at most
    before = Window.partitionBy("field").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("field", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    here = F.row_number().over(Window.partitionBy("field", "range").orderBy("category")) - 1
    return written(ranged.withColumn("here", here).join(offsets, ["field", "range"])
                   .select("field", "category", (F.col("here") + F.col("offset")).cast("int").alias("idx")))


@dataclass(frozen=True)
class SparseLayout:
    """Where each part of a record lies: the first index of every categorical field's
    block, of every numeric run, and the number of dimensions."""

    blocks: dict[int, int]
    runs: tuple[int, ...]
    dim: int
    numeric: tuple[int, ...]  # the dimensions of the numeric fields

    @classmethod
    def of(cls, sizes: dict[int, int], n_fields: int) -> "SparseLayout":
        """``sizes``: categories of each categorical field; ``n_fields`` counts the label."""
        blocks, runs, numeric, at, field = {}, [], [], 0, 0
        for p in [*sorted(sizes), max(n_fields - 1, max(sizes, default=-1) + 1)]:
            if p > field or p not in sizes:
                runs.append(at)
                numeric += range(at, at + p - field)
                at += p - field
            if p in sizes:
                blocks[p] = at
                at += sizes[p]
            field = p + 1
        return cls(blocks, tuple(runs), at, tuple(numeric))


def _numbered(values: Column, start: int) -> Column:
    return F.transform(values, lambda x, i: F.struct((i + start).alias("i"), x.alias("x")))


def sparse_one_hot(lines: DataFrame, index: DataFrame, value: str = "value", categorical: Sequence[int] = DEFAULT_CATEGORICAL,
                   mode: str = "strict", handle_invalid: str = "error", keep_line: bool = False,
                   sep: str = ",") -> tuple[DataFrame, SparseLayout]:
    """((label, idx, val), layout) of record lines; ``index`` as ``category_index`` gives it.

    Zero numbers have no cell. ``handle_invalid``: a category that is not in the index
    (or missing) raises ("error"), drops the row ("skip") or has no cell ("keep"). The
    number of fields is that of the first line; another one is an error in strict mode.
    """
    if handle_invalid not in ("error", "skip", "keep"):
        raise ValueError("handle_invalid must be 'error', 'skip' or 'keep'")
    categorical = sorted(int(p) for p in categorical)
    sizes = dict.fromkeys(categorical, 0) | {r["field"]: r["n"] for r in index.groupBy("field").agg(F.count("*").alias("n")).collect()}
    rows = with_fields(lines, value, sep, categorical, mode)
    first = rows.select(F.size(FIELDS)).first()
    layout = SparseLayout.of(sizes, first[0] if first else len(categorical) + 1)
    fields = F.col(FIELDS)
    if mode == "strict" and first:
        wrong = F.raise_error(F.concat(F.lit(f"not {first[0]} fields: "), F.coalesce(value, F.lit("NULL"))))
        rows = rows.withColumn(FIELDS, F.when(F.size(fields) == first[0], fields).otherwise(wrong.cast("array<string>")))
    for p in categorical:
        block = index.filter(F.col("field") == p).select(F.col("category").alias(f"category_{p}"), (F.col("idx") + layout.blocks[p]).alias(f"idx_{p}"))
        rows = rows.join(block, F.get(fields, F.lit(p)) == F.col(f"category_{p}"), "inner" if handle_invalid == "skip" else "left")
        if handle_invalid == "error":
            unseen = F.raise_error(F.concat(F.lit(f"unseen category in field {p}: "), F.coalesce(F.get(fields, F.lit(p)), F.lit("NULL"))))
            rows = rows.withColumn(f"idx_{p}", F.coalesce(f"idx_{p}", unseen.cast("int")))
    cells, run = [], 0
    for kind, item in numeric_segments(fields, categorical, _to_double(mode)):
        if kind == "cat":
            cells.append(F.array(F.struct(F.col(f"idx_{item}").alias("i"), F.lit(1.0).alias("x"))))
        else:
            cells.append(_numbered(item, layout.runs[run]))
            run += 1
    held = F.filter(F.concat(*cells), lambda c: c["i"].isNotNull() & ((c["x"] != 0) | c["x"].isNull()))
    out = rows.select(*([value] if keep_line else []), F.try_element_at(fields, F.lit(-1)).alias("label"), held.alias("cells"))
    return out.select(*[c for c in out.columns if c != "cells"], F.transform("cells", lambda c: c["i"]).alias("idx"),
                      F.transform("cells", lambda c: c["x"]).alias("val")), layout


def sparse_cells(rows: DataFrame, *keep: str) -> DataFrame:
    """(*keep, dim, x): one row a non-zero cell."""
    pair = F.explode(F.arrays_zip("idx", "val")).alias("c")
    return rows.select(*keep, pair).select(*keep, F.col("c.idx").alias("dim"), F.col("c.val").alias("x"))


def sparse_stats(rows: DataFrame) -> DataFrame:
    """(dim, n, mean, sd_pop) of every dimension that has a non-zero cell, zeros counted:
    the number of rows (one job), and partial aggregates of the cells."""
    n = F.lit(rows.count())
    per = sparse_cells(rows).groupBy("dim").agg(F.count("x").alias("held"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    apart, zeros = F.col("m") - F.col("mean"), n - F.col("held")
    squared = F.col("held") * (F.col("v") + apart * apart) + zeros * F.col("mean") * F.col("mean")
    return (per.withColumn("mean", F.col("m") * F.col("held") / n)
            .select("dim", n.alias("n"), "mean", F.sqrt(squared / n).alias("sd_pop")))


class _Folded:
    """Centres of z-scored rows: weights of the raw cells of the category blocks, and the
    numeric dimensions as they are."""

    def __init__(self, centers: np.ndarray, mean: np.ndarray, sd: np.ndarray, numeric: Sequence[int]):
        sd = np.where(sd > 0, sd, 1.0)
        self.numeric = list(numeric)
        self.place = np.full(len(mean), -1)
        self.place[self.numeric] = np.arange(len(self.numeric))
        shift = -(mean / sd + centers)
        shift[:, self.numeric] = 0.0
        self.scale = np.where(self.place < 0, 1.0 / sd, 0.0)
        self.base, self.weights = (shift * shift).sum(axis=1), np.ascontiguousarray((2.0 * self.scale * shift).T)
        self.mean, self.sd, self.plain = mean[self.numeric], sd[self.numeric], centers[:, self.numeric]

    def numbers(self, idx: np.ndarray, val: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
        """Squared distances over the numeric dimensions, and the base."""
        x, mine = np.zeros((rows, len(self.numeric))), self.place[idx] >= 0
        x[owner[mine], self.place[idx[mine]]] = val[mine]
        x = (x - self.mean) / self.sd
        out = np.repeat(self.base[None, :], rows, axis=0)
        for i in range(len(self.numeric)):
            diff = x[:, i, None] - self.plain[None, :, i]
            out += diff * diff
        return out

    def distances(self, idx: np.ndarray, val: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Squared distance of each row to each centre."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        out = self.numbers(idx, val, owner, len(sizes))
        out += np.bincount(owner, (val * self.scale[idx]) ** 2, len(sizes))[:, None]
        filled = sizes > 0
        if filled.any():
            out[filled] += np.add.reduceat(val[:, None] * self.weights[idx], (np.cumsum(sizes) - sizes)[filled])
        return np.maximum(out, 0.0)


def _pieces(batches, block: int = 2048):
    """(piece, idx, val, cells a row) of at most ``block`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, block):
            part = batch.slice(start, block)
            idx, val = (part[c].flatten().to_numpy(zero_copy_only=False) for c in ("idx", "val"))
            yield part, idx, val.astype(float), np.asarray(part["idx"].value_lengths())


def _nearest_kernel(folded: _Folded):
    def run(batches):
        for part, idx, val, sizes in _pieces(batches):
            d2 = folded.distances(idx, val, sizes)
            best = d2.argmin(axis=1)
            distance = np.sqrt(d2[np.arange(len(best)), best])
            unknown = np.isnan(distance)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(best.astype(np.int32), mask=unknown), pa.array(distance, mask=unknown)],
                names=[*part.schema.names, "cluster", "distance"])
    return run


def _numbers_kernel(folded: _Folded):
    """Adds the part of the squared distances that needs no category."""
    def run(batches):
        for part, idx, val, sizes in _pieces(batches, 512):
            near = folded.numbers(idx, val, np.repeat(np.arange(len(sizes)), sizes), len(sizes))
            lists = pa.ListArray.from_arrays(np.arange(len(near) + 1, dtype=np.int32) * near.shape[1], pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "near"])
    return run


def sparse_assign(rows: DataFrame, layout: SparseLayout, centers: Centers, mean: Sequence[float], sd: Sequence[float]) -> DataFrame:
    """``rows`` with cluster and distance of the nearest centre in z-scored space; a row
    with a missing number has none.

    The centres are k × d numbers; up to TASK_CELLS they travel with the tasks, beyond it
    the weights of the category blocks are a table by dimension that each cell is joined
    with, and a row's k partial sums are added up before its nearest centre is taken.
    """
    folded = _Folded(np.asarray(centers.values), np.asarray(mean, dtype=float), np.asarray(sd, dtype=float), layout.numeric)
    if centers.values.size <= TASK_CELLS:
        schema = T.StructType([*rows.schema.fields, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.DoubleType())])
        return rows.mapInArrow(_nearest_kernel(folded), schema)
    return _assign_by_join(rows, folded)


def _assign_by_join(rows: DataFrame, folded: _Folded) -> DataFrame:
    spark, k = rows.sparkSession, len(folded.base)
    path, numbered = shared_dir(spark, "weights"), shared_dir(spark, "rows")
    blocks = np.flatnonzero(folded.place < 0)
    for start in range(0, len(blocks), 100_000):  # the driver holds the centres; they leave it in pieces
        part = [(int(i), float(folded.scale[i]), folded.weights[i].tolist()) for i in blocks[start: start + 100_000]]
        spark.createDataFrame(part, "dim INT, scale DOUBLE, w ARRAY<DOUBLE>").write.mode("append").parquet(path)
    slim = _Folded.__new__(_Folded)
    slim.numeric, slim.place, slim.mean, slim.sd, slim.plain, slim.base = (
        folded.numeric, folded.place, folded.mean, folded.sd, folded.plain, folded.base)
    kept = rows.withColumn("row", F.monotonically_increasing_id())
    kept = kept.mapInArrow(_numbers_kernel(slim), kept.withColumn("near", F.array(F.lit(0.0))).schema)
    kept.write.parquet(numbered)
    kept = spark.read.parquet(numbered)
    sums = (sparse_cells(kept, "row").join(spark.read.parquet(path), "dim").groupBy("row")
            .agg(F.sum((F.col("x") * F.col("scale")) ** 2).alias("own"),
                 F.array(*[F.sum(F.col("x") * F.get("w", F.lit(j))) for j in range(k)]).alias("dots")))
    d2 = F.transform(F.zip_with("near", F.coalesce("dots", F.array_repeat(F.lit(0.0), k)), lambda a, b: a + b),
                     lambda v, j: F.struct(F.greatest(v + F.coalesce("own", F.lit(0.0)), F.lit(0.0)).alias("sq"), j.alias("j")))
    whole = ~F.exists("val", lambda x: x.isNull() | F.isnan(x))
    out = kept.join(sums, "row", "left").withColumn("best", F.when(whole, F.array_min(d2)))
    return out.select(*rows.columns, F.col("best.j").alias("cluster"), F.sqrt("best.sq").alias("distance"))
