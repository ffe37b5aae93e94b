"""Feature building: category dictionaries, one-hot splice, statistics, scaling.

Fitted state (a dictionary, per-dimension statistics, a projection matrix)
is as large as the number of categories or dimensions, whatever the number of
rows; it is brought to the driver and turned into literals.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.random import normal_matrix
from vigil.functions.vectors import explode_dims, vector_literal
from vigil.operators.parsing import (
    DEFAULT_CATEGORICAL,
    FIELDS,
    _to_double,
    numeric_segments,
    with_fields,
)


# ----------------------------------------------------------------------------
# Category dictionaries and one-hot encoding
# ----------------------------------------------------------------------------

def distinct_categories(lines: DataFrame, value: str = "value",
                        categorical: Sequence[int] = DEFAULT_CATEGORICAL,
                        sep: str = ",") -> DataFrame:
    """Distinct (field INT, category STRING) pairs, de-duplicated with a
    partial (map-side) aggregate so only distinct pairs shuffle."""
    fields = F.col(FIELDS)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(int(p)).alias("field"), F.get(fields, F.lit(int(p))).alias("category"))
        for p in categorical]))
    return with_fields(lines, value, sep).select(pairs.alias("p")).select("p.*").distinct()


def category_dictionary(lines: DataFrame, value: str = "value",
                        categorical: Sequence[int] = DEFAULT_CATEGORICAL,
                        sep: str = ",") -> DataFrame:
    """(field INT, category STRING, idx INT): categories indexed alphabetically.

    A lazy table over the distinct pairs, numbered per field in Spark; a NULL
    category is left out.
    """
    pairs = distinct_categories(lines, value, categorical, sep).filter(F.col("category").isNotNull())
    order = Window.partitionBy("field").orderBy("category")
    return pairs.select("field", "category", (F.row_number().over(order) - 1).alias("idx"))


@dataclass(frozen=True)
class Dictionary:
    """Fitted category dictionaries: position → sorted categories."""

    categories: dict[int, tuple[str, ...]]

    @classmethod
    def fit(cls, lines: DataFrame, value: str = "value",
            categorical: Sequence[int] = DEFAULT_CATEGORICAL, sep: str = ",") -> "Dictionary":
        """One job: the distinct pairs, indexed alphabetically per field. They
        are model state like the centres: as many as the one-hot vectors have
        dimensions."""
        cats: dict[int, list[str]] = {int(p): [] for p in categorical}
        for r in distinct_categories(lines, value, categorical, sep).collect():
            if r["category"] is not None:
                cats[int(r["field"])].append(r["category"])
        return cls({f: tuple(sorted(c)) for f, c in sorted(cats.items())})

    @classmethod
    def from_table(cls, table: DataFrame) -> "Dictionary":
        """Collect a (field, category, idx) table."""
        rows = table.collect()
        cats: dict[int, list[tuple[int, str]]] = {}
        for r in rows:
            cats.setdefault(int(r["field"]), []).append((int(r["idx"]), r["category"]))
        return cls({f: tuple(c for _, c in sorted(v)) for f, v in sorted(cats.items())})

    def to_rows(self) -> list[tuple[int, str, int]]:
        return [(f, c, i) for f, cs in self.categories.items() for i, c in enumerate(cs)]

    def size(self) -> int:
        return sum(len(c) for c in self.categories.values())


def one_hot(category: Column, categories: Sequence[str], handle_invalid: str = "error",
            field: int | None = None) -> Column:
    """Indicator vector of ``category`` over the sorted ``categories``.

    Built from codegen-able array functions: the 1-based position of the
    category, then zeros / one / zeros.
    """
    n = len(categories)
    pos = F.array_position(F.lit(list(categories)).cast(T.ArrayType(T.StringType())),
                           category)
    vec = F.concat(F.array_repeat(F.lit(0.0), (pos - 1).cast("int")),
                   F.array(F.lit(1.0)),
                   F.array_repeat(F.lit(0.0), (F.lit(n) - pos).cast("int")))
    if handle_invalid == "keep":
        return F.when(pos > 0, vec).otherwise(F.array_repeat(F.lit(0.0), n))
    if handle_invalid in ("error", "skip"):
        where = "" if field is None else f" in field {field}"
        return F.when(pos > 0, vec).otherwise(F.raise_error(F.concat(
            F.lit(f"unseen category{where}: "), F.coalesce(category, F.lit("NULL")))))
    raise ValueError("handle_invalid must be 'error', 'skip' or 'keep'")


def one_hot_features(lines: DataFrame, dictionary: Dictionary | None = None,
                     value: str = "value", mode: str = "strict",
                     handle_invalid: str = "error", keep_line: bool = False,
                     sep: str = ",") -> DataFrame:
    """(label, features) with each categorical field replaced in place by its
    one-hot block: ``[num0, protocol…, service…, tcp_state…, num rest…]``.

    ``dictionary`` defaults to one fitted on ``lines`` (one extra job).
    """
    if dictionary is None:
        dictionary = Dictionary.fit(lines, value, sep=sep)
    lines = with_fields(lines, value, sep, list(dictionary.categories), mode)
    fields = F.col(FIELDS)
    to_double = _to_double(mode)
    parts = []
    for kind, item in numeric_segments(fields, list(dictionary.categories), to_double):
        if kind == "num":
            parts.append(item)
        else:
            parts.append(one_hot(F.get(fields, F.lit(item)), dictionary.categories[item],
                                 handle_invalid, item))
    out = lines
    if handle_invalid == "skip":
        for p, cats in dictionary.categories.items():
            out = out.filter(F.array_contains(
                F.lit(list(cats)).cast(T.ArrayType(T.StringType())), F.get(fields, F.lit(p))))
    cols = [F.try_element_at(fields, F.lit(-1)).alias("label"), F.concat(*parts).alias("features")]
    if keep_line:
        cols.insert(0, F.col(value))
    return out.select(*cols)


# ----------------------------------------------------------------------------
# Per-dimension statistics and scaling
# ----------------------------------------------------------------------------

def column_stats(df: DataFrame, features: str = "features") -> DataFrame:
    """(dim INT, n BIGINT, mean DOUBLE, sd_pop DOUBLE) per vector dimension.

    One pass: the per-element explode feeds a hash aggregate keyed by dimension, whose
    partial (map-side) step leaves one row per dimension per task before the
    shuffle. ``stddev_pop`` is the numerically stable population sd. Measured
    on 600k rows (local[8]): 0.26 s at d=16 and 0.37 s at d=120, on par with
    ``pyspark.ml.stat.Summarizer`` (0.24 s / 0.41 s).
    """
    exploded = df.select(explode_dims(features)).filter(F.col("dim").isNotNull())
    return exploded.groupBy("dim").agg(
        F.count("x").alias("n"),
        F.avg("x").alias("mean"),
        F.stddev_pop("x").alias("sd_pop"),
    ).select(F.col("dim").cast("int").alias("dim"), "n", "mean", "sd_pop")


def column_moments(df: DataFrame, features: str = "features") -> DataFrame:
    """(dim INT, n BIGINT, total DOUBLE, squares DOUBLE): count, sum and sum of squares of
    each dimension, in one pass with partial aggregates like ``column_stats``."""
    exploded = df.select(explode_dims(features)).filter(F.col("dim").isNotNull())
    return exploded.groupBy(F.col("dim").cast("int").alias("dim")).agg(
        F.count("x").alias("n"), F.sum("x").alias("total"), F.sum(F.col("x") * F.col("x")).alias("squares"))


@dataclass(frozen=True)
class Stats:
    """Fitted z-score parameters."""

    mean: tuple[float, ...]
    sd: tuple[float, ...]
    n: int

    @classmethod
    def fit(cls, df: DataFrame, features: str = "features") -> "Stats":
        return cls.from_table(column_stats(df, features))

    def merge(self, other: "Stats") -> "Stats":
        """The statistics of the rows of both, without a look at any row: means weighted by
        rows, squared deviations added together with that of the two means."""
        if not self.n or not other.n:
            return self if self.n else other
        if len(self.mean) != len(other.mean):
            raise ValueError("statistics of different lengths")
        n, mean, sd = self.n + other.n, [], []
        for ma, sa, mb, sb in zip(self.mean, self.sd, other.mean, other.sd):
            apart = mb - ma
            mean.append(ma + apart * other.n / n)
            squared = self.n * sa * sa + other.n * sb * sb + apart * apart * self.n * other.n / n
            sd.append(math.sqrt(squared / n))
        return Stats(tuple(mean), tuple(sd), n)

    @property
    def totals(self) -> tuple[float, ...]:
        """The sum of each dimension."""
        return tuple(m * self.n for m in self.mean)

    @property
    def squares(self) -> tuple[float, ...]:
        """The sum of squares of each dimension."""
        return tuple(self.n * (sd * sd + m * m) for m, sd in zip(self.mean, self.sd))

    @classmethod
    def from_table(cls, stats: DataFrame) -> "Stats":
        rows = stats.orderBy("dim").collect()
        if [r["dim"] for r in rows] != list(range(len(rows))) or len({r["n"] for r in rows}) > 1:
            raise ValueError("rows have different lengths or missing values")
        return cls(tuple(float(r["mean"]) for r in rows),
                   tuple(float(r["sd_pop"]) for r in rows),
                   int(rows[0]["n"]) if rows else 0)


def zscore_column(features: str | Column, stats: Stats) -> Column:
    """(x − mean)/sd per dimension; a dimension with sd ≤ 0 is only centred.

    One expression whatever the dimension; a vector of another length than the
    fitted one is an error, a missing one stays missing.
    """
    feats = F.col(features) if isinstance(features, str) else features
    means = vector_literal(stats.mean)
    scales = vector_literal([sd if sd > 0 else 1.0 for sd in stats.sd])
    scaled = F.zip_with(F.zip_with(feats, means, lambda x, m: x - m), scales, lambda x, s: x / s)
    wrong = F.raise_error(F.lit(f"a vector's length is not the fitted {len(stats.mean)}"))
    return F.when(feats.isNull() | (F.size(feats) == len(stats.mean)), scaled).otherwise(
        wrong.cast(T.ArrayType(T.DoubleType())))


def zscore(df: DataFrame, stats: Stats | None = None, features: str = "features",
           output: str | None = None) -> DataFrame:
    """Population z-score of a vector column (fits ``stats`` when not given)."""
    stats = stats or Stats.fit(df, features)
    return df.withColumn(output or features, zscore_column(features, stats))


def standard_scale(df: DataFrame, features: str = "features",
                   output: str | None = None, with_mean: bool = True,
                   with_std: bool = True) -> DataFrame:
    """``pyspark.ml`` StandardScaler: sample sd; a zero-variance dimension gives 0."""
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    out = output or features
    tmp_in, tmp_out = "__ss_in", "__ss_out"
    vec = df.withColumn(tmp_in, array_to_vector(features))
    model = StandardScaler(inputCol=tmp_in, outputCol=tmp_out, withMean=with_mean,
                           withStd=with_std).fit(vec)
    return (model.transform(vec)
            .withColumn(out, vector_to_array(tmp_out))
            .drop(tmp_in, tmp_out))


# ----------------------------------------------------------------------------
# Random projection
# ----------------------------------------------------------------------------

def projection_matrix(dim: int, out_dim: int = 3, seed: int | None = 0,
                      matrix: Sequence[Sequence[float]] | None = None) -> np.ndarray:
    """A (dim × out_dim) matrix whose rows are scaled to unit length.

    Gaussian entries from ``seed`` unless ``matrix`` is given. Each *row*
    (one input feature) is divided by its norm, as the original plot script
    does.
    """
    if matrix is None:
        m = normal_matrix(dim, out_dim, seed or 0)
    else:
        m = np.asarray(matrix, dtype=float)
    norms = np.sqrt((m * m).sum(axis=1, keepdims=True))
    norms[norms == 0] = 1.0
    return m / norms


def random_projection(df: DataFrame, matrix: np.ndarray, features: str = "features",
                      names: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Project every row onto the matrix columns (one dot product each, summed left
    to right); a vector of another length than the matrix is an error."""
    feats = F.col(features)
    wrong = F.raise_error(F.lit(f"a vector's length is not the matrix's {matrix.shape[0]}"))
    dots = [F.aggregate(F.zip_with(feats, vector_literal(matrix[:, j].tolist()), lambda x, w: x * w),
                        F.lit(0.0), lambda acc, v: acc + v) for j in range(matrix.shape[1])]
    projected = F.when(feats.isNull() | (F.size(feats) == matrix.shape[0]), F.array(*dots)).otherwise(
        wrong.cast(T.ArrayType(T.DoubleType())))
    tmp = "__proj"
    out = df.withColumn(tmp, projected)
    return out.select(*[c for c in df.columns if c != features],
                      *[F.col(tmp)[i].alias(n) for i, n in enumerate(names)])


def trig_matrix(dim: int, out_dim: int = 3) -> np.ndarray:
    """Deterministic test matrix ``sin(3·dim + j + 1)`` (row-normalised later)."""
    return np.array([[math.sin(3 * d + j + 1) for j in range(out_dim)] for d in range(dim)])
