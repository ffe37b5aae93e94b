"""Dense-vector arithmetic on ARRAY<DOUBLE> columns with built-in functions.

Vectors are plain ``ARRAY<DOUBLE>`` columns; ``VectorUDT`` only appears at
``pyspark.ml`` borders. All helpers here are JVM-side higher-order
functions, so no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOUBLE_ARRAY = T.ArrayType(T.DoubleType())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double_array(c) -> Column:
    """Cast any numeric array (e.g. ARRAY<FLOAT>) to ARRAY<DOUBLE>."""
    return _col(c).cast(DOUBLE_ARRAY)


def vector_literal(values: Sequence[float] | Sequence[Sequence[float]]) -> Column:
    """A constant (nested) double array; folded to one literal by Catalyst."""
    rows = [[float(v) for v in row] for row in values] if values and isinstance(
        values[0], (list, tuple)) else [float(v) for v in values]
    if rows and isinstance(rows[0], list):
        return F.lit(rows).cast(T.ArrayType(DOUBLE_ARRAY))
    return F.lit(rows).cast(DOUBLE_ARRAY)


def squared_distance(a, b) -> Column:
    """Σ (a_i − b_i)², summed left to right."""
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y)),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )


def distance(a, b) -> Column:
    """Euclidean distance between two equal-length vectors."""
    return F.sqrt(squared_distance(a, b))


def nearest_center(features, centers: Sequence[Sequence[float]]) -> Column:
    """STRUCT(sq: DOUBLE, cluster: INT) of the nearest of a few fixed centres.

    Unrolled into plain arithmetic on the vector's elements, which
    whole-stage codegen compiles: one squared distance per centre, then
    ``array_min`` over (squared distance, index) structs, which keeps the
    lower index on ties like ``KMeansModel.predict``. Meant for small
    k × d only (the generated code grows with it). A vector that is missing
    or holds a NULL or NaN has no nearest centre (NULL); one of another length
    is an error.
    """
    feats = _col(features)
    dim = len(centers[0])
    terms = []
    for j, centre in enumerate(centers):
        sq = None
        for i, v in enumerate(centre):
            diff = feats[i] - F.lit(float(v))
            sq = diff * diff if sq is None else sq + diff * diff
        terms.append(F.struct(sq.alias("sq"), F.lit(j).alias("cluster")))
    whole = F.size(feats) == dim
    known = ~F.exists(feats, lambda v: v.isNull() | F.isnan(v))
    wrong = F.raise_error(F.lit(f"a vector's length is not the centres' {dim}"))
    return (F.when(feats.isNull(), F.lit(None)).when(~whole, wrong.cast("struct<sq:double,cluster:int>"))
            .when(known, F.array_min(F.array(*terms))))


def explode_dims(features, dim: str = "dim", value: str = "x") -> Column:
    """(dim, value) generator columns for ``select``: one row per element.

    ``posexplode_outer`` rather than ``posexplode``: the inner form makes the
    optimizer infer a ``size(features) > 0`` filter and push it, with the
    whole feature expression inlined, below the projection (evaluating the
    features twice). Rows of empty/NULL arrays give a NULL ``dim``, which
    callers filter out.
    """
    return F.posexplode_outer(_col(features)).alias(dim, value)
