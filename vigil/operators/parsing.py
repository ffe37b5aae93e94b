"""Record parsing: lines → (label, categorical fields, numeric features).

Record layout: comma-separated fields, the label is the last field, the
categorical fields sit at fixed positions (1, 2, 3 by default) and every
other field is numeric. Parsing is one projection of built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.defaults import CATEGORICAL_POSITIONS as DEFAULT_CATEGORICAL
from vigil.functions.text import jvm_split


def _to_double(mode: str):
    if mode == "strict":
        return lambda x: x.cast("double")
    if mode == "permissive":
        return lambda x: x.try_cast("double")
    raise ValueError(f"mode must be 'strict' or 'permissive', not {mode!r}")


def fields_of(value: str | Column = "value", sep: str = ",") -> Column:
    return jvm_split(value, sep)


def label_of(value: str | Column = "value", sep: str = ",") -> Column:
    """The last field of a line."""
    return F.element_at(fields_of(value, sep), -1)


def numeric_segments(fields: Column, categorical: Sequence[int], to_double) -> list[
        tuple[str, object]]:
    """Split the field array into ('num', Column) and ('cat', position) runs.

    Numeric runs are slices between categorical positions; the last run
    ends before the label, so its length depends on the row's field count.
    """
    cats = sorted(set(int(p) for p in categorical))
    segments: list[tuple[str, object]] = []
    start = 0  # 0-based index of the next numeric field
    for p in cats:
        if p > start:
            segments.append(("num", F.transform(F.slice(fields, start + 1, p - start),
                                                 to_double)))
        segments.append(("cat", p))
        start = p + 1
    rest = F.size(fields) - 1 - start
    segments.append(("num", F.transform(
        F.slice(fields, start + 1, F.greatest(rest, F.lit(0))), to_double)))
    return segments


FIELDS = "__fields"


def with_fields(lines: DataFrame, value: str = "value", sep: str = ",",
                categorical: Sequence[int] = (), mode: str = "permissive") -> DataFrame:
    """Add the split fields as a column, so that the split runs once per line
    however many expressions read the fields. In strict mode a line must have
    all categorical fields and a label after them."""
    fields = fields_of(value, sep)
    if mode == "strict" and categorical:
        need = max(int(p) for p in categorical) + 2
        short = F.raise_error(F.concat(F.lit(f"fewer than {need} fields: "), F.coalesce(value, F.lit("NULL"))))
        fields = F.when(F.size(fields) >= need, fields).otherwise(short.cast("array<string>"))
    return lines.withColumn(FIELDS, fields)


def parse_numeric(lines: DataFrame, value: str = "value",
                  categorical: Sequence[int] = DEFAULT_CATEGORICAL,
                  mode: str = "strict", keep_line: bool = False,
                  sep: str = ",") -> DataFrame:
    """(label, features): categorical fields dropped, label removed.

    ``mode="strict"`` fails on a non-numeric field (ANSI cast);
    ``"permissive"`` turns it into NULL. A line that lacks a categorical field
    or the label fails in strict mode; in permissive mode its label is its last
    field, if any, and its vector holds the numeric fields there are.
    """
    lines = with_fields(lines, value, sep, categorical, mode)
    fields = F.col(FIELDS)
    to_double = _to_double(mode)
    parts = [c for kind, c in numeric_segments(fields, categorical, to_double)
             if kind == "num"]
    cols = [F.try_element_at(fields, F.lit(-1)).alias("label"), F.concat(*parts).alias("features")]
    if keep_line:
        cols.insert(0, F.col(value))
    return lines.select(*cols)


def parse_vectors(lines: DataFrame, value: str = "value",
                  categorical: Sequence[int] = DEFAULT_CATEGORICAL,
                  mode: str = "strict", sep: str = ",") -> DataFrame:
    """Features only (label dropped too)."""
    return parse_numeric(lines, value, categorical, mode, sep=sep).select("features")


def valid_rows(df: DataFrame, features: str = "features") -> DataFrame:
    """Rows whose feature vector is present and holds no NULL.

    Use after ``mode="permissive"`` parsing and before clustering: distances
    are undefined for missing values.
    """
    return df.filter(F.col(features).isNotNull()
                     & ~F.exists(features, lambda x: x.isNull()))
