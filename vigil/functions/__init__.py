"""Column-expression helpers (built-in Spark SQL functions only)."""

from vigil.functions.text import jvm_split, words
from vigil.functions.vectors import (
    as_double_array,
    distance,
    nearest_center,
    squared_distance,
    vector_literal,
)

__all__ = [
    "as_double_array",
    "distance",
    "jvm_split",
    "nearest_center",
    "squared_distance",
    "vector_literal",
    "words",
]
