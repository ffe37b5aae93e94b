"""Text splitting with the JVM ``String.split`` semantics of the original jobs.

Spark SQL ``split`` keeps trailing empty fields (``'a,b,,'`` gives four
items) whereas ``String.split`` drops them; inner empty fields are kept by
both. A non-empty string made only of separators has no fields at all for
``String.split``, while an empty string gives one empty field.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jvm_split(text, sep: str = ",") -> Column:
    """``text.split(sep)`` as the JVM does it, as ARRAY<STRING>."""
    text = _col(text)
    pattern = re.escape(sep)
    if len(sep) == 1:
        stripped = F.rtrim(text, F.lit(sep))
    else:
        stripped = F.regexp_replace(text, f"(?:{pattern})+$", "")
    return (
        F.when((text != F.lit("")) & (stripped == F.lit("")),
               F.array().cast(T.ArrayType(T.StringType())))
        .otherwise(F.split(stripped, pattern))
    )


def words(text) -> Column:
    """Words of a line split on single spaces (``line.split(" ")``).

    Trailing spaces are removed with ``rtrim`` (spaces only), which is the
    cheap form of the trailing-empty rule for the one-character separator.
    """
    text = _col(text)
    stripped = F.rtrim(text)
    return (
        F.when((text != F.lit("")) & (stripped == F.lit("")),
               F.array().cast(T.ArrayType(T.StringType())))
        .otherwise(F.split(stripped, " "))
    )
