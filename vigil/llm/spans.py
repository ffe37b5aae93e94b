"""Positions of pattern matches in whole texts, with built-in functions only.

Matches are put between two marks, the text is cut at the marks, and running sums
of the pieces' lengths give code-point offsets. The mark is a private-use character;
one that stands in the text counts as another such character of the same length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK, OTHER = "\ue000", "\ue001"


def whole(text: Column) -> Column:
    """The text with the mark's own occurrences swapped; null: empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), MARK, OTHER)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches of a
    pattern that matches no empty string; ``text`` as ``whole`` gives it."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    zero = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), none.alias("out"))

    def step(acc, piece):
        end = acc["at"] + F.char_length(piece)
        here = F.struct(acc["at"].alias("start"), end.alias("end"), piece.alias("value"))
        return F.struct(end.alias("at"), (~acc["inside"]).alias("inside"),
                        F.when(acc["inside"], F.concat(acc["out"], F.array(here))).otherwise(acc["out"]).alias("out"))

    pieces = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK)
    return F.aggregate(pieces, zero, step, lambda acc: acc["out"])
