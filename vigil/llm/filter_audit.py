"""What each filter of a cascade removes, in every order of the filters.

Each document gets the mask of the filters that it fails, and each part the counts of
its masks: at most 2^k rows a part, pre-aggregated. A part's counts become a decision
diagram: level i asks filter i, an inner node has a pass and a fail edge, a node's weight
is what all documents below it count for, and nodes with equal functions are one. Other
orders come from swapping two adjacent levels, which touches those levels alone; the
orders are visited so that each is one swap from the last. In each order the path of
pass edges from the root gives the steps: what goes at a step is the weight at the
fail edge, what stays is the weight at the pass edge.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import SPACE

STRIP = " \t\n\x0b\x0c\r"
MOST_RULES = 7
_STEPS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_OUT = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((c, pa.int64()) for c in _STEPS)])

#: The rules of the registered query: whether a text, or its words, fail.
RULES: dict[str, Callable[[Column, Column], Column]] = {
    "A": lambda text, words: F.size(words) < 50,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
    "C": lambda text, words: 100 * (F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")))
    > 5 * F.char_length(text),
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}


def adjacent_swaps(k: int) -> Iterator[int]:
    """Places i, such that swapping i and i + 1 in turn visits all k! orders once."""
    order, way = list(range(k)), [-1] * k
    for _ in range(math.factorial(k) - 1):
        # the largest element that looks at a smaller neighbour moves one place
        movable = [x for x in range(k) if 0 <= order.index(x) + way[x] < k and order[order.index(x) + way[x]] < x]
        x = max(movable)
        at = order.index(x)
        to = at + way[x]
        order[at], order[to] = order[to], order[at]
        way = [-w if y > x else w for y, w in enumerate(way)]
        yield min(at, to)


class Diagram:
    """levels[i]: nodes (pass, fail) that point into level i + 1; weights[i]: theirs. The
    last level holds the distinct weights of single masks."""

    def __init__(self, counts: Mapping[int, tuple], k: int):
        self.order, zero = list(range(k)), (0, 0, 0)
        self.levels, self.weights = [[] for _ in range(k + 1)], [[] for _ in range(k + 1)]
        known: list[dict] = [{} for _ in range(k + 1)]

        def node(i: int, mask: int) -> int:
            if i == k:
                key = tuple(counts.get(mask, zero))
                weight = key
            else:
                key = (node(i + 1, mask), node(i + 1, mask | 1 << i))
                weight = self._sum(i + 1, key)
            if key not in known[i]:
                known[i][key] = len(self.levels[i])
                self.levels[i].append(key)
                self.weights[i].append(weight)
            return known[i][key]

        node(0, 0)

    def _sum(self, level: int, children: tuple) -> tuple:
        return tuple(a + b for a, b in zip(*(self.weights[level][c] for c in children)))

    def swap(self, i: int) -> None:
        """The filters asked at levels i and i + 1 change places; what each node of level i
        stands for stays, so nothing above it changes."""
        below, known, nodes = self.levels[i + 1], {}, []

        def node(passed: int, failed: int) -> int:
            return known.setdefault((passed, failed), len(known))

        for passed, failed in self.levels[i]:
            (pp, pf), (fp, ff) = below[passed], below[failed]
            nodes.append((node(pp, fp), node(pf, ff)))
        self.levels[i], self.levels[i + 1] = nodes, list(known)
        self.weights[i + 1] = [self._sum(i + 2, key) for key in known]
        self.order[i], self.order[i + 1] = self.order[i + 1], self.order[i]

    def steps(self) -> list[tuple[int, tuple, tuple]]:
        """(filter, weight removed, weight kept) along the path of pass edges."""
        out, at = [], 0
        for i, rule in enumerate(self.order):
            passed, failed = self.levels[i][at]
            out.append((rule, self.weights[i + 1][failed], self.weights[i + 1][passed]))
            at = passed
        return out


def audit_part(counts: Mapping[int, tuple], names: list[str], sep: str = "") -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)
    for every order; counts: mask -> (documents, good, toxic)."""
    k = len(names)
    fails = [sum(c[0] for mask, c in counts.items() if mask >> f & 1) for f in range(k)]
    alone = [counts.get(1 << f, (0,))[0] for f in range(k)]
    diagram, rows, total = Diagram(counts, k), [], [0] * k
    swaps = adjacent_swaps(k)
    while True:
        order = sep.join(names[f] for f in diagram.order)
        for step, (f, gone, kept) in enumerate(diagram.steps(), 1):
            total[f] += gone[0]
            rows.append((f, order, step, kept[0], gone[0], fails[f] - gone[0], alone[f], gone[1], gone[2]))
        place = next(swaps, None)
        if place is None:
            return [(*row[1:], total[row[0]]) for row in rows]
        diagram.swap(place)


def _audits(names: list[str], sep: str):
    def run(batches):
        for batch in batches:
            for part, masks in zip(batch["part"].to_pylist(), batch["masks"].to_pylist()):
                rows = audit_part({m["mask"]: (m["n"], m["good"], m["toxic"]) for m in masks}, names, sep)
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(rows)), *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(_OUT)[1:]))],
                                                 schema=_OUT)
    return run


def mask_counts(docs: DataFrame, labels: DataFrame, rules: Mapping[str, Callable], *, duplicates: bool = True, id_col: str = "doc_id",
                text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): how many documents of a part fail just the rules of a
    mask (bit i: rule i; the highest bit: equal to the text of a smaller id)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    base = docs.select(F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), F.col(f"`{id_col}`").alias("id"),
                       text.alias("text"), F.btrim(text, F.lit(STRIP)).alias("bare"))
    words = F.when(F.col("bare") == "", F.array().cast("array<string>")).otherwise(F.split("bare", SPACE))
    base = base.withColumn("words", words)
    mask = sum((rule(F.col("text"), F.col("words")).cast("int") * (1 << i) for i, rule in enumerate(rules.values())), F.lit(0))
    rows = base.select("part", "id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), mask.alias("mask"))
    marks = (labels.select(F.col(f"`{id_col}`").alias("id"), (F.col("quality") == 1).cast("int").alias("good"), (F.col("toxic") == 1).cast("int").alias("toxic"))
             .filter("id is not null").groupBy("id").agg(F.coalesce(F.max("good"), F.lit(0)).alias("good"), F.coalesce(F.max("toxic"), F.lit(0)).alias("toxic")))
    rows = rows.join(marks, "id", "left").fillna(0, ["good", "toxic"])
    if not duplicates:
        masks = rows.groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    else:
        # a text's copies are counted by part, mask and marks before the least id is looked for,
        # so that a text that a third of all rows share is a few rows
        same = ["t1", "t2", "part", "mask", "good", "toxic", F.col("id").isNull().alias("no_id")]
        by_id = rows.groupBy(*same, "id").agg(F.count("*").alias("c"))
        by_text = by_id.groupBy(*same[:-1], "no_id").agg(F.sum("c").alias("n"), F.min(F.struct("id", "c")).alias("low"))
        least = by_text.groupBy("t1", "t2").agg(F.min("low.id").alias("least"))
        found = by_text.join(least, ["t1", "t2"])
        first = F.when(F.col("no_id"), F.col("n")).when(F.col("low.id") == F.col("least"), F.col("low.c")).otherwise(F.lit(0))
        high = 1 << len(rules)
        both = F.array(F.struct(F.col("mask").alias("m"), first.alias("c")), F.struct((F.col("mask") + high).alias("m"), (F.col("n") - first).alias("c")))
        masks = found.select("part", "good", "toxic", F.inline(both)).filter("c > 0").select("part", F.col("m").alias("mask"), "good", "toxic", F.col("c").alias("n"))
    return masks.groupBy("part", "mask").agg(F.sum("n").cast("long").alias("n"), F.sum(F.col("n") * F.col("good")).cast("long").alias("good"),
                                             F.sum(F.col("n") * F.col("toxic")).cast("long").alias("toxic"))


def audit_filters(docs: DataFrame, labels: DataFrame, rules: Mapping[str, Callable] = RULES, *, duplicates: str | None = "E",
                  sep: str = "", **columns) -> DataFrame:
    """One row per part, order of the filters and step.

    ``rules``: name -> function of (text, array of words) that says whether a document
    fails; ``duplicates`` names one more filter, failed by a text equal to that of any
    smaller id of the whole table (None: no such filter). Null texts are empty ones, a null
    part is the empty string. Rows that share an id and a text do not fail each other; rows
    without an id fail none and are compared with none. A document is good (toxic) if any
    label row of its id has quality (toxic) 1; rows without a label count as neither. An
    empty table gives an empty result; other columns are not read.

    Counts are of documents in the part: kept after the step, removed by it, redundant
    (failing its filter, removed before), unique_fails (failing its filter alone), good_lost
    and toxic_lost among the removed, shapley (its filter's removed, summed over all orders).
    """
    names = [*rules, *([duplicates] if duplicates else [])]
    if len(names) > MOST_RULES:
        raise ValueError(f"{math.factorial(len(names))} orders: give at most {MOST_RULES} filters")
    counts = mask_counts(docs, labels, rules, duplicates=bool(duplicates), **columns)
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _STEPS)
    return parts.mapInArrow(_audits(names, sep), schema)
