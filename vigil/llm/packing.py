"""Packing of documents into token-budget batches by optimal length buckets.

A dynamic programme over the global histogram of lengths picks the bucket
boundaries that need the least padding (the least over lengths as ``rounded`` has
them). Inside a bucket, documents form batches
whose padded size stays within the token budget. Only the histogram reaches the
driver; its size is bounded whatever the table's (see ``rounded``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import written

#: Lengths keep this many leading bits in the histogram: exact up to 2048, at most
#: 0.1 % longer beyond, so 1,024 values an octave at most.
BITS = 11
#: Documents a window sorts at a time; a larger bucket is cut into parts.
PART = 20_000


def rounded(length):
    """``length`` (column) rounded up to a number with BITS leading bits."""
    spare = F.greatest(F.floor(F.log2(length.cast("double"))) - F.lit(BITS - 1), F.lit(0))
    grain = F.pow(F.lit(2.0), spare).cast("long")
    return F.ceil(length / grain).cast("long") * grain


def best_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """The upper boundaries of at most ``buckets`` buckets over the sorted distinct
    ``lengths`` for which the padded total is least."""
    size, total = np.asarray(lengths, np.float64), np.concatenate(([0], np.cumsum(counts))).astype(np.float64)
    n = len(size)
    cost = total[1:] * size  # one bucket up to j
    back = []
    for _ in range(min(buckets, n) - 1):
        new, cut = cost.copy(), np.full(n, -1)
        for j in range(1, n):
            options = cost[:j] + (total[j + 1] - total[1: j + 1]) * size[j]
            i = int(options.argmin())
            if options[i] < new[j]:
                new[j], cut[j] = options[i], i
        back.append(cut)
        cost = new
    ends, j = [n - 1], n - 1
    for cut in reversed(back):
        if cut[j] >= 0:
            j = int(cut[j])
            ends.append(j)
    return [int(lengths[e]) for e in reversed(ends)]


def token_lengths(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens): words of the whole text and one end token."""
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"))
    return docs.select("doc_id", (words + 1).cast("long").alias("n_tokens"))


def pack(lengths: DataFrame, *, budget: int = 65_536, buckets: int = 16) -> DataFrame:
    """(doc_id, n_tokens, bucket, bucket_tokens, batch_id, slot, padding) for each row
    of ``lengths`` (doc_id, n_tokens >= 1).

    bucket_tokens is the padded length. A batch holds documents of one bucket, at
    most ``budget`` padded tokens; a longer document is a batch of its own, never
    cut. Documents are dealt to batches in the order of their ids inside parts of a
    bucket of about PART rows, chosen by a hash of the row's place, so that rows without
    an id or of one id are dealt out like others; only the last batch of a part is not
    full. Ties and repeated rows are placed once each; a null id is an id like others.
    An empty table gives an empty result.
    """
    # places are numbered once, as the table is written
    lengths = written(lengths.select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"),
                                     F.monotonically_increasing_id().alias("place")), "lengths")
    size = rounded(F.col("n_tokens"))
    rows = lengths.groupBy(size.alias("size")).agg(F.count("*").alias("docs")).orderBy("size").collect()
    if not rows:
        rows = [(1, 0)]
    values, counts = [r[0] for r in rows], [r[1] for r in rows]
    ends = best_boundaries(values, counts, buckets)
    held = np.add.reduceat(counts, [0, *np.searchsorted(values, ends[:-1], side="right")]) if len(ends) > 1 else [sum(counts)]
    parts = F.array(*[F.lit(max(1, -(-int(n) // PART))) for n in held])
    bounds = F.array(*[F.lit(e).cast("long") for e in ends])

    bucket = F.size(F.filter(bounds, lambda b: b < size))
    placed = (lengths.withColumn("bucket", bucket)
              .withColumn("bucket_tokens", F.get(bounds, F.col("bucket")))
              .withColumn("part", F.pmod(F.xxhash64("place"), F.get(parts, F.col("bucket")).cast("long"))))
    order = Window.partitionBy("bucket", "part").orderBy("doc_id", "n_tokens", "place")
    each = F.greatest(F.floor(F.lit(budget) / F.col("bucket_tokens")), F.lit(1).cast("long"))
    at = F.row_number().over(order) - 1
    return (placed.withColumn("at", at).withColumn("each", each)
            .withColumn("batch_id", F.shiftleft(F.col("bucket").cast("long"), 56)
                        + F.shiftleft(F.col("part"), 20) + F.floor(F.col("at") / F.col("each")))
            .withColumn("slot", (F.col("at") % F.col("each")).cast("int"))
            .withColumn("padding", F.col("bucket_tokens") - F.col("n_tokens"))
            .select("doc_id", "n_tokens", "bucket", "bucket_tokens", "batch_id", "slot", "padding"))
