"""Helpers the operators of this subpackage share.

Words: A-Z is lower-cased and a text is cut at the six ASCII white-space
characters; ``bytes.lower`` and ``bytes.split`` do just that on UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.session import local_path, map_file, put_file, shared_dir, shared_fs  # noqa: F401

SPACE = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words a worker remembers the hash of before it forgets all (memory bound).
MEMO_WORDS = 400_000
#: Text bytes handled at a time inside a task (memory bound, not a cap).
CHUNK_BYTES = 4 << 20

GOLD = np.uint64(0x9E3779B97F4A7C15)
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
S27, S30, S31 = np.uint64(27), np.uint64(30), np.uint64(31)
#: The first n bytes of a lane of eight; spans longer than LONG are hashed by themselves.
LANE = np.asarray([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LONG = 512


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (splitmix64 finaliser)."""
    x = x + GOLD
    x = (x ^ (x >> S30)) * MIX1
    x = (x ^ (x >> S27)) * MIX2
    return x ^ (x >> S31)


class WordHash(dict):
    """word bytes -> 64-bit hash, remembered up to a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[bytes]:
    return [] if not text else text.encode("utf-8", "surrogatepass").lower().split()


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut again so that a piece holds about ``size`` bytes of text."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0)
        ends = np.cumsum(np.asarray(sizes, dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def word_spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, where each word starts and ends in them, and
    the number of words of each text; null texts have none."""
    texts = pa.compute.fill_null(texts.cast(pa.string()), "")
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    offsets = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]] if offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    offsets -= offsets[0]
    word = (data - np.uint8(9) > 4) & (data != 32)
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    heads, tails = offsets[:-1][offsets[:-1] < len(data)], offsets[1:][offsets[1:] > 0] - 1
    first[heads], last[tails] = word[heads], word[tails]
    starts = np.flatnonzero(first)
    return data, starts, np.flatnonzero(last) + 1, np.diff(np.searchsorted(starts, offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], eight bytes of all spans at a time."""
    size, padded = ends - starts, np.concatenate((data, np.zeros(8, np.uint8)))
    lanes = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    hashes = mix(size.astype(np.uint64))
    hashes = mix(hashes ^ (lanes[starts] & LANE[np.minimum(size, 8)]))
    more, done = np.flatnonzero((size > 8) & (size <= LONG)), 8
    while len(more):
        hashes[more] = mix(hashes[more] ^ (lanes[starts[more] + done] & LANE[np.minimum(size[more] - done, 8)]))
        done += 8
        more = more[size[more] > done]
    for i in np.flatnonzero(size > LONG):
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i]: ends[i]].tobytes())
    return hashes


def bucket_starts(keys: np.ndarray, skip: int) -> np.ndarray:
    """Where each bucket of sorted scrambled keys starts, one or two keys a bucket; the
    first ``skip`` bits of the keys are alike."""
    bits = max(1, len(keys).bit_length() - 1)
    return np.searchsorted(keys << np.uint64(skip), np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype("<u4")


def find(keys: np.ndarray, buckets: np.ndarray, skip: int, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted key among the sorted keys, -1 where it is not there."""
    bits = len(buckets).bit_length() - 1
    at = buckets[(wanted << np.uint64(skip)) >> np.uint64(64 - bits)].astype(np.int64)
    last = len(keys) - 1
    rest = np.flatnonzero(keys[np.minimum(at, last)] < wanted)
    while len(rest):
        at[rest] += 1
        rest = rest[at[rest] <= last]
        rest = rest[keys[at[rest]] < wanted[rest]]
    at = np.minimum(at, last)
    return np.where(keys[at] == wanted, at, -1)


def by_number(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(number, its rows) of small numbers."""
    if len(numbers):
        order = np.argsort(numbers.astype(np.uint16 if numbers.max() < 1 << 16 else np.uint64), kind="stable")
        cuts = np.flatnonzero(np.diff(numbers[order])) + 1
        for rows in np.split(order, cuts) if len(cuts) else (order,):
            yield int(numbers[rows[0]]), rows


def by_shard(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, its rows): shards are numbered by the first bits."""
    return by_number(hashes >> np.uint64(64 - bits) if bits else np.zeros(len(hashes), np.uint64))


def ascii_lower(col):
    return F.translate(col, UPPER, LOWER)


def fold_of(col, folds: int = 5):
    """crc32 of the id written as text, modulo ``folds``."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(folds)


def sealed(docs: DataFrame, *names: str) -> DataFrame:
    """(row, *names): all other columns inside ``row``, so that no column an operator adds
    can clash with one of them."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    return docs.select(F.struct(*rest or [F.lit(0)]).alias("row"), *[F.col(f"`{c}`") for c in names])


def opened(df: DataFrame, columns: list[str], *names: str) -> DataFrame:
    """The ``columns`` of a sealed table again, before whatever columns it got since."""
    new = [c for c in df.columns if c not in ("row", *names, *columns)]
    return df.select(*[F.col(c) if c in names else F.col("row").getField(c).alias(c) for c in columns], *new)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the cluster's shared folder: cuts the lineage and
    survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _stars(edges: DataFrame) -> bool:
    """Whether distinct ``edges`` (a > b) are stars around their least nodes: each a has one
    b, which is no a."""
    ends = (edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .union(edges.select("b", F.lit(0), F.lit(1)))
            .groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")))
    return not ends.agg(F.max((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0))).first()[0]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of ``edges`` (columns a, b of longs);
    component is the smallest node reachable.

    Alternates large-star and small-star steps until the edges are a forest of
    stars. Each step is two equi-joins on tables in the shared folder; nothing
    but a flag reaches the driver.
    """
    now = written(edges.filter("a <> b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct(), "edges")
    while not _stars(now):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))))
        now = written(small.selectExpr("greatest(a, b) a", "least(a, b) b").filter("a <> b").distinct(), "edges")
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
