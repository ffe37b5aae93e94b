"""Removal of passages that repeat, by level-wise doubling of window lengths.

A window is ``words`` consecutive words of one text. Its names at the levels (9, 18, 35
for 35 words) are 64-bit hashes, each made of two names of half the length, so a pass
over a text costs a few vector operations a level. At a level of length l a window is
stood for by the least name among its own sub-windows of that length: equal windows
have equal ones at equal places, so a window whose least name stands nowhere else is
unique and ends there. Only windows repeated at one length go on to twice that length,
until none survives or the full length is reached; there every window left is counted
by a name of 96 bits.

How it is dealt out:

* equal texts stand as one row with the mark that there are several, counted before the
  shuffle, so a group of copies of any size is one row;
* texts lie in chunks of bounded size in a bucketed table; a chunk's rows and what the
  counting says about them meet without shuffling a text again;
* a task sends each name once a chunk, as sorted binary runs by hash range, so a passage
  that a third of all texts hold is one number a chunk; one bit a name comes back.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import WordHash, mix, written
from vigil.session import shared_dir

#: Shortest window length that is counted; longer ones are doubled up to.
SHORTEST = 9
#: Text bytes of a chunk (memory bound of a task; a longer text is a chunk of its own).
CHUNK = 4 << 20
#: Bytes of names that a counting task holds at most, on average.
GROUP = 96 << 20
TIMES, SALT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)

_CHUNKS = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("bytes", pa.int64()), ("ids1", pa.list_(pa.int64())),
                     ("ids2", pa.list_(pa.int64())), ("several", pa.list_(pa.bool_())), ("texts", pa.list_(pa.string()))])
_NAMES = pa.schema([("shard", pa.int32()), ("t1", pa.int64()), ("t2", pa.int64()), ("names", pa.binary()),
                    ("checks", pa.binary()), ("several", pa.binary())])
_BITS = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("shard", pa.int32()), ("bits", pa.binary())])
_LEFT = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])


def levels(words: int) -> list[int]:
    """Window lengths from the shortest counted one up; each is at most twice the one before."""
    out = [words]
    while out[0] > SHORTEST:
        out.insert(0, -(-out[0] // 2))
    return out


def window_names(w: np.ndarray, length: int, done: dict[int, np.ndarray]) -> np.ndarray:
    """Names of the ``length`` words from each position on, from two names of half the
    length; at the end, where no window starts, names are of no use."""
    if length not in done:
        if length == 1:
            done[1] = mix(w)
        else:
            half = -(-length // 2)
            h = window_names(w, half, done)
            name = h * TIMES
            name[: len(h) - (length - half)] += h[length - half:]
            done[length] = mix(name)
    return done[length]


def _least(names: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` names from each position on (fewer at the end)."""
    out, have = names.copy(), 1
    while have < width:
        step = min(have, width - have)
        np.minimum(out[: len(out) - step], out[step:].copy(), out=out[: len(out) - step])
        have += step
    return out


def _firsts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    first = np.zeros(len(sorted_keys[0]), bool)
    first[:1] = True
    for key in sorted_keys:
        first[1:] |= key[1:] != key[:-1]
    return first


class Windows:
    """The windows of one chunk of texts that may still be repeated."""

    def __init__(self, texts: list[str], several: list[bool], size: int, memo: WordHash):
        self.words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        self.lengths = np.fromiter(map(len, self.words), np.int64, len(texts))
        self.size = size
        flat = [x for some in self.words for x in some]
        self.n = len(flat)
        with np.errstate(over="ignore"):
            self.w = memo.of(flat)
        left = np.repeat(np.cumsum(self.lengths), self.lengths) - np.arange(self.n)
        self.open = left >= size  # a window starts here and may be repeated
        self.several = np.repeat(np.asarray(several, bool), self.lengths)
        self._names: dict[int, np.ndarray] = {}

    def names(self, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return window_names(self.w, length, self._names)

    def checks(self) -> np.ndarray:
        """A second name of 32 bits of the whole windows."""
        with np.errstate(over="ignore"):
            return window_names(mix(self.w ^ SALT), self.size, {}).astype(np.uint32)

    def counted(self, length: int):
        """(names, checks, whether each stands at several places here) of the level, sorted."""
        h = self.names(length)
        if length == self.size:
            at, check = np.flatnonzero(self.open), self.checks()
        else:
            width = self.size - length + 1
            least, marked = _least(h, width), np.zeros(self.n, bool)
            for o in range(min(width, self.n)):
                marked[o:] |= (h[o:] == least[: self.n - o]) & self.open[: self.n - o]
            at, check = np.flatnonzero(marked), np.zeros(self.n, np.uint32)
        names, check, weight = h[at], check[at], 1 + self.several[at].astype(np.int64)
        order = np.lexsort((check, names)) if length == self.size else np.argsort(names)
        names, check, weight = names[order], check[order], weight[order]
        first = _firsts(names, check)
        starts = np.flatnonzero(first)
        count = np.add.reduceat(weight, starts) if len(starts) else weight
        return names[starts], check[starts], count > 1

    def keep(self, length: int, shards: int, bits: dict[int, bytes]) -> None:
        """Ends the windows whose name at this level is not marked in ``bits`` (by shard)."""
        at = np.flatnonzero(self.open)
        if not len(at):
            return
        h = self.names(length)
        values = h[at] if length == self.size else _least(h, self.size - length + 1)[at]
        second = self.checks()[at] if length == self.size else np.zeros(len(at), np.uint32)
        # neighbours share their least name, so a run of equal ones is looked up once
        new = _firsts(values, second)
        values, second, run = values[new], second[new], np.cumsum(new) - 1
        order = np.lexsort((second, values))
        differs = _firsts(values[order], second[order])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(differs) - 1
        u = values[order][differs]
        marks = np.zeros(len(u), bool)
        for shard, (a, b) in shard_slices(u, shards):
            if shard in bits:
                marks[a:b] = np.unpackbits(np.frombuffer(bits[shard], np.uint8), count=b - a)
        self.open[at] = marks[rank][run]

    def removed(self) -> np.ndarray:
        """Words that an open window covers."""
        edge = np.zeros(self.n + 1, np.int64)
        at = np.flatnonzero(self.open)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + self.size, -1)
        return np.cumsum(edge[:-1]) > 0


def shard_slices(names: np.ndarray, shards: int):
    """(shard, (from, to)) of the non-empty ranges of sorted names."""
    shard = ((names >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    starts = np.flatnonzero(_firsts(shard))
    ends = np.append(starts[1:], len(names))
    return [(int(shard[a]), (int(a), int(b))) for a, b in zip(starts, ends)]


def _chunked(batches):
    """Rows (t1, t2, copies, text) -> chunks, each keyed by its first text."""
    rows, size = [], 0

    def out():
        t1, t2, several, texts = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
            (t1[0], t2[0], size, list(t1), list(t2), list(several), list(texts)), _CHUNKS)], schema=_CHUNKS)

    for batch in batches:
        for t1, t2, copies, text in zip(*(batch[c].to_pylist() for c in ("t1", "t2", "copies", "text"))):
            rows.append((t1, t2, copies > 1, text))
            size += len(text.encode("utf-8", "surrogatepass")) + 16
            if size >= CHUNK:
                yield out()
                rows, size = [], 0
    if rows:
        yield out()


def _windows_of(batches, size: int, lengths: list[int], shards: int):
    """(row, its windows after the levels decided so far)."""
    memo = WordHash()
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            windows = Windows(row["texts"], row["several"], size, memo)
            for level, length in enumerate(lengths):
                windows.keep(length, shards, {p["shard"]: p["bits"] for p in row["decided"] or () if p["level"] == level})
            yield row, windows


def _names(size: int, lengths: list[int], length: int, shards: int):
    def run(batches):
        for row, windows in _windows_of(batches, size, lengths, shards):
            names, checks, several = windows.counted(length)
            out = [(shard, row["t1"], row["t2"], names[a:b].tobytes(), checks[a:b].tobytes() if length == size else b"",
                    np.packbits(several[a:b]).tobytes()) for shard, (a, b) in shard_slices(names, shards)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _NAMES)], schema=_NAMES)
    return run


def _repeated(table: pa.Table) -> pa.Table:
    """One bit a name of each chunk: whether it stands at several places."""
    parts = [np.frombuffer(b, np.uint64) for b in table["names"].to_pylist()]
    sizes = [len(p) for p in parts]
    names = np.concatenate(parts)
    checks = [np.frombuffer(b, np.uint32) for b in table["checks"].to_pylist()]
    several = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(table["several"].to_pylist(), sizes)])
    if sum(map(len, checks)):
        checks = np.concatenate(checks)
        order = np.lexsort((checks, names))
        first = _firsts(names[order], checks[order])
    else:
        order = np.argsort(names)
        first = _firsts(names[order])
    starts = np.flatnonzero(first)
    often = np.add.reduceat(1 + several[order].astype(np.int64), starts) > 1
    marks = np.empty(len(names), bool)
    marks[order] = often[np.cumsum(first) - 1]
    ends = np.cumsum(sizes)
    out = [(t1, t2, shard, np.packbits(marks[e - n: e]).tobytes()) for t1, t2, shard, n, e
           in zip(table["t1"].to_pylist(), table["t2"].to_pylist(), table["shard"].to_pylist(), sizes, ends) if marks[e - n: e].any()]
    return pa.table([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_BITS)], schema=_BITS)


def _kept(size: int, lengths: list[int], shards: int):
    def run(batches):
        for row, windows in _windows_of(batches, size, lengths, shards):
            ends = np.cumsum(windows.lengths)
            gone = windows.removed() if lengths else np.zeros(windows.n, bool)
            dropped, texts = [], []
            for words, a, b in zip(windows.words, ends - windows.lengths, ends):
                here = gone[a:b]
                dropped.append(int(here.sum()))
                texts.append(b" ".join(w for w, g in zip(words, here.tolist()) if not g).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array(row["ids1"], pa.int64()), pa.array(row["ids2"], pa.int64()),
                                              pa.array(windows.lengths), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())],
                                             schema=_LEFT)
    return run


def _spelled(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string", pa.list_(pa.int64()): "array<long>",
             pa.list_(pa.bool_()): "array<boolean>", pa.list_(pa.string()): "array<string>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def drop_repeated_passages(docs: DataFrame, *, words: int = 35, text_col: str = "text") -> DataFrame:
    """``docs`` with the words of repeated windows taken out of the text, and the new
    columns n_words (before) and n_removed (long).

    Words are runs of anything but the six ASCII white-space characters, unchanged. A word
    goes if a window of ``words`` words covers it whose word sequence also starts anywhere
    else, in the same text too. What stays is joined by single spaces. Windows are judged on
    the input. Null texts stay null and have no words; texts under ``words`` words and empty
    ones lose none; repeated rows are copies of each other; ids are not read, so rows without
    or with equal ids need no care; an empty table gives an empty result. Input columns called
    n_words or n_removed are replaced, all others stay as they are.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rest = [c for c in docs.columns if c not in (text_col, "n_words", "n_removed")]
    both = [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]
    one = docs.select(*both, text.alias("text")).groupBy("t1", "t2").agg(F.count("*").alias("copies"), F.first("text").alias("text"))
    name, folder = f"passages_{uuid.uuid4().hex[:12]}", shared_dir(spark, "passages")
    (one.mapInArrow(_chunked, _spelled(_CHUNKS)).write.option("compression", "zstd").option("path", folder)
     .bucketBy(buckets, "t1", "t2").saveAsTable(name))
    chunks = spark.table(name)
    try:
        shards = max(buckets, -(-2 * (chunks.agg(F.sum("bytes")).first()[0] or 0) // GROUP))
        none = "array<struct<level:int,shard:int,bits:binary>>"
        lengths, decided = [], None

        def open_chunks():
            if decided is None:
                return chunks.withColumn("decided", F.lit(None).cast(none))
            marks = decided.groupBy("t1", "t2").agg(F.collect_list(F.struct("level", "shard", "bits")).alias("decided"))
            return chunks.join(marks.hint("shuffle_hash"), ["t1", "t2"], "left")

        for level, length in enumerate(levels(words)):
            names = open_chunks().mapInArrow(_names(words, lengths, length, shards), _spelled(_NAMES))
            bits = written(names.groupBy("shard").applyInArrow(_repeated, _spelled(_BITS)), "repeated")
            bits = bits.withColumn("level", F.lit(level))
            decided = bits if decided is None else decided.unionByName(bits)
            lengths = [*lengths, length]
            if bits.isEmpty():
                break
        left = written(open_chunks().mapInArrow(_kept(words, lengths, shards), _spelled(_LEFT)), "kept")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    row = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.struct(F.lit(0))
    rows = docs.select(row.alias("row"), F.col(f"`{text_col}`").isNull().alias("empty"), *both)
    columns = [F.when(~F.col("empty"), F.col("text")).alias(c) if c == text_col else F.col("row").getField(c).alias(c)
               for c in docs.columns if c == text_col or c in rest]
    return rows.join(left, ["t1", "t2"]).select(*columns, "n_words", "n_removed")
