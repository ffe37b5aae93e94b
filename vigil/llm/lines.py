"""Removal of lines that repeat across documents.

Lines are hashed, range-partitioned by (hash, document) and sorted by hash,
document and position, so equal lines stream past in order of occurrence and a
line that a third of all documents hold is spread over as many partitions as it
needs. A task holds at most ``min_docs`` documents' lines of one key. Runs that
touch a partition's edge may go on in the next one; their counts are added up
from one summary row an edge. The result is a compressed keep bitmap per document
with dropped lines, not text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import ascii_lower, opened, sealed, written

STRIP = " \t\n\x0b\x0c\r"
_LINES = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("pos", pa.int32()), ("first", pa.bool_()),
                    ("h1", pa.int64()), ("h2", pa.int64()), ("docs", pa.int64())])


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, text_hash, pos) of every line whose key is long enough."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    key = ascii_lower(F.btrim("line", F.lit(STRIP)))
    return (lines.withColumn("key", key).filter(F.char_length("key") >= max(1, min_chars))
            .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "text_hash", "pos"))


def _repeats(min_docs: int):
    """Streams one sorted partition. Out: lines of keys found in at least
    ``min_docs`` documents (h1 null); lines of the partition's first run and of an
    undecided last run (h1 set, to be decided); a summary (docs set) of both runs."""

    def rows(t: pa.Table, first, decided: bool) -> pa.RecordBatch:
        n = t.num_rows
        h1 = pa.nulls(n, pa.int64()) if decided else t["h1"].combine_chunks()
        h2 = pa.nulls(n, pa.int64()) if decided else t["h2"].combine_chunks()
        return pa.RecordBatch.from_arrays(
            [t["doc_id"].combine_chunks(), t["text_hash"].combine_chunks(), t["pos"].combine_chunks(),
             pa.array(first, pa.bool_()), h1, h2, pa.nulls(n, pa.int64())], schema=_LINES)

    def summary(head: dict, docs: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([head | {"first": True, "docs": docs}], schema=_LINES)

    def run(batches):
        key, head, docs, last_doc, opening, held, streamed = None, None, 0, None, True, [], False

        def part(t: pa.Table, docs_new: np.ndarray):
            """The next rows of the current run."""
            nonlocal docs, held, streamed
            docs += int(docs_new.sum())
            first = np.zeros(t.num_rows, bool)
            first[0] = not streamed and not held
            if opening:
                streamed = True
                yield rows(t, first, False)
            elif docs >= min_docs:
                for kept, f in held:
                    yield rows(kept, f, True)
                held, streamed = [], True
                yield rows(t, first, True)
            else:
                held.append((t, first))

        def end(closing: bool):
            nonlocal held
            if opening or closing:
                for kept, f in held:
                    yield rows(kept, f, False)
                yield summary(head, docs)
            held = []

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            h1, h2 = np.asarray(batch["h1"]), np.asarray(batch["h2"])
            ids = np.asarray(pa.compute.fill_null(batch["doc_id"], 0))
            null = np.asarray(pa.compute.is_null(batch["doc_id"]))
            same = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
            starts = np.concatenate(([0], np.flatnonzero(~same) + 1, [len(h1)]))
            new_doc = np.concatenate(([True], ~same | (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])))
            # runs of one line that are neither first nor last here are not repeated
            for a, b in zip(starts[:-1], starts[1:]):
                this = (int(h1[a]), int(h2[a]))
                if this != key:
                    if key is not None:
                        yield from end(False)
                        opening = False
                    if b - a < min_docs and a and b < len(h1):
                        key, head, docs, streamed = this, None, 0, False
                        continue
                    key, docs, streamed = this, 0, False
                    head = t.slice(a, 1).to_pylist()[0]
                else:
                    new_doc[a] = (ids[a], null[a]) != last_doc
                yield from part(t.slice(a, b - a), new_doc[a:b])
            last_doc = (ids[-1], null[-1])
        if key is not None:
            yield from end(True)
    return run


def _bitmaps(batches):
    for batch in batches:
        maps = []
        for positions in batch["positions"].to_pylist():
            keep = np.ones((max(positions) // 8 + 1) * 8, np.uint8)
            keep[positions] = 0
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_hash"], batch["n_dropped"], pa.array(maps, pa.binary())],
                                         names=["doc_id", "text_hash", "n_dropped", "keep"])


def keep_bitmaps(docs: DataFrame, *, min_docs: int = 10, min_chars: int = 1, keep: str = "none") -> DataFrame:
    """(doc_id, text_hash, n_dropped, keep) of the documents that lose lines.

    A line's key is the line without ASCII white space at its ends, A-Z
    lower-cased. Keys of at least ``min_chars`` code points (1 or more) found in at
    least ``min_docs`` documents lose all their lines (``keep="none"``) or all but
    the first by document id and position (``keep="first"``). ``keep`` is a zlib-
    compressed bitmap, bit i for line i; lines beyond its end stay. text_hash
    (xxhash64 of the text) tells rows apart that share an id; such rows count as one
    document, as do all rows without an id. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = (line_keys(docs, min_chars).repartitionByRange("h1", "h2", "doc_id")
               .sortWithinPartitions("h1", "h2", "doc_id", "text_hash", "pos"))
    found = written(ordered.mapInArrow(_repeats(min_docs), "doc_id long, text_hash long, pos int, first boolean, "
                                                           "h1 long, h2 long, docs long"), "lines")
    # two rows a partition at most
    edges = (found.filter("docs is not null").groupBy("h1", "h2")
             .agg(F.sum("docs").alias("total"), F.min(F.struct("doc_id", "text_hash", "pos")).alias("head"))
             .filter(F.col("total") >= min_docs))
    here = F.struct("doc_id", "text_hash", "pos")
    open_lines = (found.filter("docs is null and h1 is not null").join(F.broadcast(edges), ["h1", "h2"])
                  .select("doc_id", "text_hash", "pos", here.eqNullSafe(F.col("head")).alias("first")))
    dropped = found.filter("docs is null and h1 is null").select("doc_id", "text_hash", "pos", "first").union(open_lines)
    if keep == "first":
        dropped = dropped.filter("not first")
    lists = dropped.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("positions"))
    return (lists.withColumn("n_dropped", F.size("positions").cast("long"))
            .mapInArrow(_bitmaps, "doc_id long, text_hash long, n_dropped long, keep binary"))


def _apply(batches):
    for batch in batches:
        out = []
        for text, packed in zip(batch["text"].to_pylist(), batch["keep"].to_pylist()):
            if packed is not None and text is not None:
                keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8))
                text = "\n".join(line for i, line in enumerate(text.split("\n")) if i >= len(keep) or keep[i])
            out.append(text)
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == "text" else batch[c] for c in names if c != "keep"],
                                         names=[c for c in names if c != "keep"])


def drop_repeated_lines(docs: DataFrame, *, min_docs: int = 10, min_chars: int = 1, keep: str = "none") -> DataFrame:
    """``docs`` with the lines of ``keep_bitmaps`` taken out of ``text``, and the new
    columns n_lines (before dropping) and n_dropped; other columns stay.

    Null texts stay null and count as one empty line. A text that loses all its
    lines becomes empty. Columns called n_lines or n_dropped are replaced, all others stay.
    """
    maps = keep_bitmaps(docs, min_docs=min_docs, min_chars=min_chars, keep=keep)
    maps = maps.select(F.col("doc_id").alias("map_id"), F.col("text_hash").alias("map_hash"),
                       F.col("n_dropped").alias("map_dropped"), "keep")
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    joined = (sealed(docs.select(*[F.col(f"`{c}`") for c in columns]), "doc_id", "text").withColumn("text", F.col("text").cast("string"))
              .join(maps, F.col("doc_id").cast("long").eqNullSafe(F.col("map_id"))
                    & (F.xxhash64("text") == F.col("map_hash")), "left")
              .withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long"))
              .withColumn("n_dropped", F.coalesce("map_dropped", F.lit(0).cast("long")))
              .drop("map_id", "map_hash", "map_dropped"))
    schema = joined.drop("keep").schema
    return opened(joined.mapInArrow(_apply, schema), columns, "doc_id", "text")
