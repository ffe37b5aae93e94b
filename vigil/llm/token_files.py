"""Token ids in fixed-width bit-packed files.

A file holds, little-endian throughout:

    payload     blocks of BLOCK ids, each id in ``bits`` bits, lowest bit first;
                every block starts on a byte, the last may be shorter
    doc ids     int64[n_docs], then uint8[n_docs], 0 where the id is null
    doc starts  uint64[n_docs + 1], in ids from the start of the file
    offsets     uint64[n_blocks + 1], in bytes from the start of the file
    tail        magic "TOKB", uint16 version, uint16 bits, uint32 BLOCK,
                uint64 n_docs, uint64 n_ids

A range of ids is read by the blocks that hold it, wherever it lies.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import bucket_starts, by_shard, chunks, find, map_file, put_file, span_hashes, word_spans, written
from vigil.session import shared_dir

BLOCK = 8192
#: The distinct words of about this many bytes of text are encoded by one task.
SHARD_BYTES = 16 << 20
#: Words whose hashes a worker remembers, bytes of new words it holds, and text bytes it
#: handles at a time (memory bounds).
MEMO, HELD, CHUNK = 2_000_000, 32 << 20, 1 << 20
TAIL = "<4sHHIQQ"
MARK_BYTES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
MARKS = np.isin(np.arange(256), np.frombuffer(MARK_BYTES, np.uint8))
LETTERS = np.isin(np.arange(256), np.arange(ord("a"), ord("z") + 1))


def _places(bits: int):
    """(id, word, shift) of 64 ids in ``bits`` words of 64 bits."""
    return [(j, j * bits // 64, j * bits % 64) for j in range(64)]


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """64 ids at a time go into ``bits`` 64-bit words, by shifts over whole columns."""
    rows = -(-len(ids) // 64)
    padded = np.zeros(rows * 64, np.uint64)
    padded[: len(ids)] = ids
    columns, words = np.ascontiguousarray(padded.reshape(rows, 64).T), np.zeros((bits, rows), np.uint64)
    for j, word, shift in _places(bits):
        words[word] |= columns[j] << np.uint64(shift)
        if shift + bits > 64:
            words[word + 1] |= columns[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8", copy=False).tobytes()[: -(-len(ids) * bits // 8)]


def unpack_bits(data, n: int, bits: int) -> np.ndarray:
    rows = -(-n // 64)
    raw = np.zeros(rows * bits * 8, np.uint8)
    raw[: -(-n * bits // 8)] = np.frombuffer(data, np.uint8, -(-n * bits // 8))
    words, out = np.ascontiguousarray(raw.view("<u8").reshape(rows, bits).T), np.empty((64, rows), np.uint32)
    for j, word, shift in _places(bits):
        value = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            value |= words[word + 1] << np.uint64(64 - shift)
        out[j] = value & np.uint64((1 << bits) - 1)
    return out.T.reshape(-1)[:n].astype("<u4", copy=False)


class TokenFile:
    """A memory-mapped file; ``ids(a, b)`` reads ids a to b by their blocks."""

    def __init__(self, folder: str, name: str):
        self.data = map_file(folder, name)
        magic, version, self.bits, self.block, self.n_docs, self.n_ids = struct.unpack(TAIL, self.data[-struct.calcsize(TAIL):])
        if magic != b"TOKB" or version != 1:
            raise ValueError(f"{name} is not a token file")
        blocks = -(-self.n_ids // self.block)
        end = len(self.data) - struct.calcsize(TAIL)
        self.offsets = np.frombuffer(self.data[end - 8 * (blocks + 1): end], "<u8")
        end -= 8 * (blocks + 1)
        self.starts = np.frombuffer(self.data[end - 8 * (self.n_docs + 1): end], "<u8")
        end -= 8 * (self.n_docs + 1)
        self.valid = np.frombuffer(self.data[end - self.n_docs: end], np.uint8)
        end -= self.n_docs
        self.doc_ids = np.frombuffer(self.data[end - 8 * self.n_docs: end], "<i8")

    def ids(self, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.empty(0, "<u4")
        lo, hi = a // self.block, -(-b // self.block)  # whole blocks follow each other without a gap
        first, last = lo * self.block, min(hi * self.block, self.n_ids)
        return unpack_bits(self.data[int(self.offsets[lo]): int(self.offsets[hi])], last - first, self.bits)[a - first: b - first]

    def doc(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def piece_spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Parts of words that the tokenizer encodes apart, so that fewer are distinct: the
    ASCII marks that end a word behind an ASCII letter, and what is before them, A-Z in
    lower case, which it would do itself. A word that may hold a special token stays as
    it is. The bytes, where each part starts and ends, and the parts of each text."""
    data, starts, ends, n = word_spans(texts)
    raw = data.tobytes()
    low, special = np.frombuffer(raw.lower(), np.uint8), np.zeros(len(starts), bool)
    if b"<|" in raw:
        at = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
        word = np.searchsorted(starts, at, side="right") - 1
        special[word[at + 1 < ends[word]]] = True  # not from one text to the next
        low = low.copy()
        for i in np.flatnonzero(special):
            low[starts[i]: ends[i]] = data[starts[i]: ends[i]]
    cut, rest = ends.copy(), np.flatnonzero(MARKS[low[ends - 1]] & ~special) if len(ends) else np.empty(0, np.int64)
    for _ in range(32):  # back to the first of the marks
        cut[rest] -= 1
        rest = rest[cut[rest] > starts[rest]]
        rest = rest[MARKS[low[cut[rest] - 1]]]
    for i in rest:
        cut[i] = starts[i] + len(raw[starts[i]: ends[i]].rstrip(MARK_BYTES))
    two = np.flatnonzero((cut < ends) & (cut > starts))
    two = two[LETTERS[low[cut[two] - 1]]]
    parts = np.ones(len(starts), np.int64)
    parts[two] = 2
    at, extra = np.repeat(np.arange(len(starts)), parts), np.cumsum(parts)[two] - 1
    from_, to = starts[at], ends[at]
    to[extra - 1] = from_[extra] = cut[two]
    held = np.concatenate(([0], np.cumsum(parts)))[np.concatenate(([0], np.cumsum(n)))]
    return low, from_, to, np.diff(held)


def pieces_of(word: bytes) -> tuple[bytes, ...]:
    low, starts, ends, _ = piece_spans(pa.array([word.decode()], pa.string()))
    return tuple(low[a:b].tobytes() for a, b in zip(starts, ends))


def first_of_each(hashes: np.ndarray) -> np.ndarray:
    """A place of each distinct hash, in the order of the hashes."""
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    return order[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else order


def _packed_words(hashes: np.ndarray, size: np.ndarray, data: np.ndarray) -> bytes:
    return len(hashes).to_bytes(8, "little") + hashes.astype("<u8").tobytes() + zlib.compress(size.astype("<u4").tobytes() + data.tobytes(), 1)


def _unpacked_words(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(packed[:8], "little")
    rest = zlib.decompress(memoryview(packed)[8 + 8 * n:])
    return np.frombuffer(packed, "<u8", n, 8), np.frombuffer(rest, "<u4", n).astype(np.int64), np.frombuffer(rest, np.uint8, -1, 4 * n)


def _distinct_words(bits: int):
    """The pieces of a task's texts, each about once, in packed rows by shard."""
    def run(batches):
        seen, held, n = np.empty(0, np.uint64), [], 0

        def out():
            hashes, size, data = (np.concatenate(x) for x in zip(*held))
            starts = np.cumsum(size) - size
            for shard, mine in by_shard(hashes, bits):
                part, _ = _gather(data, starts[mine], size[mine])
                yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "data": [_packed_words(hashes[mine], size[mine], part)]})

        for batch in chunks(batches, size=CHUNK):
            data, starts, ends, _ = piece_spans(batch["text"])
            hashes = span_hashes(data, starts, ends)
            one = first_of_each(hashes)
            if len(seen):
                at = np.minimum(np.searchsorted(seen, hashes[one]), len(seen) - 1)
                one = one[seen[at] != hashes[one]]
            if not len(one):
                continue
            size = ends[one] - starts[one]
            held.append((hashes[one], size, _gather(data, starts[one], size)[0]))
            n += len(held[-1][2]) + 16 * len(one)
            seen = np.concatenate((seen, hashes[one]))
            seen.sort(kind="stable")
            if n > HELD:
                yield from out()
                held, n = [], 0
            if len(seen) > MEMO:
                seen = seen[:0]
        if held:
            yield from out()
    return run


def encoder(vocabulary: str):
    """words -> ids of all, end to end, and their number a word. Words of a-z alone, which
    the tokenizer leaves as they are, go to its model many at a time."""
    from tokenizers import Tokenizer

    whole, probe = Tokenizer.from_file(vocabulary), "abcdefghijklmnopqrstuvwxyz"
    probe += probe[::-1]
    plain = not whole.normalizer or whole.normalizer.normalize_str(probe) == probe
    plain = plain and (not whole.pre_tokenizer or [w for w, _ in whole.pre_tokenizer.pre_tokenize_str(probe)] == [probe])
    plain = plain and not any(t.content.strip(probe) == "" for t in whole.get_added_tokens_decoder().values())
    model = Tokenizer(whole.model)

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        easy = np.asarray([plain and w.isascii() and w.isalpha() and w.islower() for w in words], bool)
        size, where, ids, rest = np.zeros(len(words), np.int64), [], [], np.flatnonzero(~easy)
        for i, e in zip(rest, whole.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
            ids.append(np.asarray(e.ids, np.uint32))
            size[i] = len(ids[-1])
        where.append(np.repeat(rest, size[rest]))
        groups = np.array_split(np.flatnonzero(easy), max(1, -(-int(easy.sum()) // 512)))
        for group, e in zip(groups, model.encode_batch([[words[i] for i in g] for g in groups], is_pretokenized=True, add_special_tokens=False)):
            of = group[np.asarray(e.word_ids, np.int64)] if len(e.ids) else group[:0]
            ids.append(np.asarray(e.ids, np.uint32))
            where.append(of)
            size += np.bincount(of, minlength=len(words))
        return np.concatenate([np.empty(0, np.uint32), *ids])[np.argsort(np.concatenate(where), kind="stable")], size
    return encode


def _encoded_words(folder: str, vocabulary: str, bits: int):
    """Encodes the words of one shard and writes them in the order of their hashes."""
    def run(key, table):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core
        shard = key[0].as_py()
        hashes, size, data = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint8)
        parts, held, left = [], 0, table.num_rows
        for row in table["data"]:  # distinct words, again whenever as many more have come
            parts.append(_unpacked_words(row.as_py()))
            held, left = held + len(parts[-1][0]), left - 1
            if held >= max(MEMO, len(hashes)) or not left:
                hashes, size, data = (np.concatenate(x) for x in zip((hashes, size, data), *parts))
                one = first_of_each(hashes)
                starts = np.cumsum(size) - size
                hashes, (data, _), size = hashes[one], _gather(data, starts[one], size[one]), size[one]
                parts, held = [], 0
        offsets = np.concatenate(([0], np.cumsum(size)))
        text, encode, ids, counts = data.tobytes(), encoder(vocabulary), [], []
        for start in range(0, len(size), 4096):
            ends = offsets[start: start + 4097].tolist()
            i, n = encode([text[a:b].decode() for a, b in zip(ends, ends[1:])])
            ids.append(i.astype("<u4"))
            counts.append(n)
        starts = np.concatenate(([0], np.cumsum(np.concatenate(counts)))).astype("<u8")
        put_file(folder, f"words-{shard:06d}", lambda f: [f.write(a.tobytes()) for a in (hashes, starts, bucket_starts(hashes, bits), *ids)])
        return pa.table({"shard": pa.array([shard], pa.int64()), "n": pa.array([len(size)], pa.int64())})
    return run


def encode_words(docs: DataFrame, vocabulary: str) -> dict:
    """Encode every distinct word of ``docs.text`` once and write hash -> ids to files of
    the shared folder. Returns what workers need to open them, a pair a shard.

    Valid for tokenizers that never join pieces across white space, as the word-end
    BPE here, which drops it; the tests compare it with encoding whole texts.
    """
    folder = shared_dir(docs.sparkSession, "words")
    texts = docs.select(F.col("text").cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, -(-size // SHARD_BYTES) - 1).bit_length()
    made = written(texts.mapInArrow(_distinct_words(bits), "shard long, data binary").groupBy("shard")
                   .applyInArrow(_encoded_words(folder, vocabulary, bits), "shard long, n long"), "words")
    return {"folder": folder, "bits": bits, "shards": [(r["shard"], r["n"]) for r in made.collect()]}


class WordIds:
    """Turns texts into ids by the memory-mapped words of ``encode_words``."""

    def __init__(self, words: dict):
        self.bits, self.shards = words["bits"], {}
        for shard, n in words["shards"]:
            data = map_file(words["folder"], f"words-{shard:06d}")
            buckets = 1 << max(1, n.bit_length() - 1)
            self.shards[shard] = (np.frombuffer(data, "<u8", n), np.frombuffer(data, "<u8", n + 1, 8 * n),
                                  np.frombuffer(data, "<u4", buckets, 8 * (2 * n + 1)),
                                  np.frombuffer(data, "<u4", -1, 8 * (2 * n + 1) + 4 * buckets))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many belong to each text."""
        data, starts, ends, n_words = piece_spans(texts)
        hashes = span_hashes(data, starts, ends)
        first, size, found = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64), []
        for shard, mine in by_shard(hashes, self.bits):
            if shard not in self.shards:
                raise KeyError("a word of these texts was not among those encoded")
            keys, begin, buckets, _ = self.shards[shard]
            at = find(keys, buckets, self.bits, hashes[mine])
            if (at < 0).any():
                raise KeyError("a word of these texts was not among those encoded")
            first[mine] = begin[at]
            size[mine] = begin[at + 1] - begin[at]
            found.append((shard, mine))
        place, flat = np.cumsum(size) - size, np.empty(size.sum(), np.uint32)
        for shard, mine in found:  # the k-th id of all words that have one, then the rest
            ids = self.shards[shard][3]
            for k in range(8):
                mine = mine[size[mine] > k]
                flat[place[mine] + k] = ids[first[mine] + k]
            if len(mine := mine[size[mine] > 8]):
                flat[_span_places(place[mine] + 8, size[mine] - 8)] = ids[_span_places(first[mine] + 8, size[mine] - 8)]
        held = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(n_words)))]
        return flat, np.diff(held)


def _span_places(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1 and so on, ``size`` of them, of every piece, end to end."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


def _gather(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values[first: first + size] of every piece, end to end, and the sizes."""
    return values[_span_places(first, size)], size


def _write(folder: str, words: dict, bits: int, end_id: int):
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        name = f"ids-{part:06d}-{uuid.uuid4().hex[:8]}.tok"
        batch = next(batches, None)
        if batch is None:
            return
        counts = [0, 0]

        def write(out):
            encoder = WordIds(words)
            doc_ids, valid, sizes, offsets, rest, at, total = [], [], [], [0], np.empty(0, np.uint32), 0, 0

            def put(ids):
                nonlocal at
                data = pack_bits(ids, bits)
                out.write(data)
                for n in range(BLOCK, len(ids) + BLOCK, BLOCK):
                    offsets.append(at + -(-min(n, len(ids)) * bits // 8))
                at += len(data)

            def pieces():
                yield batch
                yield from batches

            for piece in chunks(pieces(), size=CHUNK):
                ids, n = encoder.encode(piece["text"])
                ids = np.insert(ids, np.cumsum(n), end_id)
                doc_ids.append(np.asarray(pa.compute.fill_null(piece["doc_id"], 0), "<i8"))
                valid.append(np.asarray(pa.compute.is_valid(piece["doc_id"]), np.uint8))
                sizes.append(n + 1)
                total += len(ids)
                rest = np.concatenate((rest, ids))
                whole = len(rest) // BLOCK * BLOCK
                if whole:
                    put(rest[:whole])
                    rest = rest[whole:]
            if len(rest):
                put(rest)
            size = np.concatenate(sizes)
            for a in (np.concatenate(doc_ids), np.concatenate(valid), np.concatenate(([0], np.cumsum(size))).astype("<u8"),
                      np.asarray(offsets, "<u8")):
                out.write(a.tobytes())
            out.write(struct.pack(TAIL, b"TOKB", 1, bits, BLOCK, len(size), total))
            counts[:] = len(size), total

        put_file(folder, name, write)
        yield pa.RecordBatch.from_pydict({"part": [part], "name": [name], "n_docs": counts[:1], "n_ids": counts[1:]})
    return run


def write_token_files(docs: DataFrame, folder: str, *, vocabulary: str, vocabulary_size: int, end_id: int) -> DataFrame:
    """Encode every whole text of ``docs`` and write the files to ``folder``, which
    all machines share. Returns the manifest (part, name, n_docs, n_ids), itself a
    table in the shared folder: a file that a lost or doubled task has left is not
    named in it.

    Documents go in ascending order of doc_id (null first, equal ids by text), each
    followed by ``end_id``; null texts are empty. Other columns are not read. An
    empty table gives an empty manifest.
    """
    bits = max(vocabulary_size - 1, end_id).bit_length()
    words = encode_words(docs, vocabulary)
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text")))
    return written(ordered.mapInArrow(_write(folder, words, bits, end_id),
                                      "part long, name string, n_docs long, n_ids long"), "manifest")


def _read(folder: str):
    def run(batches):
        for batch in batches:
            for name, base in zip(batch["name"].to_pylist(), batch["base"].to_pylist()):
                f = TokenFile(folder, name)
                for lo in range(0, f.n_docs, 1024):
                    hi = min(lo + 1024, f.n_docs)
                    starts = f.starts[lo: hi + 1].astype(np.int64)
                    ids = f.ids(int(starts[0]), int(starts[-1])).astype("<u4")
                    at = starts - starts[0]
                    crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(f.doc_ids[lo:hi], pa.int64(), mask=f.valid[lo:hi] == 0), pa.array(starts[:-1] + base, pa.int64()),
                         pa.array(np.diff(starts), pa.int64()), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_token_files(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files of
    ``manifest``; start counts the ids of all documents before it. The manifest has
    a row a file and is small."""
    files = manifest.orderBy("part").collect()
    base, rows = 0, []
    for f in files:
        rows.append((f["name"], base))
        base += f["n_ids"]
    listed = spark.createDataFrame(rows, "name string, base long")
    if rows:
        listed = listed.repartition(len(rows))
    return listed.mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
