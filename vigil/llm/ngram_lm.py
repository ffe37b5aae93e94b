"""Interpolated modified Kneser-Ney language model, counted in Spark.

Order 2 with an end token: P(w | v) = max(c(v w) - D, 0) / c(v .) + g(v) P1(w), and P1
is made in the same way of continuation counts (in how many contexts w is seen),
interpolated with the uniform distribution over the training words, the end and one
unknown word. D is D1, D2 or D3+ by the count, from the counts of counts.

All parts of the model are arrays sorted by hash in files of the shared folder:

    vocabulary   word hashes; a word's id is its rank
    words        by id: c(v .), g(v), and the number of contexts w is seen in
    bigrams      scrambled (id, id) -> count, in shards by the key's first bits

Vocabulary and bigrams also hold where the buckets of their keys start.

Tasks count their own texts into sorted arrays, cut by shard; one task a shard adds
these up, so no group holds more than its shard and no hot word meets in one place.
Workers map the files into memory and look the words of many texts up together, by
bucket; nothing of the model goes through the driver but totals.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import (GOLD, MIX1, MIX2, S27, S30, S31, bucket_starts, by_number, by_shard, chunks, find, map_file, mix, put_file,
                              span_hashes, word_spans, written)
from vigil.session import shared_dir

#: About this many tokens' counts make a shard.
SHARD_TOKENS = 4_000_000
#: A task adds its counts up whenever it holds this many (memory bound).
HELD = 1_500_000
#: Text bytes handled at a time (memory bound).
CHUNK = 1 << 20
UNKNOWN = np.uint64(0xFFFFFFFF)
#: Words' statistics are kept in files of 2 ** PART ids.
PART = np.uint64(18)


def unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> S31) ^ (x >> np.uint64(62))
        x = x * np.uint64(pow(int(MIX2), -1, 1 << 64))
        x = x ^ (x >> S27) ^ (x >> np.uint64(54))
        x = x * np.uint64(pow(int(MIX1), -1, 1 << 64))
        x = x ^ (x >> S30) ^ (x >> np.uint64(60))
        return x - GOLD


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and their summed counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[starts], np.add.reduceat(counts, starts)


def packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and counts: differences by byte planes, of which the high ones, mostly
    zero, and the counts are compressed."""
    steps, counts = np.diff(keys, prepend=np.uint64(0)), counts.astype("<u4")
    low = max(0, len(steps) and (int(np.median(steps)).bit_length() + 3) // 8)  # these look random
    planes = np.ascontiguousarray(steps.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8).T)
    rest = planes[low:].tobytes() + np.ascontiguousarray(counts.view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(keys).to_bytes(8, "little") + bytes([low]) + planes[:low].tobytes() + zlib.compress(rest, 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, low = int.from_bytes(data[:8], "little"), data[8]
    raw = data[9: 9 + low * n] + zlib.decompress(data[9 + low * n:])
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n).reshape(8, n).T).reshape(-1).view("<u8")
    counts = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, 8 * n).reshape(4, n).T).reshape(-1).view("<u4")
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


def _counted(tokens_of, shard_bits: int):
    """Counts of 64-bit tokens over a task's texts, as packed arrays by shard."""
    def run(batches):
        tokens = tokens_of()
        held, n, sums = [], 0, (np.empty(0, np.uint64), np.empty(0, np.int64))

        def settle(sums, held):
            keys = np.concatenate(held)
            keys.sort()
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            return add_up(np.concatenate((sums[0], keys[starts])),
                          np.concatenate((sums[1], np.diff(starts, append=len(keys)))))

        def out(sums):
            cuts = np.searchsorted(sums[0], np.arange(1 << shard_bits, dtype=np.uint64) << np.uint64(64 - shard_bits)) if shard_bits else [0]
            for shard, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(sums[0])])):
                if b > a:
                    yield pa.RecordBatch.from_pydict({"shard": [shard], "data": [packed(sums[0][a:b], sums[1][a:b])]})

        for batch in chunks(batches, size=CHUNK):
            t = tokens(batch["text"])
            if len(t):
                held.append(t)
                n += len(t)
            if n >= HELD:
                sums, held, n = settle(sums, held), [], 0
                if len(sums[0]) >= HELD:
                    yield from out(sums)
                    sums = (np.empty(0, np.uint64), np.empty(0, np.int64))
        if held:
            sums = settle(sums, held)
        yield from out(sums)
    return run


def merged(parts) -> tuple[np.ndarray, np.ndarray]:
    """The packed arrays of one shard, added up a few at a time."""
    keys, counts, held, n = np.empty(0, np.uint64), np.empty(0, np.int64), [], 0
    for data in parts:
        held.append(unpacked(data))
        n += len(held[-1][0])
        if n >= max(HELD, len(keys)):
            keys, counts = add_up(np.concatenate([keys, *(k for k, _ in held)]), np.concatenate([counts, *(c for _, c in held)]))
            held, n = [], 0
    return add_up(np.concatenate([keys, *(k for k, _ in held)]), np.concatenate([counts, *(c for _, c in held)]))


def _vocabulary_shard(folder: str, bits: int):
    def run(key, table):
        keys, counts = merged(x.as_py() for x in table["data"])
        shard = key[0].as_py()
        put_file(folder, f"vocabulary-{shard:06d}", lambda f: (f.write(keys.tobytes()), f.write(bucket_starts(keys, bits).tobytes())))
        return pa.table({"shard": pa.array([shard], pa.int64()), "n": pa.array([len(keys)], pa.int64()),
                         "tokens": pa.array([int(counts.sum())], pa.int64())})
    return run


class Vocabulary:
    """The memory-mapped vocabulary: ids of word hashes."""

    def __init__(self, folder: str, sizes: list[tuple[int, int]], bits: int):
        self.bits, self.files, self.first, at = bits, {}, {}, 0
        for shard, n in sizes:  # in hash order
            data = map_file(folder, f"vocabulary-{shard:06d}")
            self.files[shard] = np.frombuffer(data, "<u8", n), np.frombuffer(data, "<u4", -1, 8 * n)
            self.first[shard] = at
            at += n
        self.size = at

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Ids; UNKNOWN for words not in training."""
        ids = np.full(len(hashes), UNKNOWN, np.uint64)
        for shard, mine in by_shard(hashes, self.bits):
            if shard in self.files:
                at = find(*self.files[shard], self.bits, hashes[mine])
                ids[mine] = np.where(at >= 0, (at + self.first[shard]).astype(np.uint64), UNKNOWN)
        return ids


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and the number of words of each."""
    data, starts, ends, n = word_spans(texts)
    return span_hashes(np.frombuffer(data.tobytes().lower(), np.uint8), starts, ends), n


def _hash_tokens():
    return lambda texts: word_hashes(texts)[0]


def lines_of(ids: np.ndarray, n: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' lines end to end, each begin, its words, end; and the places where lines
    begin and end."""
    ends = np.cumsum(n + 2) - 1
    begins, lines = ends - n - 1, np.empty(len(ids) + 2 * len(n), np.uint64)
    words = np.ones(len(lines), bool)
    words[begins] = words[ends] = False
    lines[words], lines[begins], lines[ends] = ids, begin, end
    return lines, begins, ends


def bigram_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((left << np.uint64(32)) | right)


def _bigram_tokens(folder, sizes, bits):
    def make():
        vocabulary = Vocabulary(folder, sizes, bits)

        def tokens(texts):
            hashes, n = word_hashes(texts)
            lines, begins, ends = lines_of(vocabulary.look_up(hashes), n, vocabulary.size, vocabulary.size + 1)
            return bigram_keys(np.delete(lines, ends), np.delete(lines, begins))
        return tokens
    return make


def _times(counts: np.ndarray) -> np.ndarray:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5]


def _bigram_shard(folder: str, bits: int):
    """Adds a shard up and writes it. Out: what it adds to the words' statistics, by
    ranges of ids (part), and its counts of counts (part -1)."""
    def run(key, table):
        keys, counts = merged(x.as_py() for x in table["data"])
        shard = key[0].as_py()
        put_file(folder, f"bigrams-{shard:06d}", lambda f: [f.write(a.tobytes()) for a in (keys, counts.astype("<u4"), bucket_starts(keys, bits))])
        pair = unmix(keys)
        left, right = pair >> np.uint64(32), pair & UNKNOWN
        rows = [(-1, "info", np.asarray([shard, len(keys), *_times(counts)], "<i8").tobytes())]
        for what, ids, values in (("total", left, counts), ("n1", left, counts == 1), ("n2", left, counts == 2),
                                  ("n3", left, counts > 2), ("seen", right, counts > 0)):
            k, v = add_up(ids, np.asarray(values, np.int64))
            k, v = k[v > 0], v[v > 0]
            for part in np.unique(k >> PART):
                mine = k >> PART == part
                rows.append((int(part), what, packed(k[mine], v[mine])))
        return pa.table({"part": pa.array([r[0] for r in rows], pa.int64()), "what": pa.array([r[1] for r in rows], pa.string()),
                         "data": pa.array([r[2] for r in rows], pa.binary())})
    return run


def discounts(times) -> list[float]:
    """D1, D2 and D3+ from how many n-grams occur 1, 2, 3 and 4 times, kept inside (0, k)."""
    n1, n2, n3, n4 = (float(x) for x in times)
    if not (n1 and n2 and n3):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)]


def _word_part(folder: str, d: list[float]):
    """Writes one range of words as dense arrays: c(v .), g(v), contexts w is seen in."""
    def run(key, table):
        part, sums = key[0].as_py(), {}
        for what in ("total", "n1", "n2", "n3", "seen"):
            ids, values = merged(x.as_py() for w, x in zip(table["what"], table["data"]) if w.as_py() == what)
            sums[what] = np.zeros(1 << int(PART), np.int64)
            sums[what][(ids - np.uint64(part << int(PART))).astype(np.int64)] = values
        total, seen = sums["total"], sums["seen"]
        mass = d[0] * sums["n1"] + d[1] * sums["n2"] + d[2] * sums["n3"]
        back = np.where(total > 0, mass / np.maximum(total, 1), 1.0)
        put_file(folder, f"words-{part:06d}", lambda f: [f.write(a.tobytes()) for a in (total.astype("<i8"), back.astype("<f8"), seen.astype("<i8"))])
        info = np.asarray([seen.sum(), *_times(seen), (seen > 2).sum()], "<i8")
        return pa.table({"part": pa.array([part], pa.int64()), "info": pa.array([info.tobytes()], pa.binary())})
    return run


class KneserNey:
    """The model as a worker has it: files mapped into memory, and a few totals."""

    def __init__(self, meta: dict):
        self.meta = meta
        self.vocabulary = Vocabulary(meta["folder"], meta["words"], meta["word_bits"])
        self.begin, self.end = self.vocabulary.size, self.vocabulary.size + 1
        self.bigrams, self.parts = {}, {}
        for shard, n in meta["bigrams"]:
            data = map_file(meta["folder"], f"bigrams-{shard:06d}")
            self.bigrams[shard] = np.frombuffer(data, "<u8", n), np.frombuffer(data, "<u4", n, 8 * n), np.frombuffer(data, "<u4", -1, 12 * n)
        for part in meta["parts"]:
            data = map_file(meta["folder"], f"words-{part:06d}")
            n = 1 << int(PART)
            self.parts[part] = [np.frombuffer(data, t, n, 8 * n * i) for i, t in enumerate(("<i8", "<f8", "<i8"))]

    def of_words(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """c(v .), g(v) and the contexts seen, of each id."""
        total, back, seen = np.zeros(len(ids), np.int64), np.ones(len(ids)), np.zeros(len(ids), np.int64)
        for p, mine in by_number(ids >> PART):
            if p in self.parts:
                at = (ids[mine] - np.uint64(p << int(PART))).astype(np.int64)
                for out, values in zip((total, back, seen), self.parts[p]):
                    out[mine] = values[at]
        return total, back, seen

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """How often each bigram is in training."""
        found, bits = np.zeros(len(keys), np.int64), self.meta["bigram_bits"]
        for shard, mine in by_shard(keys, bits):
            if shard in self.bigrams:
                known, values, buckets = self.bigrams[shard]
                at = find(known, buckets, bits, keys[mine])
                found[mine] = np.where(at >= 0, values[at], 0)
        return found

    def score(self, texts: pa.Array) -> dict[str, np.ndarray]:
        """n_tokens, n_known, base_score and score of each text."""
        hashes, size = word_hashes(texts)
        lines, begins, ends = lines_of(self.vocabulary.look_up(hashes), size, self.begin, self.end)
        size = size + 1
        total, back, seen = self.of_words(lines)
        left, right = np.delete(lines, ends), np.delete(lines, begins)
        c, seen, total, back = np.delete(total, begins), np.delete(seen, begins), np.delete(total, ends), np.delete(back, ends)
        c = np.where(right == self.end, self.meta["docs"], c)
        n = self.counts(bigram_keys(left, right))
        m = self.meta
        low = np.concatenate(([0.0], m["low_discounts"]))[np.minimum(seen, 3)]
        p = np.maximum(seen - low, 0) / max(m["seen"], 1) + m["low_weight"] / (self.vocabulary.size + 2)
        high = np.concatenate(([0.0], m["discounts"]))[np.minimum(n, 3)]
        p = np.maximum(n - high, 0) / np.maximum(total, 1) + np.where(total > 0, back, 1.0) * p
        distinct = self.vocabulary.size + (m["docs"] > 0)
        base = np.log10((c + 0.5) / (m["tokens"] + 0.5 * (distinct + 1)))
        starts = np.concatenate(([0], np.cumsum(size)[:-1]))
        return {"n_tokens": size, "n_known": np.add.reduceat((c > 0).astype(np.int64), starts),
                "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(np.log10(p), starts)}


def train(docs: DataFrame) -> dict:
    """Count the model over all texts of ``docs`` (null: empty) and write its files to the
    shared folder. Returns what workers need to open it: names, sizes and totals, a few
    numbers a shard."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    n_docs, size = texts.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    folder = shared_dir(docs.sparkSession, "ngrams")

    def bits_for(tokens):
        return max(0, -(-tokens // SHARD_TOKENS) - 1).bit_length()

    word_bits = bits_for((size or 0) // 6)
    words = written(texts.mapInArrow(_counted(_hash_tokens, word_bits), "shard long, data binary").groupBy("shard")
                    .applyInArrow(_vocabulary_shard(folder, word_bits), "shard long, n long, tokens long"), "ngrams").orderBy("shard").collect()
    sizes, n_words = [(r["shard"], r["n"]) for r in words], sum(r["tokens"] for r in words)
    if sum(n for _, n in sizes) + 2 >= int(UNKNOWN):
        raise ValueError("more distinct words than 32-bit ids")
    bigram_bits = bits_for(n_words + n_docs)
    parts = written(texts.mapInArrow(_counted(_bigram_tokens(folder, sizes, word_bits), bigram_bits), "shard long, data binary")
                    .groupBy("shard").applyInArrow(_bigram_shard(folder, bigram_bits), "part long, what string, data binary"), "ngrams")
    info = [np.frombuffer(r["data"], "<i8") for r in parts.filter("part = -1").select("data").collect()]
    d = discounts(sum(i[2:6] for i in info) if info else [0] * 4)
    low = written(parts.filter("part >= 0").groupBy("part").applyInArrow(_word_part(folder, d), "part long, info binary"), "ngrams").collect()
    sums = sum((np.frombuffer(r["info"], "<i8") for r in low), np.zeros(6, np.int64))
    e = discounts(sums[1:5])
    seen = int(sums[0])
    weight = float((e[0] * sums[1] + e[1] * sums[2] + e[2] * sums[5]) / seen) if seen else 1.0
    return {"folder": folder, "words": sizes, "word_bits": word_bits, "bigrams": sorted((int(i[0]), int(i[1])) for i in info),
            "bigram_bits": bigram_bits, "parts": [r["part"] for r in low], "discounts": d, "low_discounts": e, "low_weight": weight,
            "seen": seen, "docs": int(n_docs), "tokens": int(n_words + n_docs)}


def _scored(meta: dict):
    def run(batches):
        model = None
        for batch in chunks(batches, "text_", CHUNK):
            if not batch.num_rows:
                continue
            model = model or KneserNey(meta)
            got = model.score(batch["text_"])
            names = [c for c in batch.schema.names if c != "text_"]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in names], *[pa.array(v) for v in got.values()]], names=[*names, *got])
    return run


def score(docs: DataFrame, meta: dict) -> DataFrame:
    """``docs`` with n_tokens (words and the end), n_known (tokens seen in training),
    base_score (add-half unigram model) and score (this model), both the log10
    probability of the whole text; columns of these names are replaced.

    Null and empty texts consist of the end. A model trained on no rows gives every
    token the same probability. Null ids and repeated rows are scored like others.
    Perplexity is 10 ** (-score / n_tokens).
    """
    new = ("n_tokens", "n_known", "base_score", "score")
    frame = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (*new, "text_")],
                        F.col("text").cast("string").alias("text_"))
    whole = frame.drop("text_").withColumns({"n_tokens": F.lit(0).cast("long"), "n_known": F.lit(0).cast("long"),
                                             "base_score": F.lit(0.0), "score": F.lit(0.0)})
    return frame.mapInArrow(_scored(meta), whole.schema)
