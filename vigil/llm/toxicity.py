"""Toxicity scores by a factorization machine over hashed terms.

score = sigmoid(b + sum w_i + sum over pairs <v_i, v_j>), over the distinct terms of
a text. The pair term, computed as half of (sum v)^2 - sum v^2, lets two terms that
are harmless alone count together. Terms are words without ASCII punctuation, A-Z
lower-cased, and the beginnings of longer words, so that forms of one stem count
together; both by their 64-bit hash. The machine is fitted on a sample of labelled rows
that is bounded in rows and bytes; scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import chunks, fold_of, opened, sealed, written

#: About this many labelled rows of each class, and this many bytes of their texts, are
#: fitted on at most, taken by a hash of the id.
SAMPLE_ROWS, SAMPLE_BYTES = 10_000, 64 << 20
#: Terms must be in MIN_DOCS sampled rows; none is left out for what it tells by itself, as
#: a term that tells nothing alone may count in a pair.
MIN_DOCS = 5
#: Code points of a word's beginning that is a term of its own.
STEM = 5
#: Words a worker remembers the terms of before it forgets all (memory bound).
MEMO = 100_000
FACTORS, EPOCHS, LEAST_STEPS, BATCH, RATE, PAIR_RATE, DECAY = 8, 20, 400, 256, 0.05, 0.015, 1e-2

_PUNCTUATION = bytes(ord(" ") if not chr(b).isalnum() and b < 128 else b for b in range(256))


def _words(text: str | None) -> set[bytes]:
    return set(text.encode("utf-8", "surrogatepass").lower().translate(_PUNCTUATION).split()) if text else set()


def _forms(word: bytes) -> list[bytes]:
    """The terms of a word: itself, and its beginning if it is longer than that."""
    if len(word) <= STEM:
        return [word]
    letters = word.decode("utf-8", "surrogatepass")
    return [word, b"\0" + letters[:STEM].encode("utf-8", "surrogatepass")] if len(letters) > STEM else [word]


def terms_of(text: str | None) -> set[bytes]:
    return {form for word in _words(text) for form in _forms(word)}


def _hash(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) - (1 << 63)


def _term_hashes(batches):
    for batch in chunks(batches):
        terms = [[_hash(t) for t in terms_of(text)] for text in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["label"], batch["weight"], pa.array(terms, pa.list_(pa.int64()))],
                                         names=["label", "weight", "terms"])


def _known_terms(vocabulary: np.ndarray):
    """Each row's terms as sorted places in the sorted ``vocabulary``, others left out."""
    def run(batches):
        for batch in batches:
            places = []
            for terms in batch["terms"]:
                at, found = Machine.known(vocabulary, np.asarray(terms.values, np.int64))
                places.append(np.sort(at[found]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch["label"], batch["weight"], pa.array(places, pa.list_(pa.int32()))],
                                             names=["label", "weight", "terms"])
    return run


class Machine:
    """Terms (sorted hashes), linear weights and factors; the last row is of all other
    terms, all zero."""

    def __init__(self, terms, bias, linear, factors):
        self.terms, self.bias, self.linear, self.factors = terms, bias, linear, factors

    @property
    def informed(self) -> bool:
        """Whether labels of both classes have taught it anything but a constant."""
        return bool(np.any(self.linear))

    @staticmethod
    def known(terms: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(terms, hashes), max(0, len(terms) - 1))
        return at, terms[at] == hashes if len(terms) else np.zeros(len(hashes), bool)

    def rows_of(self, hashes: np.ndarray) -> np.ndarray:
        at, found = self.known(self.terms, hashes)
        return np.where(found, at, len(self.terms))

    def logits(self, rows: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        out = self.bias + np.bincount(owner, self.linear[rows], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[rows, f]
            out += 0.5 * (np.bincount(owner, v, n) ** 2 - np.bincount(owner, v * v, n))
        return out


def fit_machine(hashes, labels: np.ndarray, weights: np.ndarray, terms: np.ndarray, seed: int = 7) -> Machine:
    """Adam over mini-batches on weighted log loss, with decoupled decay, for at least
    EPOCHS rounds and LEAST_STEPS steps. ``hashes``: one array of term hashes a row, or
    (places in ``terms`` of all rows' terms, their number a row).

    Two things keep the machine from learning its rows by heart without leaving a term out.
    A term's linear input is scaled by the square of chi / (chi + log #terms), chi being its
    chi-square against the label: what chance reaches for a few terms counts little, however
    many terms do. The factors share one second moment, so a term's step is as long as its
    gradient is large beside the largest, while Adam's own would move every term alike.
    """
    rng = np.random.default_rng(seed)
    n_terms = len(terms)
    start = rng.normal(0, 0.02, (n_terms, FACTORS)).astype(np.float32)
    model = Machine(terms, 0.0, np.zeros(n_terms + 1, np.float32), np.vstack((start, np.zeros((1, FACTORS), np.float32))))
    n = len(labels)
    if not n or labels.min() == labels.max():
        share = labels.mean() if n else 0.5
        model.bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return model
    if isinstance(hashes, tuple):
        flat, size = hashes
        owner = np.repeat(np.arange(n, dtype=np.int32), size)
    else:
        size = np.fromiter(map(len, hashes), np.int64, n)
        flat, owner = model.rows_of(np.concatenate(hashes)).astype(np.int32), np.repeat(np.arange(n, dtype=np.int32), size)
        flat, owner = flat[flat < n_terms], owner[flat < n_terms]
    ends = np.cumsum(np.bincount(owner, minlength=n))
    begins = np.concatenate(([0], ends[:-1]))

    support, toxic = np.bincount(flat, minlength=n_terms + 1), np.bincount(flat, labels[owner], n_terms + 1)
    due, p = support * labels.mean(), labels.mean()
    chi = (toxic - due) ** 2 / np.maximum(due * (1 - p), 1e-9)
    scale = ((chi / (chi + np.log(max(3, n_terms)))) ** 2).astype(np.float32)

    weights = weights / weights.mean()
    share = np.average(labels, weights=weights)
    params = [np.array([np.log(share / (1 - share))]), model.linear, model.factors]
    first, second, step = [np.zeros_like(p) for p in params], [0.0, np.zeros_like(model.linear), 0.0], 0
    for _ in range(max(EPOCHS, -(-LEAST_STEPS // -(-n // BATCH)))):
        order = rng.permutation(n)
        for start in range(0, n, BATCH):
            part = order[start: start + BATCH]
            rows = np.concatenate([flat[begins[i]:ends[i]] for i in part])
            of = np.repeat(np.arange(len(part)), (ends - begins)[part])
            v = model.factors[rows]
            sums = np.stack([np.bincount(of, v[:, f], len(part)) for f in range(FACTORS)], axis=1).astype(np.float32)
            squares = np.bincount(of, (v * v).sum(axis=1), len(part))
            z = params[0][0] + np.bincount(of, model.linear[rows] * scale[rows], len(part)) + 0.5 * ((sums**2).sum(axis=1) - squares)
            error = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part]) * weights[part] / len(part)).astype(np.float32)
            e = error[of]
            inner = e[:, None] * (sums[of] - v)
            grads = [np.array([error.sum(dtype=np.float64)]), np.bincount(rows, e * scale[rows], n_terms + 1).astype(np.float32),
                     np.stack([np.bincount(rows, inner[:, f], n_terms + 1) for f in range(FACTORS)], axis=1).astype(np.float32)]
            step += 1
            for k, (p, g, rate) in enumerate(zip(params, grads, (RATE, RATE, PAIR_RATE))):
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * ((g * g if k == 1 else float((g * g).max())) - second[k])
                p -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                if k:
                    p *= 1 - RATE * DECAY
    model.bias = float(params[0][0])
    model.linear *= scale
    return model


def train(docs: DataFrame, labels: DataFrame, *, folds: int = 5, held_out: int = 0, sample_rows: int = SAMPLE_ROWS,
          sample_bytes: int = SAMPLE_BYTES) -> Machine:
    """Fit on labelled rows of ``docs`` whose fold (crc32 of the id as text, modulo
    ``folds``) is not ``held_out``. Null ids and labels are left out; an id with
    several labels counts as toxic if one is. Without both classes the score is a
    constant. About ``sample_rows`` ids and ``sample_bytes`` of text of each class are
    taken at most."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("label"))
             .filter("doc_id is not null and label is not null").filter(fold_of(F.col("doc_id"), folds) != held_out)
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sizes = texts.select("doc_id", F.octet_length("text").alias("bytes")).join(known, "doc_id")
    found = sizes.groupBy("label").agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes")).collect()
    share = {r["label"]: min(1.0, sample_rows / r["rows"], sample_bytes / max(1, r["bytes"] or 0)) for r in found}
    chosen = None
    for label, part in share.items():  # about sample_rows ids of each class: a bounded broadcast
        some = known.filter((F.col("label") == label) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(part * (1 << 20))))
        some = some.withColumn("weight", F.lit(1 / part))
        chosen = some if chosen is None else chosen.union(some)
    none = np.empty(0, np.int64)
    if chosen is None:
        return fit_machine([], np.empty(0), np.empty(0), none)
    rows = written(texts.join(F.broadcast(chosen), "doc_id").select("label", "weight", "text")
                   .mapInArrow(_term_hashes, "label int, weight double, terms array<long>"), "labelled")
    seen = rows.select(F.explode("terms").alias("term")).groupBy("term").count().filter(F.col("count") >= MIN_DOCS)
    vocabulary = np.sort(seen.select("term").toArrow()["term"].to_numpy().astype(np.int64))
    sample = rows.mapInArrow(_known_terms(vocabulary), "label int, weight double, terms array<int>").toArrow().combine_chunks()
    if not sample.num_rows:
        return fit_machine([], np.empty(0), np.empty(0), none)
    lists = sample["terms"].combine_chunks()
    places = np.asarray(lists.flatten(), np.int32), np.asarray(lists.value_lengths(), np.int64)
    labels, weights = np.asarray(sample["label"], np.float64), np.asarray(sample["weight"], np.float64)
    model = fit_machine(places, labels, weights, vocabulary)
    del sample, lists, places
    pa.default_memory_pool().release_unused()  # the driver lives on
    return model


class _Rows(dict):
    """word -> rows of the model that its terms have, remembered up to a bounded number
    of words."""

    def __init__(self, model: Machine):
        self.of_hash = {int(h): i for i, h in enumerate(model.terms)}

    def __missing__(self, word: bytes) -> tuple:
        if len(self) >= MEMO:
            self.clear()
        rows = self[word] = tuple(r for r in (self.of_hash.get(_hash(t), -1) for t in _forms(word)) if r >= 0)
        return rows


def _scores(model: Machine):
    def run(batches):
        rows_of = _Rows(model)
        for batch in chunks(batches):
            rows, size = [], []
            for text in batch["text"].to_pylist():
                some = set().union(*map(rows_of.__getitem__, _words(text)))
                rows.extend(some)
                size.append(len(some))
            z = model.logits(np.asarray(rows, np.int64), np.repeat(np.arange(len(size)), size), len(size))
            score = pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, "score"])
    return run


def score_toxicity(docs: DataFrame, model: Machine) -> DataFrame:
    """``docs`` with the column score (0 to 1), any column of that name replaced; all
    others stay. Null and empty texts get the bias's score; every row, repeated ones too,
    is scored by its whole text."""
    columns = [c for c in docs.columns if c != "score"]
    frame = sealed(docs.select(*[F.col(f"`{c}`") for c in columns]), "text")
    schema = frame.withColumn("score", F.lit(0.0)).schema
    return opened(frame.mapInArrow(_scores(model), schema), columns, "text")
