import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vigil.llm import ngram_lm
from vigil.llm.common import bucket_starts, mix
from vigil.llm.ngram_lm import discounts, packed, score, train, unmix, unpacked


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


class Brute:
    def __init__(self, texts):
        self.c, self.n, self.docs = collections.Counter(), collections.Counter(), len(texts)
        for t in texts:
            line = ["<b>", *words(t), "<e>"]
            self.c.update(line[1:])
            self.n.update(zip(line, line[1:]))
        self.total, self.seen, self.after = collections.Counter(), collections.Counter(), collections.defaultdict(list)
        for (v, w), k in self.n.items():
            self.total[v] += k
            self.seen[w] += 1
            self.after[v].append(k)

        def times(counts):
            return [sum(1 for k in counts if k == i) for i in (1, 2, 3, 4)]

        self.d, self.e = discounts(times(self.n.values())), discounts(times(self.seen.values()))
        self.vocabulary = len([w for w in self.c if w != "<e>"])

    def low(self, w):
        s = sum(self.seen.values())
        if not s:
            return 1 / (self.vocabulary + 2)
        weight = sum(self.e[min(k, 3) - 1] for k in self.seen.values()) / s
        k = self.seen[w]
        return (max(k - self.e[min(k, 3) - 1], 0) if k else 0) / s + weight / (self.vocabulary + 2)

    def p(self, v, w):
        if not self.total[v]:
            return self.low(w)
        k = self.n[v, w]
        back = sum(self.d[min(x, 3) - 1] for x in self.after[v]) / self.total[v]
        return (max(k - self.d[min(k, 3) - 1], 0) if k else 0) / self.total[v] + back * self.low(w)

    def score(self, text):
        line = ["<b>", *words(text), "<e>"]
        size, distinct = sum(self.c.values()), len(self.c)
        base = sum(math.log10((self.c[w] + 0.5) / (size + 0.5 * (distinct + 1))) for w in line[1:])
        return (len(line) - 1, sum(self.c[w] > 0 for w in line[1:]), base, sum(math.log10(self.p(v, w)) for v, w in zip(line, line[1:])))


def texts():
    rng = random.Random(9)
    pool = [f"Word{i}" for i in range(40)] + ["é", "the", "The"]
    return [(i, " ".join(rng.choice(pool[: rng.choice([5, 43])]) for _ in range(rng.randrange(0, 30)))) for i in range(120)] + \
        [(500, None), (501, ""), (502, "the " * 20_000), (None, "the word1")]


@pytest.mark.parametrize("shard", [4_000_000, 500])
def test_against_brute_force(spark, frame, monkeypatch, shard):
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", shard)
    rows = texts()
    learn = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True))
    meta = train(frame(rows).filter(learn))
    want = Brute([t for d, t in rows if d is None or d % 3])
    assert meta["tokens"] == sum(want.c.values())
    got = score(frame(rows), meta).collect()
    assert len(got) == len(rows)
    by = dict(rows)
    for r in got:
        n, known, base, s = want.score(by[r.doc_id])
        assert (r.n_tokens, r.n_known) == (n, known)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(s, rel=1e-9)
    everything = [*[w for w in want.c], "never seen"]
    for v in ("<b>", "the", "word3", "never seen"):
        assert sum(want.p(v, w) for w in everything) == pytest.approx(1)


def test_empty_training_and_round_trips(spark, frame):
    meta = train(frame([]))
    (r,) = score(frame([(1, "a b")]), meta).collect()
    assert (r.n_tokens, r.n_known, r.base_score) == (3, 0, 0.0) and r.score == pytest.approx(3 * math.log10(0.5))
    assert score(frame([]), meta).count() == 0
    keys = np.sort(mix(np.arange(1000, dtype=np.uint64)))
    assert (np.sort(unmix(keys)) == np.arange(1000)).all()
    k, c = unpacked(packed(keys, np.arange(1000)))
    assert (k == keys).all() and (c == np.arange(1000)).all()


def test_words_of_all_texts_are_looked_up_together(monkeypatch, tmp_path):
    """One look-up of the vocabulary for all texts of a chunk, none a text or a word."""
    keys = np.unique(ngram_lm.word_hashes(pa.array(["the end"]))[0])
    (tmp_path / "vocabulary-000000").write_bytes(keys.tobytes() + bucket_starts(keys, 0).tobytes())
    calls, look_up = [], ngram_lm.Vocabulary.look_up
    monkeypatch.setattr(ngram_lm.Vocabulary, "look_up", lambda self, hashes: calls.append(len(hashes)) or look_up(self, hashes))
    texts = ["The end", None, "", " the  odd\tEND "] * 50
    pairs = unmix(ngram_lm._bigram_tokens(f"file:{tmp_path}", [(0, 2)], 0)()(pa.array(texts, pa.string())))
    ids = dict(zip(keys.tolist(), range(2)))
    the, end = (ids[int(h)] for h in ngram_lm.word_hashes(pa.array(["the end"]))[0])
    odd = int(ngram_lm.UNKNOWN)
    want = [(2, the), (the, end), (end, 3), (2, 3), (2, 3), (2, the), (the, odd), (odd, end), (end, 3)] * 50
    assert calls == [250] and [(int(p >> np.uint64(32)), int(p & ngram_lm.UNKNOWN)) for p in pairs] == want
