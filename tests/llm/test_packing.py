import itertools
import random

from vigil.llm.packing import best_boundaries, pack, token_lengths


def test_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(30):
        lengths = sorted(rng.sample(range(1, 60), rng.randrange(1, 9)))
        counts = [rng.randrange(1, 9) for _ in lengths]
        k = rng.randrange(1, 5)

        def cost(ends):
            return sum(c * min(e for e in ends if e >= n) for n, c in zip(lengths, counts))

        best = min(cost((*some, lengths[-1])) for r in range(min(k, len(lengths)))
                   for some in itertools.combinations(lengths[:-1], r))
        got = best_boundaries(lengths, counts, k)
        assert len(got) <= k and got[-1] == lengths[-1] and cost(got) == best


def test_batches_hold_every_row_within_the_budget(spark, frame):
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([0, 1, 5, 30, 31, 400, 3000])) for i in range(400)]
    rows += [(7, "w " * 5), (None, "a b"), (None, None), (900, ""), (901, "long " * 20_000)]
    got = pack(token_lengths(frame(rows)), budget=1000, buckets=4).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got if r.doc_id is not None) == \
        sorted((d, len((t or "").split()) + 1) for d, t in rows if d is not None)
    assert len(got) == len(rows)
    for _, batch in itertools.groupby(sorted(got, key=lambda r: r.batch_id), key=lambda r: r.batch_id):
        batch = list(batch)
        assert len({r.bucket for r in batch}) == 1 and sorted(r.slot for r in batch) == list(range(len(batch)))
        assert len(batch) == 1 or len(batch) * batch[0].bucket_tokens <= 1000
        assert all(r.padding == r.bucket_tokens - r.n_tokens >= 0 for r in batch)
    assert pack(token_lengths(frame([]))).count() == 0


def test_rows_without_an_id_are_dealt_out(spark, monkeypatch):
    from vigil.llm import packing

    monkeypatch.setattr(packing, "PART", 500)
    rows = spark.range(0, 6000, 1, 4).selectExpr("cast(null as long) AS doc_id", "7L AS n_tokens", "id AS place", "'x' AS part")
    got = pack(rows, budget=70, buckets=3).collect()
    parts = {}
    for r in got:
        parts.setdefault(r.batch_id >> 20, []).append(r)
    assert len(got) == 6000 and len(parts) == 12 and max(map(len, parts.values())) < 1000
    batches = {}
    for r in got:
        batches.setdefault(r.batch_id, []).append(r.slot)
    assert all(sorted(b) == list(range(len(b))) and len(b) <= 10 for b in batches.values())
