import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.llm.common import bucket_starts, by_shard, find, mix, span_hashes, word_spans, words_of

TEXT = st.one_of(st.none(), st.lists(st.one_of(st.characters(codec="utf-8"), st.sampled_from([*" \t\n\x0b\x0c\r\x1c\x85\xa0\0ab", "word", "x" * 600]))).map("".join))


@given(st.lists(TEXT, max_size=6), st.integers(0, 3))
@settings(max_examples=150, deadline=None)
def test_spans_are_the_words_of_each_text(texts, skip):
    data, starts, ends, n = word_spans(pa.array(texts, pa.string()).slice(skip))
    data = np.frombuffer(data.tobytes().lower(), np.uint8)
    texts = texts[skip:]
    words = [w for t in texts for w in words_of(t)]
    assert n.tolist() == [len(words_of(t)) for t in texts]
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == words
    by = {}
    for w, h in zip(words, span_hashes(data, starts, ends).tolist()):
        assert by.setdefault(w, h) == h  # wherever it stands
    assert len(set(by.values())) == len(by)


def test_hashes_tell_near_words_apart():
    words = [b"a" * k for k in range(1, 700)] + [b"a" * k + b"\0" for k in range(700)] + [b"\0" * k + b"b" for k in range(1, 40)]
    data, size = np.frombuffer(b"".join(words), np.uint8), np.asarray([len(w) for w in words])
    ends = np.cumsum(size)
    assert len(set(span_hashes(data, ends - size, ends).tolist())) == len(set(words))


def test_find_in_shards():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 700):
        keys = np.unique(np.concatenate((mix(rng.integers(0, 1 << 40, n).astype(np.uint64)), np.asarray([0, 2**64 - 1], np.uint64)[: n // 2])))
        wanted = np.concatenate((keys, keys + np.uint64(1), mix(np.arange(300, dtype=np.uint64))))
        for bits in (0, 1, 3):
            got = np.full(len(wanted), -1)
            for shard, mine in by_shard(wanted, bits):
                part = keys[keys >> np.uint64(64 - bits) == shard] if bits else keys
                if len(part):
                    at = find(part, bucket_starts(part, bits), bits, wanted[mine])
                    got[mine] = np.where(at >= 0, at + np.searchsorted(keys, part[0]), -1)
            where = {int(k): i for i, k in enumerate(keys)}
            assert got.tolist() == [where.get(int(w), -1) for w in wanted]
