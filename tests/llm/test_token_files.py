import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vigil.llm import token_files
from vigil.llm.common import span_hashes
from vigil.llm.token_files import TokenFile, pack_bits, pieces_of, read_token_files, unpack_bits, write_token_files
from vigil.session import shared_dir

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


@given(st.integers(1, 32).flatmap(lambda b: st.tuples(st.just(b), st.lists(st.integers(0, 2**b - 1), max_size=70))))
@settings(max_examples=60, deadline=None)
def test_bits_round_trip(case):
    bits, ids = case
    packed = pack_bits(np.asarray(ids, np.uint32), bits)
    assert len(packed) == -(-bits * len(ids) // 8)
    assert unpack_bits(packed, len(ids), bits).tolist() == ids


WHOLE = Tokenizer.from_file(PATH)


@given(st.lists(st.lists(st.one_of(st.characters(codec="utf-8"), st.sampled_from([*" \t\n.,;'sAZé ", "<|", "|>", "endoftext", "don't", "It's.", "word,"])), max_size=40).map("".join), max_size=4))
@settings(max_examples=150, deadline=None)
def test_word_by_word_equals_whole_text(texts):
    for t in texts:
        words = [p.decode() for w in t.encode().split() for p in pieces_of(w)]
        pieces = [i for e in WHOLE.encode_batch_fast(words, add_special_tokens=False) for i in e.ids]
        assert pieces == WHOLE.encode(t, add_special_tokens=False).ids


def test_files_read_back(spark, frame):
    rows = [(i, f"Some words, number {i}! " * (i % 60)) for i in range(300)]
    rows += [(5, "again"), (None, "no id"), (400, None), (401, ""), (402, "word " * 30_000), (-3, "xé中 y")]
    folder = shared_dir(spark, "tok")
    manifest = write_token_files(frame(rows), folder, vocabulary=PATH, vocabulary_size=49_408, end_id=2)
    got = read_token_files(spark, manifest, folder).orderBy("start").collect()
    want = {}
    for d, t in rows:
        ids = np.asarray([*WHOLE.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(d, []).append((len(ids), zlib.crc32(ids.tobytes())))
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    at, seen = 0, {}
    for r in got:
        assert r.start == at
        at += r.n_tokens
        seen.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in want.items()}
    name = manifest.orderBy("part").first()["name"]
    f = TokenFile(folder, name)
    whole = f.ids(0, f.n_ids)
    assert f.bits == 16 and f.ids(f.n_ids // 3, f.n_ids // 2).tolist() == whole[f.n_ids // 3: f.n_ids // 2].tolist()
    with pytest.raises(IndexError):
        f.doc(f.n_docs)


def test_empty_table(spark, frame):
    folder = shared_dir(spark, "tok")
    manifest = write_token_files(frame([]), folder, vocabulary=PATH, vocabulary_size=49_408, end_id=2)
    assert read_token_files(spark, manifest, folder).count() == 0


def test_marks_behind_a_word_are_parts_by_themselves():
    assert pieces_of(b"Word###") == (b"word", b"###") and pieces_of(b"don't.\")") == (b"don't", b".\")")
    assert pieces_of("Ünder,".encode()) == ("Ünder".encode(), b",") and pieces_of("né,".encode()) == ("né,".encode(),)
    assert pieces_of(b"x" + b"!" * 100) == (b"x", b"!" * 100) and pieces_of(b"#" * 100) == (b"#" * 100,)
    assert pieces_of(b"AB<|c!!") == (b"AB<|c!!",) and pieces_of(b"7,") == (b"7,",)
    low, starts, ends, n = token_files.piece_spans(pa.array(["AB<", "|C, d", None, ""]))  # no special token across texts
    assert [low[a:b].tobytes() for a, b in zip(starts, ends)] == [b"ab", b"<", b"|c", b",", b"d"] and n.tolist() == [2, 3, 0, 0]


def test_words_of_a_task_come_once_in_rows_by_shard(monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK", 300)
    texts = pa.array([f"Same words, word{i % 7}!! " * 5 for i in range(60)])
    found = list(token_files._distinct_words(2)([pa.record_batch([texts], names=["text"])]))
    assert 1 <= len(found) <= 4
    seen = []
    for r in found:
        hashes, size, data = token_files._unpacked_words(r["data"][0].as_py())
        ends = np.cumsum(size)
        assert (span_hashes(data, ends - size, ends) == hashes).all() and set((hashes >> np.uint64(62)).tolist()) == {r["shard"][0].as_py()}
        seen += [data[b - n: b].tobytes() for n, b in zip(size, ends)]
    assert sorted(seen) == sorted([b"same", b"words", b",", *[b"word%d!!" % i for i in range(7)]])


@given(st.lists(st.one_of(st.text(st.sampled_from("abcxyz"), min_size=1), st.text(st.characters(codec="utf-8"), min_size=1), st.just("x" * 3000)), min_size=1, max_size=40))
@settings(max_examples=60, deadline=None)
def test_many_words_at_a_time_equal_one_at_a_time(words):
    ids, size = ENCODE(words)
    ends = np.cumsum(size)
    assert [ids[b - n: b].tolist() for n, b in zip(size, ends)] == [WHOLE.encode(w, add_special_tokens=False).ids for w in words]


ENCODE = token_files.encoder(PATH)


def test_several_shards(spark, frame, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 2000)
    rows = [(i, f"Word{i} some words, number {i * i}!! zürich " * (i % 9)) for i in range(200)] + [(900, None), (None, "é " + "long" * 400)]
    folder = shared_dir(spark, "tok")
    manifest = write_token_files(frame(rows), folder, vocabulary=PATH, vocabulary_size=49_408, end_id=2)
    want = {d: zlib.crc32(np.asarray([*WHOLE.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for d, t in rows}
    assert {r.doc_id: r.ids_crc32 for r in read_token_files(spark, manifest, folder).collect()} == want
