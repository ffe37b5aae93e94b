import collections
import random
import zlib

import numpy as np
import pytest

from vigil.llm.lines import drop_repeated_lines, keep_bitmaps


def brute(rows, min_docs, keep):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holders, first = collections.defaultdict(set), {}
    for i, (d, t) in enumerate(rows):
        for p, line in enumerate((t or "").split("\n")):
            holders[key(line)].add(d)
    out = []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        lines, left = (t or "").split("\n"), []
        for line in lines:
            k = key(line)
            often = k and len(holders[k]) >= min_docs
            if not often or (keep == "first" and k not in first):
                left.append(line)
            if often:
                first.setdefault(k, d)
        out.append((d, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def lines_of(rng):
    pool = [f"line {i} é" for i in range(12)] + ["", " ", "  HOT line\t", "hot LINE"]
    return "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 6)))


@pytest.mark.parametrize("keep", ["none", "first"])
def test_lines_against_brute_force(spark, frame, keep):
    rng = random.Random(3)
    rows = [(i, lines_of(rng) + f"\nown {i}") for i in range(150)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "hot line\n" * 500), (None, "hot line\nline 3 é")]
    got = drop_repeated_lines(frame(rows), min_docs=10, keep=keep).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got), key=repr) == \
        sorted(brute(rows, 10, keep), key=repr)


def test_hot_line_over_many_partitions(spark, frame):
    rows = [(i, "the hot line\n" + "rare %d" % (i // 3)) for i in range(3000)]
    got = drop_repeated_lines(frame(rows), min_docs=10).collect()
    assert {r.n_dropped for r in got} == {1}
    assert all(r.text == "rare %d" % (r.doc_id // 3) for r in got)
    first = drop_repeated_lines(frame(rows), min_docs=10, keep="first").filter("n_dropped = 0").collect()
    assert [r.doc_id for r in first] == [0]


def test_bitmap_and_empty_table(spark, frame):
    rows = [(i, "a\nsame\nb") for i in range(10)]
    r = keep_bitmaps(frame(rows), min_docs=10).collect()
    assert len(r) == 10
    keep = np.unpackbits(np.frombuffer(zlib.decompress(r[0]["keep"]), np.uint8))
    assert r[0].n_dropped == 3 and list(keep[:3]) == [0, 0, 0]
    assert drop_repeated_lines(frame([])).count() == 0
