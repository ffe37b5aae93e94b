import random
import re

import pytest

from vigil.llm import decontaminate as module
from vigil.llm.decontaminate import PUNCTUATION, UNITS, contamination, decontaminate, mark_contaminated

ITEMS = [(1, "If Anna has 12 apples and gives 12 of them to Bob in 3 km , how many are left ?"),
         (2, "The quick brown fox jumps over the lazy dog while the cat sleeps under a warm red blanket."),
         (3, "alpha beta gamma delta epsilon"), (4, "too short"), (5, None), (6, ""), (7, "1 2 3 4 5 6 7 8 9 10 11 12")]
ITEM = "item_id long, text string"


def template(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").strip(" \t\n\x0b\x0c\r")) if w.strip(PUNCTUATION)]
    out, value = [], []
    for i, w in enumerate(words):
        core, before = w.strip(PUNCTUATION), words[i - 1] if i else None
        if "0" <= core[0] <= "9":
            kind = "n"
        elif core[0] != core[0].lower() and before and before[-1] not in ".!?:":
            kind = "p"
        elif before and "0" <= before.strip(PUNCTUATION)[0] <= "9" and core.lower() in UNITS:
            kind = "u"
        else:
            kind = None
        out.append(kind or core.lower())
        value.append(core.lower() if kind else None)
    return out, value


def brute(docs, items, window=8, literals=5):
    found = set()
    for d, text in docs:
        t, v = template(text)
        for item, itext in items:
            it, iv = template(itext)
            size = min(window, len(it))
            if size < literals:
                continue
            lines = {}
            for p in range(len(it) - size + 1):
                if sum(x is None for x in iv[p:p + size]) >= literals:
                    for q in range(len(t) - size + 1):
                        if t[q:q + size] == it[p:p + size]:
                            lines.setdefault(q - p, []).extend((a, b) for a, b in zip(iv[p:p + size], v[q:q + size]) if a)
            for pairs in lines.values():
                pairs = set(pairs)
                if len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs):
                    found.add((d, item))
    return found


def documents():
    rng = random.Random(8)
    words = " ".join(t or "" for _, t in ITEMS).split() + ["7", "km", "Zed", "and."]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 40)))) for i in range(60)]
    for i, (_, t) in enumerate(ITEMS):
        rows.append((100 + i, f"noise before. {t} and after"))
    rows += [(200, "so If Carla has 7 apples and gives 7 of them to Dan in 9 km, how many are left?"),  # other numbers and names
             (201, "so If Carla has 7 apples and gives 8 of them to Dan in 9 km, how many are left?"),  # 12 cannot be both 7 and 8
             (300, None), (301, ""), (302, "word " * 20_000 + ITEMS[1][1]), (None, ITEMS[1][1]), (303, ITEMS[1][1]), (303, ITEMS[1][1])]
    return rows


def test_against_brute_force(spark, frame):
    rows = documents()
    items = spark.createDataFrame(ITEMS + [ITEMS[1]], ITEM)
    got = {(r.doc_id, r.item_id) for r in contamination(frame(rows), items, exact=False).collect()}
    assert got == brute(rows, ITEMS)
    assert (200, 1) in got and (302, 2) in got and (None, 2) in got and (103, 4) not in got
    clean = decontaminate(frame(rows), items, exact=False)
    assert clean.columns == frame(rows).columns
    bad = {d for d, _ in got}
    assert sorted((r.doc_id for r in clean.collect())) == sorted(d for d, _ in rows if d not in bad)
    marks = mark_contaminated(frame(rows), items, exact=False).collect()
    assert len(marks) == len(rows) and {r.doc_id for r in marks if r.contaminated} == bad


def test_inconsistent_slots(spark, frame):
    rows = [(1, "so If Carla has 7 apples and gives 8 of them to Dan"), (2, "so If Carla has 7 apples and gives 7 of them to Dan")]
    items = spark.createDataFrame([ITEMS[0]], ITEM)
    marks = {r.doc_id: r.contaminated for r in mark_contaminated(frame(rows), items).collect()}
    assert marks == {1: False, 2: True}


@pytest.mark.parametrize("docs, items", [([], ITEMS), ([(1, "a b c d e f g h i")], [])])
def test_empty_tables(spark, frame, docs, items):
    assert mark_contaminated(frame(docs), spark.createDataFrame(items, ITEM)).filter("contaminated").count() == 0


def test_windows_with_the_items_own_values_count_in_any_alignment(spark, frame):
    text = ("The farmer bought 5 white sheep from his neighbour and sold 5 brown goats at the market before he drove home "
            "along the old river road with a full purse and a cheerful song")
    rows = [(1, "so " + text.replace("sold 5", "sold 6")), (2, "so " + text.replace("5", "6"))]
    got = {r.doc_id: r for r in contamination(frame(rows), spark.createDataFrame([(1, text)], ITEM)).collect()}
    assert set(got) == {1, 2} and 0 < got[1].coverage < got[2].coverage


def test_exact_passages_that_templates_cannot_decide(spark, frame):
    items = [(1, "1 2 3 4 5 6 7 8 9 10 11 12"), (2, "too short"), (3, "Paris became the seat of government"), (4, ITEMS[1][1]),
             (5, "Anna Bob Carla Dan Eve Frank Gina Hans Ida"), (6, None)]
    rows = [(1, "sums 1 2 3 4 5 6 7 8 9 10 11 12 end"), (2, "this is too short to tell"), (3, "Too short."),
            (4, "we read, Paris became the seat of government then"), (5, "NOW " + ITEMS[1][1].upper()),
            (6, "so anna bob carla dan eve frank gina hans ida"), (7, "Eve Dan Carla Bob Anna Ida Hans Gina Frank"), (8, None), (None, "too short")]
    items = spark.createDataFrame(items, ITEM)
    got = {(r.doc_id, r.item_id) for r in contamination(frame(rows), items).collect()}
    assert got == {(1, 1), (3, 2), (4, 3), (5, 4), (6, 5), (None, 2)}
    assert {r.doc_id for r in decontaminate(frame(rows), items, exact=True).collect()} == {2, 7, 8}


def test_the_exact_pass_loses_no_template_match(spark, frame):
    rows = documents()
    items = spark.createDataFrame(ITEMS, ITEM)
    got = {(r.doc_id, r.item_id) for r in contamination(frame(rows), items, exact=True).collect()}
    assert got >= brute(rows, ITEMS) and (106, 7) in got and (103, 4) not in got


def test_windows_are_made_only_of_documents_that_hold_an_anchor(spark, frame, monkeypatch):
    rng, seen, plain = random.Random(3), [], module._with_windows
    rows = [(i, " ".join(rng.choice(["the", "lazy", "Dog", "cat", "12", "km", "over."]) for _ in range(60))) for i in range(80)]
    rows += [(100, "so " + ITEMS[1][1].upper()), (101, "they say: " + ITEMS[0][1].replace("12", "40")), (102, ITEMS[1][1])]

    def counted(df, *args):
        if "text_hash" in df.columns:
            seen.append(df.count())
        return plain(df, *args)

    monkeypatch.setattr(module, "_with_windows", counted)
    got = {(r.doc_id, r.item_id) for r in contamination(frame(rows), spark.createDataFrame(ITEMS[:2], ITEM)).collect()}
    assert got == {(100, 2), (101, 1), (102, 2)}
    assert seen and max(seen) == 3


def test_anchors_lose_no_match(spark, frame):
    items = [(1, "It's a well-known (old) saying of sailors, isn't it ?"), (2, "ΟΔΟΣ ΤΟΥ ΑΓΙΟΥ, ΚΑΙ ΑΛΛΟΣ ΔΡΟΜΟΣ ΕΔΩ ΚΑΤΩ ."),
             (3, "† alpha† beta ‡gamma delta‟ epsilon zeta •eta •"), (4, "Hello!"), (5, "mother-in-law"), (6, "9 1 2 x"),
             (7, "take 5 warm Anna bread 6 with honey"), (8, "— “ ” —"), (9, "i̇stanbul İZMİR ankara bursa adana konya van"),
             (10, "† ‡ † ‡ † ‡ † ‡")]
    rows = [(1, "so it's — A WELL-KNOWN “old” saying … of\tsailors; isn't it, though"), (2, "«οδος» του αγιου - και αλλος, δρομος εδω κατω τώρα"),
            (3, "so † alpha† - beta ‡gamma (delta‟) epsilon zeta •eta •"), (4, "-- HELLO ..."), (5, "Mother-in-law?"), (6, "9. 1, 2; X!"),
            (7, "to take 7 warm Bob bread 8 with honey"), (8, "hello mother in law"), (9, "so İstanbul İzmİr ankara bursa adana konya van"),
            (10, "† ‡ † ‡ † ‡ † ‡ †"), (11, "it's a well known old saying of sailors"), (None, "Hello")]
    got = {(r.doc_id, r.item_id) for r in contamination(frame(rows), spark.createDataFrame(items, ITEM)).collect()}
    assert got == {(i, i) for i in (1, 2, 3, 4, 5, 6, 7, 9, 10)} | {(None, 4)}


def test_few_literals_need_no_anchor(spark, frame):
    items = spark.createDataFrame([(1, "paid 5 euros twice"), (2, "Anna 3 4 slept")], ITEM)
    rows = [(1, "he paid 6 euros twice a day"), (2, "so Eve 5 6 slept"), (3, "he paid them 6 euros")]
    got = {(r.doc_id, r.item_id) for r in contamination(frame(rows), items, window=4, literals=1, exact=False).collect()}
    assert (1, 1) in got and not {d for d, _ in got} & {3}
