import hashlib
import random
import re

from pyspark.sql import functions as F

from vigil.llm.pii import KINDS, find_personal_data, sanitise, span_list

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                  "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def noise(rng):
    bits = ["a@b.c", "x.y%z@mail-1.example.co.uk", "_q@d.e", "@", ".", "1.2.3.4", "300.1.1.1", "001.02.3.255", "1.2.3.4.5.6.7.8",
            "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111112", "5", " ", "-", "+1 (413) 555-2866", "+12", "++44 20 7946 0958 1",
            "é", "\U0001f600", "", "", "\n", "word", "0" * 30, "79927398713", "$1", "\\"]
    return "".join(rng.choice(bits) for _ in range(rng.randrange(0, 14)))


def test_base_spans_against_plain_patterns(spark, frame):
    rng = random.Random(5)
    rows = [(i, noise(rng)) for i in range(1500)]
    rows += [(2000, None), (2001, ""), (None, "a@b.c"), (2002, "x" * 200_000 + "@b.c " + "1 " * 20_000 + "a." * 20_000), (2003, "a@" + "b." * 20_000 + "c")]
    got = find_personal_data(frame(rows)).select("doc_id", span_list(KINDS).alias("s")).collect()
    assert len(got) == len(rows)
    want = dict(rows)
    for r in got:
        assert r.s == ",".join(brute(want[r.doc_id])), want[r.doc_id][:200]
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit("").cast("binary"), 256)).first()[0]


def test_terms_that_disclose_an_entity(spark, frame):
    fill = ["alpha beta", "gamma delta", "epsilon zeta", "eta theta", "iota kappa"]
    rows = [(i, f"{fill[i % 5]} number {i} common Zorkmid writes to zork@example.com about common {fill[(i + 2) % 5]} things") for i in range(5)]
    rows += [(10 + i, f"common {fill[i % 5]} writes about things to number {i}") for i in range(400)]
    rows += [(1000, "zorkmid elsewhere")]
    got = {r.doc_id: r.term for r in find_personal_data(frame(rows), everywhere=False).collect()}
    for i in range(5):
        (s,) = got[i]
        assert rows[i][1][s.start:s.end] == "Zorkmid"
    assert not any(got[d] for d, _ in rows[5:])
    clean = {r.doc_id: r.text for r in sanitise(frame(rows), everywhere=False).collect()}
    assert "[NAME] writes to [EMAIL] about" in clean[0] and clean[1000] == "zorkmid elsewhere"
    assert {r.doc_id: r.text for r in sanitise(frame(rows)).collect()}[1000] == " elsewhere"


def test_copies_are_one_context_and_empty_table(spark, frame):
    rows = [(i, "Zorkmid writes to zork@example.com again") for i in range(50)] + [(100 + i, "other words") for i in range(300)]
    assert not any(r.term for r in find_personal_data(frame(rows)).collect())
    assert find_personal_data(frame([])).count() == 0


def test_terms_count_and_are_marked_at_any_distance(spark, frame):
    fill = ["alpha beta", "gamma delta", "epsilon zeta", "eta theta", "iota kappa"]
    far = " ".join(["common writes about things"] * 6)
    rows = [(i, f"Zorkmid {far} {fill[i]} to zork@example.com about {fill[(i + 2) % 5]} {far} zorkmid") for i in range(5)]
    rows += [(10 + i, f"common {fill[i % 5]} writes about things to number {i}") for i in range(400)]
    rows += [(1000, "Zorkmid elsewhere")]

    def marked(**options):
        text = dict(rows)
        return {r.doc_id: [text[r.doc_id][s.start:s.end] for s in r.term] for r in find_personal_data(frame(rows), **options).collect() if r.term}

    held = {i: ["Zorkmid", "zorkmid"] for i in range(5)}
    assert marked(everywhere=False) == held
    assert marked() == held | {1000: ["Zorkmid"]}
    clean = {r.doc_id: r.text for r in sanitise(frame(rows)).collect()}
    assert clean[1000] == "[NAME] elsewhere" and clean[0].startswith("[NAME] common") and "orkmid" not in clean[0]


def test_a_planted_term_is_found_in_a_large_corpus(spark, frame):
    """One name in 20 of 6,000 documents, beside one address in all of them."""
    rng = random.Random(8)
    words = [f"{a}{b}" for a in ("lor", "mip", "sed", "quo", "ven", "tar") for b in ("ema", "ilo", "unt", "asi", "ore", "ibu")]
    rows = [(i, " ".join(rng.choice(words) for _ in range(30))) for i in range(6000)]
    for i in range(0, 6000, 300):
        rows[i] = (i, f"{rows[i][1]} Quillfeather at quill@example.org {rows[i + 1][1]}")
    rows.append((9000, "nobody but Quillfeather knows"))
    got = {r.doc_id: [rows[min(r.doc_id, 6000)][1][s.start:s.end] for s in r.term] for r in find_personal_data(frame(rows)).collect() if r.term}
    assert got == {i: ["Quillfeather"] for i in [*range(0, 6000, 300), 9000]}
