"""Personal data: pattern spans, and terms that give a protected entity away.

Emails, addresses, card and phone numbers are found by pattern. Then, over the whole
corpus, a term is measured by what it discloses of a protected entity: with n(t)
documents that hold the term, n(e) with the entity, n(t, e) with both, at whatever
distance, and N in all, P(e | t) = n(t, e) / n(t) and the pointwise mutual information
is log2(n(t, e) * N / (n(t) * n(e))). A term over both thresholds in enough different
contexts (copies of one passage are one context) is generalised or removed at every
mention in all documents or, without ``everywhere``, in the documents that hold the
entity alone. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import written
from vigil.llm.decontaminate import small
from vigil.llm.spans import MARK, matches, whole

KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
#: The patterns find the same matches as the plain ones (see each) in linear time.
PATTERNS = {
    # a run of local characters is tried once, at its start or right after a match
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}",
    # runs of digits and single separators are maximal; only those of 13 to 19 digits are marked
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"\p{L}[\p{L}\p{N}]{2,}+"
NEAR, CONTEXTS, DISCLOSED, BITS = 48, 3, 0.8, 6.0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(
            F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))).try_cast("decimal(38,0)") <= 255, F.lit(False)))
    if kind == "card":
        return F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, email, ip, card, phone, words) for each row: arrays of struct(start,
    end, value, before, after), with NEAR code points of text on either side, and the
    distinct words of the texts that hold any."""
    df = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("text_hash"), whole(F.col("text")).alias("t"))
    df = df.select("*", *[
        F.when(F.instr("t", must) > 0, matches(F.col("t"), PATTERNS[k])).otherwise(F.array().cast(
            "array<struct<start:int,end:int,value:string>>")).alias(f"{k}_")
        if must else matches(F.col("t"), PATTERNS[k]).alias(f"{k}_")
        for k, must in (("email", "@"), ("ip", "."), ("card", None), ("phone", "+"))])

    def around(s):
        left = F.greatest(s["start"] - NEAR - 1, F.lit(0))  # one more, to see where a word begins
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), left.alias("left"),
                        F.substring(F.col("t"), left + 1, s["start"] - left).alias("before"),
                        F.substring(F.col("t"), s["end"] + 1, F.lit(NEAR + 1)).alias("after"))

    def held(kind):
        return F.filter(f"{kind}_", lambda s: _holds(kind, s["value"]))

    kept = [F.transform(held(k), around).alias(k) for k in KINDS]
    none = F.array().cast("array<string>")
    return (df.select("doc_id", "text_hash", "t", *kept)
            .select("doc_id", "text_hash", *KINDS, F.when(sum(F.size(k) for k in KINDS) > 0, _words(F.col("t"))).otherwise(none).alias("words")))


def _words(t: Column) -> Column:
    """The distinct words of a text outside its emails, lower-cased."""
    plain = F.when(F.instr(t, "@") > 0, F.regexp_replace(t, PATTERNS["email"], " ")).otherwise(t)
    return F.array_distinct(F.transform(F.regexp_extract_all(plain, F.lit(TERM), F.lit(0)), lambda w: F.lower(w)))


def _entities(base: DataFrame) -> DataFrame:
    """(doc_id, text_hash, entity, place, words): one row a document and entity; place is
    the hash of all contexts the document has the entity in."""
    def of(kind):
        return F.transform(kind, lambda s: F.struct(F.concat_ws(":", F.lit(kind), F.lower(s["value"])).alias("entity"),
                                                    F.xxhash64(s["before"], s["after"]).alias("context")))

    rows = base.select("doc_id", "text_hash", "words", F.concat(*map(of, KINDS)).alias("every")).filter(F.size("every") > 0)
    rows = rows.select("doc_id", "text_hash", "words", F.explode("every").alias("x"))
    return (rows.groupBy("doc_id", "text_hash", "x.entity")
            .agg(F.xxhash64(F.array_sort(F.collect_set("x.context"))).alias("place"), F.first("words").alias("words")))


def _terms(base: DataFrame) -> DataFrame:
    """(doc_id, text_hash, entity, context, term, start, end) of the words near entities,
    none that overlaps a pattern span or is cut by the window's edge."""
    def of(kind):
        return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s.alias("s")))

    every = F.concat(*map(of, KINDS))
    taken = F.transform(every, lambda x: F.struct(x["s"]["start"].alias("a"), x["s"]["end"].alias("b")))
    near = (base.select("doc_id", "text_hash", every.alias("every"), taken.alias("taken")).filter(F.size("every") > 0)
            .select("doc_id", "text_hash", "taken", F.explode("every").alias("x"))
            .select("doc_id", "text_hash", "taken", "x.s", F.concat_ws(":", "x.kind", F.lower("x.s.value")).alias("entity"),
                    F.xxhash64("x.s.before", "x.s.after").alias("context")))

    def shifted(words, by, clean):
        return F.transform(F.filter(words, clean), lambda w: F.struct((w["start"] + by).alias("start"), (w["end"] + by).alias("end"),
                                                                       F.lower(w["value"]).alias("term")))

    before = shifted(matches(F.col("s.before"), TERM), F.col("s.left"), lambda w: (w["start"] > 0) | (F.col("s.left") == 0))
    after = shifted(matches(F.col("s.after"), TERM), F.col("s.end"),
                    lambda w: w["end"] <= NEAR)
    rows = near.select("doc_id", "text_hash", "entity", "context", "taken", F.explode(F.concat(before, after)).alias("w"))
    free = ~F.exists("taken", lambda r: (r["a"] < F.col("w.end")) & (r["b"] > F.col("w.start")))
    return rows.filter(free).select("doc_id", "text_hash", "entity", "context", "w.term", "w.start", "w.end")


def disclosing_terms(docs: DataFrame, held: DataFrame, near: DataFrame, *, contexts: int = CONTEXTS, disclosed: float = DISCLOSED,
                     bits: float = BITS) -> DataFrame:
    """(term, entity, share, bits) of the terms whose share P(entity | term) and mutual
    information reach the thresholds; all counts are of documents of the whole corpus.

    Enough contexts are so many near the entity (``near``), or so many different
    places (``held``) of documents that hold both.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).distinct()
    total = rows.count()
    n_e = held.groupBy("entity").agg(F.count("*").alias("n_e"), F.countDistinct("place").alias("places"))
    n_e = written(n_e, "entities")
    close = near.groupBy("term", "entity").agg(F.countDistinct("context").alias("contexts")).filter(F.col("contexts") >= contexts)
    close = written(close.select("term", "entity"), "close")
    # P(e | t) is 1 at most, so no term of a more frequent entity can reach the bits
    able = small(written(n_e.filter((F.col("places") >= contexts) & (F.col("n_e") * F.lit(2.0**bits) <= F.lit(total * (1 + 1e-9))))
                         .select("entity"), "able"))
    both = held.select("entity", "place", F.explode("words").alias("term"))
    wide = (both.join(able, "entity", "left_semi").groupBy("term", "entity", "place").agg(F.count("*").alias("n"))
            .groupBy("term", "entity").agg(F.sum("n").alias("n_te"), F.count("*").alias("places"))
            .filter(F.col("places") >= contexts).select("term", "entity", "n_te"))
    narrow = both.join(small(close), ["term", "entity"], "left_semi").groupBy("term", "entity").agg(F.count("*").alias("n_te"))
    pairs = written(wide.union(narrow).distinct(), "pairs")
    wanted = small(pairs.select("term").distinct())
    # counted before the join, so that a frequent term is one row a task
    n_t = (rows.select(F.explode(_words(whole(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
           .join(wanted, "term", "left_semi"))
    return (pairs.join(n_t, "term").join(n_e.select("entity", "n_e"), "entity")
            .withColumn("share", F.col("n_te") / F.col("n_t"))
            .withColumn("bits", F.log2(F.col("n_te") * F.lit(float(total)) / (F.col("n_t") * F.col("n_e"))))
            .filter((F.col("share") >= disclosed) & (F.col("bits") >= bits)).select("term", "entity", "share", "bits"))


def _mentions(t: Column, terms: Column) -> Column:
    """array<struct<start, end>> of the words of a text that are among ``terms``."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    zero = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), none.alias("out"))

    def step(acc, piece):
        end = acc["at"] + F.char_length(piece)
        here = F.struct(acc["at"].alias("start"), end.alias("end"))
        hit = acc["inside"] & F.array_contains(terms, F.lower(piece))
        return F.struct(end.alias("at"), (~acc["inside"]).alias("inside"),
                        F.when(hit, F.concat(acc["out"], F.array(here))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(F.split(F.regexp_replace(t, TERM, f"{MARK}$0{MARK}"), MARK), zero, step, lambda acc: acc["out"])


def find_personal_data(docs: DataFrame, *, everywhere: bool = True, **thresholds) -> DataFrame:
    """(doc_id, text_hash, email, ip, card, phone, term) for each row of ``docs``: arrays
    of struct(start, end) in code points, end exclusive, by start.

    The pattern kinds are as the registered query's contract has them; ``term`` holds
    every mention of a disclosing term outside the pattern spans, in the documents that
    hold its entity or, with ``everywhere`` (the default), in all. Null texts are empty. Repeated rows
    count as one document and get the same spans; rows that share an id are told apart
    by the text's hash; a null id is an id like others.
    """
    base = written(base_spans(docs), "pii")
    once = base.distinct()
    near = written(_terms(once).select("term", "entity", "context").distinct(), "terms")
    held = written(_entities(once), "held")
    flagged = written(disclosing_terms(docs, held, near, **thresholds).select("term", "entity"), "disclosing")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    if everywhere:
        hits = (rows.select("doc_id", "text_hash", F.explode(_words(whole(F.col("text")))).alias("term"))
                .join(small(flagged.select("term").distinct()), "term", "left_semi"))
    else:
        hits = (held.select("doc_id", "text_hash", "entity", F.explode("words").alias("term"))
                .join(small(flagged), ["term", "entity"], "left_semi"))
    hits = small(written(hits.groupBy("doc_id", "text_hash").agg(F.collect_set("term").alias("terms"))
                         .withColumnsRenamed({"doc_id": "d", "text_hash": "h"}), "hits"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    spans = (rows.join(hits, same).select("d", "h", "terms", whole(F.col("text")).alias("t")).distinct()
             .select("d", "h", _mentions(F.col("t"), F.col("terms")).alias("term")))
    plain = [F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(k) for k in KINDS]
    none = F.array().cast("array<struct<start:int,end:int>>")
    free = F.filter(F.coalesce("term", none), lambda w: ~F.exists("taken", lambda r: (r["start"] < w["end"]) & (r["end"] > w["start"])))
    return (base.select("doc_id", "text_hash", *plain).withColumn("taken", F.concat(*KINDS))
            .join(small(written(spans, "mentions")), same, "left")
            .select("doc_id", "text_hash", *KINDS, free.alias("term")))


def span_list(kinds) -> Column:
    """kind:start:end of the given kinds' spans, comma-joined."""
    def of(kind):
        return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    return F.array_join(F.concat(*map(of, kinds)), ",")


def sanitise(docs: DataFrame, *, everywhere: bool = True, **thresholds) -> DataFrame:
    """``docs`` with every span of ``find_personal_data`` in ``text`` replaced: pattern
    kinds by their names in brackets, disclosing terms generalised to [NAME] if
    capitalised and removed otherwise. Of overlapping spans the first counts."""
    found = find_personal_data(docs, everywhere=everywhere, **thresholds).distinct().withColumnsRenamed({"doc_id": "d", "text_hash": "h"})

    def of(kind):
        return F.transform(kind, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"), F.lit(kind).alias("k")))

    every = F.sort_array(F.concat(*map(of, (*KINDS, "term"))))
    joined = docs.join(found.select("d", "h", every.alias("spans_")), F.col("doc_id").eqNullSafe(F.col("d"))
                       & (F.xxhash64(F.col("text").cast("string")) == F.col("h")), "left")
    t = F.col("text").cast("string")

    def step(acc, s):
        value = F.substring(t, s["a"] + 1, s["b"] - s["a"])
        first = F.substring(value, 1, 1)
        put = (F.when(s["k"] != "term", F.concat(F.lit("["), F.upper(s["k"]), F.lit("]")))
               .when(first != F.lower(first), F.lit("[NAME]")).otherwise(F.lit("")))
        fresh = s["a"] >= acc["at"]
        return F.struct(F.when(fresh, s["b"]).otherwise(acc["at"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], F.substring(t, acc["at"] + 1, s["a"] - acc["at"]), put))
                        .otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    new = F.aggregate("spans_", zero, step, lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.char_length(t))))
    return joined.withColumn("text", F.when(F.size("spans_") > 0, new).otherwise(t)).drop("d", "h", "spans_")
