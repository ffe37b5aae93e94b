"""Benchmark decontamination by canonical templates, with DataFrame functions only.

Words lose punctuation at their ends and become typed placeholders where they are
numbers, units after a number, or names (capitalised inside a sentence); others are
lower-cased. Windows of ``window`` template words are hashed and joined with those
of the benchmark, so a question with other numbers or names still meets its
template. A match counts if the slots agree: along one alignment each value of the
item stands for one value of the document, and the other way round. Windows whose
slots hold the item's own values count in any alignment.

Unless ``exact`` is turned off, windows of the lower-cased words themselves are matched
too, whatever they hold: they find word-for-word copies whose templates decide nothing (mostly
numbers or names) or read otherwise (capitals, the place in a sentence).

Every window of the benchmark has an anchor: two or three pieces of text next to each
other that each text with this window holds. The first pass looks up the pieces of all
documents and finds those that hold an anchor; the second hashes all windows of these and
finds those that hold a benchmark window; slots are looked at in the latter alone. The
benchmark's anchors and windows are broadcast if they are few enough, else joined by a
shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import opened, sealed, written

#: Punctuation stripped from the ends of a word.
PUNCTUATION = ".,;:!?\"'`()[]{}<>*#$%&|/\\=+~^@_-¿¡«»“”‘’„…–—"
#: Units of measure, as written after a number.
UNITS = ("mm cm m km in inch inches ft feet foot yd yard yards mi mile miles mg g kg kilogram kilograms gram grams lb lbs "
         "pound pounds oz ounce ounces ml l liter liters litre litres gallon gallons s sec second seconds min minute "
         "minutes h hr hour hours day days week weeks month months year years hz khz mhz ghz w kw kwh v volt volts a amp "
         "amps j joule joules n newton newtons pa bar °c °f celsius fahrenheit percent % dollar dollars euro euros cent "
         "cents meter meters metre metres kilometer kilometers degree degrees").split()
SPACE = " \t\n\x0b\x0c\r"
#: Rows up to this many are broadcast (bounded size); more are joined by a shuffle.
BROADCAST_ROWS = 500_000
WINDOW, LITERALS = 8, 5
NUMBER, UNIT, NAME = "n", "u", "p"


def _gap() -> str:
    """A pattern of what stands between two pieces of text: runs of space and punctuation.
    Characters above 255 are tried one by one, so a range that holds them all is tried first."""
    def chars(some):
        return "".join(f"\\x{{{ord(c):x}}}" for c in some)

    narrow = [c for c in PUNCTUATION + SPACE if c < "\u0100"]
    wide = sorted(set(PUNCTUATION) - set(narrow))
    return f"(?=[{chars(narrow)}{chars(wide[0])}-{chars(wide[-1])}])[{chars(narrow)}{chars(wide)}]+"


def _tokens(text: Column) -> Column:
    """array<struct<core, stop>>: each word without punctuation at its ends, in its own
    case, and whether it ends a sentence; words of punctuation alone are left out."""
    clean = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(SPACE))
    each = F.transform(F.split(clean, "[\\x20\\x09-\\x0D]+"), lambda w: F.struct(
        F.btrim(w, F.lit(PUNCTUATION)).alias("core"), F.substring(w, -1, 1).isin(".", "!", "?", ":").alias("stop")))
    return F.filter(each, lambda t: t["core"] != "")


def _is_number(core: Column) -> Column:
    return F.substring(core, 1, 1).between("0", "9")


def _template(tokens: Column) -> Column:
    """The template word of each token of an array column."""
    def one(token, i):
        core, before = token["core"], F.get(tokens, i - 1)
        first = F.substring(core, 1, 1)
        return (F.when(_is_number(core), F.lit(NUMBER))
                .when((first != F.lower(first)) & ~F.coalesce(before["stop"], F.lit(True)), F.lit(NAME))
                .when(F.coalesce(_is_number(before["core"]), F.lit(False)) & F.lower(core).isin(*UNITS), F.lit(UNIT))
                .otherwise(F.lower(core)))
    return F.transform(tokens, one)


def _halves(sizes) -> list[int]:
    """The window lengths needed to make those of ``sizes``, each of two of half its length."""
    out = set()
    for n in sizes:
        while n > 1 and n not in out:
            out.add(n)
            n = -(-n // 2)
    return sorted(out)


def _with_windows(df: DataFrame, words: str, sizes) -> DataFrame:
    """``df`` with an array column of window hashes, ``words_n``, for each n of ``sizes``
    (and what they are made of); ``words`` is an array of hashes. Each is a projection of
    its own, so that none is made twice."""
    df = df.withColumn(f"{words}_1", F.col(words))
    for n in _halves(sizes):
        half = -(-n // 2)
        of = F.col(f"{words}_{half}")
        held = F.greatest(F.size(of) - (n - half), F.lit(0))
        df = df.withColumn(f"{words}_{n}", F.zip_with(F.slice(of, 1, held), F.slice(of, 1 + n - half, held), lambda x, y: F.xxhash64(x, y)))
    return df


def _slots(df: DataFrame, size: int) -> DataFrame:
    """One row a window: df's columns without ``tokens``, pos, h, and the windows' slot
    values (null at literals)."""
    t = df.withColumn("template", _template(F.col("tokens")))
    t = t.withColumn("hashes", F.transform("template", lambda x: F.xxhash64(x)))
    value = F.transform("tokens", lambda x, i: F.when(F.get("template", i).isin(NUMBER, UNIT, NAME), F.lower(x["core"])))
    t = _with_windows(t.withColumn("value", value), "hashes", [size]).withColumn("w", F.explode(F.transform(
        F.col(f"hashes_{size}"), lambda h, i: F.struct(i.alias("pos"), h.alias("h"), F.slice("value", i + 1, F.lit(size)).alias("slots")))))
    return t.select(*[c for c in df.columns if c != "tokens"], "w.pos", "w.h", "w.slots")


def _plain(tokens: Column) -> Column:
    """The hashes of the lower-cased words."""
    return F.transform(tokens, lambda t: F.xxhash64(F.lower(t["core"])))


def _whole(words: str, size: int) -> Column:
    """The windows ``words_size``; those of fewer than LITERALS words are whole texts."""
    windows = F.col(f"{words}_{size}")
    return windows if size >= LITERALS else F.when(F.size(words) == size, windows).otherwise(F.array().cast("array<bigint>"))


def _placed(windows: Column) -> Column:
    return F.transform(windows, lambda h, i: F.struct(i.alias("pos"), h.alias("h")))


def _pieces(text: Column) -> Column:
    """The runs of characters other than space and punctuation, lower-cased. Words next to
    each other have all their pieces next to each other."""
    return F.split(F.btrim(F.lower(text), F.lit(PUNCTUATION + SPACE)), _gap())


def _place(first: Column, second: Column, third: Column) -> list[Column]:
    """pair and triple: hashes of two and of three pieces next to each other (null: the text ends)."""
    return [F.xxhash64(first, second).alias("pair"), F.when(third.isNotNull(), F.xxhash64(first, second, third)).alias("triple")]


def _anchor(words: list[Column]) -> Column:
    """The first three pieces of words next to each other, two if there are no more; null if
    a word is. Three come before two, then long ones, which tend to be rare."""
    text = F.concat_ws(" ", *words)
    place = _place(*[F.get(_pieces(text), F.lit(i)) for i in range(3)])
    known = reduce(Column.__and__, [w.isNotNull() for w in words])
    return F.when(known, F.struct(place[1].isNull().alias("short"), (-F.char_length(text)).alias("rank"), *place))


def _anchors(items: DataFrame, size: int, literals: int, exact: bool) -> DataFrame:
    """(pair, triple) of an anchor for each window of ``size`` words: of literal words if it
    has ``literals`` of them, else (with ``exact``) of any; triple is null in one of two pieces."""
    t = items.select("tokens", _template(F.col("tokens")).alias("template"))
    t = t.withColumn("word", F.transform("tokens", lambda x: F.lower(x["core"])))
    t = t.withColumn("literal", F.transform("word", lambda w, i: F.when(~F.get("template", i).isin(NUMBER, UNIT, NAME), w)))
    lengths = sorted({min(size, 2), min(size, 3)})
    for words in ("word", "literal"):
        for n in lengths:
            t = t.withColumn(f"{words}_{n}", F.transform(words, lambda _, i: _anchor([F.get(words, i + k) for k in range(n)])))

    def best(words, i):
        return F.array_min(F.concat(*[F.slice(f"{words}_{n}", i + 1, F.lit(size - n + 1)) for n in lengths]))

    def anchor(_, i):
        enough = F.size(F.filter(F.slice("literal", i + 1, F.lit(size)), lambda w: w.isNotNull())) >= literals
        return F.when(enough, best("literal", i)).otherwise(best("word", i) if exact else F.lit(None))

    windows = F.slice(F.transform("word", anchor), 1, F.greatest(F.size("word") - (size - 1), F.lit(0)))
    return t.select(F.explode(windows).alias("a")).filter("a is not null").select("a.pair", "a.triple")


def _holding(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc_id, text_hash) of the documents that hold any of the anchors."""
    pairs = anchors.groupBy("pair").agg(F.max(F.col("triple").isNull()).alias("enough"))
    triples = anchors.filter("triple is not null").select(F.col("triple").alias("known")).distinct()
    pieces = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _pieces(F.coalesce("text", F.lit(""))).alias("a"))
    # one row a piece, with the two after it
    after = [F.slice("a", k, F.size("a")).alias(c) for k, c in ((2, "b"), (3, "c"))]
    places = pieces.select("doc_id", "text_hash", F.explode(F.arrays_zip("a", *after)).alias("z"))
    at = (places.select("doc_id", "text_hash", *_place(F.col("z.a"), F.col("z.b"), F.col("z.c")))
          .join(small(written(pairs, "pairs")), "pair")
          .join(small(written(triples, "triples")), F.col("triple") == F.col("known"), "left"))
    return at.filter("enough or known is not null").select("doc_id", "text_hash").distinct()


def _rows_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The distinct rows of ``docs`` (doc_id and text) that ``wanted`` names by doc_id and text_hash."""
    wanted = small(written(wanted, "hits").select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t")))
    some = (docs.withColumn("text_hash", F.xxhash64("text"))
            .join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")), "left_semi").distinct())
    return written(some.select("doc_id", "text"), "suspects")


def small(df: DataFrame) -> DataFrame:
    """``df``, marked for a broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, literals: int = LITERALS, exact: bool = True) -> DataFrame:
    """(doc_id, text_hash, item_id, windows, coverage) for each document and item that
    match: at least one window of ``window`` template words, ``literals`` of them no
    placeholders, in an alignment whose slots are consistent, or with the item's own
    slot values. coverage is the share of the item's windows that match in its best
    alignment.

    Items of fewer words match as a whole if they have ``literals`` literal words;
    shorter ones never match. With ``exact`` (the default), one window of equal lower-cased words is
    a match as well, with any number of placeholders; items shorter than a window match
    as a whole, those of fewer than LITERALS words only a text that is nothing else. Null
    texts have no words. Rows are told apart by id and text hash; repeated rows match
    alike. A null id or item id is an id like others.
    """
    every = (benchmark.select(F.col("item_id"), F.col("text").cast("string").alias("text")).distinct()
             .select("item_id", _tokens(F.col("text")).alias("tokens")))
    every = every.withColumn("length", F.least(F.size("tokens"), F.lit(window))).filter(F.col("length") > 0)
    lengths = sorted(r[0] for r in every.select("length").distinct().collect())  # at most `window` values
    items = every.filter(F.col("length") >= literals)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    empty = docs.filter("false").select("doc_id", F.xxhash64("text").alias("text_hash"), F.lit(None).cast("long").alias("item_id"),
                                        F.lit(0).cast("long").alias("windows"), F.lit(0.0).alias("coverage"))
    sizes = [n for n in lengths if n >= literals]
    own = lengths if exact else []
    if not sizes and not own:
        return empty
    of_size, keys = {}, []
    for size in sizes:
        b = _slots(items.filter(F.col("length") == size).drop("length"), size)
        of_size[size] = written(b.filter(F.size(F.filter("slots", lambda s: s.isNull())) >= literals), "benchmark")
        keys.append(of_size[size].select("h"))
    if exact:
        parts = every.withColumn("plain", _plain(F.col("tokens")))
        parts = [_with_windows(parts.filter(F.col("length") == n), "plain", [n])
                 .select("item_id", F.explode(_placed(_whole("plain", n))).alias("w")) for n in own]
        passages = written(_union(parts).select("item_id", F.col("w.pos").alias("at"), "w.h"), "passages")
        keys.append(passages.select("h"))
    keys = small(written(_union(keys).distinct(), "keys"))
    # pass 1: the documents that hold an anchor, if each window has one
    if all(2 * literals > n + 1 for n in sizes):
        anchors = _union([_anchors(every.filter(F.col("length") == n), n, literals, exact) for n in (own or sizes)])
        docs = _rows_of(docs, _holding(docs, written(anchors.distinct(), "anchors")))
    # pass 2: ids of the documents that hold any of these windows
    # (each array is a column of its own: inside a lambda it would be made anew for every element)
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _tokens(F.col("text")).alias("tokens"))
    plain = _plain(F.col("tokens")) if exact else F.lit(None).cast("array<long>")
    words = words.select("doc_id", "text_hash", plain.alias("plain"), _template(F.col("tokens")).alias("template"))
    words = words.select("doc_id", "text_hash", "plain", F.transform("template", lambda t: F.xxhash64(t)).alias("hashes"))
    words = _with_windows(_with_windows(words, "hashes", sizes), "plain", own)
    windows = F.concat(*[F.col(f"hashes_{n}") for n in sizes], *[_whole("plain", n) for n in own])
    hit = words.select("doc_id", "text_hash", F.explode(windows).alias("h")).join(keys, "h", "left_semi").select("doc_id", "text_hash").distinct()
    # pass 3: slots, in those documents
    some = _rows_of(docs, hit).select("doc_id", F.xxhash64("text").alias("text_hash"), _tokens(F.col("text")).alias("tokens"))
    found = [_templates_found(some, b, size) for size, b in of_size.items()]
    if exact:
        found.append(_passages_found(some, passages, own))
    return (_union(found).groupBy("doc_id", "text_hash", "item_id")
            .agg(F.max("windows").alias("windows"), F.max("coverage").alias("coverage")))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


def _best(lines: DataFrame, b: DataFrame) -> DataFrame:
    """The best alignment of each document and item, of the item's windows ``b``."""
    of_item = b.groupBy(F.col("item_id").alias("i")).agg(F.count("*").alias("item_windows"))
    return (lines.groupBy("doc_id", "text_hash", "item_id").agg(F.max("windows").alias("windows"))
            .join(of_item, F.col("item_id").eqNullSafe(F.col("i")))
            .select("doc_id", "text_hash", "item_id", "windows", (F.col("windows") / F.col("item_windows")).alias("coverage")))


def _templates_found(some: DataFrame, b: DataFrame, size: int) -> DataFrame:
    places = small(b.select("h", "item_id", F.col("pos").alias("at"), F.col("slots").alias("item_slots")))
    match = _slots(some, size).join(places, "h").withColumn("shift", F.col("pos") - F.col("at"))
    line = ["doc_id", "text_hash", "item_id", "shift"]
    pair = F.explode_outer(F.filter(F.arrays_zip("item_slots", "slots"), lambda z: z["item_slots"].isNotNull()))
    own = F.when(F.col("item_slots").eqNullSafe(F.col("slots")), F.col("at")).alias("own")
    slots = (match.select(*line, "at", own, pair.alias("z"))
             .groupBy(*line)
             .agg(F.countDistinct("at").alias("windows"), F.countDistinct("own").alias("own"),
                  F.countDistinct("z.item_slots").alias("item_values"), F.countDistinct("z.slots").alias("doc_values"),
                  F.countDistinct("z.item_slots", "z.slots").alias("pairs"))
             .withColumn("windows", F.when(F.expr("item_values = pairs and doc_values = pairs"), F.col("windows")).otherwise(F.col("own")))
             .filter("windows > 0"))
    return _best(slots, b)


def _passages_found(some: DataFrame, passages: DataFrame, lengths: list[int]) -> DataFrame:
    words = _with_windows(some.select("doc_id", "text_hash", _plain(F.col("tokens")).alias("plain")), "plain", lengths)
    windows = F.concat(*[_placed(_whole("plain", n)) for n in lengths])
    match = words.select("doc_id", "text_hash", F.explode(windows).alias("w")).join(small(passages), F.col("w.h") == F.col("h"))
    lines = (match.groupBy("doc_id", "text_hash", "item_id", (F.col("w.pos") - F.col("at")).alias("shift"))
             .agg(F.countDistinct("at").alias("windows")))
    return _best(lines, passages)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that match no benchmark item; all columns stay."""
    clean = _marked(sealed(docs, "doc_id", "text"), benchmark, **options).filter("n_items = 0")
    return opened(clean.select("row", "doc_id", "text"), docs.columns, "doc_id", "text")


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, contaminated, n_items, coverage) for each row of ``docs``; coverage is
    that of the best item, 0 without a match."""
    return _marked(docs.select("doc_id", "text"), benchmark, **options).select(
        "doc_id", (F.col("n_items") > 0).alias("contaminated"), "n_items", "coverage")


def _marked(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` (a sealed table, or doc_id and text) with n_items and coverage."""
    found = (contamination(docs, benchmark, **options).groupBy("doc_id", "text_hash")
             .agg(F.count("*").alias("n_items"), F.max("coverage").alias("coverage"))
             .withColumnsRenamed({"doc_id": "match_id", "text_hash": "match_hash"}))
    joined = docs.join(small(written(found, "contaminated")), F.col("doc_id").eqNullSafe(F.col("match_id"))
                       & (F.xxhash64(F.col("text").cast("string")) == F.col("match_hash")), "left")
    return joined.fillna({"n_items": 0, "coverage": 0.0})
