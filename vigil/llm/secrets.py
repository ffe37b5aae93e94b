"""Secret scans: candidate tokens, and a random forest that removes false positives.

Candidates are private keys with their bodies; whatever is assigned to a keyword, whole,
up to a quote, a separator or white space; and maximal runs of twelve or more token
characters that hold a digit or are sixteen capitals and digits. The forest looks at
length, character transitions, mix and entropy, how much of the letters the corpus's own
dictionary covers, path marks, and the words and signs next to the candidate. It is
trained on labelled findings. Where none are given, findings whose format or place
settles the matter are the labels; the forest then mostly repeats that rule and decides
the findings it leaves open. DataFrame functions and the ML library only; values leave as
hashes.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import written
from vigil.llm.spans import matches, whole

TOKEN = "[A-Za-z0-9_+/-]"
CANDIDATE = rf"(?<!{TOKEN})(?=[A-Za-z_+/-]*+[0-9]|[A-Z0-9]{{16}}){TOKEN}{{12,}}+={{0,2}}"
PRIVATE_KEY = "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
#: The key with what follows up to its end mark, if it has one.
KEY_BODY = f"{PRIVATE_KEY}(?:[^-]*+-----END [A-Z ]{{0,20}}PRIVATE KEY-----)?"
#: Published key formats.
FORMATS = {"aws": "^(AKIA|ASIA)[0-9A-Z]{16}$", "github": "^gh[pousr]_[A-Za-z0-9]{36,}$", "slack": "^xox[abprs]-[A-Za-z0-9-]{10,}$",
           "stripe": "^(sk|rk)_live_[A-Za-z0-9]{16,}$", "google": "^AIza[A-Za-z0-9_-]{35}$", "private_key": "^-----BEGIN"}
#: Words beside a secret, and beside a stand-in for one.
_WORDS = "password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key"
KEYWORDS = f"(?i)({_WORDS})[\"']?\\s*[:=]?=?>?\\s*[\"']?$"
#: A value behind a keyword and a sign, of any characters but quotes, separators and white space.
ASSIGNED = (rf"(?<=[\"'=:>\x20\t])(?<=(?i:{_WORDS})[\"']?[\x20\t]{{0,4}}(?:=>|:=|[=:])[\x20\t]{{0,4}}[\"']?)"
            r"[^\s\"'`,;<>(){}\[\]=:][^\s\"'`,;<>(){}\[\]]{3,}+")
STAND_IN = "(?i)(example|sample|dummy|placeholder|changeme|your[_-]|xxxx|test[_-]?key|fake)"
NEAR = 32
#: Labelled findings of each class the forest is fitted on at most (by a hash).
SAMPLE_ROWS = 10_000
#: A word of the corpus's dictionary is in at least so many documents.
DICTIONARY_DOCS = 20
FEATURES = ("length", "transitions", "digits", "capitals", "hex", "distinct", "entropy", "dictionary", "slashes", "path",
            "keyword", "assigned", "quoted", "stand_in", "format")


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, value, before, after): one row a candidate."""
    df = docs.select("doc_id", whole(F.col("text")).alias("t"))
    df = df.select("doc_id", "t", matches(F.col("t"), f"{KEY_BODY}|{ASSIGNED}|{CANDIDATE}").alias("m")).filter(F.size("m") > 0)

    def around(s):
        left = F.greatest(s["start"] - NEAR, F.lit(0))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
                        F.substring(F.col("t"), left + 1, s["start"] - left).alias("before"),
                        F.substring(F.col("t"), s["end"] + 1, F.lit(NEAR)).alias("after"))

    return df.select("doc_id", F.explode(F.transform("m", around)).alias("s")).select("doc_id", "s.*")


def dictionary(docs: DataFrame) -> DataFrame:
    """(word): the words of three letters and more that DICTIONARY_DOCS documents hold."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit("(?<![a-z0-9])[a-z]{3,}+(?![a-z0-9])"), F.lit(0))
    return (docs.select(F.explode(F.array_distinct(words)).alias("word")).groupBy("word").count()
            .filter(F.col("count") >= DICTIONARY_DOCS).select("word"))


def _share(value: Column, chars: str) -> Column:
    return F.regexp_count(value, F.lit(chars)) / F.length(value)


def featurise(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the forest's inputs as columns of doubles."""
    v = F.col("value")
    chars = F.filter(F.split(v, ""), lambda c: c != "")
    size = F.length(v).cast("double")

    def bits(c):
        p = (F.length(v) - F.length(F.replace(v, c, F.lit("")))) / size
        return -p * F.log2(p)

    f = (found.withColumn("chars", F.array_distinct(chars))
         .withColumn("length", size)
         .withColumn("transitions", F.regexp_count(v, F.lit("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]")) / size)
         .withColumn("digits", _share(v, "[0-9]")).withColumn("capitals", _share(v, "[A-Z]")).withColumn("hex", _share(v, "[0-9a-f]"))
         .withColumn("distinct", F.size("chars") / size)
         .withColumn("entropy", F.aggregate(F.transform("chars", bits), F.lit(0.0), lambda a, b: a + b))
         .withColumn("slashes", F.regexp_count(v, F.lit("[/_-]")).cast("double"))
         .withColumn("path", F.col("before").rlike("(https?:|www\\.|[/\\\\.])\\S*$").cast("double"))
         .withColumn("keyword", F.col("before").rlike(KEYWORDS).cast("double"))
         .withColumn("assigned", F.col("before").rlike("[=:]\\s*[\"']?$").cast("double"))
         .withColumn("quoted", (F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).cast("double"))
         .withColumn("stand_in", F.concat("before", v, "after").rlike(STAND_IN).cast("double"))
         .withColumn("format", v.rlike("|".join(FORMATS.values())).cast("double")).drop("chars"))
    # letters of the candidate that are whole dictionary words
    pieces = (f.select(F.col("value").alias("v")).distinct()
              .select("v", F.explode(F.regexp_extract_all(F.lower("v"), F.lit("[a-z]{3,}+"), F.lit(0))).alias("word")))
    covered = pieces.join(words, "word").groupBy("v").agg(F.sum(F.length("word")).alias("covered"))
    return (f.join(covered, F.col("value") == F.col("v"), "left")
            .withColumn("dictionary", F.coalesce(F.col("covered"), F.lit(0)) / size).drop("v", "covered"))


def settled(f: DataFrame) -> DataFrame:
    """``f`` with the column label: 1 for a published format or a mixed value assigned to
    a keyword, 0 for numbers, words, paths, bare digests and stand-ins, else null."""
    good = (F.col("stand_in") == 0) & ((F.col("format") == 1) | ((F.col("keyword") == 1) & (F.col("assigned") == 1) & (F.col("digits") > 0) & (F.col("digits") < 1)))
    bad = ((F.col("stand_in") == 1) | (F.col("digits") == 1) | (F.col("dictionary") > 0.5)
           | ((F.col("keyword") == 0) & (F.col("format") == 0) & ((F.col("slashes") > 1) | (F.col("hex") == 1) | (F.col("entropy") < 2.5))))
    return f.withColumn("label", F.when(good, 1.0).when(bad, 0.0))


def scan(docs: DataFrame, findings: DataFrame | None = None, *, seed: int = 11) -> DataFrame:
    """(doc_id, start, end, kind, score, is_secret, value_sha256) for each candidate.

    ``findings`` (value_sha256, label) are labelled findings; without them ``settled``
    labels those that can be. Null and empty texts have no candidates. Repeated rows
    give repeated findings; a null id is carried on. If the labels hold one class or
    none, the score is that class, or 0.5.
    """
    found = featurise(candidates(docs), dictionary(docs)).withColumn("value_sha256", F.sha2("value", 256))
    if findings is None:
        found = settled(found)
    else:
        found = found.join(findings.select("value_sha256", F.col("label").cast("double").alias("label"))
                           .groupBy("value_sha256").agg(F.max("label").alias("label")), "value_sha256", "left")
    kind = F.coalesce(*[F.when(F.col("value").rlike(p), F.lit(k)) for k, p in FORMATS.items()],
                      F.when(F.col("keyword") == 1, F.lit("assigned")), F.lit("token"))
    found = written(found.withColumn("kind", kind).select("doc_id", "start", "end", "kind", "value_sha256", "label", *FEATURES), "findings")
    known = found.filter("label is not null")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    if len(counts) < 2:
        score = F.lit(next(iter(counts), 0.5))
        scored = found.withColumn("score", score)
    else:
        keep = F.lit(False)
        for label, n in counts.items():
            part = int(min(1.0, SAMPLE_ROWS / n) * (1 << 20))
            keep = keep | ((F.col("label") == label) & (F.pmod(F.xxhash64("value_sha256", "doc_id", "start"), F.lit(1 << 20)) < part))
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        forest = RandomForestClassifier(numTrees=32, maxDepth=8, seed=seed, featuresCol="features", labelCol="label")
        model = forest.fit(vectors.transform(known.filter(keep)).select("features", "label"))
        scored = model.transform(vectors.transform(found)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "start", "end", "kind", "score", (F.col("score") >= 0.5).alias("is_secret"), "value_sha256")
