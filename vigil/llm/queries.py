"""The thin registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import ngram_lm
from vigil.llm.common import ascii_lower, fold_of
from vigil.llm.covertree import near_vectors
from vigil.llm.decontaminate import mark_contaminated
from vigil.llm.filter_audit import audit_filters
from vigil.llm.lines import drop_repeated_lines
from vigil.llm.merkle import FIELDS, dataset_manifest, fold, leaf_hash, path_hash
from vigil.llm.minhash import near_duplicates
from vigil.llm.packing import pack, token_lengths
from vigil.llm.passages import drop_repeated_passages
from vigil.llm.pii import KINDS, find_personal_data, span_list
from vigil.llm.secrets import scan
from vigil.llm.token_files import read_token_files, write_token_files
from vigil.llm.toxicity import score_toxicity, train
from vigil.session import shared_dir

QUERIES, ORACLE_SQL = {}, {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), n=2)


@_query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = drop_repeated_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return done.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL["op2_line_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT k.doc_id, count(*)::BIGINT AS n_lines, count(o.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (o.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN often o ON k.key = o.key GROUP BY k.r, k.doc_id
"""


@_query
def op4_length_bucket_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_lengths(table(spark, sf_dir, "documents")))


@_query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = shared_dir(spark, "tokens")
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder,
                                 vocabulary=str(public_tokenizers.path("word_bpe_49k.json")), vocabulary_size=49_408, end_id=2)
    return read_token_files(spark, manifest, folder)


@_query
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), exact=True)


@_query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


@_query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"), everywhere=True)
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(span_list(KINDS).cast("binary"), 256).alias("base_sha256"),
                        span_list((*KINDS, "term")).alias("spans"))


@_query
def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold_of(F.col("doc_id")) == 1
    model = ngram_lm.train(docs.filter(~F.coalesce(held_out, F.lit(False))))
    return ngram_lm.score(docs, model).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
                                              F.lit(model["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")


@_query
def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


@_query
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = drop_repeated_passages(table(spark, sf_dir, "documents"), words=35)
    return done.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL["op11_substring_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
w AS (SELECT r, unnest(range(1, len(words) - 33)) AS pos, words FROM d WHERE len(words) >= 35),
k AS (SELECT r, pos, array_to_string(words[pos:pos + 34], ' ') AS seq FROM w),
often AS (SELECT seq FROM k GROUP BY seq HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, pos + o.i AS pos FROM k JOIN often USING (seq), range(0, 35) o(i)),
t AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM d),
s AS (SELECT t.r, count(gone.pos) AS n_removed, string_agg(word, ' ' ORDER BY t.pos) FILTER (gone.pos IS NULL) AS kept
      FROM t LEFT JOIN gone ON t.r = gone.r AND t.pos = gone.pos GROUP BY t.r)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(s.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(s.kept, '')) AS kept_sha256
FROM d LEFT JOIN s ON d.r = s.r
"""


@_query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.when(fold_of(F.col("doc_id")) == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    docs = docs.withColumn("tampered", leaf_hash(*[text if c == "text" else F.col(c) for c in FIELDS]))
    found = dataset_manifest(docs, carry=["tampered"]).withColumn("folded_root", fold(F.col("path"), F.col("tampered")))
    return found.select("doc_id", "leaf", "subroot", "root", path_hash(F.col("path")).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


def _merkle_sql(levels: int = 4, upper: int = 2, fanout: int = 16) -> str:
    """The tree by levels written out: ``levels`` of them in a source, ``upper`` above."""
    def spelled(c):
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text):
        return "sha256(" + " || ".join(spelled(text if c == "text" else c) for c in FIELDS) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = ("xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT), "
           "lambda a, c: list_reduce([xor(a, c)] || range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)")
    ctes = [f"""d AS (SELECT row_number() OVER () AS r, doc_id, source AS s, {leaf('text')} AS leaf,
               CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS tampered FROM documents)""",
            """n0 AS (SELECT s, leaf AS hash, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS place,
               count(*) OVER (PARTITION BY s) AS n, r FROM d)"""]

    def climb(k, keys, name):
        part = f"{keys}, " if keys else ""
        by = f"PARTITION BY {keys}" if keys else ""
        ctes.append(f"""{name}{k + 1} AS (SELECT *, count(*) OVER ({by}) AS n FROM (SELECT {part}place // {fanout} AS place,
            CASE WHEN max(n) > 1 THEN sha256(string_agg(hash, '' ORDER BY place)) ELSE min(hash) END AS hash
            FROM {name}{k} GROUP BY ALL))""")

    def aside(k, keys, name, row, where):
        """Left and right siblings of each row on level k; null where the part has one node."""
        same = " AND ".join(["x.place <> y.place", f"x.place // {fanout} = y.place // {fanout}"] + ([f"x.{keys} IS NOT DISTINCT FROM y.{keys}"] if keys else []))
        part = f"x.{keys}, " if keys else ""
        ctes.append(f"""{where}{k} AS (SELECT {part}x.place, max(x.n) > 1 AS open,
            coalesce(string_agg(y.hash, '' ORDER BY y.place) FILTER (y.place < x.place), '') AS l,
            coalesce(string_agg(y.hash, '' ORDER BY y.place) FILTER (y.place > x.place), '') AS h
            FROM {name}{k} x LEFT JOIN {name}{k} y ON {same} GROUP BY ALL)""")

    for k in range(levels):
        climb(k, "s", "n")
        aside(k, "s", "n", "place", "a")
    ctes.append(f"m0 AS (SELECT s, hash, row_number() OVER (ORDER BY s NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM n{levels})")
    for k in range(upper):
        climb(k, "", "m")
        aside(k, "", "m", "place", "b")
    ctes.append("f0 AS (SELECT d.r, d.doc_id, d.s, d.leaf, d.tampered AS h, '' AS proof, n0.place FROM d JOIN n0 ON d.r = n0.r)")
    for k in range(levels):
        ctes.append(f"""f{k + 1} AS (SELECT r, doc_id, f.s, leaf, CASE WHEN open THEN sha256(a.l || f.h || a.h) ELSE f.h END AS h,
            proof || a.l || a.h AS proof, f.place // {fanout} AS place FROM f{k} f JOIN a{k} a ON f.s IS NOT DISTINCT FROM a.s AND f.place = a.place)""")
    ctes.append(f"g0 AS (SELECT f.* EXCLUDE (place), m0.hash AS subroot, m0.place FROM f{levels} f JOIN m0 ON f.s IS NOT DISTINCT FROM m0.s)")
    for k in range(upper):
        ctes.append(f"""g{k + 1} AS (SELECT g.* EXCLUDE (h, proof, place), CASE WHEN open THEN sha256(b.l || g.h || b.h) ELSE g.h END AS h,
            proof || b.l || b.h AS proof, g.place // {fanout} AS place FROM g{k} g JOIN b{k} b ON g.place = b.place)""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT g.doc_id, g.leaf, g.subroot, m.hash AS root, sha256(g.proof) AS proof_sha256, g.h AS folded_root, g.h = m.hash AS verified
FROM g{upper} g, m{upper} m"""


ORACLE_SQL["op12_merkle_manifest"] = _merkle_sql()


@_query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_SQL["op13_filter_audit"] = """
WITH marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS t,
             list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
m AS (SELECT part, (len(words) < 50)::INT + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT
             + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
             + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
      FROM d LEFT JOIN marks USING (doc_id)),
h AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
l(b, c) AS (VALUES (1, 'A'), (2, 'B'), (4, 'C'), (8, 'D'), (16, 'E')),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits FROM l a, l b, l c, l d, l e
      WHERE a.b + b.b + c.b + d.b + e.b = 31 AND list_unique([a.b, b.b, c.b, d.b, e.b]) = 5),
s AS (SELECT filter_order, i::INT AS step, bits[i] AS bit, coalesce(list_sum(bits[1:i - 1]), 0)::INT AS pre FROM o, range(1, 6) r(i)),
a AS (SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER (mask & (pre | bit) = 0), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (mask & pre = 0 AND mask & bit > 0), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER (mask & pre > 0 AND mask & bit > 0), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
             coalesce(sum(good) FILTER (mask & pre = 0 AND mask & bit > 0), 0)::BIGINT AS good_lost,
             coalesce(sum(toxic) FILTER (mask & pre = 0 AND mask & bit > 0), 0)::BIGINT AS toxic_lost
      FROM h, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM a
"""
