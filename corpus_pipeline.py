"""From raw documents to packed training batches, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. ``run`` writes each stage's result to the shared
folder and reads it again, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import opened, sealed, written
from vigil.llm.decontaminate import decontaminate
from vigil.llm.lines import STRIP, drop_repeated_lines
from vigil.llm.minhash import drop_near_duplicates
from vigil.llm.packing import pack, token_lengths
from vigil.llm.toxicity import score_toxicity, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; all where the labels do not hold
    both classes."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if not model.informed:
        return docs
    left = score_toxicity(sealed(docs, "text"), model).filter("score < 0.5").drop("score")
    return opened(left, docs.columns, "text")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more stay in the first of them only; n_chars
    follows the text. A document of which nothing is left goes."""
    plain = ["doc_id", "text"] + [c for c in docs.columns if c == "n_chars"]
    done = drop_repeated_lines(sealed(docs, *plain), min_docs=10, keep="first")
    gone = (F.col("n_dropped") > 0) & (F.btrim("text", F.lit(STRIP)) == "")
    if "n_chars" in plain:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return opened(done.filter(~gone).drop("n_lines", "n_dropped"), docs.columns, *plain)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies: five-word
    shingles, similarity 0.8."""
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), exact=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch, slot and padding of every document."""
    return pack(token_lengths(docs))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("minhash_near_dedup", minhash_near_dedup),
          ("benchmark_decontamination", benchmark_decontamination), ("packing", packing)]

#: A trained model and a dynamic programme have no SQL; the stages have brute-force tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
