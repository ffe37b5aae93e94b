"""Word count: per micro-batch (not cumulative) or a running total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.text import words
from vigil.session import spread
from vigil.streaming.sources import echo, write_batch


def word_counts(df: DataFrame, text: str = "value") -> DataFrame:
    """(word, cnt) over the space-separated words of ``text``.

    ``explode`` feeds a partial hash aggregate, so a very frequent word is
    pre-counted in every task before the shuffle.
    """
    return (df.select(F.explode(words(text)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))


def stream_word_count(stream: DataFrame, out: str, text: str = "value",
                      mode: str = "batch", echo_rows: int | None = None):
    """A stream writer (not started) for word counts.

    ``mode="batch"``: each micro-batch's own counts go to ``out/batch_id=N``.
    ``mode="complete"``: Spark keeps the running total in its state store and
    every batch rewrites ``out/batch_id=N`` with the full table.
    ``echo_rows`` also prints that many rows of each batch's result.
    """
    if mode == "batch":
        def each(batch: DataFrame, batch_id: int) -> None:
            counts = word_counts(spread(batch), text)
            write_batch(counts, out, batch_id)
            if echo_rows:
                echo(counts, batch_id, echo_rows)

        return stream.writeStream.foreachBatch(each)
    if mode == "complete":
        totals = word_counts(stream, text)

        def each_total(batch: DataFrame, batch_id: int) -> None:
            write_batch(batch, out, batch_id)
            if echo_rows:
                echo(batch, batch_id, echo_rows)

        return totals.writeStream.outputMode("complete").foreachBatch(each_total)
    raise ValueError("mode must be 'batch' or 'complete'")
