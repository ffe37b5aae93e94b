"""Streaming sources and the per-batch output convention.

Per-batch results are written to ``<out>/batch_id=N`` with overwrite, so a
micro-batch replayed after a failure rewrites the same folder (idempotent
``foreachBatch``); reading ``<out>`` back gives a ``batch_id`` column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from vigil.defaults import ECHO_ROWS, KMEANS_BATCH_INTERVAL


def stream_lines(spark: SparkSession, path: str | None = None, fmt: str = "text",
                 **options) -> DataFrame:
    """A streaming DataFrame of text lines (``value STRING``).

    ``fmt="text"`` watches a folder for new files (files already present are
    read too, unless the query resumes from a checkpoint that has seen them;
    ``skip_existing`` has it see them without reading);
    ``fmt="socket"`` passes ``host``/``port`` through to Spark's socket source.
    """
    reader = spark.readStream.format(fmt)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path) if path is not None else reader.load()


def stream_table(spark: SparkSession, folder: str, schema: T.StructType | str,
                 glob: str | None = None, max_files_per_trigger: int | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """A streaming DataFrame over the files of ``folder`` (optionally one
    table's file, selected with ``pathGlobFilter``)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder)


def stage_slice(df: DataFrame, folder: str, fmt: str = "parquet") -> None:
    """Append one slice's files to a watched folder (written in parallel)."""
    df.write.mode("append").format(fmt).save(folder)


def write_batch(df: DataFrame, out: str, batch_id: int, fmt: str = "parquet") -> None:
    """Idempotent per-batch output: overwrite ``<out>/batch_id=N``."""
    df.write.mode("overwrite").format(fmt).save(f"{out.rstrip('/')}/batch_id={int(batch_id)}")


def noted(spark: SparkSession, folder: str, batch_id: int, choose: Callable[[], object]) -> str:
    """What was chosen for this batch, as text: chosen and written down on the first
    attempt, read back on a replay."""
    try:
        row = spark.read.parquet(folder).filter(F.col("batch_id") == batch_id).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        row = None
    if row is not None:
        return row["value"]
    value = str(choose())
    write_batch(spark.createDataFrame([(value,)], "value STRING").coalesce(1), folder, batch_id)
    return value


def skip_existing(stream: DataFrame, checkpoint: str) -> None:
    """Have the query of ``checkpoint`` start with new files only: a first run records
    the files that are there as seen, without reading them. Does nothing if the query
    has run before, so that files that came since its last stop are not lost."""
    try:
        stream.sparkSession.read.text(f"{checkpoint.rstrip('/')}/offsets")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        run_available(stream.writeStream.foreachBatch(lambda batch, batch_id: None), checkpoint)


def run_available(writer, checkpoint: str) -> None:
    """Run a stream writer once over everything available, then stop."""
    query = (writer.option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def start_stream(writer, checkpoint: str, interval: str = KMEANS_BATCH_INTERVAL):
    """Start a long-running stream with a fixed micro-batch cadence
    (``trigger(processingTime=…)``); returns the StreamingQuery."""
    return (writer.option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval).start())


def echo(df: DataFrame, batch_id: int, rows: int = ECHO_ROWS) -> None:
    """Print the first ``rows`` rows of a batch result (console sink)."""
    print(f"-------- batch {batch_id} --------")
    df.show(rows, truncate=False)
