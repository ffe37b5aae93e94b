"""Structured Streaming: sources, per-batch sinks, word count, online k-means."""

from vigil.streaming.kmeans import StreamingKMeans
from vigil.streaming.predict import (
    read_stream_assignments,
    stream_predict,
    stream_predict_latest,
    stream_write_assignments,
)
from vigil.streaming.sources import skip_existing, stage_slice, stream_lines, stream_table
from vigil.streaming.wordcount import stream_word_count, word_counts

__all__ = [
    "StreamingKMeans",
    "read_stream_assignments",
    "skip_existing",
    "stage_slice",
    "stream_predict",
    "stream_predict_latest",
    "stream_lines",
    "stream_table",
    "stream_word_count",
    "stream_write_assignments",
    "word_counts",
]
