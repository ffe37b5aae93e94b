"""Batch sources and sinks: text lines, record views, assignments, models."""

from vigil.sources.records import (
    embedding_vectors,
    read_assignments,
    read_lines,
    record_lines,
    write_assignments,
)

__all__ = [
    "embedding_vectors",
    "read_assignments",
    "read_lines",
    "record_lines",
    "write_assignments",
]
