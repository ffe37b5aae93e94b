"""Session helpers: a local session for tests/bench, and the shared folder with its
tables and files."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def get_session(master: str | None = None, app: str = "vigil", **conf) -> SparkSession:
    """Return the active session or build a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app).master(master or "local[*]")
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    On a cluster the setting names a shared file system folder; it is only
    filled in here when unset, which happens in local tests and the bench.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="vigil-ckpt-", dir="/tmp")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder, for written tables and state."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df, name: str):
    """``df`` written once to the shared folder and read from there: what several passes
    read is then neither computed again for each of them nor held in memory."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(uri: str) -> str | None:
    """The plain path of a shared folder that is mounted on every machine."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return None if "://" in uri else uri


def shared_fs(uri: str):
    """(pyarrow file system, path) of a shared folder, for binary files."""
    from pyarrow import fs

    path = local_path(uri)
    return (fs.LocalFileSystem(), path) if path else fs.FileSystem.from_uri(uri)


def put_file(folder: str, name: str, write) -> None:
    """Write a file as a whole: a retried or doubled task never shows half of it."""
    filesystem, path = shared_fs(folder)
    filesystem.create_dir(path, recursive=True)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    with filesystem.open_output_stream(part) as out:
        write(out)
    filesystem.move(part, f"{path}/{name}")


def map_file(folder: str, name: str) -> memoryview:
    """A file of the shared folder, memory-mapped; one in a remote store is first
    copied to an unnamed local file."""
    import mmap

    path = local_path(folder)
    if path:
        with open(os.path.join(path, name), "rb") as f:
            return memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    filesystem, path = shared_fs(folder)
    with tempfile.TemporaryFile() as f:
        with filesystem.open_input_stream(f"{path}/{name}") as source:
            while piece := source.read(8 << 20):
                f.write(piece)
        f.flush()
        return memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


def spread(df, min_partitions: int | None = None, force: bool = False):
    """Round-robin repartition a *source* DataFrame that has fewer partitions
    than the cluster can run at once (e.g. a single-row-group Parquet file or
    a gzipped text file); otherwise return it unchanged.

    Apply it to scans (plus projections/filters) only: their partition count
    is file metadata, so asking for it runs nothing. On a plan with an
    exchange, adaptive execution would have to run the shuffle or broadcast
    stages just to report a count. On large inputs (many more splits than
    cores) this is a no-op, so it never adds a shuffle of big data; on small
    or unsplittable inputs the one cheap shuffle lets every core work on the
    per-row parsing and the iterative fits that follow. ``force=True``
    repartitions regardless, for a source where one unsplittable file (e.g.
    gzipped text) holds a large share of the rows among many small ones.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if not force and df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


_CACHE_LOCK = threading.Lock()
_CACHE_USERS: dict[int, int] = {}


@contextmanager
def shared_cache(df):
    """Persist ``df`` for the block. Spark keeps one cache entry for equal plans, so
    concurrent blocks over equal plans share it and the last one releases it."""
    key = df.semanticHash()
    with _CACHE_LOCK:
        if not _CACHE_USERS.get(key) and (df.storageLevel.useMemory or df.storageLevel.useDisk):
            key = None  # somebody else's to release
        else:
            _CACHE_USERS[key] = _CACHE_USERS.get(key, 0) + 1
            df.persist()
    try:
        yield df
    finally:
        with _CACHE_LOCK:
            if key is not None:
                _CACHE_USERS[key] -= 1
                if not _CACHE_USERS[key]:
                    del _CACHE_USERS[key]
                    df.unpersist()


class cached:
    """Context manager: persist a DataFrame for a multi-pass step unless it is
    already persisted, and release it afterwards only if it was persisted here.

        with cached(df) as data:
            ... several actions on data ...
    """

    def __init__(self, df):
        self.df = df
        self.owned = False

    def __enter__(self):
        level = self.df.storageLevel
        if not (level.useMemory or level.useDisk):
            self.df = self.df.persist()
            self.owned = True
        return self.df

    def __exit__(self, *exc):
        if self.owned:
            self.df.unpersist()
        return False
