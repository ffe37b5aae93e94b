"""Streaming (online) k-means over Structured Streaming micro-batches.

Each micro-batch runs, in order: centres before → update (train) → centres
after → predict with the updated model (cluster × label counts and mean
distance). All outputs and the model state are written per batch to
``batch_id=N`` folders with overwrite; the state for batch N is read from
the highest stored batch below N, so a replayed batch (after a driver or
executor failure) gives the same result. The model lives in the shared
folder, not only in driver memory.

Structured Streaming runs no batch for an interval without rows. With
``interval`` (seconds) the state keeps the number of the interval it was last
updated in, and a batch first ages the weights by the intervals that lie
between, as if each had been a batch without rows. A batch's interval is written
down before it is used, so a replay takes the same one.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from vigil.operators.clustering import assign_clusters
from vigil.operators.online import OnlineState, idle_ticks, online_update, state_table
from vigil.session import spread
from vigil.streaming.sources import echo, noted, write_batch


@dataclass
class StreamingKMeans:
    initial: OnlineState
    out: str
    features: str = "features"
    label: str | None = "label"
    echo_rows: int | None = None  # print this many result rows a batch (console)
    interval: float | None = None  # seconds; age the weights by intervals without rows
    clock: Callable[[], float] = time.time
    _memo: tuple[int, OnlineState] | None = field(default=None, repr=False)

    @property
    def state_dir(self) -> str:
        return f"{self.out}/state"

    def state_before(self, batch: DataFrame, batch_id: int) -> OnlineState:
        if self._memo is not None and self._memo[0] == batch_id - 1:
            return self._memo[1]
        spark = batch.sparkSession
        try:
            stored = spark.read.parquet(self.state_dir)
        except AnalysisException as error:  # no batch has been stored yet; anything else rises
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.initial
        prev = stored.filter(F.col("batch_id") < batch_id).agg(F.max("batch_id")).first()[0]
        if prev is None:
            return self.initial
        table = stored.filter(F.col("batch_id") == prev)
        return OnlineState.from_table(table, self.initial.decay, self.initial.time_unit)

    def ticks_before(self, batch: DataFrame, batch_id: int) -> int:
        """Intervals that passed without a batch before this one."""
        spark, folder = batch.sparkSession, f"{self.out}/ticks"
        now = noted(spark, folder, batch_id, lambda: int(self.clock() // self.interval))
        last = spark.read.parquet(folder).filter(F.col("batch_id") < batch_id).agg(F.max(F.col("value").cast("long"))).first()[0]
        return 0 if last is None else max(0, int(now) - last - 1)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cols = [self.features] + ([self.label] if self.label else [])
        data = spread(batch.select(*cols)).persist()
        try:
            before = self.state_before(batch, batch_id)
            if self.interval:
                before = idle_ticks(before, self.ticks_before(batch, batch_id))
            after = online_update(data, before, self.features)
            write_batch(after.to_table(spark), self.state_dir, batch_id)
            centres = (state_table(spark, before).withColumn("phase", F.lit("before"))
                       .unionByName(state_table(spark, after).withColumn("phase", F.lit("after"))))
            write_batch(centres, f"{self.out}/centers", batch_id)
            scored = assign_clusters(data, after.model, self.features, distance_col="distance")
            # One pass over the batch: per (cluster, label) counts and distance
            # sums; the batch mean distance is derived from that small table.
            keys = ["cluster"] + ([self.label] if self.label else [])
            per = scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"),
                                            F.sum("distance").alias("dsum")).persist()
            try:
                if self.label:
                    counts = per.select("cluster", self.label, "cnt").orderBy("cluster", self.label)
                    write_batch(counts, f"{self.out}/counts", batch_id)
                    if self.echo_rows:
                        echo(counts, batch_id, self.echo_rows)
                write_batch(per.agg((F.sum("dsum") / F.sum("cnt")).alias("mean_distance")),
                            f"{self.out}/mean_distance", batch_id)
            finally:
                per.unpersist()
            self._memo = (batch_id, after)
        finally:
            data.unpersist()

    def writer(self, stream: DataFrame):
        """A stream writer (not started) running :meth:`process` per batch."""
        return stream.writeStream.foreachBatch(self.process)
