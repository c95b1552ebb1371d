"""Live counters of a running query: totals of observed metrics, and counters per tag in a stateful aggregate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.messages import COUNTERS, GAUGES, queue_counters
from ..sources.landed import poll_trigger


def _observed() -> list[Column]:
    counts = [F.count_if(F.col("measure") == name).alias(name) for name in COUNTERS]
    last = [F.max(F.when(F.col("measure") == name, F.struct(F.unix_micros("ts").alias("at"), "value"))).alias(name) for name in GAUGES]
    return counts + last


def observe_counters(log: DataFrame, name: str = "counters") -> DataFrame:
    """``log`` of (ts, measure, value) with its counters observed as it passes; no rows are changed or held."""
    return log.observe(name, *_observed())


def add_up(totals: dict, row) -> dict:
    """``totals`` with the observed metrics of one micro-batch: counts are summed, of capacities the latest stays."""
    for name in COUNTERS:
        totals[name] = totals.get(name, 0) + (row[name] or 0)
    for name in GAUGES:
        if row[name] is not None:
            totals[name] = max(totals.get(name) or (-1, 0), (row[name]["at"], row[name]["value"]))
    return totals


class LiveCounters(StreamingQueryListener):
    """Totals per query of what ``observe_counters`` observes, gathered with every micro-batch.

    Add it with ``spark.streams.addListener``; ``counters(query)`` can be asked at any time. A micro-batch that is run again
    after a failure counts once, as its number is known.
    """

    def __init__(self, name: str = "counters"):
        self.name = name
        self.totals: dict[str, dict] = {}
        self.batches: dict[str, int] = {}
        self.updated: dict[str, datetime] = {}

    def onQueryStarted(self, event) -> None:
        self.totals.setdefault(str(event.id), {})

    def onQueryProgress(self, event) -> None:
        progress, id = event.progress, str(event.progress.id)
        row = progress.observedMetrics.get(self.name)
        if row is not None and progress.batchId > self.batches.get(id, -1):
            self.batches[id] = progress.batchId
            add_up(self.totals.setdefault(id, {}), row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def counters(self, query: StreamingQuery) -> dict[str, int | None]:
        found = self.totals.get(str(query.id), {})
        return {**{n: found.get(n, 0) for n in COUNTERS}, **{n: found[n][1] if n in found else None for n in GAUGES}}


def stream_queue_counters(
    log: DataFrame, out: str, checkpoint: str, interval_seconds: float | None = None,
) -> StreamingQuery:
    """``queue_counters`` kept up to date: after each micro-batch the tags that it touched go to ``out/batch=N``.

    State is one row per tag; ``latest_counters`` reads the newest row of each.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        queue_counters(log).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**poll_trigger(interval_seconds)).start())


def latest_counters(written: DataFrame) -> DataFrame:
    """The newest row per tag of what ``stream_queue_counters`` wrote, ``batch`` being the folder it was read from."""
    tags = ["resource_group", "namespace", "name"]
    values = [c for c in written.columns if c not in (*tags, "batch")]
    return written.groupBy(*tags).agg(F.max_by(F.struct(*values), "batch").alias("_v")).select(*tags, "_v.*")
