"""Windowed statistics, window capture and deduplication on streams."""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.capture import log_windows
from ..operators.metrics import evaluable, match_points
from ..operators.order_stats import PERCENTILE, SPREAD, STATS, exact_percentile
from ..schemas import BOOL, DOUBLE, LONG, STR, struct
from ..sinks.events import run_batches


#: Parts of a bucket; windows no longer than one of them meet log entries in buckets of that size.
FINER = 16


class Periods(StatefulProcessor):
    """Adds the base windows of a query up to its own periods, and gives a period when the watermark passes its end.

    Values that are not a number are counted apart, as pandas takes them for missing ones.
    """

    parts = {"n": "sum", "nans": "sum", "total": "sum", "least": "min", "most": "max"}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start bigint", "n bigint, nans bigint, total double, least double, most double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)
        period, starts = key[2], []
        frame["start"] = frame["start"] // period * period
        for start in frame["start"].unique():
            if self.open.containsKey((int(start),)):
                starts.append((int(start), *self.open.getValue((int(start),))))
            else:
                self.handle.registerTimer((int(start) + period) * 1000)
        columns = ["start", *self.parts]
        held = pd.DataFrame(starts, columns=columns).astype(frame[columns].dtypes.to_dict())
        for start, n, nans, *numbers in pd.concat([held, frame[columns]]).groupby("start").agg(self.parts).itertuples():
            self.open.updateValue((int(start),), (int(n), int(nans), *(None if pd.isna(x) else float(x) for x in numbers)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        id, stat, period = key
        start = expiredTimerInfo.getExpiryTimeInMs() // 1000 - period
        n, nans, total, low, high = self.open.getValue((start,))
        self.open.removeKey((start,))
        # a value that is not a number is larger than any: only the least is not one of them, if there is another
        odd = nans > 0 and stat != "SampleCount" and (stat != "Minimum" or n == nans)
        value = {"Sum": total, "Average": (total or 0.0) / n, "Minimum": low, "Maximum": high, "SampleCount": float(n)}[stat]
        yield pd.DataFrame({"id": [id], "start": [start], "value": [0.0 if odd else value], "odd": [odd]})

    def close(self) -> None:
        pass


def stream_metric_stat(
    points: DataFrame, queries: DataFrame, period_seconds: int | None = None, delay: str = "0 seconds",
) -> DataFrame:
    """``metric_stat`` on a stream for all queries of a simple statistic, whatever their periods: ``(id, ts, value)``.

    Points are summed up in windows of the greatest period that divides all others, under one watermark; closed windows
    are added up to the periods of their queries. A period is given once the watermark has passed its end. Percentiles
    need ``stream_percentile``. With ``period_seconds`` only the queries of that period are answered.
    """
    simple = evaluable(queries).where(F.col("stat").isin(STATS))
    if period_seconds is not None:
        simple = simple.where(F.col("period") == period_seconds)
    base = gcd(*[r.period for r in simple.select("period").distinct().collect()]) or 1  # query tables are small
    matched = match_points(points, simple).withWatermark("point_ts", delay)
    number = F.when(~F.isnan("value"), F.col("value"))
    summed = matched.groupBy("id", "stat", "period", F.window("point_ts", f"{base} seconds")).agg(
        F.count("value").alias("n"), F.count_if(F.isnan("value")).alias("nans"), F.sum(number).alias("total"),
        F.min(number).alias("least"), F.max(number).alias("most"))
    rows = summed.select(
        "id", "stat", "period", F.window_time("window").alias("at"), F.unix_seconds("window.start").alias("start"),
        "n", "nans", "total", "least", "most")
    closed = rows.groupBy("id", "stat", "period").transformWithStateInPandas(
        statefulProcessor=Periods(), outputStructType=struct({"id": STR, "start": LONG, "value": DOUBLE, "odd": BOOL}),
        outputMode="Append", timeMode="EventTime")
    value = F.when(F.col("odd"), float("nan")).otherwise(F.col("value"))
    return closed.select("id", F.timestamp_seconds("start").alias("ts"), value.alias("value"))


def stream_percentile(
    points: DataFrame, queries: DataFrame, period_seconds: int, out: str, checkpoint: str,
    delay: str = "0 seconds", interval_seconds: float | None = None,
) -> StreamingQuery:
    """Percentile queries of one period on a stream, written to ``out/batch=N``.

    State is one count per value of an open period, spread by value. All counts
    of a period leave it in the same micro-batch, which then ranks them exactly.
    The watermark follows the matched points: a filter on the metric would be
    pushed below one on all points, so that alone has a settled meaning.
    """
    answered = queries.where((F.col("period") == period_seconds) & F.col("stat").rlike(PERCENTILE))
    matched = match_points(points, answered).withWatermark("point_ts", delay)
    counts = (
        matched.groupBy("id", "stat", F.window("point_ts", f"{period_seconds} seconds"), "value")
        .agg(F.count("*").alias("n")))
    fraction = F.expr("substring(stat, 2)").try_cast("double") / 100
    ready = counts.select(
        "id", F.col("window.start").alias("ts"), "value", "n", fraction.alias("fraction"),
        F.pmod(F.xxhash64("value"), F.lit(SPREAD)).alias("spread"))

    def write(batch: DataFrame, batch_id: int) -> None:
        exact_percentile(batch, ["id", "ts"]).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return run_batches(ready, write, checkpoint, interval_seconds)


def stream_log_capture(logs: DataFrame, interval_seconds: int, lateness_ms: int = 0) -> DataFrame:
    """Entries with the poll window they belong to, ``late`` when ingested after it closed.

    With a fixed interval both follow from the entry alone, so nothing is held in
    state and late entries can be sent elsewhere instead of being lost.
    """
    return log_windows(logs, interval_seconds).withColumn(
        "late", F.col("IngestionTime") > F.col("end_ms") + lateness_ms)


def _widths(bucket_seconds: int) -> tuple[int, int]:
    return bucket_seconds * 1000, max(bucket_seconds * 1000 // FINER, 1)


def _bucket(ms: Column, width: str) -> Column:
    return F.floor(ms / F.col(width)).cast("bigint")


def entry_buckets(logs: DataFrame, bucket_seconds: int) -> DataFrame:
    """Entries with their time, once in a bucket of either width."""
    entries = logs.withColumns({
        "_at": F.timestamp_millis("Timestamp"), "_width": F.explode(F.array(*map(F.lit, _widths(bucket_seconds))))})
    return entries.withColumn("_bucket", _bucket(F.col("Timestamp"), "_width"))


def window_buckets(windows: DataFrame, bucket_seconds: int) -> DataFrame:
    """Windows in every bucket they touch, of the smaller width if they are no longer than that."""
    whole, fine = _widths(bucket_seconds)
    spans = windows.where("start_ms < end_ms").select(
        F.col("log_group").alias("_group"), "start_ms", "end_ms", F.timestamp_millis("start_ms").alias("_from"),
        F.when(F.col("end_ms") - F.col("start_ms") > fine, whole).otherwise(fine).alias("_wide"))
    touched = F.sequence(_bucket(F.col("start_ms"), "_wide"), _bucket(F.col("end_ms") - 1, "_wide"))
    return spans.withColumn("_span", F.explode(touched))


def stream_log_windows(
    logs: DataFrame, windows: DataFrame, longest: str = "1 day", delay: str = "1 hour", bucket_seconds: int = 300,
    lateness_ms: int = 0,
) -> DataFrame:
    """``log_capture`` on two streams: entries, and poll windows (log_group, start_ms, end_ms) of any length up to ``longest``.

    Either side may come first, by ``delay`` at most. Both meet on (group, time bucket), so a busy group is spread, and
    both leave the state when the watermarks of the two have passed what can still meet them. Windows of up to a
    ``FINER``th of a bucket meet entries in buckets of that size: however many of them there are, an entry meets few that
    it is not inside. ``late`` is set on entries that were ingested after their window closed.
    """
    entries, spans = entry_buckets(logs, bucket_seconds), window_buckets(windows, bucket_seconds)
    met = (
        (F.col("log_group") == F.col("_group")) & (F.col("_width") == F.col("_wide")) & (F.col("_bucket") == F.col("_span"))
        & (F.col("Timestamp") < F.col("end_ms")) & (F.col("_at") >= F.col("_from"))
        & (F.col("_at") < F.col("_from") + F.expr(f"interval {longest}")))
    joined = entries.withWatermark("_at", delay).join(spans.withWatermark("_from", delay), met)
    late = F.col("IngestionTime") > F.col("end_ms") + lateness_ms
    return joined.withColumn("late", late).drop("_at", "_width", "_bucket", "_group", "_from", "_wide", "_span")


def undated(events: DataFrame, time: str = "time") -> DataFrame:
    """Dead letters of ``dedupe_redelivered``: events whose time is not known, with ``error``."""
    return events.where(F.col(time).isNull()).withColumn("error", F.lit("event without time"))


def dedupe_redelivered(
    events: DataFrame, delay: str = "12 hours", keys: tuple[str, ...] | None = None, time: str = "time"
) -> DataFrame:
    """Events without copies delivered again within ``delay``.

    Copies agree in id, source and subject (where there is one), or in ``keys``. A copy
    whose time is at most ``delay`` after that of another copy goes; on a stream, one that comes
    later still goes or stays as the watermark has it. Events without time can't leave the state again:
    they are left out here, and ``undated`` gives them as dead letters.
    """
    keys = list(keys or (k for k in ("id", "source", "subject") if k in events.columns))
    dated = events.where(F.col(time).isNotNull())
    if events.isStreaming:
        return dated.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
    # copies of one time are combined before the shuffle, so few rows of an event meet in its window
    dated = dated.dropDuplicates([*keys, time])
    before = F.lag(time).over(Window.partitionBy(*keys).orderBy(time))
    again = F.coalesce(before + F.expr(f"interval {delay}") >= F.col(time), F.lit(False))
    return dated.withColumn("_again", again).where("NOT _again").drop("_again")
