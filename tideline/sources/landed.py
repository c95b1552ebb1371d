"""Reading and landing tables of service payloads, in batch and as streams."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..operators.envelope import TIMESTAMPS
from ..schemas import ARRIVAL, LANDED

# folders of a landed table; new shards and groups are found by listing
PARTITIONS = {
    "stream_record": ["shard_id"],
    "change_record": ["shard_id"],
    "log_event": ["log_group"],
}


#: folder of a landed table by day of arrival
DAY = "arrival_date"


def arrival(kind: str) -> Column:
    """When a row of ``kind`` arrived, as a timestamp; an error for a kind without such a column."""
    if kind not in ARRIVAL:
        raise ValueError(f'rows of kind "{kind}" have no time of arrival')
    column = F.col(ARRIVAL[kind])
    return F.timestamp_millis(column) if kind == "log_event" else column


def read_landed(
    spark: SparkSession, kind: str, path: str, streaming: bool = False,
    max_files: int | None = None, after=None, fmt: str = "parquet", start=None, end=None,
    by_day: bool = False,
) -> DataFrame:
    """The landed table of ``kind``, with its declared schema.

    ``after`` is a start position: only rows that arrived later are read (a
    timestamp, or epoch milliseconds for logs). ``start`` and ``end`` bound a window that holds its start.
    A table landed ``by_day`` is read only in the folders that can hold such rows. ``max_files`` bounds a micro-batch.
    """
    reader = (spark.readStream if streaming else spark.read).format(fmt)
    fields = [*LANDED[kind].fields, *([StructField(DAY, DateType())] if by_day else [])]
    reader = reader.schema(StructType(fields))
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(path)
    for bound, test, day_test in ((after, operator.gt, operator.ge), (start, operator.ge, operator.ge), (end, operator.lt, operator.le)):
        if bound is not None:
            arrival(kind)
            value = F.lit(bound)
            rows = rows.where(test(F.col(ARRIVAL[kind]), value))
            if by_day:
                day = F.to_date(F.timestamp_millis(value) if kind == "log_event" else value)
                rows = rows.where(day_test(F.col(DAY), day))
    return rows.drop(DAY) if by_day else rows


def land(rows: DataFrame, kind: str, path: str, fmt: str = "parquet", by_day: bool = False) -> None:
    """Append rows to the landed table of ``kind``; columns are put into its schema.

    With ``by_day`` files go to a folder per day of arrival, on which a start position or a window prunes.
    """
    fields = [
        (F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in LANDED[kind]]
    folders = PARTITIONS.get(kind, [])
    rows = rows.select(*fields)
    if by_day:
        rows, folders = rows.withColumn(DAY, F.to_date(arrival(kind))), [DAY, *folders]
    writer = rows.write.partitionBy(*folders).mode("append")
    if fmt == "json":
        writer = writer.option("timestampFormat", TIMESTAMPS)
    writer.format(fmt).save(path)


def union_shards(*shards: DataFrame) -> DataFrame:
    """Rows of all shards; a column that a shard lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shards)


def union_event_streams(*streams: DataFrame) -> DataFrame:
    """Envelopes of several kinds as one stream."""
    return reduce(DataFrame.unionByName, streams)


def poll_trigger(interval_seconds: float | None = None) -> dict:
    """Trigger options: a fixed cadence, or everything available and stop."""
    if interval_seconds is None:
        return {"availableNow": True}
    return {"processingTime": f"{interval_seconds} seconds"}
