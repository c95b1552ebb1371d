"""Message processors that users write as Arrow table functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .envelope import event_envelope
from .messages import register_processor

#: What a conversion returns; columns it leaves out are null.
CONVERTED = pa.schema([
    ("id", pa.string()), ("type", pa.string()), ("subject", pa.string()), ("time", pa.timestamp("us", tz="UTC")),
    ("data", pa.string()), ("error", pa.string())])
OUTPUT = "id string, type string, subject string, time timestamp, data string, error string"

Conversion = Callable[[pa.RecordBatch], "pa.Table | pa.RecordBatch"]


def completed(found: pa.Table | pa.RecordBatch) -> pa.Table:
    """``found`` with the declared columns and types."""
    missing = set(found.schema.names) - set(CONVERTED.names)
    if missing:
        raise ValueError(f"undeclared columns {sorted(missing)}")
    columns = [found.column(f.name).cast(f.type) if f.name in found.schema.names else pa.nulls(found.num_rows, f.type) for f in CONVERTED]
    return pa.table(columns, schema=CONVERTED)


def convert_batch(convert: Conversion, batch: pa.RecordBatch) -> Iterator[pa.Table]:
    """Events of a batch; if it fails, of each message by itself, those that fail as a row with ``error``."""
    try:
        yield completed(convert(batch))
    except Exception as error:  # noqa: BLE001  whatever a user's function raises concerns its messages only
        if batch.num_rows > 1:
            half = batch.num_rows // 2
            yield from convert_batch(convert, batch.slice(0, half))
            yield from convert_batch(convert, batch.slice(half))
        elif batch.num_rows:
            failed = pa.table({"id": batch.column("MessageId"), "error": [f"{type(error).__name__}: {error}"]})
            yield completed(failed)


def register_table_processor(name: str, convert: Conversion) -> None:
    """Make ``convert`` a processor under ``name``.

    ``convert`` takes Arrow batches of messages (MessageId, Body, SentTimestamp, Attributes, MessageAttributes as JSON text) and
    returns a table with any of id, type, subject, time and data, a row per event; a message may give none or several. It runs as
    a table function on the partitions of the messages, without a shuffle. Events come with ``errors`` like those of other
    processors: a message that ``convert`` fails on is one event with its error, so ``dead_letters`` finds it.
    """
    class Handler:
        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            yield from convert_batch(convert, batch)

    function = F.arrow_udtf(Handler, returnType=OUTPUT)

    def process(messages: DataFrame, source: str | Column) -> DataFrame:
        if isinstance(source, Column):
            raise TypeError("a table processor needs one source for all messages")
        sent = F.col("SentTimestamp") if "SentTimestamp" in messages.columns else F.lit(None).cast("timestamp")
        text = lambda c: (F.to_json(c) if c in messages.columns else F.lit(None).cast("string")).alias(c)
        rows = messages.select("MessageId", "Body", sent.alias("SentTimestamp"), text("Attributes"), text("MessageAttributes"))
        found = function(rows.asTable())
        errors = F.array_compact(F.array("error", F.when(F.col("error").isNull() & F.col("type").isNull(), "missing type")))
        events = event_envelope(
            found.withColumn("_errors", errors), F.col("type"), F.lit(source), F.col("data"), id=F.col("id"), subject=F.col("subject"),
            time=F.col("time"), keep=["_errors"])
        return events.withColumnRenamed("_errors", "errors")

    register_processor(name, process)
