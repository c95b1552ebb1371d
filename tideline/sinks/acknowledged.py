"""A sink that acknowledges what it took: refused events become dead letters, a replayed micro-batch counts once.

Tasks write files below ``staged`` and report them in their commit message. The commit of a micro-batch lists these files in
``commits/<number>``, written in one step; only listed files are part of the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..schemas import STR, struct
from ..sources.landed import poll_trigger
from ..sources.shards import filesystem

#: Columns of an event as the sink takes it; time is microseconds, extensions are JSON text.
SENT = struct({"id": STR, "source": STR, "specversion": STR, "type": STR, "subject": STR, "time": STR, "datacontenttype": STR,
               "extensions": STR, "data": STR})
REQUIRED = ("id", "source", "specversion", "type")


@dataclass
class Taken(WriterCommitMessage):
    """What a task has staged: files and rows, of events and of dead letters."""

    files: list[str]
    dead_files: list[str]
    taken: int
    refused: int


def reasons(batch: pa.RecordBatch, largest: int) -> pa.Array:
    """Why each event is refused, null for those that are taken."""
    reason = pa.nulls(len(batch), pa.string())
    size = pc.fill_null(pc.binary_length(batch.column("data")), 0)
    reason = pc.if_else(pc.greater(size, largest), f"data of more than {largest} bytes", reason)
    for name in reversed(REQUIRED):
        column = batch.column(name)
        missing = pc.or_(pc.is_null(column), pc.equal(pc.fill_null(column, ""), ""))
        reason = pc.if_else(missing, f"missing {name}", reason)
    return reason


class EventWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, largest: int):
        self.path, self.largest = path, largest

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Taken:
        store, root = filesystem(self.path)
        out, name = Taken([], [], 0, 0), uuid.uuid4().hex
        writers: dict[str, pq.ParquetWriter] = {}

        def put(kind: str, table: pa.Table, files: list[str]) -> None:
            if table.num_rows:
                if kind not in writers:
                    store.create_dir(f"{root}/staged", recursive=True)
                    files.append(f"{kind}-{name}.parquet")
                    writers[kind] = pq.ParquetWriter(f"{root}/staged/{files[-1]}", table.schema, filesystem=store)
                writers[kind].write_table(table)

        for batch in iterator:
            reason = reasons(batch, self.largest)
            refused = pc.is_valid(reason)
            dead = pa.Table.from_batches([batch]).append_column("error", reason).filter(refused)
            taken = pa.Table.from_batches([batch]).filter(pc.invert(refused))
            put("events", taken, out.files)
            put("dead", dead, out.dead_files)
            out.taken, out.refused = out.taken + taken.num_rows, out.refused + dead.num_rows
        for writer in writers.values():
            writer.close()
        return out

    def commit(self, messages: list[Taken | None], batchId: int) -> None:
        store, root = filesystem(self.path)
        done = [m for m in messages if m is not None]
        entry = f"{root}/commits/{batchId:012d}"
        if store.get_file_info(entry).type != fs.FileType.NotFound:  # a replay: what it staged is not needed
            return self.abort(messages, batchId)
        store.create_dir(f"{root}/commits", recursive=True)
        with store.open_output_stream(f"{entry}.tmp") as f:
            f.write(json.dumps({
                "events": [x for m in done for x in m.files], "dead": [x for m in done for x in m.dead_files],
                "taken": sum(m.taken for m in done), "refused": sum(m.refused for m in done)}).encode())
        store.move(f"{entry}.tmp", entry)

    def abort(self, messages: list[Taken | None], batchId: int) -> None:
        store, root = filesystem(self.path)
        for name in (x for m in messages if m is not None for x in (*m.files, *m.dead_files)):
            store.delete_file(f"{root}/staged/{name}")


class AcknowledgedSink(DataSource):
    """Format ``acknowledged_events``: options ``path`` and ``largest``, the bytes that an event's data may have."""

    @classmethod
    def name(cls) -> str:
        return "acknowledged_events"

    def schema(self) -> StructType:
        return SENT

    def streamWriter(self, schema: StructType, overwrite: bool) -> EventWriter:
        return EventWriter(self.options["path"], int(self.options.get("largest", 262_144)))


def send_events(
    events: DataFrame, path: str, checkpoint: str, largest: int = 262_144, interval_seconds: float | None = None,
) -> StreamingQuery:
    """Send a stream of envelopes to the sink at ``path``; ``sent_events`` and ``refused_events`` read what became of them."""
    events.sparkSession.dataSource.register(AcknowledgedSink)
    rows = events.select(*[
        F.unix_micros("time").cast("string").alias("time") if n == "time" else
        F.to_json("extensions").alias("extensions") if n == "extensions" else F.col(n) for n in SENT.names])
    return (
        rows.writeStream.format("acknowledged_events").option("path", path).option("largest", largest)
        .option("checkpointLocation", checkpoint).trigger(**poll_trigger(interval_seconds)).start())


def commits(path: str) -> list[dict]:
    """The committed micro-batches in order; one small entry each."""
    store, root = filesystem(path)
    found = store.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True))
    out = []
    for info in sorted((i for i in found if not i.base_name.endswith(".tmp")), key=lambda i: i.base_name):
        with store.open_input_file(info.path) as f:
            out.append({"batch": int(info.base_name)} | json.loads(f.read()))
    return out


def _read(spark: SparkSession, path: str, kind: str, schema: StructType) -> DataFrame:
    files = [f"{path}/staged/{name}" for c in commits(path) for name in c[kind]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def sent_events(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes that the sink took, each once."""
    rows = _read(spark, path, "events", SENT)
    return rows.withColumns({
        "time": F.timestamp_micros(F.col("time").cast("bigint")), "extensions": F.from_json("extensions", "map<string,string>")})


def refused_events(spark: SparkSession, path: str) -> DataFrame:
    """Events that the sink refused, with ``error``."""
    return _read(spark, path, "dead", StructType([*SENT.fields, *struct({"error": STR}).fields]))
