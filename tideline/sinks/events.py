"""Writing envelopes, and keeping those that failed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.envelope import TIMESTAMPS
from ..schemas import EVENT, STR_MAP
from ..sources.landed import poll_trigger

_CONTEXT = ["specversion", "id", "source", "type", "subject", "datacontenttype"]


def structured_json() -> Column:
    """JSON text of an envelope: attributes and extensions side by side, data nested."""
    context = F.create_map(*[
        x for name in _CONTEXT for x in (F.lit(name), F.col(name))],
        F.lit("time"), F.date_format("time", TIMESTAMPS))
    reserved = F.array(*[F.lit(name) for name in [*_CONTEXT, "time", "data"]])
    extensions = F.map_filter(
        F.coalesce("extensions", F.create_map().cast(STR_MAP)),
        lambda k, _: ~F.array_contains(reserved, k))
    attributes = F.to_json(F.map_filter(F.map_concat(context, extensions), lambda _, v: v.isNotNull()))
    return F.concat(
        F.regexp_replace(attributes, r"\}\z", ""), F.lit(',"data":'), F.coalesce("data", F.lit("null")), F.lit("}"))


def parse_structured(text: Column) -> Column:
    """The envelope struct of a structured JSON text."""
    members = F.from_json(text, STR_MAP)
    nested = F.try_variant_get(F.try_parse_json(text), "$.data", "variant")
    plain = F.map_filter(members, lambda k, _: ~k.isin(*_CONTEXT, "time", "data"))
    return F.struct(
        members["id"].alias("id"), members["source"].alias("source"),
        members["specversion"].alias("specversion"), members["type"].alias("type"),
        members["subject"].alias("subject"),
        F.to_timestamp(members["time"], TIMESTAMPS).alias("time"),
        members["datacontenttype"].alias("datacontenttype"),
        F.when(F.size(plain) > 0, plain).alias("extensions"),
        # a text loses its quotes as a member of the map
        F.when(F.schema_of_variant(nested) == "STRING", F.to_json(nested)).otherwise(members["data"]).alias("data"))


def write_events(events: DataFrame, path: str, fmt: str = "json", mode: str = "append") -> None:
    """Write envelopes in folders by type: structured JSON lines, or their columns as Parquet."""
    if fmt == "json":
        lines = events.select("type", structured_json().alias("value"))
        lines.write.partitionBy("type").mode(mode).text(path)
    else:
        events.select(*EVENT.names).write.partitionBy("type").mode(mode).format(fmt).save(path)


def read_events(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Envelopes written by ``write_events``."""
    if fmt == "json":
        lines = spark.read.schema("value string").text(path)
        return lines.select(parse_structured(F.col("value")).alias("event")).select("event.*")
    return spark.read.schema(EVENT).format(fmt).load(path).select(*EVENT.names)


def valid_events(events: DataFrame) -> DataFrame:
    return events.where(F.size("errors") == 0).drop("errors")


def dead_letters(events: DataFrame) -> DataFrame:
    """Events that could not be built, with their errors as one text."""
    failed = events.where(F.size("errors") > 0)
    return failed.withColumn("error", F.array_join("errors", "; ")).drop("errors")


def run_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
    interval_seconds: float | None = None,
) -> StreamingQuery:
    """Start a query that hands each micro-batch to ``write``, which must bear replays."""
    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**poll_trigger(interval_seconds)).start())


def stream_events(
    events: DataFrame, path: str, dead_path: str, checkpoint: str, fmt: str = "json",
    interval_seconds: float | None = None,
) -> StreamingQuery:
    """Write a stream of events; those with ``errors`` go to ``dead_path``.

    A micro-batch overwrites its own folder, so a replay after a failure leaves
    no duplicates; the offsets are committed only after both writes.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write_events(valid_events(batch), f"{path}/batch={batch_id}", fmt, "overwrite")
            dead_letters(batch).write.mode("overwrite").parquet(f"{dead_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return run_batches(events, write, checkpoint, interval_seconds)
