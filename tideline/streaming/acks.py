"""Buffering of acknowledgements on a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.messages import BATCH_SIZE, FLUSH_SECONDS
from ..schemas import LONG, STR, struct

OUTPUT = struct({"queue": STR, "worker": LONG, "batch": LONG, "MessageId": STR, "ReceiptHandle": STR})


class AckBuffer(StatefulProcessor):
    """Holds up to ``size`` receipts per (queue, worker) and flushes them together."""

    def __init__(self, size: int, flush_seconds: float, event_time: bool):
        self.size = size
        self.flush_ms = int(flush_seconds * 1000)
        self.event_time = event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getMapState("buffer", "MessageId string", "ReceiptHandle string")
        self.batches = handle.getValueState("batches", "n bigint")

    def _flush(self, key, held: dict[str, str]) -> list[tuple]:
        batch = self.sent
        self.sent += 1
        rows = [(key[0], key[1], batch, message, receipt) for message, receipt in sorted(held.items())]
        held.clear()
        return rows

    def _resume(self) -> dict[str, str]:
        self.sent = self.batches.get()[0] if self.batches.exists() else 0
        return {k[0]: v[0] for k, v in self.buffer.iterator()} if self.buffer.exists() else {}

    def _restart_timer(self, start_ms: int) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(start_ms + self.flush_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """The requests that fill up, one frame for all of a batch of rows; the state is written once, at the end."""
        held, start = self._resume(), None
        for frame in rows:
            frame, full = frame.sort_values("ts", kind="stable"), []
            # boxing a time costs more than all else of a row: only places are kept here
            for place, (message, receipt) in enumerate(zip(frame["MessageId"], frame["ReceiptHandle"])):
                if not held:
                    start = place
                held[message] = receipt
                if len(held) == self.size:
                    full += self._flush(key, held)
            if isinstance(start, int):
                start = frame["ts"].iloc[start]
            if full:
                yield pd.DataFrame(full, columns=OUTPUT.names)
        self.batches.update((self.sent,))
        self.buffer.clear()
        for message, receipt in held.items():
            self.buffer.updateValue((message,), (receipt,))
        if start is not None:
            event_ms = int(start.timestamp() * 1000)
            self._restart_timer(event_ms if self.event_time else timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._resume()
        if held:
            self.buffer.clear()
            rows = self._flush(key, held)
            self.batches.update((self.sent,))
            yield pd.DataFrame(rows, columns=OUTPUT.names)

    def close(self) -> None:
        pass


def stream_ack_buffer(
    acks: DataFrame, size: int = BATCH_SIZE, flush_seconds: float = FLUSH_SECONDS, workers: int = 24,
    event_time: bool = False,
) -> DataFrame:
    """Delete requests from a stream of ``(queue, ts, MessageId, ReceiptHandle)``, a row per entry.

    A request goes out when it holds ``size`` entries, or ``flush_seconds`` after its
    first one came. With ``event_time`` these seconds pass with the watermark on
    ``ts`` instead of the clock, and a query can end when its input does. State is at most ``size`` receipts per (queue, worker), and is kept
    across restarts. Rows are handled as they come; none are held beyond the buffer.
    """
    digest = F.conv(F.substring(F.md5("MessageId"), 1, 8), 16, 10).cast("bigint")
    if event_time:
        acks = acks.withWatermark("ts", "0 seconds")
    return (
        acks.withColumn("worker", digest % workers)
        .select("queue", "worker", "ts", "MessageId", "ReceiptHandle")
        .groupBy("queue", "worker")
        .transformWithStateInPandas(
            statefulProcessor=AckBuffer(size, flush_seconds, event_time), outputStructType=OUTPUT,
            outputMode="Append", timeMode="EventTime" if event_time else "ProcessingTime"))
