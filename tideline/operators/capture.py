"""Incremental capture: poll windows, change detection, watermarks, snapshot diffs.

Operators that look at the previous row of a key never order a whole key in one
task. Rows are first ordered inside (key, time chunk); only the first row and the
last value of each chunk then travel on to a per-key window. A key that holds
most of the rows is thus spread over as many tasks as it has chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.attributes import seconds_ms

CHUNK_SECONDS = 900
_FIRST_CHUNK = -(1 << 62)


def _chunk(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(ts) / seconds).cast("bigint")


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    values: Sequence[str],
    tiebreak: Sequence[str] = (),
    prior: DataFrame | None = None,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Adds ``previous``: a struct of ``values`` from the row before, per key; null on the first.

    ``prior`` holds the last known ``keys + values`` of earlier input and comes
    before every row of its key.
    """
    rows = df.withColumn("_chunk", _chunk(F.col(ts), chunk_seconds))
    # one row per chunk, combined before the shuffle; only these meet in a per-key window
    last = rows.groupBy(*keys, "_chunk").agg(F.max_by(F.struct(*values), F.struct(ts, *tiebreak)).alias("_last"))
    if prior is not None:
        last = last.unionByName(prior.select(
            *keys, F.lit(_FIRST_CHUNK).cast("bigint").alias("_chunk"), F.struct(*values).alias("_last")))
    across = Window.partitionBy(*keys).orderBy("_chunk")
    last = last.select(*keys, "_chunk", F.lag("_last").over(across).alias("_earlier"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(ts, *tiebreak)
    rows = rows.withColumns({"_n": F.row_number().over(inside), "_before": F.lag(F.struct(*values)).over(inside)})
    met = [F.col(f"_r.{k}").eqNullSafe(F.col(f"_l.{k}")) for k in (*keys, "_chunk")]
    joined = rows.alias("_r").join(last.alias("_l"), met, "left")
    previous = F.when(F.col("_n") > 1, F.col("_before")).otherwise(F.col("_earlier"))
    return joined.select("_r.*", previous.alias("previous")).drop("_chunk", "_n", "_before")


def latest_values(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str],
    prior: DataFrame | None = None,
) -> DataFrame:
    """Last ``values`` per key; what ``prior`` of the next run should be."""
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_v"))
    newest = newest.select(*keys, "_v.*")
    if prior is None:
        return newest
    kept = prior.select(*keys, *values).join(newest, list(keys), "left_anti")
    return newest.unionByName(kept)


def _window_columns(ticks: DataFrame, interval_seconds: int | Column, tick: str, previous: Column) -> DataFrame:
    seconds = F.lit(interval_seconds) if isinstance(interval_seconds, int) else interval_seconds
    back = F.timestamp_micros(F.unix_micros(tick) - seconds.cast("bigint") * 1_000_000)
    windows = ticks.withColumns({"window_start": F.coalesce(previous, back), "window_end": F.col(tick)})
    return windows.withColumns({
        "start_ms": seconds_ms(F.col("window_start")), "end_ms": seconds_ms(F.col("window_end"))})


def poll_windows(
    ticks: DataFrame, interval_seconds: int | Column, source: str = "source", tick: str = "tick",
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Adds ``window_start`` and ``window_end``: from the previous tick, or one interval back, to the tick.

    ``start_ms`` and ``end_ms`` are the same bounds cut to whole seconds, as log
    windows use them.
    """
    linked = with_previous(ticks, [source], tick, [tick], chunk_seconds=chunk_seconds)
    return _window_columns(linked, interval_seconds, tick, F.col(f"previous.{tick}")).drop("previous")


def head_changes(
    heads: DataFrame, prior: DataFrame | None = None, tiebreak: Sequence[str] = (),
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Rows of ``(repo, branch, poll_ts, commit_id)`` whose commit differs from the poll before.

    The first head of a branch only sets the baseline, unless ``prior`` has one.
    """
    linked = with_previous(
        heads, ["repo", "branch"], "poll_ts", ["commit_id"], tiebreak, prior, chunk_seconds)
    changed = F.col("previous").isNotNull() & ~F.col("commit_id").eqNullSafe(F.col("previous.commit_id"))
    return linked.where(changed).withColumn("previous_commit", F.col("previous.commit_id")).drop("previous")


def status_changes(
    prs: DataFrame, prior: DataFrame | None = None, tiebreak: Sequence[str] = (),
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Rows of ``(repo, pr_id, poll_ts, status)`` that are new or whose status changed.

    Everything seen in a repository's first poll is baseline. ``prior`` holds the
    known ``(repo, pr_id, status)``; a repository in it has had its first poll.
    """
    linked = with_previous(
        prs, ["repo", "pr_id"], "poll_ts", ["status"], tiebreak, prior, chunk_seconds)
    is_new = F.col("previous").isNull()
    candidates = linked.where(is_new | ~F.col("status").eqNullSafe(F.col("previous.status")))
    first = prs.groupBy("repo").agg(F.min("poll_ts").alias("_first"))
    if prior is not None:
        first = first.join(prior.select("repo").distinct(), "repo", "left_anti")
    baseline = is_new & F.coalesce(F.col("poll_ts") <= F.col("_first"), F.lit(False))
    return (
        candidates.join(first, "repo", "left").where(~baseline)
        .withColumn("previous_status", F.col("previous.status")).drop("previous", "_first"))


def modified_since(users: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """Rows of ``(pool, poll_ts, UserLastModifiedDate, ...)`` above all earlier polls.

    The mark of a poll is the highest date of the polls before it, strictly
    exceeded by the rows that pass. A pool without a mark emits nothing. Marks
    come from one row per poll; raw rows are never ordered. ``prior`` holds
    ``(pool, mark)``.
    """
    polls = users.groupBy("pool", "poll_ts").agg(F.max("UserLastModifiedDate").alias("_top"))
    earlier = Window.partitionBy("pool").orderBy("poll_ts").rowsBetween(Window.unboundedPreceding, -1)
    marks = polls.withColumn("mark", F.max("_top").over(earlier))
    if prior is not None:
        known = prior.select("pool", F.col("mark").alias("_known"))
        marks = marks.join(known, "pool", "left").withColumn("mark", F.greatest("mark", "_known"))
    marks = marks.where("mark IS NOT NULL").select("pool", "poll_ts", "mark")
    return users.join(marks, ["pool", "poll_ts"]).where(F.col("UserLastModifiedDate") > F.col("mark"))


def backoff_steps(
    polls: DataFrame, source: str = "source", tick: str = "tick", had_data: str = "had_data",
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Adds ``step``, polls since the last one with data or since the first, and ``previous_tick``."""
    rows = polls.withColumn("_chunk", _chunk(F.col(tick), chunk_seconds))
    inside = Window.partitionBy(source, "_chunk").orderBy(tick)
    rows = rows.withColumns({
        "_n": F.row_number().over(inside).cast("bigint"), "_before": F.lag(tick).over(inside)})
    rows = rows.withColumn("_reset", F.max(F.when(F.col(had_data), F.col("_n"))).over(inside))
    # one row per chunk: where it starts, the last poll before it, and the last one with data
    chunks = rows.groupBy(source, "_chunk").agg(
        F.max("_n").alias("_size"), F.max("_reset").alias("_at"), F.max(tick).alias("_end"))
    across = Window.partitionBy(source).orderBy("_chunk")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumns({
        "_start": F.coalesce(F.sum("_size").over(before), F.lit(0)), "_earlier": F.lag("_end").over(across)})
    chunks = chunks.withColumn("_past", F.max(F.col("_start") + F.col("_at")).over(before))
    chunks = chunks.select(source, "_chunk", "_start", "_earlier", F.coalesce("_past", F.lit(1)).alias("_past"))
    position = F.col("_start") + F.col("_n")
    last_reset = F.coalesce(F.col("_start") + F.col("_reset"), F.col("_past"))
    return (
        rows.join(chunks, [source, "_chunk"])
        .withColumns({
            "step": (position - last_reset).cast("bigint"), "previous_tick": F.coalesce("_before", "_earlier")})
        .drop("_chunk", "_n", "_before", "_reset", "_start", "_earlier", "_past"))


def backoff_delay(step: Column, shortest: float = 1.0, longest: float = 32.0) -> Column:
    """Seconds to wait after a poll: ``shortest * 2^step - shortest``, within the two bounds."""
    return F.greatest(F.lit(shortest), F.least(F.lit(longest), F.lit(shortest) * F.pow(F.lit(2.0), step) - shortest))


def backoff_schedule(
    polls: DataFrame, shortest: float = 1.0, longest: float = 32.0, source: str = "source",
    tick: str = "tick", had_data: str = "had_data", chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Adds ``step`` and ``delay_seconds`` to a poll log."""
    stepped = backoff_steps(polls, source, tick, had_data, chunk_seconds).drop("previous_tick")
    return stepped.withColumn("delay_seconds", backoff_delay(F.col("step"), shortest, longest))


def poll_delay(polls: DataFrame) -> DataFrame:
    """Adds ``burst_seconds``: poll again at once after data, in 3 s after none, in 1 s after an error."""
    delay = F.when(F.col("failed"), 1.0).when(F.col("n_rows") > 0, 0.0).otherwise(3.0)
    return polls.withColumn("burst_seconds", delay)


def poll_history(polls: DataFrame, interval_seconds: int = 300, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Windows and idle streaks of ``(source, tick, n_rows, failed)`` rows, with the delays of the schedule, in one ordering."""
    logged = polls.withColumn("had_data", (F.col("n_rows") > 0) & ~F.col("failed"))
    stepped = backoff_steps(logged, chunk_seconds=chunk_seconds)
    windows = _window_columns(stepped, interval_seconds, "tick", F.col("previous_tick")).drop("previous_tick")
    return poll_delay(windows.withColumn("delay_seconds", backoff_delay(F.col("step"))))


def diff_snapshots(
    old: DataFrame, new: DataFrame, key: str, status: str, order: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``new`` whose key is not in ``old`` or has another status there.

    Keys that repeat in ``old`` count with their last row by ``order``. Rows that
    are only in ``old`` give nothing.
    """
    last = F.max_by(status, F.struct(*order)) if order else F.max(status)
    # texts and structs are aggregated by sorting: dealt by key first, rows are sorted once, not on both sides of a shuffle
    dealt = old.select(F.col(key).alias("_key"), *dict.fromkeys([status, *order])).repartition("_key")
    known = dealt.groupBy("_key").agg(F.struct(last.alias("status")).alias("_old"))
    changed = F.col("_old").isNull() | ~F.col(status).eqNullSafe(F.col("_old.status"))
    return new.join(known, F.col(key) == F.col("_key"), "left").where(changed).drop("_key", "_old")


def merge_seen(
    seen: DataFrame, emitted: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """``seen`` plus ``emitted``, one row per key; an emitted row wins, then the last by ``order``."""
    both = seen.withColumn("_new", F.lit(0)).unionByName(emitted.withColumn("_new", F.lit(1)))
    names = [c for c in seen.columns if c not in keys]
    newest = F.max_by(F.struct(*names), F.struct("_new", *order))
    return both.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


def select_log_streams(streams: DataFrame, start_ms: int | Column, stream: str | Column = "*") -> DataFrame:
    """Streams with entries ingested after ``start_ms``, of the one configured name or of any."""
    start = F.lit(start_ms) if isinstance(start_ms, int) else start_ms
    wanted = F.lit(stream) if isinstance(stream, str) else stream
    return streams.where(
        (F.col("LastIngestionTime") > start)
        & (wanted.isin("", "*") | (F.col("log_stream") == wanted)))


def trim_to_window(logs: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Entries with ``start_ms <= Timestamp < end_ms``; the range reaches the scan."""
    return logs.where((F.col("Timestamp") >= start_ms) & (F.col("Timestamp") < end_ms))


def log_windows(logs: DataFrame, interval_seconds: int) -> DataFrame:
    """Adds the window of a fixed polling interval, computed from the timestamp: no join."""
    step = interval_seconds * 1000
    start = F.floor(F.col("Timestamp") / step).cast("bigint") * step
    return logs.withColumns({"start_ms": start, "end_ms": start + step})


def log_capture(
    logs: DataFrame, windows: DataFrame, bucket_seconds: int = 300, lateness_ms: int = 0
) -> DataFrame:
    """Entries inside a poll window of their group, with ``late`` set on those never seen.

    ``windows`` has ``(log_group, start_ms, end_ms)`` of any length, as given by
    ``poll_windows``. An entry ingested after its window closed was missed. Both
    sides meet on (group, time bucket), so the join hashes instead of comparing
    every entry with every window.
    """
    bucket_ms = bucket_seconds * 1000
    first = F.floor(F.col("start_ms") / bucket_ms).cast("bigint")
    last = F.floor((F.col("end_ms") - 1) / bucket_ms).cast("bigint")
    spans = (
        windows.where("start_ms < end_ms").select("log_group", "start_ms", "end_ms")
        .withColumn("_bucket", F.explode(F.sequence(first, last))))
    keyed = logs.withColumn("_bucket", F.floor(F.col("Timestamp") / bucket_ms).cast("bigint"))
    inside = (F.col("Timestamp") >= F.col("start_ms")) & (F.col("Timestamp") < F.col("end_ms"))
    late = F.col("IngestionTime") > F.col("end_ms") + lateness_ms
    return (
        keyed.join(spans, ["log_group", "_bucket"]).where(inside)
        .withColumn("late", late).drop("_bucket"))


def latest_stream(streams: DataFrame) -> DataFrame:
    """Latest stream per table of ``(table_arn, stream_arn, created)``; ``error`` where there is none."""
    order = F.when(F.col("stream_arn").isNotNull(), F.struct("created", "stream_arn"))
    latest = streams.groupBy("table_arn").agg(F.max_by("stream_arn", order).alias("stream_arn"))
    missing = F.concat(F.lit("no stream is associated with table "), F.col("table_arn"))
    return latest.withColumn("error", F.when(F.col("stream_arn").isNull(), missing))
