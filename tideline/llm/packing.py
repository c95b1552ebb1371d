"""Best-fit packing: patterns of few documents fitted to the length histogram by non-negative least squares."""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tokens import encoder, slices
from .util import released, stored, text_of

CAPACITY = 4096
#: Lengths are classed for the fit; patterns hold up to DEPTH classes that fill a sequence.
CLASSES = 64
DEPTH = 3
RANK_BUCKETS = 256


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids, little-endian uint32 bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text")):
                doc_ids = batch.column("doc_id").slice(at, len(texts)).to_pylist()
                at += len(texts)
                ids, ends = encode(texts)
                out: list[list] = [[], [], [], [], [], []]
                for i, doc_id in enumerate(doc_ids):
                    data = np.append(ids[ends[i]:ends[i + 1]], end_id).astype("<u4").tobytes()
                    for piece, s in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[s:s + 4 * capacity]
                        for column, x in zip(out, (doc_id, piece, s // 4, len(part) // 4, zlib.crc32(part), part)):
                            column.append(x)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                arrays = [pa.array(c, t) for c, t in zip(out, kinds)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                n = 6 if with_ids else 5
                yield pa.RecordBatch.from_arrays(arrays[:n], names[:n])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(released(run), schema)


def patterns(classes: int, depth: int) -> list[tuple[int, ...]]:
    """All multisets of up to ``depth`` classes whose sizes 1..classes sum to exactly ``classes``."""
    found: list[tuple[int, ...]] = []

    def extend(head: tuple[int, ...], left: int, most: int) -> None:
        if left == 0:
            found.append(head)
        elif len(head) < depth:
            for size in range(min(left, most), (left - 1) // (depth - len(head)), -1):
                extend((*head, size), left - size, size)

    extend((), classes, classes)
    return found


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Non-negative least squares by active sets: x >= 0 that minimises |a x - b|."""
    x, free = np.zeros(a.shape[1]), []
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[free] = -np.inf
        best = int(gain.argmax())
        if gain[best] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        free.append(best)
        while True:
            z = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if (z > 0).all():
                break
            now = x[free]
            low = z <= 0
            step = np.min(now[low] / np.maximum(now[low] - z[low], 1e-300))
            moved = now + step * (z - now)
            x[free] = np.where(moved > 1e-12, moved, 0.0)
            kept = [f for f in free if x[f] > 0]
            if len(kept) == len(free):
                break
            x[[f for f in free if f not in kept]] = 0.0
            free = kept
            if not free:
                break
        if free:
            x[free] = np.maximum(np.linalg.lstsq(a[:, free], b, rcond=None)[0], 0.0)
    return x


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Sequences for a histogram of lengths 1..capacity: ((length, count), ...) and how many are alike.

    Lengths are classed by width, rounded up; least squares says how often each few-document pattern is
    used, rounded down; what is left, small pieces above all, goes by best fit in decreasing length into
    the room that is left. Work and result depend on the number of lengths, not on how many pieces there are.
    """
    left = Counter({n: c for n, c in histogram.items() if c})
    width = -(-capacity // CLASSES)
    classes = -(-capacity // width)
    by_class: dict[int, list[int]] = {}
    for n in sorted(left):
        by_class.setdefault(-(-n // width), []).append(n)
    bins: list[tuple[Counter, int]] = []
    if left:
        kinds = patterns(classes, DEPTH)
        kinds = [k for k in kinds if all(c in by_class for c in k)]
        target = np.array([sum(left[n] for n in by_class.get(c, ())) for c in range(1, classes + 1)], float)
        if kinds:
            a = np.zeros((classes, len(kinds)))
            for j, k in enumerate(kinds):
                for c in k:
                    a[c - 1, j] += 1
            times = np.floor(nnls(a, target) + 1e-9).astype(np.int64)
            # the longest pieces of each class go first; the smallest class gives way to the best fit of all lengths
            lengths = sorted(left)
            for j in np.argsort(-times, kind="stable"):
                want = int(times[j])
                while want:
                    take: Counter = Counter()
                    for c in kinds[j][:-1]:
                        take[next((n for n in reversed(by_class[c]) if left[n] > take[n]), 0)] += 1
                    room = capacity - sum(n * m for n, m in take.items())
                    at = bisect_right(lengths, room) - 1
                    while at >= 0 and left[lengths[at]] <= take[lengths[at]]:
                        if not left[lengths[at]]:
                            del lengths[at]
                        at -= 1
                    if at < 0 or take[0]:
                        break
                    take[lengths[at]] += 1
                    runs = min([want, *(left[n] // m for n, m in take.items() if m)])
                    left.subtract({n: m * runs for n, m in take.items()})
                    bins.append((+take, runs))
                    want -= runs

    # best fit, decreasing: (room, number) of open sequences sorted by room
    rooms: list[tuple[int, int]] = sorted((capacity - sum(n * m for n, m in b.items()), i) for i, (b, _) in enumerate(bins))
    for n in sorted((n for n, c in left.items() if c > 0), reverse=True):
        count = left[n]
        while count:
            at = bisect_left(rooms, (n, -1))
            if at == len(rooms):
                per = capacity // n
                full, rest = divmod(count, per)
                for m, times in ((per, full), (rest, 1)):
                    if m and times:
                        bins.append((Counter({n: m}), times))
                        insort(rooms, (capacity - m * n, len(bins) - 1))
                break
            room, i = rooms.pop(at)
            content, times = bins[i]
            per = min(room // n, count)
            used = min(times, count // per)
            if used < times:
                bins.append((Counter(content), times - used))
                insort(rooms, (room, len(bins) - 1))
            content = Counter(content)
            content[n] += per
            bins[i] = (content, used)
            insort(rooms, (room - per * n, i))
            count -= per * used
    return [(tuple(sorted(b.items(), reverse=True)), times) for b, times in bins]


def slot_table(sequences: list[tuple[tuple[tuple[int, int], ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first slot, repeats per sequence, first sequence and first offset of each group of like sequences."""
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    used: Counter = Counter()
    first = 0
    for content, times in sequences:
        offset = 0
        for n, m in content:
            slots.setdefault(n, []).append((used[n], m, first, offset))
            used[n] += m * times
            offset += n * m
        first += times
    return {n: tuple(np.array(x, np.int64) for x in zip(*rows)) for n, rows in slots.items()}


def ranked_by_length(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``slot``, their number among pieces of the same length; a common length is split by hash."""
    split = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(RANK_BUCKETS)).cast("int")
    rows = pieces.withColumn("part", split)
    parts = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    return rows.withColumn("rn", F.row_number().over(inside)).join(parts, ["length", "part"]).withColumn(
        "slot", F.col("before") + F.col("rn") - 1).drop("part", "before", "rn")


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset. The plan, bounded by the capacity, is made from the histogram."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = pieces.sparkSession.sparkContext.broadcast(slot_table(plan(histogram, capacity)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("slot").to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else ():
                n = int(lengths[rows[0]])
                start, repeats, first, base = table[n]
                g = np.searchsorted(start, ranks[rows], side="right") - 1
                inside = ranks[rows] - start[g]
                sequence[rows] = first[g] + inside // repeats[g]
                offset[rows] = base[g] + inside % repeats[g] * n
            out = pa.Table.from_batches([batch]).drop_columns(["slot"])
            yield from out.append_column("sequence_id", pa.array(sequence)).append_column(
                "offset", pa.array(offset)).to_batches()

    ranked = ranked_by_length(pieces)
    fields = [f for f in ranked.schema.fields if f.name != "slot"]
    return ranked.mapInArrow(released(run), T.StructType(
        [*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every document (null text: empty) is its ids and ``end_id``; only one longer than ``capacity`` is cut,
    into full pieces and a rest. Rows that repeat are packed each; other columns are not read; an empty
    table gives an empty result. Sequences are gapless from 0 and hold at most ``capacity`` ids.
    """
    return place(stored(token_pieces(docs, vocabulary, end_id, capacity), "pieces"), capacity)


def packed_sequences(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """The sequences themselves: sequence_id, n_tokens, ids (little-endian uint32), doc_ids in order."""
    placed = place(stored(token_pieces(docs, vocabulary, end_id, capacity, with_ids=True), "pieces"), capacity)
    parts = placed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("p"), F.sum("length").alias("n_tokens"))
    return parts.select(
        "sequence_id", "n_tokens", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"))
