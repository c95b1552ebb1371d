"""Raw token ids on disk with a minimal perfect hash index from document keys to places.

A store is three Parquet tables below one path. ``payload`` holds chunks of raw little-endian ids, in
the order of doc_id; ``shards`` the ids per shard; ``index`` one row per hash bucket of keys: the bits
of a minimal perfect hash, a fingerprint per slot, and the places of each slot's entries. A key is found
by a few bit probes and one comparison, whatever the size of the store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tokens import encoder, slices
from .util import text_of

DOCS_PER_SHARD = 4096
MOST_SHARDS = 2048
KEYS_PER_BUCKET = 8192
CHUNK_BYTES = 1 << 20
#: Stands for a null doc_id in the index.
NO_KEY = -(1 << 63)

PAYLOAD = "shard int, chunk int, n_ids long, data binary, doc_ids array<long>, sizes array<long>"
INDEX = ("bucket long, levels array<long>, bits binary, fingerprints binary, slots binary, shard binary, chunk binary, "
         "at binary, n binary, before binary")


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 99) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """Distinct 64-bit keys to 0..n-1: keys alone in their place at a level are placed, the others go on."""

    def __init__(self, levels: list[int], bits: np.ndarray) -> None:
        self.levels, self.bits = levels, bits
        self.rank = np.concatenate(([0], np.cumsum(bits)))

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, parts, rest = [], [], keys.astype(np.uint64)
        while len(rest):
            size = max(8, 2 * len(rest))
            place = (mix(rest, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(size)
            parts.append(alone)
            rest = rest[~alone[place]]
        return cls(levels, np.concatenate(parts) if parts else np.empty(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key, -1 where no level holds one; keys not built in may get any slot."""
        keys, base = keys.astype(np.uint64), 0
        out = np.full(len(keys), -1, np.int64)
        for level, size in enumerate(self.levels):
            spot = base + (mix(keys, level) % np.uint64(size)).astype(np.int64)
            hit = (out < 0) & self.bits[spot]
            out[hit] = self.rank[spot[hit]]
            base += size
        return out


def encoded(docs: DataFrame, vocabulary: str, end_id: int, bounds: list[int], width: str) -> DataFrame:
    """(shard, doc_id, data): every document's ids and the end id, shards by doc_id, null first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, edges = encoder(vocabulary), np.array(bounds, np.int64)
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text")):
                doc_ids = batch.column("doc_id").slice(at, len(texts))
                at += len(texts)
                ids, ends = encode(texts)
                data = [np.append(ids[s:e], end_id).astype(width).tobytes() for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
                shard = np.searchsorted(edges, doc_ids.fill_null(NO_KEY).to_numpy(zero_copy_only=False), side="left")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.astype(np.int32)), doc_ids, pa.array(data, pa.binary())], ["shard", "doc_id", "data"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, "shard int, doc_id long, data binary")


def payload_chunks(width: str):
    """A mapInArrow function: documents sorted by (shard, doc_id) to chunks of about CHUNK_BYTES, whole documents each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk, held, ids, sizes = None, 0, [], [], []

        def flush() -> pa.RecordBatch:
            data = b"".join(held)
            columns = ([shard], [chunk], [sum(sizes)], [data], [list(ids)], [list(sizes)])
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], ["shard", "chunk", "n_ids", "data", "doc_ids", "sizes"])

        filled = 0
        for batch in batches:
            for s, doc_id, data in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (s != shard or filled + len(data) > CHUNK_BYTES):
                    yield flush()
                    chunk = chunk + 1 if s == shard else 0
                    held, ids, sizes, filled = [], [], [], 0
                elif s != shard:
                    chunk = 0
                shard = s
                held.append(data)
                ids.append(doc_id)
                sizes.append(len(data) // np.dtype(width).itemsize)
                filled += len(data)
        if held:
            yield flush()
    return run


def key_of(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(NO_KEY))


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def index_bucket(key: tuple, rows: pa.Table) -> pa.Table:
    """One index row from the entries (key, shard, chunk, at, n, before) of a bucket."""
    rows = rows.sort_by([("key", "ascending"), ("shard", "ascending"), ("chunk", "ascending"), ("at", "ascending")])
    keys = rows.column("key").to_numpy()
    unique, first = np.unique(keys, return_index=True)
    hash_ = PerfectHash.build(unique)
    slots = hash_.slots(unique)
    order = np.argsort(slots)
    counts = np.diff(np.append(first, len(keys)))[order]
    ends = np.cumsum(counts)
    take = np.repeat(first[order] - (ends - counts), counts) + np.arange(len(keys))
    column = lambda name: rows.column(name).to_numpy().astype("<i8")[take].tobytes()
    return pa.table({
        "bucket": pa.array([key[0].as_py()], pa.int64()), "levels": pa.array([hash_.levels], pa.list_(pa.int64())),
        "bits": [np.packbits(hash_.bits).tobytes()], "fingerprints": [prints(unique[order]).tobytes()],
        "slots": [np.concatenate(([0], ends)).astype("<i8").tobytes()],
        **{name: [column(name)] for name in ("shard", "chunk", "at", "n", "before")}})


def write_store(docs: DataFrame, path: str, vocabulary: str, end_id: int, vocabulary_size: int = 1 << 16) -> None:
    """Write the ids of all ``docs`` below ``path``; a null text is empty, rows with one doc_id are entries of one key."""
    spark = docs.sparkSession
    width = "<u2" if vocabulary_size <= 1 << 16 else "<u4"
    total = docs.count()
    shards = max(1, min(MOST_SHARDS, -(-total // DOCS_PER_SHARD)))
    cuts = [i / shards for i in range(1, shards)]
    found = docs.agg(F.percentile_approx("doc_id", cuts or [0.5], 100 * shards).alias("b")).first()["b"] or []
    bounds = sorted(set(found)) if cuts else []
    parts = encoded(docs, vocabulary, end_id, bounds, width).repartition("shard").sortWithinPartitions("shard", "doc_id", "data")
    parts.mapInArrow(payload_chunks(width), PAYLOAD).write.option("compression", "zstd").parquet(f"{path}/payload")
    payload = spark.read.schema(PAYLOAD).parquet(f"{path}/payload")

    in_shard = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = payload.select("shard", "chunk", "n_ids", F.coalesce(F.sum("n_ids").over(in_shard), F.lit(0)).alias("start"))
    per_shard = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    so_far = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard, MOST_SHARDS at most
    per_shard.select("shard", "n_ids", F.coalesce(F.sum("n_ids").over(so_far), F.lit(0)).alias("start")).coalesce(1).write.parquet(f"{path}/shards")

    entries = payload.select("shard", "chunk", F.posexplode(F.arrays_zip("doc_ids", "sizes")).alias("i", "e")).select(
        "shard", "chunk", "i", key_of(F.col("e.doc_ids")).alias("key"), F.col("e.sizes").alias("n"))
    in_chunk = Window.partitionBy("shard", "chunk").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    entries = entries.withColumn("at", F.coalesce(F.sum("n").over(in_chunk), F.lit(0))).join(
        chunks.select("shard", "chunk", "start"), ["shard", "chunk"]).select(
        "key", "shard", "chunk", "at", "n", (F.col("start") + F.col("at")).alias("before"))
    buckets = max(1, -(-total // KEYS_PER_BUCKET))
    entries.withColumn("bucket", bucket_of(F.col("key"), buckets)).groupBy("bucket").applyInArrow(index_bucket, INDEX).withColumn(
        "buckets", F.lit(buckets)).write.option("compression", "zstd").parquet(f"{path}/index")


def look_up(_key: tuple, wanted: pa.Table, index: pa.Table) -> pa.Table:
    """Places of the wanted keys of one bucket; a key whose fingerprint differs is not in the store."""
    names = ("shard", "chunk", "at", "n", "before")
    keys = wanted.column("key").to_numpy()
    empty = pa.table({"key": pa.array([], pa.int64()), **{n: pa.array([], pa.int64()) for n in names}})
    if not index.num_rows or not len(keys):
        return empty
    row = index.to_pylist()[0]
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["levels"])).astype(bool)
    slots = PerfectHash(row["levels"], bits).slots(keys)
    known = np.frombuffer(row["fingerprints"], "<u4")
    hit = (slots >= 0) & (known[np.maximum(slots, 0)] == prints(keys))
    keys, slots = keys[hit], slots[hit]
    ends = np.frombuffer(row["slots"], "<i8")
    counts = ends[slots + 1] - ends[slots]
    take = np.repeat(ends[slots] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return pa.table({"key": np.repeat(keys, counts), **{n: np.frombuffer(row[n], "<i8")[take] for n in names}})


def read_chunk(width: str):
    def run(_key: tuple, places: pa.Table, payload: pa.Table) -> pa.Table:
        size = np.dtype(width).itemsize
        data = payload.column("data")[0].as_py() if payload.num_rows else b""
        ids = [data[a * size:(a + n) * size] for a, n in zip(places.column("at").to_pylist(), places.column("n").to_pylist())]
        ids = [np.frombuffer(x, width).astype("<u4").tobytes() for x in ids]
        return pa.table({
            "key": places.column("key"), "shard": places.column("shard").cast(pa.int32()), "before": places.column("before"),
            "n": places.column("n"), "crc": pa.array([zlib.crc32(x) for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())})
    return run


def fetch(spark: SparkSession, path: str, keys: DataFrame, vocabulary_size: int = 1 << 16) -> DataFrame:
    """Entries of the store for the distinct doc_ids of ``keys``: doc_id, start, n_tokens, ids_crc32, ids.

    ``start`` counts the ids of all documents before it, ``ids`` are little-endian unsigned 32-bit numbers.
    Keys that the store lacks have no row; a doc_id that was stored twice has two.
    """
    width = "<u2" if vocabulary_size <= 1 << 16 else "<u4"
    index = spark.read.parquet(f"{path}/index")
    first = index.select("buckets").first()
    buckets = first["buckets"] if first else 1
    wanted = keys.select(key_of(F.col("doc_id")).alias("key")).distinct().withColumn("bucket", bucket_of(F.col("key"), buckets))
    places = wanted.groupBy("bucket").cogroup(index.drop("buckets").groupBy("bucket")).applyInArrow(
        look_up, "key long, shard long, chunk long, at long, n long, before long")
    payload = spark.read.schema(PAYLOAD).parquet(f"{path}/payload").select(
        F.col("shard").cast("long").alias("shard"), F.col("chunk").cast("long").alias("chunk"), "data")
    read = places.groupBy("shard", "chunk").cogroup(payload.groupBy("shard", "chunk")).applyInArrow(
        read_chunk(width), "key long, shard int, before long, n long, crc long, ids binary")
    shards = spark.read.parquet(f"{path}/shards").select("shard", F.col("start").alias("shard_start"))
    return read.join(shards, "shard").select(
        F.when(F.col("key") != NO_KEY, F.col("key")).alias("doc_id"), (F.col("shard_start") + F.col("before")).alias("start"),
        F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"), "ids")
