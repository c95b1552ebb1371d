"""Exact deduplication over keyed stream state that never expires.

Digests arrive as a stream. The state, on disk in RocksDB and in the checkpoint, holds for each
digest the stable identifier (largest doc_id), the locator of that row's bytes and the number of
rows. Rows that hit a digest held by another row are then compared with that row byte by byte.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import new_dir
from .util import located, locator, rows_at, stored, text_of

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Copies that are compared with one shipped original; a larger group gets more originals.
COPIES_PER_ORIGINAL = 2000


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def digest_state(arrivals: DataFrame, checkpoint: str, files_per_batch: int) -> DataFrame:
    """Feed landed digests through the keyed state; returns (digest, kept, n) as the state holds them."""
    spark = arrivals.sparkSession.newSession()
    for key, value in {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # no megabytes set aside per partition
        # the state partitions of an executor share one bounded memory, however many there are
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
        "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "1",
        "spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB": "2",
        "spark.sql.shuffle.partitions": arrivals.sparkSession.conf.get("spark.sql.shuffle.partitions"),
    }.items():
        spark.conf.set(key, value)
    path = new_dir(arrivals.sparkSession, "arrivals")
    arrivals.write.parquet(path)
    stream = spark.readStream.schema(arrivals.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    query = (
        stream.groupBy("digest")
        .agg(F.max(F.struct("doc_id", "file", "row")).alias("kept"), F.count(F.lit(1)).alias("n"))
        .writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if query.lastProgress is None:  # nothing arrived, so there is no state to read
        return arrivals.groupBy("digest").agg(
            F.max(F.struct("doc_id", "file", "row")).alias("kept"), F.count(F.lit(1)).alias("n"))
    held = spark.read.format("statestore").load(checkpoint)  # with the session's store settings
    kept, n = held.schema["value"].dataType.names
    held = held.select("key.digest", F.col("value").getField(kept).alias("kept"), F.col("value").getField(n).alias("n"))
    path = new_dir(arrivals.sparkSession, "held")
    held.write.parquet(path)
    return arrivals.sparkSession.read.schema(held.schema).parquet(path)


def exact_dedup(
    docs: DataFrame, digest: Callable[[Column], Column] = sha256, files_per_batch: int = 1024,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, file, row.

    Rows are equal when their whole texts are (null counts as empty); the largest doc_id stays, a
    null doc_id ranks below all, and rows that repeat a doc_id are told apart by their place in the
    table (the later one stays). An empty table gives an empty result; other columns are not read.
    ``digest`` may collide: rows whose bytes differ from the kept row's are grouped by full text.
    """
    spark, docs = docs.sparkSession, located(docs)
    rows = docs.select("doc_id", text_of().alias("text"), *locator())
    arrivals = stored(
        rows.select(digest(F.col("text")).alias("digest"), F.sha2("text", 256).alias("text_sha256"),
                    "doc_id", "file", "row"), "digests")
    state = digest_state(arrivals.drop("text_sha256"), new_dir(spark, "state"), files_per_batch)
    grouped = arrivals.join(state, "digest")

    # full bytes on hits: copies meet the kept row under (digest, salt), so a large group spreads
    salts = F.ceil(F.col("n") / COPIES_PER_ORIGINAL).cast("int")
    hits = stored(
        rows.withColumn("digest", digest(F.col("text"))).join(state.where("n > 1"), "digest")
        .withColumn("original", F.struct("doc_id", "file", "row") == F.col("kept")), "hits")
    copies = hits.where("not original").withColumn("salt", F.pmod(F.xxhash64("file", "row"), salts).cast("int"))
    originals = hits.where("original").select(
        "digest", F.col("text").alias("held_text"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    differs = stored(
        copies.join(originals, ["digest", "salt"]).where("text != held_text").select("digest").distinct(), "differs")

    out = grouped.select("digest", "doc_id", "file", "row", "text_sha256", "kept", "n")
    if not differs.isEmpty():
        texts = hits.join(differs, "digest").select("digest", "text", "doc_id", "file", "row")
        by_text = texts.groupBy("digest", "text").agg(
            F.max(F.struct("doc_id", "file", "row")).alias("kept"), F.count(F.lit(1)).alias("n"))
        again = texts.join(by_text, ["digest", "text"]).select("file", "row", "kept", "n")
        out = out.join(differs, "digest", "left_anti").unionByName(
            out.join(differs, "digest", "left_semi").drop("kept", "n").join(again, ["file", "row"]))
    return out.select(
        "doc_id", F.col("kept.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.struct("doc_id", "file", "row") == F.col("kept")).alias("kept"), "text_sha256", "file", "row")


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact deduplication keeps, all columns."""
    docs = located(docs)
    return rows_at(docs, exact_dedup(docs).where("kept").select("file", "row"))
