"""Substring deduplication by content-defined chunks.

A gear rolling hash over the last 16 bytes puts chunk ends where the content says so, hence an
insertion moves only the chunks around it. Chunks are deduplicated by digest, and runs of chunks that
other documents hold too are reported as repeated passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tokens import slices
from .util import free_names, stored, text_of

WINDOW = 16
#: One position in RATE ends a chunk, unless an end lies less than LEAST bytes before; no chunk is longer than MOST.
RATE, LEAST, MOST = 20, 12, 256
#: A passage is reported if it may reach so many words (its run with the two chunks cut at its ends),
SPAN_WORDS = 50
#: and if so many words of it are whole chunks that repeat.
SURE_WORDS = 8
#: A table of 256 random 32-bit values, one per byte.
GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)


def long_gap(h: np.ndarray, start: int, end: int) -> list[int]:
    """Cuts of a stretch without ends: where its hash is least, which in a text that repeats itself is in every period."""
    cuts, todo = [], [(start, end)]
    while todo:
        s, e = todo.pop()
        if e - s <= MOST:
            continue
        inner = h[s + LEAST:e - LEAST]
        picked = [s]
        for p in (np.flatnonzero(inner == inner.min()) + s + LEAST + 1).tolist():
            if p - picked[-1] >= MOST // 4:
                picked.append(p)
        if len(picked) == 1:  # the least lies near the start only
            picked.append(s + MOST)
        cuts += picked[1:]
        todo += zip(picked, [*picked[1:], e])
    return cuts


def rolling(data: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The hash of the last 16 bytes at every byte, from the start of its text on: zeros stand between texts."""
    places = np.arange(len(data)) + WINDOW * owner
    h = np.zeros(int(places[-1]) + 1 if len(places) else 0, np.uint32)
    h[places] = GEAR[data]
    for j in (1, 2, 4, 8):  # after these steps h covers the last 16 bytes, the j-th last shifted by j bits
        h[j:] = h[j:] + (h[:-j] << np.uint32(j))
    return h[places]


def chunk_ends(data: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Ends of the chunks of texts that lie in ``data`` one after another and end at ``limits``; each text is cut by itself."""
    sizes = np.diff(limits, prepend=0)
    owner = np.repeat(np.arange(len(limits)), sizes)
    h = rolling(data, owner)
    ends = np.flatnonzero((h >> np.uint32(16)) < 65536 // RATE) + 1
    apart = ends + WINDOW * owner[ends - 1]
    ends = ends[np.diff(apart, prepend=-LEAST) >= LEAST]
    ends = np.union1d(ends, limits[sizes > 0])
    gaps = np.diff(ends, prepend=0)
    more = [cut for e, g in zip(ends[gaps > MOST].tolist(), gaps[gaps > MOST].tolist()) for cut in long_gap(h, e - g, e)]
    ends = np.union1d(ends, np.array(more, np.int64))
    starts = np.append((data & 0xC0) != 0x80, True)  # an end inside a character moves back to its start
    return np.unique(np.maximum.accumulate(np.where(starts, np.arange(len(starts)), 0))[ends])


def chunk_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digest (64 bits, and 32 more), text number and packed span (offset, length, words here, before and after) of every chunk."""
    line = b"".join(texts)
    data = np.frombuffer(line, np.uint8)
    limits = np.cumsum([len(t) for t in texts], dtype=np.int64)
    ends = chunk_ends(data, limits) if len(data) else np.empty(0, np.int64)
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    owner = np.searchsorted(limits, starts, side="right")
    space = (data == 32) | ((data >= 9) & (data <= 13))
    begins = ~space
    begins[1:] &= space[:-1]
    begins[limits[:-1][limits[:-1] < len(data)]] = ~space[limits[:-1][limits[:-1] < len(data)]]  # a text's first word is one by itself
    begun = np.concatenate(([0], np.cumsum(begins)))
    n_words = np.minimum(begun[ends] - begun[starts], 127)
    same = owner[1:] == owner[:-1]
    before = np.concatenate(([0], n_words[:-1] * same)) if len(ends) else n_words
    after = np.append(n_words[1:] * same, 0) if len(ends) else n_words
    offset = starts - np.concatenate(([0], limits[:-1]))[owner] if len(ends) else starts
    span = offset << 32 | (ends - starts) << 21 | n_words << 14 | before << 7 | after
    digest = xxhash.xxh3_128_digest
    found = b"".join([digest(line[s:e]) for s, e in zip(starts.tolist(), ends.tolist())])
    words = np.frombuffer(found, "<i8").reshape(-1, 2)
    return words[:, 0].copy(), (words[:, 1] >> 32).astype(np.int32), owner, span.astype(np.int64)


#: A chunk's digest, and the document it is in: its doc_id, and a hash of the text, as rows may share a doc_id.
DIGEST, DOCUMENT = ["digest", "more"], ["doc", "text_hash"]


def document_chunks(docs: DataFrame) -> DataFrame:
    """(digest, more, doc, text_hash, span) per chunk; doc is the doc_id, for a null one a hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text")):
                doc, text_hash = (batch.column(c).slice(at, len(texts)).to_numpy() for c in DOCUMENT)
                at += len(texts)
                digest, more, owner, span = chunk_texts(texts.cast(pa.binary()).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (digest, more, doc[owner], text_hash[owner], span)], [*DIGEST, *DOCUMENT, "span"])

    rows = docs.select("doc_id", text_of().alias("text")).select(*document_key(), "text")
    return rows.mapInArrow(run, "digest long, more int, doc long, text_hash int, span long")


def document_key() -> list[Column]:
    return [F.coalesce("doc_id", F.xxhash64("text")).alias("doc"), F.hash("text").alias("text_hash")]


def passage_stretches(docs: DataFrame, span_words: int = SPAN_WORDS, sure_words: int = SURE_WORDS) -> DataFrame:
    """(doc, text_hash, run, start, length, words, first): the repeated passages of each document, broken where the first holder of
    their chunks changes."""
    chunks = document_chunks(docs)
    held = chunks.groupBy(*DIGEST).agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where(
        "first < last").select(*DIGEST, "first")
    field = lambda shift, bits: F.shiftright("span", shift).bitwiseAND(F.lit((1 << bits) - 1))
    hits = chunks.join(held, DIGEST).select(
        *DOCUMENT, "first", F.shiftright("span", 32).alias("start"), field(21, 11).alias("length"),
        field(14, 7).alias("words"), field(7, 7).alias("before"), F.col("span").bitwiseAND(F.lit(127)).alias("after"))
    along = Window.partitionBy(*DOCUMENT).orderBy("start", "length")
    broken = F.coalesce(F.lag(F.col("start") + F.col("length")).over(along) != F.col("start"), F.lit(True))
    changed = broken | (F.lag("first").over(along) != F.col("first"))
    runs = hits.distinct().withColumn("broken", broken.cast("int")).withColumn("changed", changed.cast("int"))
    runs = runs.withColumn("run", F.sum("broken").over(along)).withColumn("stretch", F.sum("changed").over(along))
    stretches = runs.groupBy(*DOCUMENT, "run", "stretch").agg(
        F.min("start").alias("start"), F.sum("length").alias("length"), F.sum("words").alias("words"),
        F.min("first").alias("first"),
        F.min_by("before", "start").alias("before"), F.max_by("after", "start").alias("after"))
    passage = Window.partitionBy(*DOCUMENT, "run")
    sure = F.sum("words").over(passage)
    reach = sure + F.min_by("before", "start").over(passage) + F.max_by("after", "start").over(passage)
    return stretches.withColumn("sure", sure).withColumn("reach", reach).where(
        (F.col("sure") >= sure_words) & (F.col("reach") >= span_words)).select(
        *DOCUMENT, "run", "start", "length", "words", "first")


def repeated_passages(docs: DataFrame, span_words: int = SPAN_WORDS, sure_words: int = SURE_WORDS) -> DataFrame:
    """One row per repeated passage and document: doc_id, start, length, words, first_doc_id.

    A passage is a run of chunks that other documents hold too; it has a row for each stretch of chunks with the
    same first holder, a stretch of less than ``sure_words`` goes with the one before (the first ones with the one
    after). ``start`` and ``length`` are bytes of the UTF-8 text and cover whole chunks; ``first_doc_id`` is the
    smallest document that holds the chunks of the row's longest stretch (the document itself, if it holds the copy
    that stays). Documents without repeated passages have no rows. A null or empty text has no chunks; a null doc_id
    is replaced by a hash of the text; what repeats only between rows that share a doc_id is not reported, and equal
    rows are one. Rows of one doc_id and different texts have their passages each. The result does not depend on the
    order or the partitions of ``docs``. Other columns are not read.
    """
    along = Window.partitionBy(*DOCUMENT, "run").orderBy("start")
    part = F.greatest(F.lit(1), F.sum((F.col("words") >= sure_words).cast("int")).over(along))
    return passage_stretches(docs, span_words, sure_words).withColumn("part", part).groupBy(*DOCUMENT, "run", "part").agg(
        F.min("start").alias("start"), F.sum("length").alias("length"), F.sum("words").alias("words"),
        F.max_by("first", F.struct("words", -F.col("start"))).alias("first_doc_id")).select(
        F.col("doc").alias("doc_id"), "start", "length", "words", "first_doc_id")


def without_repeats(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with repeated passages cut, each chunk of them from all documents but the first that holds it.

    A row is cut by the passages of its own text, also where several rows share a doc_id.
    """
    doc, text_hash, cuts = free_names(docs, "doc", "text_hash", "cuts")
    found = stored(passage_stretches(docs, **parameters).where("doc != first"), "passages").groupBy(
        F.col("doc").alias(doc), F.col("text_hash").alias(text_hash)).agg(
        F.array_sort(F.collect_list(F.struct("start", "length"))).alias(cuts))
    keys = [c.alias(n) for c, n in zip(document_key(), (doc, text_hash))]
    rows = docs.select("*", *keys).join(found, [doc, text_hash], "left")
    raw = F.encode("text", "UTF-8")
    start = F.struct(F.lit(b"").alias("out"), F.lit(0).cast("long").alias("at"))

    def cut(state, c):
        piece = F.substring(raw, (state["at"] + 1).cast("int"), (c["start"] - state["at"]).cast("int"))
        return F.struct(F.concat(state["out"], piece).alias("out"), (c["start"] + c["length"]).alias("at"))

    kept = F.aggregate(F.col(cuts), start, cut, lambda s: F.concat(
        s["out"], F.substring(raw, (s["at"] + 1).cast("int"), F.lit((1 << 31) - 1))))
    text = F.when(F.col(cuts).isNull(), F.col("text")).otherwise(F.decode(kept, "UTF-8"))
    return rows.withColumn("text", text).select(*[F.col(f"`{c}`") for c in docs.columns])
