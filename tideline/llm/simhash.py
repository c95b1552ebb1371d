"""SimHash near-duplicate detection with multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hamming import components, hamming_links, node_of
from .shingles import remixed, shingle_hashes
from .util import located, locator, released, rows_at, stored, text_of

#: 64 bits in two halves: no pair of at most 4 (indeed 5) differing bits is lost.
HALVES = ((0, 0, 32), (0, 32, 32))


def fingerprint(text: bytes, size: int, words: int, distinct: bool) -> list[int]:
    """``words`` signed 64-bit words; a bit is 1 if set in over half of the shingle hashes; no words: zero."""
    h = shingle_hashes(text, size)
    if distinct:
        h = np.unique(h)
    out = []
    for j in range(words):
        votes = np.zeros(64, np.int64)
        for s in range(0, len(h), 1 << 16):
            part = remixed(h[s:s + (1 << 16)], j)
            votes += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
                axis=0, dtype=np.int64)
        out.append(int(np.packbits((votes * 2 > len(h)).astype(np.uint8), bitorder="little").view("<i8")[0]))
    return out


def fingerprints(rows: DataFrame, size: int, words: int = 1, distinct: bool = False) -> DataFrame:
    """The columns of ``rows`` but ``text``, and p0, p1, ..."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            texts = table.column("text").cast(pa.large_binary())
            prints = np.array([fingerprint(t.as_py(), size, words, distinct) for t in texts], np.int64).reshape(-1, words)
            table = table.drop_columns(["text"])
            for j in range(words):
                table = table.append_column(f"p{j}", pa.array(prints[:, j]))
            yield from table.to_batches()

    schema = rows.drop("text").schema
    for j in range(words):
        schema = schema.add(f"p{j}", "long")
    return rows.mapInArrow(released(run), schema)


def print_components(rows: DataFrame, segments, limit: int) -> DataFrame:
    """``rows`` (p0, p1, ... and others) with ``root``, equal for rows whose prints are linked by a chain."""
    words = [c for c in rows.columns if c.startswith("p")]
    roots = components(hamming_links(stored(rows.select(*words).distinct(), "prints"), segments, limit))
    return rows.withColumn("node", node_of(words)).join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")).drop("node")


def simhash_components(docs: DataFrame, size: int = 4, limit: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    64-bit prints over shingles of ``size`` words; prints link at ``limit`` or fewer differing bits (at
    most 5), and component_id is the smallest doc_id reachable. A text without words (null too) has print
    zero and links like any other; equal prints are one node, so copies and repeated rows cost nothing
    extra. A null doc_id counts for nothing in the minimum. Other columns are not read.
    """
    if limit > 5:
        raise ValueError("two halves of 64 bits find up to 5 differing bits")
    rows = stored(fingerprints(docs.select("doc_id", text_of().alias("text")), size), "simhash")
    prints = rows.groupBy("p0").agg(F.min("doc_id").alias("first"))
    rooted = stored(print_components(prints, HALVES, limit), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(rooted.join(smallest, "root").select("p0", "component_id"), "p0").select(
        "doc_id", F.lpad(F.lower(F.hex("p0")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, size: int = 4, limit: int = 4) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component of ``simhash_components`` the row with the smallest doc_id stays.

    Texts without words are one group. A null doc_id gives way to any other; rows that repeat a doc_id are told
    apart by their place in the table (the earlier one stays). An empty table gives an empty result.
    """
    docs = located(docs)
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file", "row")
    prints = fingerprints(docs.select("doc_id", text_of().alias("text"), *locator()), size).groupBy("p0").agg(F.min(rank).alias("first"))
    kept = print_components(stored(prints, "prints"), HALVES, limit).groupBy("root").agg(F.min("first").alias("first"))
    return rows_at(docs, kept.select("first.file", "first.row"))
