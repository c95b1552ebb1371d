"""Per-document token frequencies, packed by shard, and their join to values per token.

A map task turns a run of texts (a batch) into one row per shard of the token space: its tokens, and
for each token the documents of the batch that hold it and how often. That is a few bytes per distinct
(document, token). A shard's rows meet the shard's token values in one task; what comes back per
document is a short list of partial sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import slices
from .util import released, stored

SCHEMA = ("batch string, shard int, lang string, n int, tokens binary, counts binary, docs binary, freqs binary, "
          "trusted binary, ids array<long>, sizes array<long>, flags array<boolean>")
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
TYPES = [pa.string(), pa.int32(), pa.string(), pa.int32(), *[pa.binary()] * 5, pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_())]
HEADER = -1
#: Batches of one shard that a task handles; with more, the shard's values go to several tasks.
BATCHES_PER_TASK = 4096

#: Distinct tokens (as an array that can be indexed), their shards, the code of each entry, its document, sizes of the
#: documents, and how many occurrences each entry stands for (None: one).
Extract = Callable[
    [pa.Array, int], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]]


def packed(values: np.ndarray) -> bytes:
    """Non-negative numbers in the narrowest of 1, 2, 4 and 8 bytes, compressed."""
    most = int(values.max(initial=0))
    kind = "<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<u8"
    return small(values.astype(kind).tobytes())


def small(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def whole(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def unpacked(data: bytes, n: int) -> np.ndarray:
    data = whole(data)
    return np.frombuffer(data, f"<u{len(data) // n if n else 1}").astype(np.int64)


def pack_tokens(tokens: np.ndarray) -> bytes:
    """Integer tokens as they are; byte strings with their lengths in front."""
    if tokens.dtype != object:
        return small(tokens.astype("<u8").tobytes())
    return small(np.fromiter(map(len, tokens), "<u4", len(tokens)).tobytes() + b"".join(tokens))


def unpack_numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(whole(data), "<i8")


def unpack_strings(data: bytes, n: int) -> list[bytes]:
    data = whole(data)
    ends = np.cumsum(np.frombuffer(data, "<u4", n).astype(np.int64)) + 4 * n
    return [data[s:e] for s, e in zip([4 * n, *ends[:-1].tolist()], ends.tolist())]


def batch_rows(batch: str, lang: str | None, texts: pa.Array, ids: list, flags: list, extract: Extract, shards: int) -> list[tuple]:
    tokens, shard, codes, docs, sizes, often = extract(texts, shards)
    entries = docs * max(1, len(tokens)) + codes
    if often is None:
        pairs, freqs = np.unique(entries, return_counts=True)
    else:
        pairs, at = np.unique(entries, return_inverse=True)
        freqs = np.bincount(at, often, len(pairs)).astype(np.int64)
    pair_doc, pair_token = np.divmod(pairs, max(1, len(tokens)))
    order = np.lexsort((pair_doc, pair_token, shard[pair_token]))
    pair_doc, pair_token, freqs = pair_doc[order], pair_token[order], freqs[order]
    in_trusted = np.array(flags, bool)[pair_doc] * freqs if flags else freqs * 0
    rows = [(batch, HEADER, lang, 0, None, None, None, None, None, ids, sizes.tolist(), flags)]
    of = shard[pair_token]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(of)) + 1, [len(of)])) if len(of) else np.array([0])
    for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        first = np.concatenate(([0], np.flatnonzero(np.diff(pair_token[s:e])) + 1))
        counts = np.diff(np.append(first, e - s))
        rows.append((
            batch, int(of[s]), lang, len(first), pack_tokens(tokens[pair_token[s:e][first]]), packed(counts),
            small(pair_doc[s:e].astype("<u2").tobytes()), packed(freqs[s:e]),
            packed(np.add.reduceat(in_trusted[s:e], first)), None, None, None))
    return rows


def postings(rows: DataFrame, extract: Extract, shards: int) -> DataFrame:
    """The stored postings of ``rows`` (doc_id, text, lang, trusted); a batch holds one language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            order = batch.column("lang").dictionary_encode().indices.to_numpy(zero_copy_only=False)
            batch = batch.take(pa.array(np.argsort(order, kind="stable")))
            langs = batch.column("lang").to_pylist()
            at = 0
            while at < len(langs):
                end = at + 1
                while end < len(langs) and langs[end] == langs[at]:
                    end += 1
                for texts in slices(batch.column("text").slice(at, end - at)):
                    ids, flags = (batch.column(c).slice(at, len(texts)).to_pylist() for c in ("doc_id", "trusted"))
                    out = batch_rows(f"{part}-{number}", langs[at], texts, ids, flags, extract, shards)
                    at, number = at + len(texts), number + 1
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), TYPES)], NAMES)

    return stored(rows.select("doc_id", "text", "lang", "trusted").mapInArrow(released(run), SCHEMA), "postings")


def partial_sums(row: dict, values: np.ndarray, counts: np.ndarray) -> tuple[str, bytes, bytes]:
    """(batch, documents, sums) of one postings row, given a value per token."""
    docs = np.frombuffer(whole(row["docs"]), "<u2")
    weighted = np.repeat(values, counts) * unpacked(row["freqs"], len(docs))
    sums = np.bincount(docs, weighted)
    hit = np.unique(docs)
    return row["batch"], hit.tobytes(), sums[hit].astype("<f8").tobytes()


def tasks_per_shard(table: DataFrame) -> int:
    """Into how many tasks a shard's batches are split."""
    return 1 + table.where(F.col("shard") == HEADER).count() // BATCHES_PER_TASK


def sums_by_document(table: DataFrame, partials: DataFrame) -> DataFrame:
    """(doc_id, lang, size, trusted, total) per document from partial sums (batch, docs, sums)."""
    def run(_key: tuple, found: pa.Table) -> pa.Table:
        rows = found.to_pylist()
        head = next(r for r in rows if r["ids"] is not None)
        total = np.zeros(len(head["ids"]))
        for r in rows:
            if r["docs"]:
                total[np.frombuffer(r["docs"], "<u2")] += np.frombuffer(r["sums"], "<f8")
        n = len(total)
        pa.default_memory_pool().release_unused()
        return pa.table({
            "doc_id": pa.array(head["ids"], pa.int64()), "lang": pa.array([head["lang"]] * n, pa.string()),
            "size": pa.array(head["sizes"], pa.int64()), "trusted": pa.array(head["flags"], pa.bool_()), "total": total})

    heads = table.where(F.col("shard") == HEADER).select("batch", "lang", "ids", "sizes", "flags")
    return heads.unionByName(partials, allowMissingColumns=True).groupBy("batch").applyInArrow(
        run, "doc_id long, lang string, size long, trusted boolean, total double")
