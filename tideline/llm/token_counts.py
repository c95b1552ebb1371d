"""Token counts without token ids: pieces are counted once per distinct pre-token."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .postings import HEADER, partial_sums, postings, sums_by_document, tasks_per_shard, unpack_strings, unpacked
from .tokens import chunk_lists
from .util import text_of

#: No piece of the model holds a blank or line end after another character.
BREAKS = "[ \n]"


def pre_tokens(texts: pa.Array, shards: int):
    """Pre-tokens are runs of blanks and line ends with what follows; the model's leading blank is made plain first."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
    lists = chunk_lists(texts, punctuation=False, space=BREAKS)
    coded = lists.flatten().dictionary_encode()
    tokens = np.empty(len(coded.dictionary), object)
    tokens[:] = coded.dictionary.cast(pa.binary()).to_pylist()
    shard = np.fromiter((zlib.crc32(t) % shards for t in tokens), np.int64, len(tokens))
    docs = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    return tokens, shard, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), docs, sizes, None


@lru_cache(maxsize=2)
def piece_model(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def count_pieces(tokens: list[bytes], path: str) -> list[int]:
    """Pieces of each pre-token in its place.

    Encoding one alone puts a blank in front, so one that starts with a blank goes without it, and from one
    that starts with a line end the blank is taken off again. A blank alone, at the end of a text, is one piece.
    """
    texts = [t.decode() for t in tokens]
    found = piece_model(path).encode([t[1:] if t[:1] == " " else t for t in texts], num_threads=1)
    return [1 if t == " " else len(p) - (t[:1] == "\n") if t else 0 for p, t in zip(found, texts)]


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Counts are those of the sentencepiece model for whole texts, null as empty, without added tokens.
    Rows may repeat or lack a doc_id; other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", text_of().alias("text"), F.lit(None).cast("string").alias("lang"), F.lit(False).alias("trusted"))
    table = postings(rows, pre_tokens, shards)
    cell = F.pmod(F.xxhash64("batch"), F.lit(tasks_per_shard(table)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, known = None, {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["shard"] != shard:  # a pre-token belongs to one shard, so its count is not needed again
                    shard, known = row["shard"], {}
                n = row["n"]
                tokens = unpack_strings(row["tokens"], n)
                new = [t for t in tokens if t not in known]
                known.update(zip(new, count_pieces(new, model)))
                values = np.fromiter((known[t] for t in tokens), np.float64, n)
                out.append(partial_sums(row, values, unpacked(row["counts"], n)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.binary(), pa.binary()))],
                    ["batch", "docs", "sums"])

    cells = table.where(F.col("shard") != HEADER).select("batch", "shard", cell.alias("cell"), "tokens", "n", "counts", "docs", "freqs")
    partials = cells.repartition("shard", "cell").sortWithinPartitions("shard", "cell").mapInArrow(
        run, "batch string, docs binary, sums binary")
    total = F.col("total").cast("long")
    return sums_by_document(table, partials).select(
        "doc_id", F.col("size").alias("n_bytes"), total.alias("n_tokens"), (total > limit).alias("over_limit"))
