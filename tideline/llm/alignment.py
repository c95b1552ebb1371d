"""Alignment of two tokenizers over whole texts, with corpus counts of the id pairs whose tokens overlap.

Texts are cut where no token of either tokenizer can cross, so each distinct chunk is encoded and aligned on
byte offsets by itself. A first pass collects the id pairs; a minimal perfect hash numbers the distinct ones,
every task's counts become dense vectors over these numbers, and the vectors are added up a tree. A second
pass aligns the documents again and looks each pair up in the hash, its key verified.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .postings import small, whole
from .token_counts import piece_model
from .token_store import PerfectHash
from .tokens import MARK, SPACE, Memory, Rows, chunk_lists, encoder, slices
from .util import located, locator, stored, text_of

#: Cut before a blank or line end after something else than white space: neither tokenizer has a token across.
CUT = (f"([^{SPACE[1:]})([ \n]{SPACE}*)", f"\\1{MARK}\\2")
#: Pairs under one hash, hashes that are shipped to the workers at once, pairs that a task holds before it passes them on.
PAIRS_PER_BUCKET, BUCKETS_PER_ROUND, HELD_PAIRS = 1 << 16, 64, 1 << 22
#: Pairs in a row of a task's counts, and vectors that are added in one group.
PAIRS_PER_ROW, FAN_IN = 1 << 17, 16


def byte_level_bytes(path: str) -> list[bytes]:
    """The bytes of every entry of a byte-level vocabulary, by id."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    others = [b for b in range(256) if b not in plain]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    vocabulary = encoder(path, ordinary=True).tokenizer.get_vocab()
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
    return out


def piece_bytes(path: str) -> list[bytes]:
    """The bytes of every piece, by id: the sign for blanks as a blank, <0xHH> as that byte."""
    model = piece_model(path)
    return [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(len(model))]


class Side:
    """What the ids of one tokenizer stand for."""

    def __init__(self, table: list[bytes]) -> None:
        self.bytes = pa.array(table, pa.large_binary())
        self.lengths = np.array([len(b) for b in table], np.int64)
        self.names = pa.array([str(i) for i in range(len(table))])


class Aligned(NamedTuple):
    """Per chunk: whether its bytes come out differently, numbers of tokens, groups and links, and the links themselves."""

    odd: np.ndarray
    n: np.ndarray
    links: np.ndarray
    link_at: np.ndarray
    groups: pa.Array | None


class Aligner:
    """Aligns chunks of texts that start with a blank."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.encoder, self.model = encoder(path_a, ordinary=True), piece_model(path_b)
        self.a, self.b = Side(byte_level_bytes(path_a)), Side(piece_bytes(path_b))
        self.blank = [self.model.piece_to_id("▁")]
        self.recall = Memory(lambda chunks: [self.encoder.learn(chunks), self.pieces(chunks)], sides=2)

    def pieces(self, chunks: pa.Array) -> Rows:
        """The model puts a blank in front: a chunk's own goes before, that of a chunk with a line end goes after."""
        texts = chunks.to_numpy(zero_copy_only=False).tolist()
        found = self.model.encode([c[1:] if c[:1] == " " else c for c in texts], num_threads=1)
        return Rows.of([self.blank if c == " " else f[1:] if c[:1] == "\n" else f for c, f in zip(texts, found)])

    def align(self, chunks: pa.Array, texts: list[str], strings: bool) -> Aligned:
        """All ``chunks``, and behind them ``texts``, encoded whole."""
        place, sides = self.recall(chunks)
        more = [Rows.of([self.encoder.alone.encode(t, add_special_tokens=False).ids for t in texts]), Rows.of(self.model.encode([t[1:] for t in texts]))]
        (a, a_at), (b, b_at) = (side.take(place).then(m) for side, m in zip(sides, more))
        a, b = a.astype(np.int64), b.astype(np.int64)
        chunks = pa.concat_arrays([chunks, pa.array(texts, chunks.type)]).cast(pa.large_binary())
        odd = self.differs(self.a, a, a_at, chunks) | self.differs(self.b, b, b_at, chunks)
        if odd.any():
            a, a_at = without(a, a_at, odd)
            b, b_at = without(b, b_at, odd)
        chunk_ends = np.cumsum(np.where(odd, 0, pc.binary_length(chunks).to_numpy(zero_copy_only=False)))
        marks = np.zeros((2, int(chunk_ends[-1]) + 1 if len(chunk_ends) else 1), bool)
        for mark, side, ids in zip(marks, (self.a, self.b), (a, b)):
            mark[np.cumsum(side.lengths[ids])] = True
        # a token of each ends at every end of a stretch, or goes on: stretches and overlapping pairs are the same
        stretches, common = np.flatnonzero(marks[0] | marks[1]), np.flatnonzero(marks[0] & marks[1])
        before = [np.cumsum(mark, dtype=np.int64) - mark for mark in marks]
        links = a[before[0][stretches]] << 32 | b[before[1][stretches]]
        link_at, group_at = (np.concatenate(([0], np.searchsorted(x, chunk_ends, side="right"))) for x in (stretches, common))
        n = np.stack([np.diff(a_at), np.diff(b_at), np.diff(group_at), np.diff(link_at)])
        groups = None
        if strings:
            sides = [joined(side.names, ids, np.concatenate(([0], (past + mark)[common])), ",")
                     for side, ids, past, mark in ((self.a, a, before[0], marks[0]), (self.b, b, before[1], marks[1]))]
            groups = joined(pc.binary_join_element_wise(*sides, "|"), np.arange(len(common)), group_at, ";")
        return Aligned(odd, n, links, link_at, groups)

    @staticmethod
    def differs(side: Side, ids: np.ndarray, at: np.ndarray, chunks: pa.Array) -> np.ndarray:
        """Whether the joined bytes of a chunk's ids are other than the chunk."""
        ends = np.concatenate(([0], np.cumsum(side.lengths[ids])))[at]
        lengths = pc.binary_length(chunks).to_numpy(zero_copy_only=False)
        odd = np.diff(ends) != lengths
        ids, _ = without(ids, at, odd)
        same = [np.frombuffer(x.buffers()[2] or b"", np.uint8) for x in (
            side.bytes.take(pa.array(ids)), chunks.take(pa.array(np.flatnonzero(~odd))))]
        wrong = np.flatnonzero(same[0][:lengths[~odd].sum()] != same[1][:lengths[~odd].sum()])
        if len(wrong):
            odd[np.flatnonzero(~odd)[np.unique(np.searchsorted(np.cumsum(lengths[~odd]), wrong, side="right"))]] = True
        return odd


def without(ids: np.ndarray, at: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets with nothing left of the odd chunks."""
    n = np.diff(at)
    return ids[np.repeat(~odd, n)], np.concatenate(([0], np.cumsum(np.where(odd, 0, n))))


def joined(values: pa.Array, take: np.ndarray, at: np.ndarray, separator: str) -> pa.Array:
    lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), values.take(pa.array(take)))
    return pc.binary_join(lists, separator)


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker; what it remembers of chunks outlives a task."""
    return Aligner(path_a, path_b)


def aligned_texts(texts: pa.Array, align: Aligner, strings: bool) -> tuple[np.ndarray, np.ndarray, Aligned]:
    """Chunk numbers of all texts in a row, the offset of each text in them, and the chunks aligned."""
    filled = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
    lists = chunk_lists(filled, punctuation=False, cut=CUT)
    flat = lists.flatten()
    doc = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    there = pc.not_equal(flat, "")
    coded, doc = flat.filter(there).dictionary_encode(), doc[there.to_numpy(zero_copy_only=False)]
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    found = align.align(coded.dictionary, [], strings)
    if found.odd.any():
        # a text with such a chunk is encoded and compared as a whole; one that differs then has no tokens
        again = np.unique(doc[found.odd[codes]])
        found = align.align(coded.dictionary, filled.take(pa.array(again)).to_pylist(), strings)
        keep = ~np.isin(doc, again)
        good = np.flatnonzero(~found.odd[len(coded.dictionary):])
        doc, codes = np.concatenate([doc[keep], again[good]]), np.concatenate([codes[keep], len(coded.dictionary) + good])
        order = np.argsort(doc, kind="stable")
        doc, codes = doc[order], codes[order]
    return codes, np.searchsorted(doc, np.arange(len(texts) + 1)), found


def summed(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches."""
    return np.diff(np.concatenate(([0], np.cumsum(values, dtype=np.int64)))[at])


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their summed counts."""
    keys, counts = (np.concatenate([p[i] for p in parts] or [np.empty(0, np.int64)]) for i in (0, 1))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def pair_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(part, pairs, counts): the linked id pairs of each task with their links, PAIRS_PER_ROW at most in a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, part, parts, held = aligner(path_a, path_b), TaskContext.get().partitionId(), [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            keys, counts = merged(parts)
            for s in range(0, len(keys), PAIRS_PER_ROW):
                lists = [pa.array([x[s:s + PAIRS_PER_ROW]], pa.list_(pa.int64())) for x in (keys, counts)]
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), *lists], ["part", "pairs", "counts"])

        for batch in batches:
            for texts in slices(batch.column("text")):
                codes, _, found = aligned_texts(texts, align, strings=False)
                times = np.bincount(codes, minlength=len(found.odd))
                parts.append(merged([(found.links, np.repeat(times, found.n[3]))]))
                held += len(parts[-1][0])
                if held > HELD_PAIRS:
                    parts = [merged(parts)]
                    held = len(parts[0][0])
                    if held > HELD_PAIRS // 2:
                        yield from rows()
                        parts, held = [], 0
        yield from rows()

    return docs.select(text_of().alias("text")).mapInArrow(run, "part long, pairs array<long>, counts array<long>")


def bucket_of(pairs, buckets: int):
    """The bucket of a pair, for columns and arrays alike."""
    return ((pairs >> 32) * 2654435761 + (pairs & 0xFFFFFFFF) * 40503) % buckets if isinstance(pairs, np.ndarray) else (
        F.pmod(F.shiftright(pairs, 32) * F.lit(2654435761) + pairs.bitwiseAND(F.lit(0xFFFFFFFF)) * F.lit(40503), F.lit(buckets)))


def build_hash(key: tuple, rows: pa.Table) -> pa.Table:
    """One row per bucket: the bits of its hash, and its pairs in the order of their numbers."""
    keys = rows.column("pair").to_numpy()
    hash_ = PerfectHash.build(keys)
    ordered = np.empty(len(keys), np.int64)
    ordered[hash_.slots(keys)] = keys
    return pa.table({
        "bucket": pa.array([key[0].as_py()], pa.int64()), "levels": pa.array([hash_.levels], pa.list_(pa.int64())),
        "bits": [np.packbits(hash_.bits).tobytes()], "pairs": [ordered.tobytes()]})


class Numbering:
    """The hashes of some buckets: a pair's place in the vectors of these buckets laid end to end, -1 if it is not among them."""

    def __init__(self, rows: list) -> None:
        self.at = {}
        pairs, base = [], 0
        for r in rows:
            bits = np.unpackbits(np.frombuffer(bytes(r.bits), np.uint8), count=sum(r.levels)).astype(bool)
            pairs.append(np.frombuffer(bytes(r.pairs), np.int64))
            self.at[r.bucket] = (base, PerfectHash(list(r.levels), bits))
            base += len(pairs[-1])
        self.pairs = np.concatenate(pairs) if pairs else np.empty(0, np.int64)

    def __call__(self, pairs: np.ndarray, buckets: int) -> np.ndarray:
        out, bucket = np.full(len(pairs), -1, np.int64), bucket_of(pairs, buckets)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(buckets + 1)) if buckets <= len(pairs) else None
        for b, (base, hash_) in self.at.items():
            here = order[starts[b]:starts[b + 1]] if starts is not None else np.flatnonzero(bucket == b)
            if len(here):
                slot = hash_.slots(pairs[here])
                known = slot >= 0
                known[known] = self.pairs[base + slot[known]] == pairs[here[known]]
                out[here[known]] = base + slot[known]
        return out


def add_vectors(_key: tuple, rows: pa.Table) -> pa.Table:
    total = 0
    for c in rows.column("counts"):
        total = total + np.frombuffer(whole(c.as_py()), np.int64)
    return rows.slice(0, 1).set_column(2, "counts", pa.array([small(total.tobytes())], pa.binary()))


def dense_counts(tasks: DataFrame, numbering: Numbering, buckets: int, parts: int) -> DataFrame:
    """(bucket, part, counts): every task's counts as dense vectors by bucket, added FAN_IN at a time until one is left of each."""
    shared = tasks.sparkSession.sparkContext.broadcast(pickle.dumps(numbering))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total, part = None, None, 0
        for batch in batches:
            for row in range(batch.num_rows):
                if number is None:
                    number = pickle.loads(shared.value)
                    total = np.zeros(len(number.pairs), np.int64)
                part = batch.column("part")[row].as_py()
                pairs, counts = (batch.column(c)[row].values.to_numpy() for c in ("pairs", "counts"))
                place = number(pairs, buckets)
                total[place[place >= 0]] += counts[place >= 0]  # the pairs of a row are distinct
        if number is not None:
            for bucket, (base, hash_) in number.at.items():
                vector = total[base:base + int(hash_.rank[-1])]
                if vector.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([bucket], pa.int64()), pa.array([part], pa.int64()), pa.array([small(vector.tobytes())], pa.binary())],
                        ["bucket", "part", "counts"])

    schema = "bucket long, part long, counts binary"
    vectors = tasks.mapInArrow(run, schema)
    while True:
        parts = -(-parts // FAN_IN)
        vectors = vectors.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("bucket", "part").applyInArrow(add_vectors, schema)
        if parts <= 1:
            return vectors


def best_counts(counted: DataFrame) -> dict[int, int]:
    """The highest count of every B id; as many rows as B has ids at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs, counts in zip(batch.column("pairs").to_pylist(), batch.column("counts").to_pylist()):
                b, n = np.frombuffer(pairs, np.int64) & 0xFFFFFFFF, np.frombuffer(whole(counts), np.int64)
                order = np.lexsort((n, b))
                last = np.flatnonzero(np.append(b[order][1:] != b[order][:-1], True))
                yield pa.RecordBatch.from_arrays([pa.array(b[order][last]), pa.array(n[order][last])], ["b", "n"])

    rows = counted.select("pairs", "counts").mapInArrow(run, "b long, n long").groupBy("b").agg(F.max("n").alias("n"))
    return {r.b: r.n for r in rows.collect()}


OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def scored(docs: DataFrame, path_a: str, path_b: str, shared, buckets: int, places: bool) -> DataFrame:
    """The second pass over ``docs`` with the hashes and counts of ``shared``."""
    extra = ["file", "row"] if places else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, known = aligner(path_a, path_b), None
        for batch in batches:
            known = known or pickle.loads(shared.value)
            number, counts, best = known
            at = 0
            for texts in slices(batch.column("text")):
                ids = [batch.column(c).slice(at, len(texts)) for c in ("doc_id", *extra)]
                at += len(texts)
                codes, doc_at, found = aligned_texts(texts, align, strings=True)
                place = number(found.links, buckets)
                n = np.where(place >= 0, counts[place], 0) if len(counts) else np.zeros(len(place), np.int64)
                top = (place >= 0) & (n == best[found.links & 0xFFFFFFFF])
                sums = [summed(x, found.link_at) for x in (top, n)]
                columns = [summed(x[codes], doc_at) for x in (*found.n, *sums)]
                lines = joined(found.groups, codes, doc_at, ";").to_pylist()
                digests = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in lines]
                yield pa.RecordBatch.from_arrays(
                    [ids[0], *map(pa.array, columns), pa.array(digests, pa.string()), *ids[1:]],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *extra])

    schema = OUT + (", file string, row long" if places else "")
    return docs.select("doc_id", text_of().alias("text"), *(locator() if places else [])).mapInArrow(run, schema)


def align_tokenizers(
    docs: DataFrame, path_a: str, path_b: str, pairs_per_bucket: int = PAIRS_PER_BUCKET, buckets_per_round: int = BUCKETS_PER_ROUND,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is a byte-level vocabulary for tokenizers, given a blank and the text; B a sentencepiece model, given the text,
    to which it adds the blank. Special tokens are neither added nor read from texts. Texts that are null or empty, or
    whose joined bytes are not the blank and the text in A or in B, have no tokens: zeros, and an empty digest. Byte
    offsets where a token of both ends cut the tokens into groups; a link is an A and a B token whose bytes overlap; a
    pair's count is the number of links with its ids in all texts. ``n_best`` counts links whose count is the highest
    of their B id, ``count_sum`` sums the counts of all links. Equal rows each count; a null doc_id is returned as
    null; other columns are not read; an empty table gives an empty result.

    ``buckets_per_round`` hashes (with ``pairs_per_bucket`` pairs each) are shipped to the workers at once. There is one
    round unless the two vocabularies meet in more pairs; each further round is one more pass over the texts.
    """
    docs = located(docs)
    spark = docs.sparkSession
    tasks = stored(pair_counts(docs, path_a, path_b), "pair_counts")
    pairs = stored(tasks.select(F.explode("pairs").alias("pair")).distinct(), "pairs")
    buckets = max(1, -(-pairs.count() // pairs_per_bucket))
    hashes = stored(pairs.withColumn("bucket", bucket_of(F.col("pair"), buckets)).groupBy("bucket").applyInArrow(
        build_hash, "bucket long, levels array<long>, bits binary, pairs binary"), "hashes")
    parts = (tasks.agg(F.max("part")).first()[0] or 0) + 1
    rounds = [F.col("bucket").between(s, s + buckets_per_round - 1) for s in range(0, buckets, buckets_per_round)]
    counted = None
    for some in rounds:
        vectors = dense_counts(tasks, Numbering(hashes.where(some).collect()), buckets, parts)
        table = stored(hashes.join(vectors.drop("part"), "bucket"), "counted")
        counted = table if counted is None else counted.unionByName(table)

    found = best_counts(counted)
    best = np.zeros(max(found, default=0) + 1, np.int64)
    best[list(found)] = list(found.values())
    results = []
    for some in rounds:
        rows = counted.where(some).collect()
        counts = np.concatenate([np.frombuffer(whole(bytes(r.counts)), np.int64) for r in rows] or [np.empty(0, np.int64)])
        shared = spark.sparkContext.broadcast(pickle.dumps((Numbering(rows), counts, best)))
        results.append(scored(docs, path_a, path_b, shared, buckets, places=len(rounds) > 1))
    if len(results) == 1:
        return results[0]
    both = results[0]
    for more in results[1:]:
        both = both.unionByName(more)
    same = [F.first(c).alias(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    return both.groupBy("file", "row").agg(
        *same, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"),
        F.first("groups_sha256").alias("groups_sha256")).drop("file", "row")
