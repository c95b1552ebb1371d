"""Links between near fingerprints by multi-index hashing, and the components they form."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import released, stored

#: A bucket up to this size is compared pair by pair in one vector pass, a larger one row by row.
SMALL = 48


class Forest:
    """Union-find over the links of one task; a link inside a known tree is not passed on."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}
        self.new: list[np.ndarray] = []

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    def link(self, nodes: np.ndarray, prints: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Rows ``a`` link to rows ``b``; of links that join two trees, both prints are passed on."""
        fresh = []
        for i, (x, y) in enumerate(zip(nodes[a].tolist(), nodes[b].tolist())):
            rx, ry = self.root(x), self.root(y)
            if rx != ry:
                self.parent[max(rx, ry)] = min(rx, ry)
                fresh.append(i)
        if fresh:
            self.new.extend(np.concatenate([prints[a[fresh]], prints[b[fresh]]], axis=1))

    def take(self, words: int) -> pa.RecordBatch:
        pairs, self.new = np.array(self.new, np.uint64).reshape(-1, 2 * words).view(np.int64), []
        return pa.RecordBatch.from_arrays([pa.array(column) for column in pairs.T], link_columns(words))


def link_columns(words: int) -> list[str]:
    return [f"{side}{j}" for side in "ab" for j in range(words)]


def names_of(prints: np.ndarray) -> np.ndarray:
    """A 64-bit name per print, for use inside a task; a print of one word is its own."""
    name = prints[:, 0].copy()
    for word in prints.T[1:]:
        name = (name ^ (name >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + word
        name = (name ^ (name >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return name


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int32)


def link_bucket(nodes: np.ndarray, prints: np.ndarray, limit: int, forest: Forest) -> None:
    """All links of one large bucket that join different trees.

    The row nearest to the bitwise majority goes first and takes what is near to it; afterwards only
    rows outside that tree need comparing with the whole bucket, for a link has to leave a tree.
    """
    votes = sum(np.unpackbits(part.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
                for part in np.array_split(prints, max(1, len(prints) // 8192)))
    centre = np.packbits((votes * 2 > len(prints)).astype(np.uint8)).view(np.uint64)
    middle = int(np.argmin(distance(prints, centre)))
    inside = distance(prints, prints[middle]) <= limit
    near = np.flatnonzero(inside)
    forest.link(nodes, prints, np.full(len(near), middle), near)
    for i in np.flatnonzero(~inside).tolist():
        near = np.flatnonzero(distance(prints, prints[i]) <= limit)
        forest.link(nodes, prints, np.full(len(near), i), near)


def link_buckets(keys: np.ndarray, prints: np.ndarray, limit: int, forest: Forest) -> None:
    """Links of whole buckets, rows sorted by key."""
    nodes = names_of(prints)
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.append(starts, len(keys)))
    for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        link_bucket(nodes[s:s + n], prints[s:s + n], limit, forest)
    # row i of a bucket of n meets rows i+1 .. i+n-1: one pass per distance between rows
    left = np.repeat(np.where(sizes <= SMALL, starts + sizes, 0), sizes) - np.arange(len(keys))
    at = np.flatnonzero(left > 1)
    step = 1
    while len(at):
        near = at[distance(prints[at], prints[at + step]) <= limit]
        forest.link(nodes, prints, near, near + step)
        step += 1
        at = at[left[at] > step]


def link_sorted(words: int, limit: int):
    """A mapInArrow function over (key, p0, p1, ...) sorted by key; memory holds one bucket and one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        held = [np.empty(0, np.int64), np.empty((0, words), np.uint64)]
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            fresh = [columns[0], np.stack([c.view(np.uint64) for c in columns[1:]], axis=1)]
            keys, prints = (np.concatenate(x) for x in zip(held, fresh))
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                link_buckets(keys[:cut], prints[:cut], limit, forest)
                if forest.new:
                    yield forest.take(words)
            held = [keys[cut:], prints[cut:]]
        if len(held[0]):
            link_buckets(*held, limit, forest)
        yield forest.take(words)
    return run


def node_of(words: Sequence[str]) -> Column:
    """The name of a print in links and components."""
    return F.col(words[0]) if len(words) == 1 else F.xxhash64(*words)


def hamming_links(prints: DataFrame, segments: Sequence[tuple[int, int, int]], limit: int) -> DataFrame:
    """Links (a, b) between distinct prints (p0, p1, ...), named by ``node_of``, that differ in at most ``limit`` bits.

    Each segment (word, shift, bits) indexes a row under its value and all values one bit away, so two
    rows meet wherever a segment differs in two bits or less; with ``limit`` below three times the number
    of disjoint segments no link is lost. Full distances are checked where rows meet. Of the links, each
    task passes on a spanning forest: components are exact and the output stays linear.
    """
    words = [c for c in prints.columns if c.startswith("p")]
    keys = []
    for i, (word, shift, bits) in enumerate(segments):
        value = F.shiftrightunsigned(words[word], shift).bitwiseAND(F.lit((1 << bits) - 1))
        ball = F.array(F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(bits)])
        keys.append(F.transform(ball, lambda m: value.bitwiseXOR(m) + F.lit(i << 40)))  # noqa: B023
    rows = prints.select(F.explode(F.flatten(F.array(*keys))).alias("key"), *words)
    columns = link_columns(len(words))
    links = rows.repartition("key").sortWithinPartitions("key").mapInArrow(
        released(link_sorted(len(words), limit)), ", ".join(f"{c} long" for c in columns))
    return links.select(node_of(columns[:len(words)]).alias("a"), node_of(columns[len(words):]).alias("b"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node, root the smallest node reachable: large and small stars in turn."""
    a, b = F.col("a"), F.col("b")
    edges = stored(links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return edges.select(a.alias("node"), b.alias("root"))
        seen = state
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where(b > a).join(low, "a").select(b.alias("a"), F.col("low").alias("b"))
        large = stored(large.where(a != b).distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where(b != F.col("low")).select(b.alias("a"), F.col("low").alias("b"))
        edges = stored(small.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), "small")
