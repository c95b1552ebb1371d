"""Exact top-k inner products with pivot tables.

Every vector's distances to a fixed set of pivots are computed once. For a query q and a candidate c
the largest |d(q,p) - d(c,p)| bounds the distance of q and c from below, hence the inner product
(|q|^2 + |c|^2 - d(q,c)^2) / 2 from above. Candidates of a block are evaluated in the order of that
bound until it falls below the k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .util import stored

PIVOTS = 32
PIVOT_POOL = 2048
BLOCK = 2048
STEP = 64


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double; null unless all components are finite numbers."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.when(F.forall(vector, finite), F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale))))


def choose_pivots(pool: np.ndarray, n: int) -> np.ndarray:
    """Far-apart rows: each next pivot is the row farthest from those chosen."""
    chosen, gap = [0], np.linalg.norm(pool - pool[0], axis=1)
    while len(chosen) < min(n, len(pool)):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, np.linalg.norm(pool - pool[chosen[-1]], axis=1))
    return pool[chosen]


def lists_of(array: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a list array."""
    return array.flatten().to_numpy(zero_copy_only=False), array.offsets.to_numpy() - array.offsets[0].as_py()


def with_pivot_distances(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``classes`` with column ``to_pivots``, the Euclidean distances to the pivots of its dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            out = []
            for v in table.column("v").to_pylist():
                p = pivots[len(v)]
                out.append(np.sqrt(((p - np.array(v, np.float64)) ** 2).sum(axis=1)).tolist())
            yield from table.append_column("to_pivots", pa.array(out, pa.list_(pa.float64()))).to_batches()

    added = T.StructField("to_pivots", T.ArrayType(T.DoubleType()))
    return classes.mapInArrow(run, T.StructType([*classes.schema.fields, added]))


class Block:
    """Vectors of one dimension with norms, pivot distances and the smallest ids of each."""

    def __init__(self, rows: pa.StructArray, dim: int) -> None:
        n = len(rows)
        self.cid = rows.field("cid").to_numpy()
        self.v = lists_of(rows.field("v"))[0].astype(np.int64).reshape(n, dim)
        self.to_pivots = lists_of(rows.field("to_pivots"))[0].reshape(n, -1)
        self.ids, self.at = lists_of(rows.field("ids"))
        self.norm2 = (self.v.astype(np.float64) ** 2).sum(axis=1)


def search_block(q: Block, c: Block, k: int) -> Iterator[tuple[int, int, int]]:
    """(query class, score, vec_id) of the best k ids of ``c`` for every row of ``q``."""
    exact = max(np.abs(q.v).max(initial=0), np.abs(c.v).max(initial=0)) ** 2 * max(1, q.v.shape[1]) < 1 << 53
    table = c.v.astype(np.float64) if exact else c.v
    first = c.ids[c.at[:-1]]
    for i in range(len(q.cid)):
        bound = np.abs(c.to_pivots - q.to_pivots[i]).max(axis=1, initial=0.0)
        upper = (q.norm2[i] + c.norm2 - bound ** 2) / 2
        upper += 1e-9 * (q.norm2[i] + c.norm2) + 1  # rounding must not lower a bound
        order = np.argsort(-upper, kind="stable")
        query = q.v[i].astype(table.dtype)
        scores, rows, best = np.empty(0), np.empty(0, np.int64), None
        for s in range(0, len(order), STEP):
            if best is not None and upper[order[s]] < best:
                break
            part = order[s:s + STEP]
            scores, rows = np.concatenate((scores, table[part] @ query)), np.concatenate((rows, part))
            top = np.lexsort((first[rows], -scores))[:k]
            scores, rows = scores[top], rows[top]
            best = scores[-1] if len(scores) == k else None
        found = [(int(score), int(id_)) for score, row in zip(scores, rows) for id_ in c.ids[c.at[row]:c.at[row + 1]]]
        for score, id_ in sorted(found, key=lambda x: (-x[0], x[1]))[:k]:
            yield int(q.cid[i]), score, id_


def search_pairs(k: int):
    """A mapInArrow function over (dim, candidate block, query block) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                dim = batch.column("dim")[r].as_py()
                c, q = (Block(batch.column(n)[r].values, dim) for n in ("cands", "queries"))
                out = np.array(list(search_block(q, c, k)), np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([pa.array(out[:, j]) for j in range(3)], ["cid", "score", "vec_id"])
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, block: int = BLOCK) -> DataFrame:
    """The ``k`` best candidates of every query: query_id, rank, vec_id, score, ties to the smaller vec_id.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on vec_id. Candidates are all other
    rows of the same dimension. Vectors that are null or hold null or non-finite components take no part,
    nor do rows without vec_id; exact repeats of a row count once. Scores are inner products of the
    floored components times 256 and must fit a long. Equal vectors are searched once: a class stands for
    them with its k+1 smallest ids, which is all that a top k can hold of it.
    """
    rows = stored(vectors.select("vec_id", quantised(F.col("embedding")).alias("v"), is_query.alias("asks")).where(
        "vec_id is not null and v is not null").distinct().withColumn("cid", F.xxhash64("v")), "vectors")
    low = Window.partitionBy("cid", "v").orderBy("vec_id")
    members = rows.withColumn("rn", F.row_number().over(low)).where(F.col("rn") <= k + 1).groupBy("cid", "v").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asked = rows.groupBy("cid", "v").agg(F.max("asks").alias("asks"))
    classes = members.join(asked, ["cid", "v"]).withColumn("dim", F.size("v"))
    pool = rows.dropDuplicates(["cid"]).select(F.size("v").alias("dim"), "v", F.xxhash64("cid").alias("o"))
    near_o = Window.partitionBy("dim").orderBy("o")
    pool = pool.withColumn("rn", F.row_number().over(near_o)).where(F.col("rn") <= PIVOT_POOL)
    by_dim: dict[int, list] = {}
    for r in pool.orderBy("dim", "o").toLocalIterator():  # at most PIVOT_POOL rows per dimension
        by_dim.setdefault(r["dim"], []).append(r["v"])
    pivots = {d: choose_pivots(np.array(v, np.float64).reshape(len(v), d), PIVOTS) for d, v in by_dim.items()}
    classes = stored(with_pivot_distances(classes, pivots), "classes")

    blocks = max(1, -(-classes.count() // block))
    entry = F.struct("cid", "v", "to_pivots", "ids")
    spread = F.pmod(F.xxhash64(F.lit(1), "cid"), F.lit(blocks)).alias("b")
    cands = classes.groupBy("dim", spread).agg(F.collect_list(entry).alias("cands"))
    asks = classes.where("asks").groupBy(
        "dim", F.pmod(F.xxhash64(F.lit(2), "cid"), F.lit(max(1, blocks // 8))).alias("qb")).agg(
        F.collect_list(entry).alias("queries"))
    pairs = asks.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn(
        "b", F.col("b").cast("long")).join(cands, ["dim", "b"]).select("dim", "cands", "queries")
    found = pairs.mapInArrow(search_pairs(k + 1), "cid long, score long, vec_id long")
    best = Window.partitionBy("cid").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k + 1).drop("rn")
    ranked = Window.partitionBy("query_id", "cid").orderBy(F.desc("score"), "vec_id")
    return rows.where("asks").select(F.col("vec_id").alias("query_id"), "cid").join(found, "cid").where(
        "vec_id != query_id").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
