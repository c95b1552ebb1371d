"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of characters.

One model of order 3 per language is trained on trusted text. Counts, continuation counts and
discounts are Spark aggregations, the probability of every trigram of the corpus comes from joins of
these counts, and documents meet the probabilities shard by shard (see ``postings``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .postings import HEADER, partial_sums, postings, sums_by_document, tasks_per_shard, unpack_numbers, unpacked, whole
from .util import located, locator, released, rows_at, stored, text_of

#: A character takes 21 bits of a token; the start and end of a text count as characters.
BITS = 21
MASK = (1 << BITS) - 1
START, END = "\x02", "\x03"
#: Characters whose trigrams are counted at a time.
WINDOW = 1 << 19
#: A document is rejected above this quantile of its language's trusted documents, plus a margin in nats for text the model
#: has not seen: of the pairs tried none decides fewer held-out labelled rows wrongly (README has the rates).
QUANTILE = 0.995
MARGIN = 0.05
#: A document's cross-entropy is drawn to its language's mean by so many characters.
PRIOR = 60


def windows(strings: list[str], most: int = WINDOW) -> Iterator[tuple[list[int], list[str]]]:
    """Runs of padded texts of about ``most`` characters, with the number of each; a longer text comes in overlapping pieces."""
    numbers, pieces, held = [], [], 0
    for i, text in enumerate(strings):
        padded = f"{START}{START}{text}{END}"
        for at in range(0, len(padded) - 2, most):
            piece = padded[at:at + most + 2]
            if pieces and held + len(piece) > most:
                yield numbers, pieces
                numbers, pieces, held = [], [], 0
            numbers.append(i)
            pieces.append(piece)
            held += len(piece)
    if pieces:
        yield numbers, pieces


def trigrams(texts: pa.Array, shards: int):
    """Trigrams per document, counted window by window: memory follows the distinct ones, not the characters."""
    strings = texts.to_pylist()
    sizes = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
    found, of, often = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for numbers, pieces in windows(strings):
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        points = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        starts = np.ones(len(points), bool)
        starts[np.cumsum(lengths) - 1] = starts[np.cumsum(lengths) - 2] = False
        grams = (points[:-2] << 2 * BITS | points[1:-1] << BITS | points[2:])[starts[:-2]]
        known, codes = np.unique(grams, return_inverse=True)
        pairs, counts = np.unique(np.repeat(np.arange(len(pieces)), lengths - 2) * len(known) + codes, return_counts=True)
        piece, code = np.divmod(pairs, len(known))
        found.append(known[code])
        of.append(np.array(numbers, np.int64)[piece])
        often.append(counts)
    tokens, codes = np.unique(np.concatenate(found), return_inverse=True)
    spread = tokens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
    return (tokens, (spread % np.uint64(shards)).astype(np.int64), codes, np.concatenate(of), sizes,
            np.concatenate(often))


def trusted_flags(table: DataFrame, keys: DataFrame) -> DataFrame:
    """(batch, flags): which documents of each batch have their doc_id in ``keys``; a bit per document when stored."""
    ids = table.where(F.col("shard") == HEADER).select("batch", F.posexplode("ids").alias("at", "doc_id"))
    found = ids.join(keys.select("doc_id", F.lit(True).alias("hit")), "doc_id", "left")
    pairs = F.array_sort(F.collect_list(F.struct("at", F.coalesce("hit", F.lit(False)).alias("hit"))))
    return stored(found.groupBy("batch").agg(pairs.getField("hit").alias("flags")), "flags")


def gram_counts(table: DataFrame) -> DataFrame:
    """(lang, token, shard, c): every trigram of the corpus with its count in trusted text (0 if it has none)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for at in range(len(batch)) for r in batch.slice(at, 1).to_pylist()):
                n = row["n"]
                docs = np.frombuffer(whole(row["docs"]), "<u2")
                sure = np.array(row["flags"], bool)[docs] * unpacked(row["freqs"], len(docs))
                counts = unpacked(row["counts"], n)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["lang"]] * n, pa.string()), pa.array([row["shard"]] * n, pa.int32()),
                    pa.array(unpack_numbers(row["tokens"])), pa.array(np.add.reduceat(sure, np.cumsum(counts) - counts))],
                    ["lang", "shard", "token", "c"])

    rows = table.where(F.col("shard") != HEADER).select("lang", "shard", "n", "tokens", "counts", "docs", "freqs", "flags")
    return rows.mapInArrow(released(run), "lang string, shard int, token long, c long").groupBy("lang", "token", "shard").agg(
        F.sum("c").alias("c"))


def discounts(counts: DataFrame, order: str) -> DataFrame:
    """(lang, d1, d2, d3) from how many n-grams of column c occur one to four times; 0 where it can't be told."""
    n = [F.sum((F.col("c") == k).cast("long")) for k in (1, 2, 3, 4)]
    at = counts.groupBy("lang").agg(*[x.alias(f"n{k}") for k, x in enumerate(n, 1)])
    y = F.col("n1") / F.nullif(F.col("n1") + 2 * F.col("n2"), F.lit(0))

    def d(k: int) -> Column:
        raw = k - (k + 1) * y * F.col(f"n{k + 1}") / F.nullif(F.col(f"n{k}"), F.lit(0))
        return F.greatest(F.lit(0.0), F.least(F.lit(float(k)), F.coalesce(raw, F.lit(0.5 * k)))).alias(f"{order}{k}")

    return at.select("lang", d(1), d(2), d(3))


def discount_of(c: Column, order: str) -> Column:
    return F.when(c >= 3, F.col(f"{order}3")).when(c == 2, F.col(f"{order}2")).when(c == 1, F.col(f"{order}1")).otherwise(0.0)


def context(counts: DataFrame, key: Column, name: str) -> DataFrame:
    """Per (lang, context): the total of c and how many n-grams have c = 1, 2, 3 or more."""
    hits = [F.sum((F.col("c") == 1).cast("long")), F.sum((F.col("c") == 2).cast("long")), F.sum((F.col("c") >= 3).cast("long"))]
    return counts.groupBy("lang", key.alias(name)).agg(
        F.sum("c").alias(f"{name}_all"), *[h.alias(f"{name}_{k}") for k, h in enumerate(hits, 1)])


def saved_mass(name: str, order: str) -> Column:
    """The mass that discounting takes from a context, as a share; all of it for a context never seen."""
    mass = sum(F.col(f"{order}{k}") * F.col(f"{name}_{k}") for k in (1, 2, 3))
    return F.coalesce(mass / F.col(f"{name}_all"), F.lit(1.0))


def kept_share(c: Column, name: str, order: str) -> Column:
    return F.coalesce(F.greatest(c - discount_of(c, order), F.lit(0.0)) / F.col(f"{name}_all"), F.lit(0.0))


def gram_costs(grams: DataFrame) -> DataFrame:
    """(lang, shard, token, cost): -ln P(c | a b) of every trigram; languages without trusted text have none."""
    token = F.col("token")
    tri = grams.where("c > 0")
    last, ctx_ab, ctx_b = token.bitwiseAND(F.lit(MASK)), F.shiftright(token, BITS), None
    bi = tri.groupBy("lang", token.bitwiseAND(F.lit((1 << 2 * BITS) - 1)).alias("bc")).agg(F.count(F.lit(1)).alias("c"))
    ctx_b = F.shiftright(F.col("bc"), BITS)
    uni = bi.groupBy("lang", F.col("bc").bitwiseAND(F.lit(MASK)).alias("ch")).agg(F.count(F.lit(1)).alias("c"))
    all_ = context(uni, F.lit(0), "z").drop("z").join(uni.groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("v")), "lang")
    per_lang = all_.join(discounts(tri, "t"), "lang").join(discounts(bi, "b"), "lang").join(discounts(uni, "u"), "lang")
    rows = grams.select(
        "lang", "shard", "token", F.col("c").alias("c3"), ctx_ab.alias("ab"),
        token.bitwiseAND(F.lit((1 << 2 * BITS) - 1)).alias("bc"), last.alias("ch")).withColumn(
        "b", F.shiftright("bc", BITS))
    rows = rows.join(per_lang, "lang").join(context(tri, F.shiftright("token", BITS), "ab"), ["lang", "ab"], "left")
    rows = rows.join(bi.withColumnRenamed("c", "c2"), ["lang", "bc"], "left").join(
        context(bi, ctx_b, "b"), ["lang", "b"], "left").join(uni.withColumnRenamed("c", "c1"), ["lang", "ch"], "left")
    c1, c2 = F.coalesce("c1", F.lit(0)), F.coalesce("c2", F.lit(0))
    p1 = kept_share(c1, "z", "u") + saved_mass("z", "u") / F.col("v")
    p2 = kept_share(c2, "b", "b") + saved_mass("b", "b") * p1
    p3 = kept_share(F.col("c3"), "ab", "t") + saved_mass("ab", "t") * p2
    return rows.select("lang", "shard", "token", (-F.log(F.greatest(p3, F.lit(1e-12)))).alias("cost"))


def document_costs(table: DataFrame, costs: DataFrame) -> DataFrame:
    """(batch, docs, sums): postings rows meet their shard's costs, a shard with many batches in several tasks."""
    def run(_key: tuple, rows: pa.Table, values: pa.Table) -> pa.Table:
        model = {}
        for lang in values.column("lang").unique().to_pylist():
            part = values.filter(pa.compute.equal(values.column("lang"), lang))
            token = part.column("token").to_numpy()
            order = np.argsort(token)
            model[lang] = token[order], part.column("cost").to_numpy()[order]
        out = []
        for row in rows.to_pylist():
            if row["lang"] in model:
                token, cost = model[row["lang"]]
                at = np.searchsorted(token, unpack_numbers(row["tokens"]))
                out.append(partial_sums(row, cost[at], unpacked(row["counts"], row["n"])))
        columns = zip(*out) if out else ([], [], [])
        pa.default_memory_pool().release_unused()
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.binary(), pa.binary()))],
                        ["batch", "docs", "sums"])

    split = tasks_per_shard(table)
    rows = table.where(F.col("shard") != HEADER).select(
        "shard", F.pmod(F.xxhash64("batch"), F.lit(split)).cast("int").alias("cell"), "batch", "lang", "n", "tokens", "counts", "docs", "freqs")
    values = costs.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(split - 1))))
    return rows.groupBy("shard", "cell").cogroup(values.groupBy("shard", "cell")).applyInArrow(
        run, "batch string, docs binary, sums binary")


def score_quality(
    docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN, prior: int = PRIOR,
    key: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, n_chars, perplexity, threshold, kept.

    Trusted are all documents labelled quality 1 and not toxic. ``perplexity``
    is per character, a short text drawn to its language's mean by ``prior`` characters; ``threshold`` is the
    ``quantile`` of the language's trusted documents times exp(``margin``). A null or empty text has only an
    end to score. A null language is a language of its own; a language without trusted documents has null
    perplexity and threshold, and its documents are kept. Rows may repeat; other columns are not read.
    ``key``, a long, is returned as doc_id in its place.
    """
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    trusted = labels.where("doc_id is not null and quality = 1 and coalesce(toxic, 0) = 0").select("doc_id").distinct()
    if key is not None:
        trusted = docs.select("doc_id", key.alias("_key")).join(trusted, "doc_id").select(F.col("_key").alias("doc_id")).distinct()
    rows = docs.select(
        (F.col("doc_id") if key is None else key).alias("doc_id"), text_of().alias("text"),
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("~")).alias("lang"), F.lit(False).alias("trusted"))
    table = postings(rows, trigrams, shards)
    flagged = table.drop("flags").join(trusted_flags(table, trusted), "batch")
    costs = stored(gram_costs(stored(gram_counts(flagged), "grams")), "costs")
    scored = stored(sums_by_document(flagged, document_costs(table, costs)), "scored")

    sure = scored.where("trusted and size > 0")
    means = sure.groupBy("lang").agg((F.sum("total") / F.sum("size")).alias("mean"))
    smooth = (F.col("total") + prior * F.col("mean")) / (F.col("size") + prior)
    limits = sure.join(means, "lang").groupBy("lang").agg(
        F.first("mean").alias("mean"), (F.percentile_approx(smooth, quantile, 10000) + margin).alias("limit"))
    limits = stored(limits, "limits", 1)
    return scored.join(limits, "lang", "left").select(
        "doc_id", F.when(F.col("lang") != "~", F.expr("substring(lang, 2)")).alias("lang"),
        (F.col("size") - 1).alias("n_chars"), F.exp(smooth).alias("perplexity"), F.exp("limit").alias("threshold"),
        F.coalesce(smooth <= F.col("limit"), F.lit(True)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns; rows are told apart by a hash of their place."""
    docs = located(docs)
    key = F.xxhash64(*locator())
    bad = score_quality(docs, labels, key=key, **parameters).where("not kept").select(F.col("doc_id").alias("key"))
    places = docs.select(*locator()).withColumn("key", F.xxhash64("file", "row")).join(bad, "key", "left_semi")
    return rows_at(docs, places.select("file", "row"), "left_anti")
