"""Search, mixing, quality, URL filter, registered queries and the pipeline."""

import math
import os
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tideline.llm import queries
from tideline.llm.kneser_ney import keep_good, score_quality
from tideline.llm.mixing import hypergeometric, mix_plan, mix_sources, mixed_rows, split_quotas
from tideline.llm.packing import pack_documents
from tideline.llm.pivot_search import top_k
from tideline.llm.url_filter import bloom_cascade, filter_urls, member
from tideline.llm.util import stored

from samples import awkward_rows, prose

SF = "/root/testdata/sf0.001"


def brute_top(rows, k=5, every=3):
    rows = {r for r in rows if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])}
    ints = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows]
    out = []
    for i, v in ints:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ints if j != i and len(w) == len(v))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_top_k(spark):
    rng = np.random.default_rng(4)
    rows = [(i, tuple(map(float, np.float32(rng.normal(size=8) / 3)))) for i in range(200)]
    rows += [(300 + i, rows[7][1]) for i in range(40)]  # one vector many times
    rows += [(500, None), (501, (None, *rows[0][1][1:])), (502, (float("nan"), *rows[0][1][1:])), (503, (float("inf"), *rows[0][1][1:])),
             (504, (0.5,)), (507, (0.25,)), (510, (0.75,)), (513, ()), (516, ()), (None, rows[3][1]), rows[9]]
    df = spark.createDataFrame([(i, None if v is None else list(v)) for i, v in rows], "vec_id long, embedding array<float>").withColumn("v", F.lit(1))
    got = top_k(df, F.pmod("vec_id", F.lit(3)) == 0)
    assert sorted(map(tuple, got.collect())) == brute_top(rows)
    assert top_k(df.limit(0), F.lit(True)).count() == 0
    small = top_k(df, F.pmod("vec_id", F.lit(3)) == 0, block=16)
    assert sorted(map(tuple, small.collect())) == brute_top(rows)


def water_fill(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = {}, sum(sizes.values()), set(order)
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not full:
            return target | {s: level * w[s] for s in open_}
        target |= {s: float(most * sizes[s]) for s in full}
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def count_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mix(awkward):
    rows = awkward_rows()
    got = mix_sources(awkward, block_words=64, shard_levels=3).collect()
    again = mix_sources(awkward.repartition(5), block_words=64, shard_levels=3).collect()
    assert Counter(map(str, got)) == Counter(map(str, again))
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += count_words(t)
    target = water_fill(sizes)
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in got) == Counter(
        (i, count_words(t), sizes[s], round(target[s], 6)) for i, t, _, s in rows)
    assert all(r.taken == r.size * len(r.shards) <= 3 * r.size and all(0 <= x < 8 for x in r.shards) for r in got)
    source = {i: s for i, _, _, s in rows}
    taken, longest = Counter(), defaultdict(int)
    for r in got:
        taken[source[r.doc_id]] += r.taken
        longest[source[r.doc_id]] = max(longest[source[r.doc_id]], r.size * (2 if r.doc_id == 5 else 1))
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1 for s in sizes)
    drawn = mixed_rows(awkward, block_words=64, shard_levels=3)
    assert drawn.columns == awkward.columns
    assert Counter(r.doc_id for r in drawn.collect()) == sum((Counter({r.doc_id: len(r.shards)}) for r in got if r.shards), Counter())


def test_mix_edge_cases(spark, nothing, nameless):
    assert mix_sources(nothing).count() == 0 and mixed_rows(nothing).count() == 0
    got = mix_sources(nameless).collect()
    assert {r.source_size for r in got} == {9} and {r.target for r in got} == {9.0}
    blank = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "one two", "b")], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mix_sources(blank).collect()}
    assert (got[1].target, got[1].taken, got[3].target, got[3].taken) == (0.0, 0, 2.0, 2)


def test_quota_tree(spark):
    root = spark.createDataFrame([([40, 0, 7, 1000, 1],)], "quotas array<long>")
    leaves = split_quotas(root, 3, seed=5).collect()
    assert sorted(r.node for r in leaves) == list(range(8))
    assert np.sum([r.quotas for r in leaves], axis=0).tolist() == [40, 0, 7, 1000, 1]
    sizes = [sum(r.quotas) for r in leaves]
    assert min(min(r.quotas) for r in leaves) >= 0 and max(sizes) - min(sizes) <= 1


def test_hypergeometric_distribution(spark):
    n = 4000
    draws = spark.range(n).select(hypergeometric(F.lit(30), F.lit(100), F.lit(50), (F.col("id") + 0.5) / n).alias("x"))
    got = Counter(r.x for r in draws.collect())
    for k in range(31):
        want = math.comb(30, k) * math.comb(70, 50 - k) / math.comb(100, 50)
        assert abs(got[k] / n - want) < 1.01 / n


def plain_model(texts):
    """Interpolated modified Kneser-Ney of order 3 over characters, by the book."""
    tri = Counter()
    for t in texts:
        s = "\x02\x02" + t + "\x03"
        tri.update(s[i:i + 3] for i in range(len(s) - 2))
    bi = Counter(g[1:] for g in tri)
    uni = Counter(g[1:] for g in bi)

    def discount(counts):
        n = [sum(c == k for c in counts.values()) for k in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else None
        out = []
        for k in (1, 2, 3):
            raw = k - (k + 1) * y * n[k] / n[k - 1] if y is not None and n[k - 1] else 0.5 * k
            out.append(max(0.0, min(float(k), raw)))
        return lambda c: out[min(c, 3) - 1] if c else 0.0

    levels = [(tri, discount(tri)), (bi, discount(bi)), (uni, discount(uni))]

    def p(gram):
        if not gram:
            return 1 / (len(uni) + 1)
        counts, d = levels[3 - len(gram)]
        seen = [c for g, c in counts.items() if g[:-1] == gram[:-1]]
        lower = p(gram[1:])
        if not seen:
            return lower
        return max(counts[gram] - d(counts[gram]), 0) / sum(seen) + sum(map(d, seen)) / sum(seen) * lower

    return lambda t: sum(-math.log(p(("\x02\x02" + t + "\x03")[i:i + 3])) for i in range(len(t) + 1)) / (len(t) + 1)


def test_perplexity_by_the_book(spark):
    docs = [(i, prose(i, 12)) for i in range(8)] + [(20, "zzz qq"), (21, ""), (22, None)]
    df = spark.createDataFrame([(i, t, "en") for i, t in docs], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6)] + [(6, 1, 1), (7, 0, 0), (None, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    cost = plain_model([t for i, t in docs if i < 6])
    got = {r.doc_id: r for r in score_quality(df, labels, prior=0).collect()}
    for i, t in docs:
        assert math.log(got[i].perplexity) == pytest.approx(cost(t or ""), rel=1e-6)


def test_quality_separates(spark, awkward, nothing, nameless):
    good = [(i, prose(i, 150), "en") for i in range(60)]
    junk = [(100 + i, " ".join(f"{w}$#%" for w in prose(i, 100).upper().split()), "en") for i in range(10)]
    df = spark.createDataFrame(good + junk, "doc_id long, text string, lang string").withColumn("total", F.lit(1))
    labels = spark.createDataFrame([(i, int(i < 40), 0) for i in [*range(40), *range(100, 105)]], "doc_id long, quality int, toxic int")
    kept = keep_good(df, labels)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == list(range(60))
    scored = score_quality(awkward, labels.where("doc_id < 30")).collect()
    assert len(scored) == len(awkward_rows())
    assert all(r.kept and r.perplexity is None for r in scored if r.lang in ("fr", "xx", None))
    assert score_quality(nothing, labels).count() == 0
    assert score_quality(awkward, labels.limit(0)).where("kept").count() == len(awkward_rows())
    assert keep_good(nameless, labels).count() == 4


def test_cascade_is_exact(spark):
    universe = spark.range(3000).select(F.col("id").cast("string").alias("key"))
    for listed in (universe.where("key % 50 = 0"), universe.where("key % 2 = 0"), universe, universe.limit(0)):
        levels = bloom_cascade(listed, universe)
        got = {r.key for r in universe.where(member(levels, F.col("key"))).collect()}
        assert got == {r.key for r in listed.collect()}


def test_urls(spark):
    urls = [(1, "HTTP://A.Example.ORG/es/x?q"), (2, "http://example.org/en/12#t"), (3, "http://example.org"), (4, "https://x.com/fr/"),
            (5, "https://x.com/de/y"), (6, None), (7, "no scheme"), (8, "http://badcom/de/"), (9, "x://spam.net?a=/de/"), (9, "x://spam.net?a=/de/"),
            (10, "http://org/e"), (11, "http://É.COM/fr/é#")]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit("z")).withColumn("rule", F.lit(1))
    listed = spark.createDataFrame([("spam.net",), ("spam.net",), ("elsewhere.net",), (None,)], "key string")
    got = Counter(map(tuple, filter_urls(pages, listed).collect()))
    assert got == Counter([
        (1, "a.example.org", "/es/x", "example.org/es/", "block"), (2, "example.org", "/en/12", "example.org/en/1", "block"),
        (3, "example.org", "", None, "allow"), (4, "x.com", "/fr/", "com/fr/", "allow"), (5, "x.com", "/de/y", "com/de/", "block"),
        (6, "", "", None, "allow"), (7, "", "", None, "allow"), (8, "badcom", "/de/", None, "allow"), (9, "spam.net", "", None, "block"),
        (9, "spam.net", "", None, "block"), (10, "org", "/e", "org/", "allow"), (11, "É.com", "/fr/é", "com/fr/", "allow")])
    assert filter_urls(pages.limit(0), listed).count() == 0
    assert {r.verdict for r in filter_urls(pages, listed.limit(0)).where("page_id = 9").collect()} == {"allow"}


needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in queries.ORACLES:
        sys.path.insert(0, os.path.join(os.path.dirname(corpus_pipeline.__file__), "tools"))
        from check import canonical, oracle

        cursor = oracle(SF).execute(queries.ORACLES[name])
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert canonical(df.columns, rows) == canonical(columns, cursor.fetchall())


@needs_tables
def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mix", "pack"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start, columns = docs.count(), docs.columns
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), "stage")
        assert docs.columns == columns
        sizes.append(docs.count())
    assert start > sizes[0] >= sizes[1] >= sizes[2] > 0 and docs.select("doc_id").distinct().count() <= sizes[2]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.where("piece = 0").count() == docs.count() == sizes[3]
    assert corpus_pipeline.run(spark, SF).count() == last.count()
    assert last.columns == pack_documents(docs, queries.vocabulary("word_bpe_49k.json")).columns


def test_plan_without_sources(spark):
    empty = spark.createDataFrame([], "key string, h long, size long")
    assert mix_plan(empty).count() == 0


def test_every_trusted_row_counts(spark):
    """A language whose trusted rows hash behind 200,000 others has a model and a threshold."""
    last = [r.id for r in spark.range(200_400).orderBy(F.xxhash64("id").desc()).limit(40).collect()]
    docs = [(i, prose(i, 120), "rare") for i in last] + [(900_000, " ".join(f"{w}$#%" for w in prose(1, 100).upper().split()), "rare")]
    labels = spark.range(200_400).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in score_quality(df, labels).collect()}
    assert all(r.threshold is not None for r in got.values()) and not got[900_000].kept
    assert 900_000 not in {r.doc_id for r in keep_good(df, labels).collect()}


def test_threshold_is_near_the_quantile(spark):
    """At most 0.1 nats on top of what trusted documents of the language reach."""
    df = spark.createDataFrame([(i, prose(i, 30 + i), "en") for i in range(50)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    got = score_quality(df, labels).collect()
    assert 0 <= math.log(got[0].threshold) - math.log(max(r.perplexity for r in got if r.doc_id < 30)) < 0.1
