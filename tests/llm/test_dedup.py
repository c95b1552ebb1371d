"""Exact, near and substring deduplication against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tideline.llm.chunk_dedup import chunk_texts, repeated_passages, without_repeats
from tideline.llm.exact_dedup import exact_dedup, keep_first_copies
from tideline.llm.hamming import Forest, components, link_bucket
from tideline.llm.simhash import fingerprint, keep_one_of_each, shingle_hashes, simhash_components

from samples import awkward_rows, prose


def check_exact(rows, got):
    texts = defaultdict(list)
    for doc_id, text, *_ in rows:
        texts[text or ""].append(doc_id)
    want = Counter()
    for text, ids in texts.items():
        top = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        want.update((i, top, len(ids), digest) for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert Counter(r.text_sha256 for r in kept) == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in texts})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact(awkward):
    check_exact(awkward_rows(), exact_dedup(awkward).collect())


def test_exact_over_several_batches_with_colliding_digests(awkward):
    weak = lambda t: F.encode(F.substring(t, 1, 1), "UTF-8")
    check_exact(awkward_rows(), exact_dedup(awkward, digest=weak, files_per_batch=1).collect())


def test_exact_without_ids(nameless):
    rows = [tuple(r) for r in nameless.collect()]
    got = exact_dedup(nameless).collect()
    check_exact(rows, got)
    assert sum(r.kept for r in got) == 2


def test_exact_empty(nothing):
    assert exact_dedup(nothing).count() == 0
    assert keep_first_copies(nothing).columns == nothing.columns


def test_exact_rows(awkward):
    kept = keep_first_copies(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == len({t or "" for _, t, *_ in awkward_rows()})


def brute_components(rows, limit):
    prints = [(i, fingerprint((t or "").encode(), 4, 1, False)[0] & (1 << 64) - 1) for i, t in rows]
    label = list(range(len(prints)))
    for a, (_, x) in enumerate(prints):
        for b in range(a):
            if (x ^ prints[b][1]).bit_count() <= limit and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if v == old else v for v in label]
    smallest = {}
    for v, (i, _) in zip(label, prints):
        if i is not None:
            smallest[v] = min(i, smallest.get(v, i))
    return Counter((i, f"{p:016x}", smallest.get(v)) for v, (i, p) in zip(label, prints))


def test_fingerprint_by_hand():
    words = b"a b c d e".split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), seed=42) for i in (0, 1)]
    assert shingle_hashes(b"A b\tC d\x0be", 4).tolist() == hashes
    assert fingerprint(b"A b C d e", 4, 1, False)[0] & (1 << 64) - 1 == hashes[0] & hashes[1]  # over half of two is both
    assert fingerprint(b" \n", 4, 2, False) == [0, 0]
    assert shingle_hashes(b"x y", 4).tolist() == [xxhash.xxh64_intdigest(b"x y", seed=42)]


def test_simhash(awkward, nameless, nothing):
    rows = [(i, t) for i, t, *_ in awkward_rows()]
    got = simhash_components(awkward).collect()
    assert Counter(map(tuple, got)) == brute_components(rows, 4)
    got = simhash_components(nameless).collect()
    assert Counter(map(tuple, got)) == brute_components([(r.doc_id, r.text) for r in nameless.collect()], 4)
    assert simhash_components(nothing).count() == 0


def test_simhash_links_of_five_bits(spark):
    base = prose(1, 40).split()
    texts = [" ".join(base[:k] + ["other"] + base[k + 1:]) for k in range(0, 40, 3)] + [" ".join(base)] * 2 + [prose(s, 30) for s in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for limit in (0, 3, 5):
        got = simhash_components(docs, limit=limit).collect()
        assert Counter(map(tuple, got)) == brute_components(list(enumerate(texts)), limit)


def test_large_bucket_keeps_components():
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 64, 3, dtype=np.uint64)
    prints = np.concatenate([s ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) for s in seeds])
    nodes, forest = np.arange(len(prints)), Forest()
    link_bucket(nodes, prints.reshape(-1, 1), 2, forest)
    roots = [forest.root(i) for i in range(600)]
    assert [len(set(roots[k:k + 200])) for k in (0, 200, 400)] == [1, 1, 1] and len(set(roots)) == 3
    assert len(forest.new) == 597


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (95, 95)], "a long, b long")
    got = dict(map(tuple, components(links).collect()))
    assert got == {**{i: 0 for i in range(1, 41)}, 95: 90, 100: 90}


def test_near_copies(spark):
    """One row of each component stays, the one with the smallest doc_id, as brute force has the components."""
    base = [prose(s, 300).split() for s in range(12)]
    docs = [(s, " ".join(b)) for s, b in enumerate(base)]
    docs += [(100 + s, " ".join([*b[:s * 9], "changed", *b[s * 9 + 1:]])) for s, b in enumerate(base)]
    docs += [(500, None), (501, "short one"), (502, "short one")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("p0", "file", "row", "first"):
        df = df.withColumn(name, F.lit("mine"))
    kept = keep_one_of_each(df)
    assert kept.columns == df.columns and {r.file for r in kept.collect()} == {"mine"}
    want = sorted({c for _, _, c in brute_components(docs, 4)})
    assert sorted(r.doc_id for r in kept.collect()) == want and len(want) < 20


def test_near_edge_cases(awkward, nameless, nothing):
    assert {r.text for r in keep_one_of_each(nameless).collect()} == {"same words here", None}
    ids = [r.doc_id for r in keep_one_of_each(awkward).select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and {3, 200, 203, 204, 300} <= set(ids) and not {100, 201, 301} & set(ids)
    assert keep_one_of_each(nothing).count() == 0


def test_chunks_cover_texts():
    texts = [prose(1, 500).encode(), b"", "é日本語 ß".encode() * 300, b"the " * 1000, b"x" * 5000]
    *_, owner, span = chunk_texts(texts)
    for i, text in enumerate(texts):
        at = 0
        for s in span[owner == i].tolist():
            assert s >> 32 == at
            at += s >> 21 & 0x7FF
            text[:at].decode()
        assert at == len(text)


def test_passages(spark):
    passage = prose(1000, 60)
    docs = [(s, prose(s, 150 + s)) for s in range(10)]
    docs += [(20 + s, prose(50 + s, 80 + 3 * s) + " " + passage + "\n" + prose(80 + s, 90)) for s in range(6)]
    docs += [(40, prose(2, 152)[:60] + " " + prose(200, 100))]  # ten words shared with document 2
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = repeated_passages(df).collect()
    assert {r.doc_id for r in got} == set(range(20, 26))
    assert min(r.first_doc_id for r in got) == 20 and all(r.first_doc_id <= r.doc_id for r in got)
    texts = {i: t.encode() for i, t in docs}
    assert all(len(set(texts[r.doc_id][r.start:r.start + r.length].split()) & set(passage.encode().split())) > 5 for r in got)
    cleaned = dict(map(tuple, without_repeats(df).collect()))
    assert cleaned[20] == docs[10][1] and sum(len(cleaned[i]) < len(texts[i]) - 100 for i in range(21, 26)) > 2
    assert all(cleaned[i] == t for i, t in docs[:10])


def test_passage_edge_cases(awkward, nameless, nothing):
    ids = {r.doc_id for r in repeated_passages(awkward).collect()}
    assert {8, 205, 300, 302} <= ids and not {100, 200, 201, 202, 203, 204} & ids  # 100 is a copy of 41 words
    assert 5 not in ids  # its rows are one document
    assert repeated_passages(nameless).count() == 0 and repeated_passages(nothing).count() == 0
    assert without_repeats(awkward).columns == awkward.columns


def test_no_passage_is_lost_everywhere(spark):
    """A run whose chunks have several first holders is cut chunk by chunk."""
    opening, body = prose(900, 14), " ".join(f"{w}{k}" for k, w in enumerate(prose(901, 400).split()))
    x, y, z = (" ".join(f"{w}{k}{n}" for k, w in enumerate(prose(910 + k, 45).split())) for k, n in enumerate("xyz"))
    docs = [(1, f"{opening} {prose(902, 60)}"), (5, f"{opening} {body}"), (9, f"{opening} {body}"),
            (11, f"{x} {y}"), (15, f"{x} {y} {z}"), (19, f"{y} {z}")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    cleaned = dict(map(tuple, without_repeats(df).collect()))
    assert cleaned[5].endswith(body) and len(cleaned[9]) < 100
    assert sum(len(cleaned[i]) for i in (11, 15, 19)) < sum(map(len, (x, y, z, y, z)))
    holders = defaultdict(list)
    for i, text in docs:
        for d in chunk_texts([text.encode()])[0].tolist():
            holders[d].append(i)
    texts = {i: t.encode() for i, t in docs}
    for r in repeated_passages(df).collect():
        digests, *_, span = chunk_texts([texts[r.doc_id]])
        held = Counter()
        for d, s in zip(digests.tolist(), span.tolist()):
            if r.start <= s >> 32 < r.start + r.length:
                held[min(holders[d])] += s >> 14 & 127
        assert held[r.first_doc_id] == max(held.values()) and sum(held.values()) - held[r.first_doc_id] < 16
    for i, text in texts.items():
        *_, span = chunk_texts([text])
        for s in span.tolist():
            chunk = text[s >> 32:(s >> 32) + (s >> 21 & 0x7FF)].decode()
            assert any(chunk in t for t in cleaned.values())


def test_texts_are_cut_by_themselves():
    texts = [prose(i, 40 + i).encode() for i in range(20)] + [b"", "é日本".encode() * 40, b"x"]
    together = [[c.tolist() for c in chunk_texts(texts)[:2]], chunk_texts(texts)[3].tolist()]
    alone = [chunk_texts([t]) for t in texts]
    assert together == [[[x for a in alone for x in a[i].tolist()] for i in (0, 1)], [x for a in alone for x in a[3].tolist()]]


def passages_of(df):
    return Counter(map(tuple, repeated_passages(df).select("doc_id", "start", "length", "words", "first_doc_id").collect()))


def test_passages_in_any_order_and_of_shared_ids(spark):
    passage = prose(1000, 70)
    docs = [(s % 9, prose(s, 90 + s) + (" " + passage + " " + prose(s + 50, 40) if s % 2 else "")) for s in range(24)]  # doc_ids repeat
    docs += [(None, prose(70, 50) + " " + passage), (None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("doc", "text_hash", "cuts"):
        df = df.withColumn(name, F.lit("mine"))
    want = passages_of(df.coalesce(1))
    assert sum(want.values()) >= 12
    for seed in (1, 2):
        assert passages_of(df.orderBy(F.rand(seed)).repartition(3 + seed)) == want
    cleaned = without_repeats(df)
    assert cleaned.columns == df.columns and {r.cuts for r in cleaned.collect()} == {"mine"}
    # what a row has for itself stays, whatever rows share its doc_id
    for (doc_id, text), own in ((d, d[1].replace(passage, "")) for d in docs if d[1]):
        assert any(r.doc_id == doc_id and set(own.split()) <= set(r.text.split()) for r in cleaned.collect()), text[:40]


def test_repeats_of_fifty_words_by_brute_force(spark):
    """Documents that share 58 words in a row with another are all found; those that share fewer than 35 are not."""
    rng = np.random.default_rng(5)
    fresh = lambda n: " ".join(f"{a}{b}" for a, b in zip(rng.integers(0, 10**6, n), rng.choice(list("aeiou"), n)))
    shared = [fresh(n) for n in (58, 75, 120, 60, 34, 30, 20)]
    docs = [(i, f"{fresh(int(rng.integers(20, 90)))} {shared[i % 7]} {fresh(int(rng.integers(0, 60)))}") for i in range(70)]
    docs += [(100 + i, fresh(150)) for i in range(20)]
    grams = defaultdict(lambda: defaultdict(set))
    for n in (58, 35):
        for i, text in docs:
            words = text.split()
            for k in range(len(words) - n + 1):
                grams[n][" ".join(words[k:k + n])].add(i)
    repeated = {n: {i for holders in grams[n].values() if len(holders) > 1 for i in holders} for n in grams}
    got = {r.doc_id for r in repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert repeated[58] <= got <= repeated[35] and len(repeated[58]) == 40
