"""Personal data: the rules against plain scans, the model by sequences of labels and on held-out spellings."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tideline.llm.pii import (
    KINDS, LABELS, NEVER, Crf, Words, base_spans, crf_spans, examples, find_personal_data, labelled_stretches, luhn, spellings,
    transitions_allowed,
)

from samples import awkward_rows, prose

CARD, ADDRESS = "4539578763621486", "someone.12@mail4.example.com"


def plain(text):
    """The rules once more, straight from their statement."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if max(map(int, m.group().split("."))) <= 255:
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def line(seed):
    """A text with one span of each kind, some numbers that are none, and junk around them."""
    rng = random.Random(seed)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    body = number(15)
    card = next(body + str(d) for d in range(10) if luhn(body + str(d)))
    parts = [f"{rng.choice(['ann', 'jo', 'kim'])}.{number(2)}@mail{rng.randrange(9)}.example.com", ".".join(str(rng.randrange(256)) for _ in range(4)),
             card, f"+1 ({number(3)}) 555-{number(4)}", number(16), f"token = \"{rng.randbytes(20).hex()}\"", f"{number(2)}:{number(2)}", f"v{number(1)}.{number(2)}"]
    rng.shuffle(parts)
    return " ".join(f"{prose(seed * 20 + i, 9)} {p}{rng.choice(['', '', '###', ','])}" for i, p in enumerate(parts)) + " " + prose(seed, 5)


EDGES = ["", " ", "no marks", "1.2.3.4.5 300.1.1.1 1.2.3.256 001.002.003.004 1.2.3", f"{CARD} 4539-5787-6362-1486 4539 5787 6362 1486 4539578763621487",
         "0" * 12 + " " + "0" * 25, f"x@y x@y.z é{ADDRESS}é a@b.c@d.e ..@-.-", "+12345678 +123456789 +1 2 3 4 5 6 7 8 9 0 +1 (136) 555-7479 0810992847249404",
         "+1234567890123456", "1" * 5000, "é日本 +49 (30) 123 456 78.", "9" * 400 + ".1.1.1", "١٢٣٤٥٦٧٨٩٠١٢٣"]


def test_rules():
    for text in [*EDGES, *map(line, range(40)), *(t or "" for _, t, *_ in awkward_rows())]:
        assert base_spans(text) == plain(text)
    assert luhn(CARD) and not luhn(CARD[:-1] + "7") and not base_spans(EDGES[4])  # runs of numbers with blanks are one match


def test_decoding_is_the_best_of_all_sequences():
    rng = np.random.default_rng(0)
    model, allowed = Crf(), transitions_allowed()
    model.weights, model.follow = rng.normal(size=model.weights.shape), rng.normal(size=model.follow.shape)
    sentences = [["a1", "+1", "b@c"], ["x"], ["7.7", "9", "a1", "q"], ["+1", "+1"]]
    got, at = model.decode(sentences), 0
    follow = model.follow + allowed
    for words in sentences:
        emit = Words([words]).emissions(model.weights)

        def score(path, emit=emit):
            steps = zip((LABELS, *path), path)
            return sum(emit[i, y] for i, y in enumerate(path)) + sum(follow[x, y] for x, y in steps)

        best = max(itertools.product(range(LABELS), repeat=len(words)), key=score)
        assert tuple(got[at:at + len(words)].tolist()) == best
        at += len(words)


def test_expectations_by_all_sequences():
    rng = np.random.default_rng(1)
    model, allowed = Crf(), transitions_allowed()
    model.weights, model.follow = rng.normal(size=model.weights.shape), rng.normal(size=model.follow.shape)
    sentences = [["a1", "+1", "b@c"], ["x"], ["9", "9"]]
    words = Words(sentences)
    marginal, expected = model.expectations(words, list(words.steps()), allowed)
    emit, follow, want, at, pairs = words.emissions(model.weights), model.follow + allowed, np.zeros_like(marginal), 0, np.zeros_like(expected)
    for s in sentences:
        paths = list(itertools.product(range(LABELS), repeat=len(s)))
        scores = np.array([sum(emit[at + i, y] for i, y in enumerate(p)) + sum(follow[x, y] for x, y in zip((LABELS, *p), p)) for p in paths])
        chance = np.exp(scores - scores.max())
        chance /= chance.sum()
        for p, c in zip(paths, chance):
            for i, (x, y) in enumerate(zip((LABELS, *p), p)):
                want[at + i, y] += c
                pairs[x, y] += c
        at += len(s)
    assert np.allclose(marginal, want) and np.allclose(expected, pairs) and NEVER < -1e8


def test_held_out_spellings():
    """Spellings of texts that the model has not seen are found, other numbers are left alone."""
    pairs = [x for s in range(150) for x in examples(line(s))]
    model = Crf().fit([w for w, _ in pairs], [y for _, y in pairs])
    assert np.array_equal(model.weights, Crf().fit([w for w, _ in pairs], [y for _, y in pairs]).weights)
    found = wanted = extra = 0
    for seed in range(1000, 1040):
        text = line(seed)
        new = []
        for s, k, e in reversed(base_spans(text)):
            ways = spellings(KINDS[k], text[s:e])
            other = " " + ways[seed % len(ways)] + " "
            text = text[:s] + other + text[e:]
            new = [(s + 1, k, s + len(other) - 1)] + [(a + len(other) - (e - s), b, c + len(other) - (e - s)) for a, b, c in new]
        got = crf_spans([text], model)[0]
        wanted += len(new)
        found += len(set(new) & set(got))
        extra += sum(not any(s < y[2] and y[0] < e for y in new) for s, _, e in got)
    assert wanted >= 150 and found > 0.95 * wanted and extra <= 0.02 * wanted


def test_query(spark, nameless, awkward, nothing):
    texts = [*map(line, range(60)), *EDGES, None, line(3), "call (555) 123-4567 or jo.77(at)mail3.example.com today"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).withColumn("words", F.lit("mine"))
    got = {r.doc_id: r for r in find_personal_data(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        spans = plain(text or "")
        names = [f"{KINDS[k]}:{s}:{e}" for s, k, e in spans]
        counts = Counter(k for _, k, _ in spans)
        assert [got[i][f"n_{k}"] for k in KINDS] == [counts[k] for k in range(4)]
        assert got[i].base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(got[i].spans.split(","))
    assert got[len(texts) - 1].spans == "phone:5:19,email:23:49"
    assert find_personal_data(awkward).count() == len(awkward_rows()) and find_personal_data(nothing).count() == 0
    assert Counter((r.doc_id, r.spans) for r in find_personal_data(nameless).collect()) == Counter({(None, ""): 3, (1, ""): 1})
    assert labelled_stretches(nothing).count() == 0
