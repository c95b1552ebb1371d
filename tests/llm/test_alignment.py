"""Tokenizer alignment against the two tokenizers and a token by token comparison."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tideline.llm import alignment
from tideline.llm.alignment import Aligner, align_tokenizers, aligned_texts, aligner, byte_level_bytes, piece_bytes

from samples import awkward_rows, prose

vocabularies = pytest.importorskip("public_tokenizers")
A, B = vocabularies.path("byte_bpe_50k.json"), vocabularies.path("piece_bpe_32k.model")
ODD = ["", " ", "\n", "  a  b\n\n c\t\td \n", "a\x1eb  c \n x", "<s> hi </s> z", "é日本語 　 x", "x \r\n y\n\n\n\n z", "\t x\t y",
       "it's, don't. 'tis a 's!? word,. (end), x!!!", "a <|endoftext|> b<|endoftext|>", "1,234.5 a,b.c ... !? ,", "\n\nstart", "end  ",
       "sign ▁ of blanks", "a▁b", "x\x00y", "x 　 y", ";\r\n}\r\n x", "tab\t  two", "😀 👍🏽 ok", "a  b  c"]


def tokens(text):
    """Ids and byte ends of both sides, or nothing."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    tokenizer, model = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    tokenizer.encode_special_tokens = True
    tables = byte_level_bytes(A), piece_bytes(B)
    for t in [text] if isinstance(text, str) else text:
        sides = tokenizer.encode(" " + t, add_special_tokens=False).ids, model.encode(t)
        spans = [[table[i] for i in ids] for ids, table in zip(sides, tables)]
        if not t or any(b"".join(s) != (" " + t).encode() for s in spans):
            yield None
        else:
            yield [[(i, end - len(x), end) for i, x, end in zip(ids, s, np.cumsum([len(x) for x in s]).tolist())]
                   for ids, s in zip(sides, spans)]


def brute(texts):
    found = list(tokens([t or "" for t in texts]))
    links = [[] if f is None else [(a, b) for a, s, e in f[0] for b, s2, e2 in f[1] if s < e2 and s2 < e] for f in found]
    count = Counter(x for row in links for x in row)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for f, row in zip(found, links):
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        cuts = sorted({e for *_, e in f[0]} & {e for *_, e in f[1]})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, _ in side if start <= s < cut) for side in f))
            start = cut
        out.append((len(f[0]), len(f[1]), len(cuts), len(row), sum(count[x] == best[x[1]] for x in row),
                    sum(count[x] for x in row), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


TEXTS = ODD + [(t or "")[:1500] for _, t, *_ in awkward_rows()]


def test_chunks_align_as_whole_texts():
    align, want = aligner(A, B), brute(TEXTS)
    for _ in range(2):  # the second time from memory
        codes, at, found = aligned_texts(pa.array(TEXTS), align, strings=True)
        got = [found.n[:, codes[s:e]].sum(axis=1).tolist() for s, e in zip(at[:-1], at[1:])]
        assert got == [list(w[:4]) for w in want]
        lines = [";".join(found.groups.take(pa.array(codes[s:e])).to_pylist()) for s, e in zip(at[:-1], at[1:])]
        assert [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in lines] == [w[6] for w in want]


def rows(df):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


@pytest.mark.parametrize("limits", [{}, {"pairs_per_bucket": 100, "buckets_per_round": 5}])
def test_against_every_overlap(spark, monkeypatch, limits):
    """One round, and several; with more tasks than are added at once."""
    monkeypatch.setattr(alignment, "FAN_IN", 2)
    texts = [*TEXTS, None, prose(4, 30), prose(4, 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for name in ("file", "row", "part", "pairs"):
        docs = docs.withColumn(name, docs.doc_id)
    assert rows(align_tokenizers(docs, A, B, **limits)) == Counter((i, *w) for i, w in enumerate(brute(texts)))


def test_edge_cases(awkward, nameless, nothing):
    got = rows(align_tokenizers(nameless, A, B))
    assert sum(got.values()) == 4 and {k[0] for k in got} == {None, 1} and got[(None, 0, 0, 0, 0, 0, 0, "")] == 1
    assert align_tokenizers(awkward, A, B).count() == len(awkward_rows())
    assert align_tokenizers(nothing, A, B).count() == 0


def test_words_reach_neither_tokenizer_twice(monkeypatch):
    """A word goes to the model of A without the rest of its tokenizer, and a second pass asks neither side."""
    align, given = Aligner(A, B), []

    class Counting:
        def __getattr__(self, name):
            return getattr(tokenizer, name)

        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return tokenizer.encode_batch_fast(texts, **options)

    tokenizer = align.encoder.tokenizer
    monkeypatch.setattr(align.encoder, "tokenizer", Counting())
    words = [f"{a}{b}é{c}" for a in "bcdfgh" for b in "aeiou" for c in ("", "lich", ",", "!?", ".\n")]
    texts = pa.array([" ".join(words), " ".join(reversed(words)) + " don't"])
    first = aligned_texts(texts, align, strings=True)
    assert sum(map(len, given)) < 100  # of about 700
    monkeypatch.setattr(align.recall, "learn", None)
    given.clear()
    again = aligned_texts(texts, align, strings=True)
    assert not given and first[2].groups.equals(again[2].groups) and (first[0] == again[0]).all()
    lines = alignment.joined(first[2].groups, first[0], first[1], ";").to_pylist()
    assert [hashlib.sha256(x.encode()).hexdigest() for x in lines] == [r[-1] for r in brute(texts.to_pylist())]
