"""Token counts, stores and packing against the tokenizers themselves."""

import json
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tideline.llm.packing import nnls, pack_documents, packed_sequences, patterns, plan
from tideline.llm.token_counts import piece_model, token_counts
from tideline.llm.token_store import PerfectHash, fetch, write_store
from tideline.llm.tokens import Encoder, Memory, Rows, chunk_lists, encoder, slices, word_table
from tideline.session import new_dir

from samples import awkward_rows

vocabularies = pytest.importorskip("public_tokenizers")
BYTES, WORDS = (vocabularies.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECES = vocabularies.path("piece_bpe_32k.model")
ODD = ["", " ", "\n", "  a  b\n\n c\t\td \n", "a\x1eb  c \n x", "<s> hi </s> z", "é日本語 　 x", "x \r\n y\n\n\n\n z",
       "it's, don't. 'tis a 's!? word,. (end), x!!!", "é café, Å.", "a <|endoftext|> b<|endoftext|>", "ǅ İstanbul ΣΑΣ",
       "1,234.5 a,b.c ... !? ,", " a  b   c", "x\x1c\x1dy \x1f z", "<|startoftext|>q"]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_are_those_of_whole_texts(path):
    texts = ODD + [t or "" for _, t, *_ in awkward_rows()]
    encode = encoder(path)
    for _ in range(2):  # the second time from memory
        for group in (texts, texts[:1], [*reversed(texts)], *[[t] for t in ODD]):
            ids, ends = encode(pa.array(group))
            want = encode.tokenizer.encode_batch(group, add_special_tokens=False)
            assert [ids[s:e].tolist() for s, e in zip(ends[:-1], ends[1:])] == [w.ids for w in want]


class Counting:
    """A tokenizer that says how many bytes the whole of it was given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode_batch_fast(self, texts, **options):
        self.given += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_are_spelt_for_the_model_alone(path):
    letters = [c for c in map(chr, range(192, 256)) if c not in "×÷"]
    words = [f"{a}{b}{c}" for a in ["x", "QU", *letters] for b in letters for c in ("", "heit")]
    odd = ["e\u0301t", "µm", "ªb", "Ÿ", "ſt", "don't", "'re", "x'll,", "a=\u0338", "b|", "<|", "x<|endoftext|>y", "a1", "×", "A\u030a"]
    texts = [" ".join(words[i::16]) for i in range(16)] + [
        "\n".join(w + e for w in words[::97]) for e in ["", ",", "!?", "###", '("', "_[", "..."]] + [" ".join(odd), "\n".join(odd)]
    encode = Encoder(path, "<|endoftext|>")
    encode.tokenizer = Counting(encode.tokenizer)
    ids, ends = encode(pa.array(texts[:16]))
    assert encode.tokenizer.given < 1000  # of 142,553
    for some in (texts[:16], texts, texts[16:]):
        ids, ends = encode(pa.array(some))
        want = encode.alone.encode_batch(some, add_special_tokens=False)
        assert [ids[s:e].tolist() for s, e in zip(ends[:-1], ends[1:])] == [w.ids for w in want]


def test_other_vocabularies_are_given_whole(tmp_path):
    definition = json.loads(open(BYTES).read())
    definition["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "v.json").write_text(json.dumps(definition))
    assert word_table(definition) is None and Encoder(str(tmp_path / "v.json"), "<|endoftext|>").spelling is None
    named = json.loads(open(BYTES).read())
    named["added_tokens"].append(named["added_tokens"][0] | {"content": "Pad"})
    assert word_table(named) is None


def test_memory_keeps_what_was_asked_for_last():
    learned = []

    def learn(keys):
        learned.extend(keys.to_pylist())
        return [Rows.of([[len(k)] * (int(k) % 3) for k in keys.to_pylist()])]

    memory = Memory(learn, most=10)
    for keys in (range(8), range(4), range(20, 24), range(30, 34), range(4), [], range(40, 80), range(40, 80)):
        names = [str(k) for k in keys]
        place, (rows,) = memory(pa.array(names, pa.string()))
        got = rows.take(place)
        assert [got.ids[s:e].tolist() for s, e in zip(got.at[:-1], got.at[1:])] == [[len(k)] * (int(k) % 3) for k in names]
        assert len(memory.keys) == len(memory.asked) == len(memory.sides[0].at) - 1 <= 10
    assert learned.count("0") == learned.count("20") == 1 == learned.count("40") and learned.count("1") == learned.count("79") == 2


def test_chunks_are_known_after_many_others():
    """Chunks of earlier batches are not encoded again when half a million others came since."""
    encode = Encoder(BYTES, "<|endoftext|>")
    first, *others = [pa.array([" ".join(f"a{i}" for i in range(s, s + 1000)) for s in range(k, k + 160_000, 1000)]) for k in (0, 160_000, 320_000)]
    ids, _ = encode(first)
    for more in others:
        encode(more)
    encode.tokenizer = Counting(encode.tokenizer)
    again, _ = encode(first)
    assert encode.tokenizer.given == 0 and (ids == again).all()


def test_chunks_and_slices():
    texts = pa.array(ODD)
    assert ["".join(c) for c in chunk_lists(texts).to_pylist()] == [t if "\x1e" in t else t for t in ODD]
    assert pa.concat_arrays(slices(texts, 8)).equals(texts) and not list(slices(texts.slice(0, 0)))


def test_counts(spark, awkward, nameless, nothing):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string").unionByName(awkward.select("doc_id", "text"))
    texts = [(i, t) for i, t in enumerate(ODD)] + [(i, t) for i, t, *_ in awkward_rows()]
    model = piece_model(PIECES)
    want = Counter((i, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 300) for i, t in texts)
    assert Counter(map(tuple, token_counts(docs, PIECES, limit=300).collect())) == want
    assert token_counts(awkward, PIECES).count() == len(awkward_rows())
    assert Counter(r.doc_id for r in token_counts(nameless, PIECES).collect()) == Counter([None, None, None, 1])
    assert token_counts(nothing, PIECES).count() == 0


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(2).integers(-(1 << 62), 1 << 62, 5000))
    hash_ = PerfectHash.build(keys)
    assert sorted(hash_.slots(keys)) == list(range(len(keys)))
    assert PerfectHash.build(keys[:0]).slots(keys).max() == -1


def test_store(spark, awkward, nameless, nothing):
    encode = encoder(BYTES).tokenizer.encode
    for docs in (awkward, nameless, nothing):
        path = new_dir(spark, "store")
        write_store(docs, path, BYTES, end_id=2)
        got = fetch(spark, path, docs).collect()
        rows = [(r.doc_id, encode(r.text or "", add_special_tokens=False).ids + [2]) for r in docs.select("doc_id", "text").collect()]
        assert Counter((r.doc_id, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in got) == Counter(
            (i, len(x), crc(x), np.array(x, "<u4").tobytes()) for i, x in rows)
        at = 0
        for r in sorted(got, key=lambda r: r.start):
            assert r.start == at
            at += r.n_tokens
        order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
        assert order == sorted(order, key=lambda i: (i is not None, i or 0))
        absent = spark.createDataFrame([(987654,)], "doc_id long")
        assert fetch(spark, path, absent).count() == 0


def check_packing(rows, got, capacity):
    pieces = {}
    for doc_id, ids in rows:
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s:s + capacity]
            pieces[(doc_id, k, s, len(part), crc(part))] = pieces.get((doc_id, k, s, len(part), crc(part)), 0) + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values(), default=0) <= capacity
    return len(ends)


def test_packing(spark, awkward, nameless, nothing):
    encode = encoder(WORDS).tokenizer.encode
    for docs, capacity in ((awkward, 4096), (awkward, 100), (nameless, 4096), (nothing, 4096)):
        rows = [(r.doc_id, encode(r.text or "", add_special_tokens=False).ids + [1]) for r in docs.select("doc_id", "text").collect()]
        used = check_packing(rows, pack_documents(docs, WORDS, capacity=capacity).collect(), capacity)
        total = sum(len(x) for _, x in rows)
        assert used <= max(1, 1.1 * total / capacity + 1) * (total > 0)


def test_packed_ids(awkward):
    sequences = packed_sequences(awkward, WORDS, capacity=512).collect()
    assert all(len(s.ids) == 4 * s.n_tokens <= 4 * 512 for s in sequences)
    encode = encoder(WORDS).tokenizer.encode
    want = Counter(x for _, t, *_ in awkward_rows() for x in encode(t or "", add_special_tokens=False).ids + [1])
    assert Counter(x for s in sequences for x in np.frombuffer(s.ids, "<u4").tolist()) == want


def test_patterns_and_least_squares():
    assert sorted(patterns(6, 3)) == [(2, 2, 2), (3, 2, 1), (3, 3), (4, 1, 1), (4, 2), (5, 1), (6,)]
    rng = np.random.default_rng(5)
    a, x = rng.random((30, 50)), np.maximum(rng.normal(size=50), 0)
    fit = nnls(a, a @ x)
    assert (fit >= 0).all() and np.abs(a @ fit - a @ x).max() < 1e-6
    b = rng.normal(size=30)
    fit = nnls(a, b)
    gain = a.T @ (b - a @ fit)
    assert (gain < 1e-6).all() and np.abs(gain[fit > 0]).max(initial=0) < 1e-6


@pytest.mark.parametrize("n", [0, 1, 40, 3000])
def test_plan_is_close_to_the_bound(n):
    lengths = np.clip(np.random.default_rng(n).lognormal(5.9, 1.0, n).astype(int) + 1, 1, 4096)
    sequences = plan(dict(Counter(lengths.tolist())))
    used = Counter()
    for content, times in sequences:
        assert times > 0 and sum(k * m for k, m in content) <= 4096
        for k, m in content:
            used[k] += m * times
    assert used == Counter(lengths.tolist())
    assert sum(t for _, t in sequences) <= 1.01 * lengths.sum() / 4096 + 1


def test_plan_of_one_length():
    assert plan({4096: 10}) == [(((4096, 1),), 10)]
    assert sum(t for _, t in plan({1: 100_000})) == 25 and sum(t for _, t in plan({2049: 7})) == 7
