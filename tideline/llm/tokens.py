"""Token ids of whole texts, each distinct chunk of text encoded once per worker.

A text is cut where no token can cross (before a run of white space, and between a letter and the
punctuation that ends a word), chunks are numbered by a dictionary, and only chunks that the worker
has not met are given to the tokenizer. The ids are those of encoding the text as a whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MARK = "\x1e"
SPACE = "[\t-\r \u0085   -     　]"
LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
#: A word alone, behind a line end or before signs (ASCII, none of which is in a contraction or a special token), and LETTER's letters.
SIGN = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
WORD = f"\\A(?P<line>\\n?)(?P<word> ?{LETTER}+)(?P<sign>[{re.escape(SIGN)}]*)\\z"
LETTERS = [c for c in map(chr, range(256)) if c.isalpha() and c not in "ªµº"]
#: Normalizers and pre-tokenizers that take such a word as one piece, and what is before or behind it as another.
SIGNS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
WORD_FORMS = [
    (None, BYTE_LEVEL | {"use_regex": True}),
    ({"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
     {"type": "Sequence", "pretokenizers": [
         {"type": "Split", "pattern": {"Regex": SIGNS}, "behavior": "Removed", "invert": True}, BYTE_LEVEL | {"use_regex": False}]})]
#: Bytes that a byte-level vocabulary writes as other characters, from chr(256) on.
OTHER_BYTES = [*range(33), *range(127, 161), 173]
#: Text bytes that are cut and numbered at a time, and chunks that a worker remembers, by number and bytes.
SLICE_BYTES = 8 << 20
SLICE_ROWS = 50_000
REMEMBERED = 600_000
MEMORY_BYTES = 48 << 20


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """``texts`` in runs of about ``most`` bytes, at least one text and at most SLICE_ROWS each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = np.cumsum(np.maximum(sizes, most // SLICE_ROWS + 1)) // most
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(run)) + 1, [len(texts)])) if len(texts) else np.array([0, 0])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b > a:
            yield texts.slice(a, b - a)


def plain_space(texts: pa.Array) -> bool:
    """Whether all white space is single blanks and line ends (judged from bytes, wrongly no at worst)."""
    data = np.concatenate([np.frombuffer(t.as_buffer(), np.uint8) for t in texts if len(t.as_buffer())] or [np.empty(0, np.uint8)])
    space = (data == 32) | (data == 10)
    other = ((data >= 9) & (data <= 13) & (data != 10)) | np.isin(data, (0xE1, 0xE2, 0xE3))
    after_c2 = (data[:-1] == 0xC2) & np.isin(data[1:], (0x85, 0xA0))
    return not (other.any() or after_c2.any() or (space[:-1] & space[1:]).any())


def chunk_lists(texts: pa.Array, punctuation: bool = True, space: str = SPACE, cut: tuple[str, str] | None = None) -> pa.ListArray:
    """The chunks of every text, cut before runs of ``space`` (or as ``cut``, a pattern and its replacement, says).

    A text that holds the mark itself is one chunk.
    """
    odd = pc.match_substring(texts, MARK)
    clean = pc.if_else(odd, "", texts)
    if plain_space(clean):
        marked = pc.replace_substring(pc.replace_substring(clean, " ", MARK + " "), "\n", MARK + "\n")
    else:
        marked = pc.replace_substring_regex(clean, *(cut or (f"({space}+)", MARK + "\\1")))
    if punctuation:
        marked = pc.replace_substring_regex(marked, f"({LETTER})([,.!?]+){MARK}", f"\\1{MARK}\\2{MARK}")
    lists = pc.split_pattern(marked, MARK)
    if not pc.any(odd).as_py():
        return lists
    whole = pa.array([[t] for t in texts.filter(odd).to_pylist()], lists.type)
    is_odd = odd.to_numpy(zero_copy_only=False)
    order = np.where(is_odd, len(texts) + np.cumsum(is_odd) - 1, np.arange(len(texts)))
    return pa.concat_arrays([lists, whole]).take(pa.array(order))


class Rows(NamedTuple):
    """Ids of many strings in a row, and the offset of each string in them (one more than strings)."""

    ids: np.ndarray
    at: np.ndarray

    @staticmethod
    def of(lists: list[list[int]]) -> Rows:
        at = np.concatenate(([0], np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))))
        return Rows(np.fromiter(chain.from_iterable(lists), "<u4", int(at[-1])), at)

    def then(self, more: Rows) -> Rows:
        return Rows(np.concatenate([self.ids, more.ids]), np.concatenate([self.at, self.at[-1] + more.at[1:]]))

    def take(self, rows: np.ndarray) -> Rows:
        starts, n = self.at[rows], np.diff(self.at)[rows]
        at = np.concatenate(([0], np.cumsum(n)))
        return Rows(self.ids[np.repeat(starts - at[:-1], n) + np.arange(at[-1])], at)


NO_ROWS = Rows(np.empty(0, "<u4"), np.zeros(1, np.int64))


class Memory:
    """What is known of strings, held in arrays: past ``most`` entries (or MEMORY_BYTES) the half asked for last stays."""

    def __init__(self, learn: Callable[[pa.Array], Sequence[Rows]], sides: int = 1, most: int = REMEMBERED) -> None:
        self.learn, self.most, self.calls = learn, most, 0
        self.keys, self.asked, self.sides = pa.array([], pa.large_string()), np.empty(0, np.int64), [NO_ROWS] * sides

    def __call__(self, keys: pa.Array) -> tuple[np.ndarray, list[Rows]]:
        """Where each of the distinct ``keys`` is in the rows of every side; ``learn`` gives those of keys that are not known."""
        keys = keys.cast(pa.large_string())
        place = pc.index_in(keys, value_set=self.keys)
        new = keys.filter(pc.is_null(place))
        place = pc.fill_null(place, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[place < 0] = len(self.keys) + np.arange(len(new))
        if len(new):
            self.sides = [old.then(found) for old, found in zip(self.sides, self.learn(new))]
            self.keys = pa.concat_arrays([self.keys, new])
            self.asked = np.concatenate([self.asked, np.zeros(len(new), np.int64)])
        self.calls += 1
        self.asked[place] = self.calls
        sides = self.sides
        if len(self.keys) > self.most or self.keys.nbytes > MEMORY_BYTES:
            self.keep(np.sort(np.argsort(-self.asked, kind="stable")[:self.most // 2]))
        return place, sides

    def keep(self, rows: np.ndarray) -> None:
        kept = self.keys.take(pa.array(rows))
        if kept.nbytes > MEMORY_BYTES:
            rows, kept = rows[:0], kept.slice(0, 0)
        self.keys, self.asked, self.sides = kept, self.asked[rows], [side.take(rows) for side in self.sides]


def word_table(definition: dict) -> dict[int, str] | None:
    """How a vocabulary spells blanks and letters, if its pre-tokenizer takes a word with the blank before it in one piece.

    That is known of two forms, and where no added token is made of what WORD takes; of others nothing is said.
    """
    form = definition["normalizer"], definition["pre_tokenizer"]
    if form not in WORD_FORMS or definition["model"]["type"] != "BPE" or any(
            not set(t["content"]) - {*"\n ", *LETTERS, *SIGN} for t in definition["added_tokens"]):
        return None
    lower = form[0] is not None
    spell = lambda c: "".join(chr(b) if 33 <= b < 127 or 161 <= b < 173 or b >= 174 else chr(256 + OTHER_BYTES.index(b)) for b in c.encode())
    return {ord(c): spell(c.lower() if lower else c) for c in LETTERS} | {ord(" "): "" if lower else spell(" ")}


class Encoder:
    """Encodes arrays of texts; ``special`` is a special token that separates chunks in one call.

    Its string inside a text is the token, or with ``ordinary`` plain text like any other. Chunks of one
    word are given to the vocabulary's model itself: its pre-tokenizer would leave them whole.
    """

    def __init__(self, path: str, special: str, ordinary: bool = False) -> None:
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = self.alone = Tokenizer.from_file(path)
        if ordinary:
            self.alone = Tokenizer.from_file(path)
            self.alone.encode_special_tokens = True
        self.special, self.special_id = special, self.tokenizer.token_to_id(special)
        self.spelling, self.model = word_table(json.loads(self.tokenizer.to_str())), self.tokenizer.model
        self.chunks = Memory(lambda chunks: [self.learn(chunks)])

    def learn(self, chunks: pa.Array) -> Rows:
        """The ids of every chunk."""
        if self.spelling is None:
            return self.piped(chunks.to_pylist())
        parts = pc.extract_regex(chunks, WORD)
        is_word = pc.is_valid(parts)
        others = chunks.filter(pc.invert(is_word))
        found = self.words(*(parts.filter(is_word).field(i).to_numpy(zero_copy_only=False).tolist() for i in range(3)))
        is_word = is_word.to_numpy(zero_copy_only=False)
        place = np.where(is_word, np.cumsum(is_word), len(found.at) - 1 + np.cumsum(~is_word)) - 1
        return found.then(self.piped(others.to_pylist())).take(place)

    def words(self, lines: list[str], words: list[str], signs: list[str]) -> Rows:
        """The ids of chunks that are a line end or none, a word, and signs or none: those of words by the model alone."""
        if not words:
            return NO_ROWS
        ends = sorted({*lines, *signs})
        rows = self.piped(ends)
        known = {c: rows.ids[s:e].tolist() if c else [] for c, s, e in zip(ends, rows.at[:-1].tolist(), rows.at[1:].tolist())}
        tokenize, ids, at = self.model.tokenize, [], [0]
        for line, word, sign in zip(lines, "\n".join(words).translate(self.spelling).split("\n"), signs):
            if line:
                ids += known[line]
            ids += [t.id for t in tokenize(word)]
            if sign:
                ids += known[sign]
            at.append(len(ids))
        return Rows(np.array(ids, "<u4"), np.array(at, np.int64))

    def piped(self, chunks: list[str]) -> Rows:
        """The ids of every chunk, by the whole tokenizer."""
        alone = [c for c in chunks if "<" in c and "|" in c]  # special tokens of the vocabularies are written so
        apart = dict(zip(alone, (e.ids for e in self.alone.encode_batch_fast(alone, add_special_tokens=False))))
        rest = [c for c in chunks if c not in apart] if apart else chunks
        groups = [rest[i:i + 256] for i in range(0, len(rest), 256)]
        lines = self.tokenizer.encode_batch_fast([self.special.join(g) for g in groups], add_special_tokens=False)
        found = []
        for e in lines:
            ids = np.array(e.ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.special_id), len(ids))
            ids = ids.tolist()
            found += [ids[s:t] for s, t in zip([0, *(ends[:-1] + 1).tolist()], ends.tolist())]
        if apart:
            known = dict(zip(rest, found))
            found = [apart[c] if c in apart else known[c] for c in chunks]
        return Rows.of(found)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in a row, and the offset of each text in them (one more than texts)."""
        lists = chunk_lists(texts)
        coded = lists.flatten().dictionary_encode()
        place, (rows,) = self.chunks(coded.dictionary)
        ids, at = rows.take(place[coded.indices.to_numpy(zero_copy_only=False)])
        return ids, at[lists.offsets.to_numpy() - lists.offsets[0].as_py()]


@lru_cache(maxsize=4)
def encoder(path: str, special: str = "<|endoftext|>", ordinary: bool = False) -> Encoder:
    """One encoder per worker and vocabulary; what it remembers outlives a task."""
    return Encoder(path, special, ordinary)
