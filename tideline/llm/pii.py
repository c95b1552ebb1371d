"""Personal data by rules, and by a conditional random field that learns other spellings from what the rules find.

The rules give the base spans. A linear-chain conditional random field over word shapes is trained on a small table of
labelled stretches of words, in which spans are also spelt in ways that the rules don't know, and adds what it finds
elsewhere. A word without digits and marks, away from such words, can only be outside, so a text falls apart into
stretches that are decoded by themselves, many at a time.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import located, locator, rows_at, text_of

KINDS = ("email", "ip", "card", "phone")
RULES = [
    ("email", "@", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", ".", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", "", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", "+", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: What makes a word worth a look: a digit, an at sign, or a spelt-out one.
MARK = re.compile(r"[0-9@]|[(\[](?:at|dot)[)\]]")
ANY_MARK = r"[0-9@]|[(\[](at|dot)[)\]]"
#: Texts that the labelled table is made from, and stretches taken from one of them, at most.
LABELLED_TEXTS, STRETCHES_PER_TEXT = 2000, 8
#: Hashed features, weight of the regulariser, steps and step size of the training.
SIZE, RIDGE, STEPS, RATE = 1 << 14, 1e-4, 120, 0.3
#: Labels: 0 outside, then the first and the further words of each kind.
LABELS = 1 + 2 * len(KINDS)
NEVER = -1e9


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    doubled = [(0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for c in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def holds(kind: str, found: str) -> bool:
    """Whether what the pattern of ``kind`` matched is one."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in found.split("."))
    if kind == "card":
        digits = digits_of(found)
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits_of(found)) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of what the rules find, in order."""
    out = [(m.start(), k, m.end()) for k, (kind, sign, pattern) in enumerate(RULES) if sign in text
           for m in pattern.finditer(text) if holds(kind, m.group())]
    return sorted(out)


def stretches(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of words (start, end) that hold a mark or stand next to one that does."""
    words = [m.span() for m in WORD.finditer(text)]
    starts = [s for s, _ in words]
    marked = sorted({bisect_right(starts, m.start()) - 1 for m in MARK.finditer(text)})
    first = last = None
    for i in marked:
        if first is not None and i - 1 > last:
            yield words[first:last + 1]
            first = None
        if first is None:
            first = max(0, i - 1)
        last = min(i + 1, len(words) - 1)
    if first is not None:
        yield words[first:last + 1]


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """The span without the signs around it."""
    while start < end and not (text[start].isalnum() or text[start] in "+("):
        start += 1
    while end > start and not (text[end - 1].isalnum() or text[end - 1] == ")"):
        end -= 1
    return start, end


def shape(word: str) -> str:
    """Capitals as X, other letters as x, digits as 9, runs of each as one; signs as they are."""
    kinds = ("9" if "0" <= c <= "9" else "X" if c.isupper() else "x" if c.isalpha() else c for c in word)
    out = []
    for c in kinds:
        if not (out and out[-1] == c and c in "9Xx"):
            out.append(c)
    return "".join(out)


def features(word: str) -> tuple[list[int], list[int]]:
    """Hashed features of a word for itself, and for the words next to it."""
    start, end = trimmed(word, 0, len(word))
    core = word[start:end] or word[:8]
    runs, digits, form = re.findall(r"[0-9]+", core), digits_of(core), shape(core[:200])
    mine = ["1", "s" + form[:40], "d" + str(min(len(digits), 20)), "r" + ".".join(str(len(r)) for r in runs[:8]),
            "l" + str(min(len(core), 32) // 4), "t" + form[-6:]]
    mine += ["luhn"] if 12 <= len(digits) <= 19 and luhn(digits) else []
    mine += ["octets"] if len(runs) == 4 and all(len(r) < 4 and int(r) <= 255 for r in runs) else []
    mine += ["w" + core.lower()] if len(core) <= 5 and MARK.search(core) and not digits else []
    near = ["1", "s" + form[:20], "d" + str(min(len(digits), 20)), *mine[-1:]]
    return [crc32(f.encode()) % SIZE for f in mine], [crc32(f.encode()) % SIZE for f in near]


def transitions_allowed() -> np.ndarray:
    """0 where a label may follow another, NEVER where not; the last row is for a stretch's first word."""
    out = np.zeros((LABELS + 1, LABELS))
    for k in range(len(KINDS)):
        inside = 2 * k + 2
        out[:, inside] = NEVER
        out[[inside - 1, inside], inside] = 0
    return out


class Words:
    """Distinct words of some stretches with their features, and the stretches as word numbers laid end to end."""

    def __init__(self, sentences: Sequence[Sequence[str]]) -> None:
        number: dict[str, int] = {}
        # the last number stands for the place before a stretch's first and after its last word
        self.ids = np.array([number.setdefault(w, len(number)) for s in sentences for w in s], np.int64)
        self.lengths = np.array([len(s) for s in sentences], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        found = [features(w) for w in number] + [([0], [0])]
        self.edge = len(number)
        self.flat, self.owner = [], []
        for role in (0, 1):
            self.flat.append(np.array([x for f in found for x in f[role]], np.int64))
            self.owner.append(np.repeat(np.arange(len(found)), [len(f[role]) for f in found]))
        self.before, self.after = np.full(len(self.ids), self.edge), np.full(len(self.ids), self.edge)
        inner = np.ones(len(self.ids), bool)
        inner[self.starts] = False
        self.before[inner] = self.ids[np.flatnonzero(inner) - 1]
        self.after[np.flatnonzero(inner) - 1] = self.ids[inner]

    def roles(self) -> tuple:
        """(role of the weights, word numbers, features, their words) of the word itself, the one before and the one after."""
        return ((0, self.ids, self.flat[0], self.owner[0]), (1, self.before, self.flat[1], self.owner[1]),
                (2, self.after, self.flat[1], self.owner[1]))

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.ids), LABELS))
        for role, ids, flat, owner in self.roles():
            scores = np.zeros((self.edge + 1, LABELS))
            np.add.at(scores, owner, weights[role][flat])
            out += scores[ids]
        return out

    def gradient(self, per_word: np.ndarray) -> np.ndarray:
        out = np.zeros((3, SIZE, LABELS))
        for role, ids, flat, owner in self.roles():
            scores = np.zeros((self.edge + 1, LABELS))
            np.add.at(scores, ids, per_word)
            np.add.at(out[role], flat, scores[owner])
        return out

    def steps(self) -> Iterator[np.ndarray]:
        """For t = 0, 1, ...: the places of the t-th words, longest stretches first."""
        order = np.argsort(-self.lengths, kind="stable")
        for t in range(int(self.lengths.max(initial=0))):
            order = order[:np.searchsorted(-self.lengths[order], -t, side="left")]
            yield self.starts[order] + t


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Crf:
    """A linear-chain conditional random field; weights of features by role, and of one label after another."""

    def __init__(self) -> None:
        self.weights, self.follow = np.zeros((3, SIZE, LABELS)), np.zeros((LABELS + 1, LABELS))

    def fit(self, sentences: Sequence[Sequence[str]], labels: Sequence[Sequence[int]]) -> Crf:
        """Maximum likelihood with a ridge by gradient steps scaled by their history; equal input gives equal weights."""
        if not sentences:
            return self
        words, allowed = Words(sentences), transitions_allowed()
        truth = np.concatenate([np.array(x, np.int64) for x in labels])
        previous = np.full(len(truth), LABELS)
        inner = words.before != words.edge
        previous[inner] = truth[np.flatnonzero(inner) - 1]
        seen = np.zeros((len(truth), LABELS))
        seen[np.arange(len(truth)), truth] = 1
        pairs = np.zeros_like(self.follow)
        np.add.at(pairs, (previous, truth), 1)
        history = [np.full_like(self.weights, 1e-8), np.full_like(self.follow, 1e-8)]
        steps = list(words.steps())
        for _ in range(STEPS):
            marginal, expected = self.expectations(words, steps, allowed)
            slopes = (words.gradient(marginal - seen) / len(sentences) + RIDGE * self.weights,
                      (expected - pairs) / len(sentences) + RIDGE * self.follow)
            for values, slope, past in zip((self.weights, self.follow), slopes, history):
                past += slope ** 2
                values -= RATE * slope / np.sqrt(past)
        return self

    def expectations(self, words: Words, steps: list[np.ndarray], allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How likely each label is for each word, and how often each is to follow each."""
        emit, follow = words.emissions(self.weights), self.follow + allowed
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        for t, at in enumerate(steps):
            forward[at] = emit[at] + (follow[-1] if not t else log_sum(forward[at - 1][:, :, None] + follow[None, :-1], 1))
        for at in steps[:0:-1]:
            backward[at - 1] = log_sum(follow[None, :-1] + (emit[at] + backward[at])[:, None, :], 2)
        total = np.zeros(len(emit))
        total[steps[0]] = log_sum((forward + backward)[steps[0]], 1)
        total = np.repeat(total[words.starts], words.lengths)
        marginal = np.exp(forward + backward - total[:, None])
        expected = np.zeros_like(self.follow)
        expected[-1] = marginal[words.starts].sum(axis=0)
        for at in steps[1:]:
            expected[:-1] += np.exp(forward[at - 1][:, :, None] + follow[None, :-1]
                                    + (emit[at] + backward[at] - total[at, None])[:, None, :]).sum(axis=0)
        return marginal, expected

    def decode(self, sentences: Sequence[Sequence[str]]) -> np.ndarray:
        """The likeliest labels (Viterbi) of all words of ``sentences`` in a row, all stretches step by step together."""
        words, follow = Words(sentences), self.follow + transitions_allowed()
        emit, best = words.emissions(self.weights), None
        score, back = np.zeros_like(emit), np.zeros(emit.shape, np.int8)
        steps = list(words.steps())
        for t, at in enumerate(steps):
            if not t:
                score[at] = emit[at] + follow[-1]
            else:
                paths = score[at - 1][:, :, None] + follow[None, :-1]
                back[at] = paths.argmax(axis=1)
                score[at] = emit[at] + paths.max(axis=1)
        best = score.argmax(axis=1)
        for at in steps[:0:-1]:
            best[at - 1] = back[at, best[at]]  # the end of a stretch keeps its own best
        return best


def labelled(text: str, spans: list[tuple[int, int, int]], words: list[tuple[int, int]]) -> tuple[list[str], list[int]]:
    """The words of a stretch and their labels."""
    labels = []
    for s, e in words:
        hit = next(((start, kind) for start, kind, end in spans if start < e and s < end), None)
        labels.append(0 if hit is None else 2 * hit[1] + (1 if hit[0] >= s or not labels else 2))
    return [text[s:e] for s, e in words], labels


def spellings(kind: str, found: str) -> list[str]:
    """Other ways to write what a rule found, none of which a rule finds."""
    digits = digits_of(found)
    if kind == "email":
        user, host = found.split("@", 1)
        return [f"{user}(at){host}", f"{user} [at] {host.replace('.', ' [dot] ')}", f"{user}[at]{host.replace('.', '[dot]')}"]
    if kind == "ip":
        return [found.replace(".", "[.]"), found.replace(".", "(dot)")]
    if kind == "card":
        return [sign.join(digits[i:i + 4] for i in range(0, len(digits), 4)) for sign in "./_"]
    area, rest = digits[-10:-7] or digits[:3], f"{digits[-7:-4]}-{digits[-4:]}"
    return [f"({area}) {rest}", f"{area}-{rest}", f"{area}.{rest.replace('-', '.')}"]


def examples(text: str) -> Iterator[tuple[list[str], list[int]]]:
    """Stretches of a text with the labels of the rules, and with every span in one other spelling."""
    spans = base_spans(text)
    for words in sorted(stretches(text), key=lambda w: crc32(text[w[0][0]:w[-1][1]].encode()))[:STRETCHES_PER_TEXT]:
        yield labelled(text, spans, words)
        start, end = words[0][0], words[-1][1]
        inside = [(s, k, e) for s, k, e in spans if start <= s and e <= end]
        numbers = [(m.start(), 2, m.end()) for m in re.finditer(r"(?<![0-9])[0-9]{12,19}(?![0-9])", text[start:end])]
        numbers = [(s + start, k, e + start) for s, k, e in numbers if not any(x[0] < e + start and s + start < x[2] for x in spans)]
        for s, k, e in [*inside, *numbers]:
            ways = spellings(KINDS[k], text[s:e])
            new = ways[crc32(text[s:e].encode()) % len(ways)]
            other = text[start:s] + " " + new + " " + text[e:end] if k == 3 else text[start:s] + new + text[e:end]
            at = s - start + (k == 3)
            mark = [(at, k, at + len(new))] if (s, k, e) in inside else []  # a number that fails the sum stays outside
            rest = [x for x in base_spans(other) if x[0] >= at + len(new) or x[2] <= at]
            for part in stretches(other):
                yield labelled(other, sorted(mark + rest), part)


def labelled_stretches(docs: DataFrame, texts: int = LABELLED_TEXTS) -> DataFrame:
    """(words, labels): the labelled table, from ``texts`` distinct texts with marks, those whose hashes come first."""
    docs = located(docs)
    place = F.struct("file", "row")
    chosen = docs.where(F.col("text").rlike(ANY_MARK)).select(F.xxhash64("text").alias("h"), *locator()).groupBy("h").agg(
        F.min(place).alias("place")).orderBy("h").limit(texts).select("place.file", "place.row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for text in batch.column("text").to_pylist() for x in examples(text)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.list_(pa.string())), pa.array([f[1] for f in found], pa.list_(pa.int32()))],
                ["words", "labels"])

    return rows_at(docs, chosen).select("text").mapInArrow(run, "words array<string>, labels array<int>")


def crf_spans(texts: list[str], model: Crf) -> list[list[tuple[int, int, int]]]:
    """Per text what the model finds: (start, kind number, end)."""
    found = [(i, words) for i, text in enumerate(texts) for words in stretches(text)]
    labels = model.decode([[texts[i][s:e] for s, e in words] for i, words in found])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    at = 0
    for i, words in found:
        mine = labels[at:at + len(words)].tolist()
        at += len(words)
        for j, label in enumerate(mine):
            if label % 2:
                end = j + 1
                while end < len(mine) and mine[end] == label + 1:
                    end += 1
                s, e = trimmed(texts[i], words[j][0], words[end - 1][1])
                if s < e:
                    out[i].append((s, label // 2, e))
    return out


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_personal_data(docs: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and the digest are those of the base spans; ``spans`` lists these and the ones that the model adds, which
    overlap none of them, as kind:start:end in code points, by start, then kind. ``training`` has (words, labels); without
    it the table comes from ``docs`` (``labelled_stretches``). Without any labelled stretch the model adds nothing. A
    null text is empty: counts of zero, the digest of an empty line, no spans. Rows may repeat; a null doc_id is
    returned; other columns are not read; an empty table gives an empty result.
    """
    training = labelled_stretches(docs) if training is None else training
    rows = sorted((tuple(r.words), tuple(r.labels)) for r in training.collect())  # bounded by the size of the labelled table
    model = Crf().fit([r[0] for r in rows], [r[1] for r in rows])
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model if rows else None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = pickle.loads(shared.value)
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            n, digests, lines = np.zeros((len(KINDS), len(batch)), np.int64), [nothing] * len(batch), [""] * len(batch)
            marked = np.flatnonzero(pc.match_substring_regex(batch.column("text"), ANY_MARK).to_numpy(zero_copy_only=False))
            texts = batch.column("text").take(pa.array(marked)).to_pylist()
            more = crf_spans(texts, crf) if crf else [[] for _ in texts]
            for i, text, added in zip(marked.tolist(), texts, more):
                spans = base_spans(text)
                for _, k, _ in spans:
                    n[k, i] += 1
                digests[i] = hashlib.sha256(listed(spans).encode()).hexdigest()
                ends = np.array([[s, e] for s, _, e in spans], np.int64).reshape(-1, 2)
                new = [x for x in added if not ((ends[:, 0] < x[2]) & (x[0] < ends[:, 1])).any()]
                lines[i] = listed(sorted(spans + new))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, n), pa.array(digests, pa.string()), pa.array(lines, pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)
