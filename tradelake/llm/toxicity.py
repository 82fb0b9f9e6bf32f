"""Toxicity by a subsequence string kernel and a support vector machine.

Method. The sentences of labelled documents carry their document's label and are bags of word
strings. The kernel compares two strings by the subsequences of three letters that they share,
each weighted by ``DECAY`` to the length it spans, so letters between and around weaken a match
but do not break it; signs between letters are gaps, look-alike digits are letters, and single
letters and neighbouring short pieces set apart by spaces and signs are joined first. Landmarks among the words give Nyström features,
on which a support vector machine separates the words of toxic sentences from the others, the
positive ones also with characters inserted; a second round adds the clean words that the first
found most toxic. As the kernel is a product of subsequence weights, the machine folds into one
weight per subsequence, by which any string is scored. A document's score is a logistic function
of its most toxic strings.

Training reads at most ``max_labelled`` labelled rows, chosen by the hash of their id, and keeps
at most ``max_words`` words a side. Scoring reads whole texts.

Defined results
  null or empty text   a score like any other: no string at all
  null doc_id, null label   not learned from; scored
  repeated rows, ties  each row is scored by itself; equal texts get equal scores
  empty tables         no labels: all scores 0; no documents: no rows
  other columns        passed through; ``score`` replaces a column of that name
"""

from __future__ import annotations

import itertools
import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, saved, text_of

DECAY, SPAN, LONGEST = 0.5, 8, 24
CLASSES, GAP = 48, 47
MAX_CACHED = 300_000
#: Digits and signs that stand for letters inside a word.
LOOK_ALIKES = str.maketrans("0134578@$!|", "oieastbasil")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def letters_of(word: str) -> str:
    """The string that the kernel sees: lower case, no signs at the ends, look-alikes as letters inside."""
    word = _EDGE.sub("", word.lower())
    return word if word.isalpha() or word.isdigit() else word.translate(LOOK_ALIKES)


def codes_of(word: str) -> list[int]:
    return [ord(c) - 97 if "a" <= c <= "z" else 26 + ord(c) % 21 if c.isalnum() else GAP for c in word]


@lru_cache(maxsize=LONGEST + 1)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    found = [t for t in itertools.combinations(range(n), 3) if t[2] - t[0] < SPAN]
    i, j, k = (np.array(x, dtype=np.int64) for x in (zip(*found) if found else ((), (), ())))
    return i, j, k, DECAY ** (k - i + 1).astype(np.float64)


def features(words: list[str]):
    """(places in ``words``, subsequence keys, weights of length-one rows) for strings of one length at a time."""
    pieces: dict[int, list[tuple[int, list[int]]]] = {}
    for at, word in enumerate(words):
        codes = codes_of(letters_of(word))
        for start in range(0, max(1, len(codes) - LONGEST // 2), LONGEST // 2):
            part = codes[start : start + LONGEST]
            if len(part) >= 3:
                pieces.setdefault(len(part), []).append((at, part))
    for n, some in pieces.items():
        i, j, k, decay = _triples(n)
        for a in range(0, len(some), 2000):
            chunk = some[a : a + 2000]
            codes = np.array([c for _, c in chunk], dtype=np.int64)
            x, y, z = codes[:, i], codes[:, j], codes[:, k]
            weights = np.where((x != GAP) & (y != GAP) & (z != GAP), decay, 0.0)
            weights /= np.maximum(np.sqrt((weights**2).sum(axis=1, keepdims=True)), 1e-9)
            yield np.array([p for p, _ in chunk]), (x * CLASSES + y) * CLASSES + z, weights


def folded(words: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """The machine's value for each string, the largest of a long string's parts."""
    out = np.full(len(words), bias)
    fresh = np.ones(len(words), dtype=bool)
    for at, keys, w in features(words):
        value = (weights[keys] * w).sum(axis=1) + bias
        for p, x in zip(at.tolist(), value.tolist()):
            if fresh[p] or x > out[p]:
                out[p], fresh[p] = x, False
    return out


def dense(words: list[str]) -> np.ndarray:
    """Subsequence vectors of a few strings."""
    out = np.zeros((len(words), CLASSES**3), dtype=np.float32)
    for at, keys, w in features(words):
        np.add.at(out, (np.repeat(at, keys.shape[1]), keys.ravel()), w.ravel())
    return out


def _kernel(words: list[str], landmarks: np.ndarray) -> np.ndarray:
    out = np.zeros((len(words), len(landmarks)))
    for at, keys, w in features(words):
        for m in range(len(landmarks)):
            np.maximum.at(out[:, m], at, (landmarks[m][keys] * w).sum(axis=1))
    return out


def train_machine(positive: list[str], negative: list[str], landmarks: list[str], cost: float = 20.0) -> tuple[np.ndarray, float]:
    """(weight per subsequence, bias) of a squared-hinge machine on Nyström features."""
    base = dense(landmarks)
    gram = base @ base.T
    values, vectors = np.linalg.eigh(gram.astype(np.float64))
    root = vectors[:, values > 1e-6] / np.sqrt(values[values > 1e-6])
    z = _kernel(positive + negative, base) @ root
    z = np.append(z, np.ones((len(z), 1)), axis=1)
    y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
    c = np.where(y > 0, len(y) / (2.0 * max(1, len(positive))), len(y) / (2.0 * max(1, len(negative)))) * cost
    w = np.zeros(z.shape[1])
    ridge = np.eye(z.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(30):  # Newton steps over the rows inside the margin
        inside = y * (z @ w) < 1
        new = np.linalg.solve(ridge + (z[inside] * c[inside, None]).T @ z[inside], z[inside].T @ (c[inside] * y[inside]))
        if np.abs(new - w).max() < 1e-7:
            break
        w = new
    return (root @ w[:-1]).astype(np.float32) @ base, float(w[-1])


def disguised(word: str, rng: np.random.Generator) -> str:
    """The word with signs or a letter put in."""
    if rng.random() < 0.5:
        return "-.*_"[rng.integers(4)].join(word)
    at = int(rng.integers(1, max(2, len(word))))
    return word[:at] + "abcdefghijklmnopqrstuvwxyz"[rng.integers(26)] + word[at:]


def strings_of(text: str | None) -> set[str]:
    """Distinct words of a text, and what spaces may have cut: runs of three or more single letters, neighbours of up to three letters.

    Signs around short pieces and between them are left out.
    """
    words = (text or "").lower().split()
    out = set(words)
    single: list[str] = []
    last = ""
    for w in words:
        piece = w if len(w) <= 3 and w.isalnum() else _EDGE.sub("", w) if len(w) <= 6 else w
        if not piece:  # signs alone
            continue
        short = len(piece) <= 3 and piece.isalnum()
        if len(piece) == 1 and short:
            single.append(piece)
        elif single:
            if len(single) >= 3:
                out.add("".join(single))
            single = []
        if short and last and len(last) + len(piece) >= 4:
            out.add(last + piece)
        last = piece if short else ""
    if len(single) >= 3:
        out.add("".join(single))
    return out


class Scorer:
    """Scores strings, and keeps those of earlier texts."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias, self.known = weights, bias, {}

    def facts(self, texts: list[str | None]) -> np.ndarray:
        """Per text: the three largest string scores, and the logarithms of how many are above 0 and of how many there are."""
        sets = [strings_of(t) for t in texts]
        new = set().union(*sets).difference(self.known) if sets else set()
        full = len(new) + len(self.known) > MAX_CACHED  # frequent strings are known by then: these are not kept
        if new:
            words = list(new)
            self.known.update(zip(words, folded(words, self.weights, self.bias).tolist()))
        out = np.zeros((len(texts), 5))
        for row, strings in zip(out, sets):
            values = np.fromiter(map(self.known.__getitem__, strings), np.float64, len(strings))
            top = np.sort(np.partition(values, -3)[-3:])[::-1] if len(values) > 3 else np.sort(values)[::-1]
            row[:3] = -1.5
            row[: len(top)] = np.clip(top, -1.5, 1.5)
            row[3] = np.log1p((values > 0).sum())
            row[4] = np.log1p(max(32, len(values)))  # a very short text is no likelier toxic
        if full:
            for w in new:
                del self.known[w]
        return out


def scorer(name: str, weights: np.ndarray, bias: float) -> Scorer:
    return kept(("scorer", name), lambda: Scorer(weights, bias))


def _by_size(texts, most: int = 1_000_000):
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t or "")
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights with the bias last, by Newton steps."""
    x = np.append(x, np.ones((len(x), 1)), axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, weights: np.ndarray, bias: float, calibration: np.ndarray, name: str):
        self.weights, self.bias, self.calibration, self.name = weights.astype(np.float32), bias, calibration, name

    def scores(self, texts) -> np.ndarray:
        """The scores of texts (any iterable)."""
        out = [np.zeros(0)]
        if not len(self.calibration):
            return np.zeros(sum(1 for _ in texts))
        mine = scorer(self.name, self.weights, self.bias)
        for group in _by_size(texts):
            facts = mine.facts(group)
            out.append(1 / (1 + np.exp(-np.clip(np.append(facts, np.ones((len(facts), 1)), axis=1) @ self.calibration, -30, 30))))
        return np.concatenate(out)


def _words(labelled: DataFrame) -> DataFrame:
    """word, toxic and clean: in how many distinct sentences of either label a word is.

    A sentence that a clean document holds too is clean.
    """
    sentences = (
        labelled.select("label", F.explode(F.split("text", r"(?<=[.!?])\s+|\n")).alias("sentence")).groupBy("sentence").agg(F.min("label").alias("label"))
    )

    def run(batches):
        schema = pa.schema([("word", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
        counts: dict[str, list[int]] = {}

        def out():
            words = list(counts)
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array([counts[w][1] for w in words], pa.int64()), pa.array([counts[w][0] for w in words], pa.int64())], schema=schema)

        for batch in batches:
            for sentence, label in zip(batch.column("sentence").to_pylist(), batch.column("label").to_pylist()):
                for word in {letters_of(w) for w in strings_of(sentence)}:
                    if 3 <= len(word) <= LONGEST:
                        counts.setdefault(word, [0, 0])[label] += 1
            if len(counts) > 500_000:
                yield out()
                counts.clear()
        if counts:
            yield out()

    return sentences.mapInArrow(run, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_labelled: int = 12_000,
    max_words: int = 3_000,
    n_landmarks: int = 96,
    seed: int = 5,
) -> Model:
    """``labels``: the rows to learn from. The sample is bounded, so its ids may be broadcast."""
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_labelled)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    labelled = saved(texts.join(F.broadcast(chosen), "id").select("id", "text", "label"), "labelled")
    words = saved(_words(labelled), "word-counts")
    toxic, clean, n = words.agg(F.sum("toxic"), F.sum("clean"), F.count("*")).first()
    if not toxic or not clean:
        return Model(np.zeros(CLASSES**3), 0.0, np.zeros(0), "none")
    base = toxic / (toxic + clean)
    both = F.col("toxic") + F.col("clean")
    share = F.col("toxic") / both
    # log-likelihood ratio against the rate of all words; by chance alone no word is expected above log(n)
    ratio = F.col("toxic") * F.log(F.greatest(share, F.lit(1e-9)) / base) + F.col("clean") * F.log(F.greatest(1 - share, F.lit(1e-9)) / (1 - base))
    found = words.where((share >= 0.5) & (ratio >= math.log(n) + 2)).orderBy(ratio.desc(), "word").limit(max_words)
    positive = [r.word for r in found.select("word").collect()]
    others = words.where(share < 0.5)
    spread = [r.word for r in others.orderBy(F.xxhash64("word"), "word").limit(max_words).select("word").collect()]
    if not positive or not spread:
        return Model(np.zeros(CLASSES**3), 0.0, np.zeros(0), "none")
    rng = np.random.default_rng(seed)
    disguises = [disguised(w, rng) for w in positive]
    weights, bias = train_machine(positive + disguises, spread, positive[:n_landmarks] + spread[:n_landmarks])

    def value(batches):
        schema = pa.schema([("word", pa.string()), ("value", pa.float64())])
        for batch in batches:
            got = folded(batch.column(0).to_pylist(), weights, bias)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), pa.array(got)], schema=schema)

    hard = others.select("word").mapInArrow(value, "word string, value double").orderBy(F.desc("value"), "word").limit(max_words)
    hardest = [r.word for r in hard.collect()]
    near = positive[:n_landmarks] + hardest[:n_landmarks] + spread[: n_landmarks // 2]
    weights, bias = train_machine(positive + disguises, hardest + spread, near)

    name = f"{seed}-{float(np.abs(weights).sum()):.12g}-{bias:.12g}"
    model = Model(weights, bias, np.zeros(0), name)

    def facts(batches):
        schema = pa.schema([("x", pa.list_(pa.float64())), ("label", pa.int32())])
        mine = scorer(model.name, model.weights, model.bias)
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                yield pa.RecordBatch.from_arrays([pa.array(list(mine.facts(part.column("text").to_pylist())), pa.list_(pa.float64())), part.column("label")], schema=schema)

    rows = labelled.select("text", "label").mapInArrow(facts, "x array<double>, label int").collect()  # at most max_labelled rows
    x, y = np.array([r.x for r in rows]), np.array([r.label for r in rows], dtype=float)
    order = np.lexsort((*x.T, y))  # the same sums whatever the order of the tasks
    return Model(weights, bias, logistic(x[order], y[order]), name)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score between 0 and 1, from the whole text alone."""

    @F.arrow_udf("double")
    def value(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(t.as_py() for t in texts), pa.float64())

    # only the text goes to Python and only the score comes back
    others = [F.col(f"`{c}`") for c in docs.columns if c != score_col]
    return docs.select(*others, value(F.col(f"`{text_col}`")).alias(score_col))
