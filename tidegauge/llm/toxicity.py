"""Toxicity by a support vector machine on a subsequence string kernel.

Two words are alike by the subsequences of letters they share, gaps allowed and paid for by their length.
So "i.d.i-o_t" and "idxiot" stay close to "idiot", though no n-gram is left. Kernels against all training
words are out of reach; a few landmark words stand for them (Nyström): the kernel values of a word
against the landmarks, whitened by the landmarks' own kernel matrix, are its coordinates.

A text is the bag of the words of its sentences. Per landmark, the values of its distinct words are summed and
saturate, so that one insult counts, several count more, and length alone does not. A linear support
vector machine separates these texts, and a logistic curve turns its margin into a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled documents that are learnt from, at most; those with the smallest hash of their id.
SAMPLE = 12_000
#: Words that may become landmarks, and landmarks.
CANDIDATES = 3_000
LANDMARKS = 96
#: Length of the subsequences, and the price of each letter that one spans.
ORDER = 3
DECAY = 0.7
#: Kernel values up to this count as zero; random words of a language are that much alike.
FLOOR = 0.5
#: Letters of a word that are compared at once; longer words go in overlapping pieces.
PIECE = 24
#: Weight of the margin's size against errors.
RIDGE = 1.0
#: Share of the landmark's neighbouring letters that a word must have in order, at most three letters
#: between, to be compared at all.
PAIRS = 0.7
_CACHE = 200_000
_GAP, _EDGE = 0, 1
_REACH = 4


# Words


def raw_words(text: str) -> set[str]:
    """Distinct words in lower case. Three or more single characters in a row are one word too, as a
    spaced-out insult is."""
    words = text.lower().split()
    found = set(words)
    if len([w for w in found if len(w) == 1]) > 1:
        run: list[str] = []
        for word in [*words, ""]:
            if len(word) == 1:
                run.append(word)
            elif run:
                if len(run) > 2:
                    found.add("".join(run))
                run = []
    return found


def words_of(text: str) -> set[str]:
    """As ``raw_words``, without punctuation at the ends."""
    return {w.strip(_ENDS) for w in raw_words(text)} - {""}


_ENDS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "¡¿«»„“”‘’…–—"


def pieces_of(word: str) -> list[str]:
    if len(word) <= PIECE:
        return [word]
    half = PIECE // 2
    return [word[i : i + PIECE] for i in range(0, len(word) - half, half)]


def codes_of(words: list[str]) -> np.ndarray:
    """Words as rows of numbers, with a mark of the word's edge at the front. What is not a letter or a
    digit is a gap that matches nothing."""
    out = np.full((len(words), PIECE + 1), _EDGE, dtype=np.uint32)
    if words:
        codes = np.array(words, dtype=f"U{PIECE}").view(np.uint32).reshape(-1, PIECE)
        out[:, 1:] = np.where(_ALNUM[codes.clip(max=0xFFFF)], codes, _GAP)
    return out


#: Which codes are letters or digits; those beyond the table count as the last one.
_ALNUM = np.array([chr(i).isalnum() for i in range(0xFFFF)] + [True])


# The kernel


def subsequence_kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Kernel of each row of ``a`` with the same row of ``b``: the sum over shared subsequences of
    ORDER letters of DECAY to the letters they span in both."""
    out = np.zeros(len(a))
    order = np.argsort((a != _GAP).sum(axis=1), kind="stable")
    for low in range(0, len(order), 4096):
        rows = order[low : low + 4096]
        out[rows] = _kernel_block(_trimmed(a[rows]), _trimmed(b[rows]))
    return out


def _kernel_block(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Letter by letter of ``a``; ``open[o][j]`` sums the subsequences of o letters that end before place j of
    ``b``, with the price of all letters since. ``carry`` moves them on along ``b``."""
    m, count = b.shape[1], len(a)
    places = np.arange(m)
    carry = np.tril(DECAY ** (places[:, None] - places).clip(min=0)).astype(np.float32)
    squared, decay = np.float32(DECAY * DECAY), np.float32(DECAY)
    other = np.ascontiguousarray(b.T)
    open_ = [np.ones((m + 1, count), dtype=np.float32)]
    open_ += [np.zeros((m + 1, count), dtype=np.float32) for _ in range(ORDER - 1)]
    total = np.zeros(count, dtype=np.float32)
    for i in range(a.shape[1]):
        letter = a[:, i]
        match = ((other == letter) & (letter != _GAP)) * squared
        ended = [o[:-1] * match for o in open_]
        total += ended[-1].sum(axis=0)
        for o in range(1, ORDER):
            open_[o][1:] = decay * open_[o][1:] + carry @ ended[o - 1]
    return total


def _trimmed(codes: np.ndarray) -> np.ndarray:
    """Without the columns that are gaps in all rows at the end."""
    used = np.flatnonzero((codes != _GAP).any(axis=0))
    return codes[:, : int(used[-1]) + 1] if len(used) else codes[:, :1]


def _pair_marks(codes: np.ndarray, reach: int) -> np.ndarray:
    """Ordered pairs of letters at most ``reach`` apart, as bits by their hash in four numbers."""
    marks = np.zeros((len(codes), 4), dtype=np.uint64)
    rows = np.arange(len(codes))
    for apart in range(1, reach + 1):
        for i in range(codes.shape[1] - apart):
            first, second = codes[:, i].astype(np.uint64), codes[:, i + apart].astype(np.uint64)
            bit = ((first * np.uint64(0x9E3779B1) + second * np.uint64(0x85EBCA77)) >> np.uint64(13)) % np.uint64(256)
            both = (first != _GAP) & (second != _GAP)
            marks[rows, (bit >> np.uint64(6)).astype(np.int64)] |= np.where(
                both, np.uint64(1) << (bit & np.uint64(63)), np.uint64(0)
            )
    return marks


class Landmarks(NamedTuple):
    words: list[str]
    codes: np.ndarray
    norms: np.ndarray
    marks: np.ndarray


def landmarks_of(words: list[str]) -> Landmarks:
    codes = codes_of(words)
    return Landmarks(words, codes, np.sqrt(_self_kernel(codes)), _pair_marks(codes, 1))


def _self_kernel(codes: np.ndarray) -> np.ndarray:
    return subsequence_kernel(codes, codes)


def similarities(words: list[str], marks: Landmarks) -> np.ndarray:
    """Kernel of every word with every landmark, normalised, 0 up to FLOOR and 1 for the landmark."""
    pieces = [(i, p) for i, w in enumerate(words) for p in pieces_of(w)]
    codes = codes_of([p for _, p in pieces])
    out = np.zeros((len(words), len(marks.words)), dtype=np.float32)
    if not len(codes):
        return out
    owner = np.array([i for i, _ in pieces])
    held = _pair_marks(codes, _REACH)
    close = np.zeros((len(codes), len(marks.words)), dtype=bool)
    for j, wanted in enumerate(marks.marks):
        shared = np.bitwise_count(held & wanted).sum(axis=1)
        close[:, j] = shared >= PAIRS * np.bitwise_count(wanted).sum()
    # a word is at least as like itself as by its letters in their own places alone; with this smaller
    # norm the values are too large, so what does not pass the floor now never will
    lengths = (codes != _GAP).sum(axis=1)
    gapped = lengths < (codes != _GAP)[:, ::-1].argmax(axis=1) * -1 + codes.shape[1]
    least = np.where(gapped, 0.0, _LEAST_NORM[lengths])
    rows, asked = np.nonzero(close & (marks.norms > 0))
    values = subsequence_kernel(codes[rows], marks.codes[asked]) / marks.norms[asked]
    above = values > FLOOR * least[rows]
    rows, asked, values = rows[above], asked[above], values[above]
    some = np.unique(rows)
    norms = np.zeros(len(codes))
    norms[some] = np.sqrt(_self_kernel(codes[some]))
    values = (values / norms[rows] - FLOOR) / (1 - FLOOR)
    np.maximum.at(out, (owner[rows], asked), values.clip(0, 1).astype(np.float32))
    return out


def _least_norms() -> np.ndarray:
    """By the number of letters, the norm of a word whose letters all differ."""
    codes = np.arange(1, PIECE + 2, dtype=np.uint32)
    norms = [0.0]
    for n in range(1, PIECE + 2):
        word = codes[None, :n]
        norms.append(math.sqrt(subsequence_kernel(word, word)[0]))
    return np.array(norms) * (1 - 1e-6)


_LEAST_NORM = _least_norms()


# Texts


class Featurizer:
    """Saturated sums of the similarities of a text's distinct words, per landmark. Words are remembered
    up to a bound: those that are like no landmark, the most, and the values of the others."""

    def __init__(self, marks: Landmarks) -> None:
        self.marks = marks
        self.known: set[str] = set()
        self.live: dict[str, tuple[str, np.ndarray]] = {}

    def __call__(self, texts: list[str]) -> np.ndarray:
        bags = [raw_words(t) for t in texts]
        if len(self.known) > _CACHE:
            self.known.clear()
            self.live.clear()
        new = set().union(*bags) - self.known
        self.known |= new
        forms: dict[str, list[str]] = {}
        for w in new:
            forms.setdefault(w.strip(_ENDS), []).append(w)
        words = sorted(forms)
        for low in range(0, len(words), 32_768):
            block = words[low : low + 32_768]
            values = similarities(block, self.marks)
            for i in np.flatnonzero(values.any(axis=1)).tolist():
                self.live.update((w, (block[i], values[i])) for w in forms[block[i]])
        live = set(self.live)
        out = np.zeros((len(texts), len(self.marks.words)))
        for i, bag in enumerate(bags):
            hits = dict(self.live[w] for w in bag & live)
            for word in sorted(hits):
                out[i] += hits[word]
        return 1.0 - np.exp(-out)


# Learning


class Model(NamedTuple):
    """Landmarks, the weight of each after whitening, the offset, and the logistic curve of the margin."""

    landmarks: Landmarks
    weights: np.ndarray
    offset: float
    slope: float
    shift: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        margin = features @ self.weights + self.offset
        return 1.0 / (1.0 + np.exp(-(self.slope * margin + self.shift).clip(-30, 30)))


def choose_landmarks(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> list[str]:
    """The words that tell the classes apart best, none too like another one chosen before.

    ``counts`` has words with the number of toxic and clean texts they are in. A word's worth is the
    evidence that it is commoner in toxic texts (the signed root of the likelihood ratio)."""

    def worth(a: int, b: int) -> float:
        p, q, r = (a + 0.5) / (toxic + 1), (b + 0.5) / (clean + 1), (a + b + 0.5) / (toxic + clean + 1)
        gain = a * math.log(p / r) + b * math.log(q / r)
        return math.copysign(math.sqrt(2 * max(gain, 0.0)), p - q)

    ranked = sorted(((worth(a, b), w) for w, a, b in counts), key=lambda x: (-x[0], x[1]))
    chosen: list[str] = []
    for value, word in ranked:
        if value < 3.0 or len(chosen) >= LANDMARKS:
            break
        if not chosen or similarities([word], landmarks_of(chosen)).max() < 0.8:
            chosen.append(word)
    return chosen or [w for _, w in ranked[:1]] or ["-"]


def train_svm(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, both classes weighing the same in sum, by Newton steps."""
    sign = np.where(y == 1, 1.0, -1.0)
    cost = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    full = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(full.shape[1]) * RIDGE
    ridge[-1, -1] = 1e-6
    w = np.zeros(full.shape[1])
    inside = np.ones(len(y), dtype=bool)
    for _ in range(50):
        part = full[inside] * cost[inside, None]
        w = np.linalg.solve(ridge + part.T @ full[inside], part.T @ sign[inside])
        after = sign * (full @ w) < 1
        if (after == inside).all():
            break
        inside = after
    return w[:-1], float(w[-1])


def fit_logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (positive) and shift of the logistic curve, with smoothed targets."""
    up, down = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    design = np.stack([margin, np.ones_like(margin)], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-(a * margin + b).clip(-30, 30)))
        grad = design.T @ (target - p) - np.array([1e-3 * a, 0.0])
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(hess, grad)
        a, b = a + step[0].clip(-1, 1), b + step[1].clip(-1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 1e-3), float(b)


def held_out(doc_id):
    """Whether a document is kept from learning: the checksum of its id's digits is divisible by five."""
    digits = F.coalesce(doc_id.cast("bigint").cast("string"), F.lit(""))
    return F.crc32(digits.cast("binary")) % 5 == 0


def _sample(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """``text`` and ``toxic`` of labelled documents that are not held out, at most ``size`` of them."""
    usable = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
    chosen = (
        usable.groupBy(F.col("doc_id").cast("bigint").alias("labelled"))
        .agg(F.max("toxic").cast("int").alias("label"))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(size)
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("d"), F.col("text").cast("string").alias("text"))
    joined = texts.join(F.broadcast(chosen), F.col("d") == F.col("labelled"))  # at most ``size`` rows
    return joined.select(F.coalesce("text", F.lit("")).alias("text"), "label")


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model | None:
    """A model from at most ``size`` labelled documents, or None if a class has no document.

    Words are counted and features computed on the executors; the driver gets the counts of CANDIDATES
    words and one short row per document of the sample.
    """
    sample = _sample(docs, labels, size)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                words, kinds = ["\n"] * part.num_rows, part["label"].to_pylist()
                for text, label in zip(part["text"].to_pylist(), part["label"].to_pylist(), strict=True):
                    bag = [w for w in words_of(text) if 3 <= len(w) <= PIECE]
                    words += bag
                    kinds += [label] * len(bag)
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(kinds, pa.int32())], ["word", "label"])

    counts = (
        sample.mapInArrow(explode, "word string, label int")
        .groupBy("word")
        .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    )
    totals = counts.where(F.col("word") == "\n").first()
    if totals is None or not totals["toxic"] or not totals["clean"]:
        return None
    enough = max(2, totals["toxic"] // 200)
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    best = (
        counts.where((F.col("word") != "\n") & (F.col("toxic") >= enough))
        .orderBy((F.sqrt("toxic") * share).desc(), "word")
        .limit(CANDIDATES)
    )
    rows = [(r["word"], r["toxic"], r["clean"]) for r in best.collect()]
    marks = landmarks_of(choose_landmarks(rows, totals["toxic"], totals["clean"]))
    features, y = _features(sample, marks)
    whiten = _whitening(marks)
    weights, offset = train_svm(features @ whiten, y)
    weights = whiten @ weights
    slope, shift = fit_logistic(features @ weights + offset, y)
    return Model(marks, weights, offset, slope, shift)


def _whitening(marks: Landmarks) -> np.ndarray:
    """Inverse root of the landmarks' kernel matrix."""
    kernel = similarities(marks.words, marks).astype(np.float64)
    values, vectors = np.linalg.eigh((kernel + kernel.T) / 2)
    return (vectors / np.sqrt(values.clip(min=0.05))) @ vectors.T


def _features(sample: DataFrame, marks: Landmarks) -> tuple[np.ndarray, np.ndarray]:
    sent = sample.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Featurizer(sent.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows = made(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(rows), pa.list_(pa.float64())), part["label"]], ["x", "label"]
                )

    # sorted, so that the model does not depend on the order of rows
    rows = sorted((tuple(r["x"]), r["label"]) for r in sample.mapInArrow(run, "x array<double>, label int").collect())
    return np.array([x for x, _ in rows]), np.array([y for _, y in rows])


def score_texts(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of each row of ``docs``.

    Only the text is an input of the score. A null or empty text has the score of a text without
    landmarks. Repeated rows are each scored, null ids passed on, other columns not read, and an empty
    table gives no rows. Without a model, as when no label could be learnt from, every score is 0.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        made = Featurizer(own.landmarks) if own else None
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                texts = part["text"].to_pylist()
                scores = own.scores(made(texts)) if own else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["held_out"], pa.array(scores, pa.float64())],
                    ["doc_id", "held_out", "score"],
                )

    columns = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    scored = columns.mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
