"""Toxicity: hashed subword embeddings, averaged into a linear softmax, trained jointly in numpy."""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import smallest_hashes, written

WORD = re.compile(r"\w+")
BUCKETS = 1 << 16
DIM = 8
GRAMS = (3, 4, 5)
#: Word scores kept by a Python worker; the store is emptied when it is full.
KEPT_WORDS = 300_000
KEPT_CHARS = 48
#: Words whose buckets are kept while the driver turns the sample into bags.
TRAINING_WORDS = 20_000


def subwords(word: str) -> list[int]:
    """Buckets of the word itself and of its character n-grams with the word's borders marked."""
    marked = f"<{word}>"
    grams = [marked[i:i + n] for n in GRAMS for i in range(len(marked) - n + 1)]
    return [zlib.crc32(g.encode()) % BUCKETS for g in (marked, *grams)]


class WordBuckets(dict):
    """Word -> buckets of its subwords; holds a bounded number of words."""

    def __missing__(self, word: str) -> np.ndarray:
        found = np.array(subwords(word), np.uint16)
        if len(word) <= KEPT_CHARS:
            if len(self) >= TRAINING_WORDS:
                self.clear()
            self[word] = found
        return found


@dataclass
class Bags:
    """Texts one behind another: their buckets, how often each has them, and where each text begins (one more entry)."""

    index: array = field(default_factory=lambda: array("H"))
    count: array = field(default_factory=lambda: array("i"))
    first: list[int] = field(default_factory=lambda: [0])

    def add(self, text: str, known: WordBuckets) -> None:
        parts = list(map(known.__getitem__, WORD.findall(text.lower())))
        if parts:
            index, count = np.unique(np.concatenate(parts), return_counts=True)
            self.index.frombytes(index.tobytes())
            self.count.frombytes(count.astype(np.int32).tobytes())
        self.first.append(len(self.index))

    def shares(self, min_texts: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Buckets, their share of the text and where texts begin, for buckets found in at least ``min_texts`` texts.

        Written over the bags, which are used up.
        """
        index, count, ends = np.asarray(self.index), np.asarray(self.count), list(zip(self.first, self.first[1:]))
        share = count.view(np.float32)
        spread = np.zeros(BUCKETS, np.int64)
        for a, z in ends:
            spread[index[a:z]] += 1
        common = spread >= min_texts
        first = [0]
        for a, z in ends:
            kept = common[index[a:z]]
            some, part = index[a:z][kept], count[a:z][kept] / max(1, count[a:z].sum())
            first.append(first[-1] + len(some))
            index[first[-2]:first[-1]], share[first[-2]:first[-1]] = some, part
        return index, share, first


@dataclass
class Model:
    """The softmax of two classes over averaged embeddings; only class 1 minus class 0 matters."""

    embeddings: np.ndarray
    weights: np.ndarray
    bias: float

    def bucket_scores(self) -> np.ndarray:
        """The average is linear, so each bucket adds its own share to a text's score."""
        return self.embeddings @ (self.weights[1] - self.weights[0])


def fit(bags: Bags, labels: list[int], epochs: int = 6, batch: int = 64, rate: float = 0.03,
        min_texts: int = 8, seed: int = 7) -> Model:
    """Embeddings and softmax together by Adam, from the texts' bags; both classes weigh the same.

    Buckets found in fewer than ``min_texts`` texts keep a zero embedding.
    """
    rng = np.random.default_rng(seed)
    w = np.stack([-np.ones(DIM), np.ones(DIM)]).astype(np.float32) * rng.uniform(0.5, 1.5, DIM).astype(np.float32)
    bias = np.zeros(2, np.float32)
    e = np.zeros((BUCKETS, DIM), np.float32)
    y = np.array(labels, np.int64)
    share = np.bincount(y, minlength=2) / max(1, len(y))
    weight = np.where(y == 1, 0.5 / max(share[1], 1e-9), 0.5 / max(share[0], 1e-9)).astype(np.float32)
    buckets, shares, first = bags.shares(min_texts)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (e, w, bias)]
    steps = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            part = order[at:at + batch]
            index = np.concatenate([buckets[first[i]:first[i + 1]] for i in part])
            value = np.concatenate([shares[first[i]:first[i + 1]] for i in part])
            owner = np.repeat(np.arange(len(part)), [first[i + 1] - first[i] for i in part])
            gathered = e[index] * value[:, None]
            mean = np.stack([np.bincount(owner, gathered[:, d], len(part)) for d in range(DIM)], 1)
            logit = mean @ w.T + bias
            logit -= logit.max(1, keepdims=True)
            p = np.exp(logit)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), y[part]] -= 1
            p *= weight[part, None] / len(part)
            back = (p @ w).astype(np.float32)[owner] * value[:, None]
            used, place = np.unique(index, return_inverse=True)
            de = np.stack([np.bincount(place, back[:, d], len(used)) for d in range(DIM)], 1)
            steps += 1
            params = ((e, de, used), (w, p.T @ mean, slice(None)), (bias, p.sum(0), slice(None)))
            for (param, grad, where), (m, v) in zip(params, moments):
                m[where] = 0.9 * m[where] + 0.1 * grad
                v[where] = 0.99 * v[where] + 0.01 * grad * grad
                hat = np.sqrt(v[where] / (1 - 0.99 ** steps)) + 1e-7
                param[where] -= rate * m[where] / (1 - 0.9 ** steps) / hat
    return Model(e, w, float(bias[1] - bias[0]))


class WordScores(dict):
    """Word -> (summed score of its subwords, their number); holds a bounded number of words."""

    def __init__(self, scores: np.ndarray):
        super().__init__()
        self.scores = scores.tolist()

    def __missing__(self, word: str) -> tuple[float, int]:
        buckets = subwords(word)
        found = (sum(map(self.scores.__getitem__, buckets)), len(buckets))
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = found
        return found


def probability(text: str, words: WordScores, bias: float) -> float:
    pairs = list(map(words.__getitem__, WORD.findall(text.lower())))
    total = sum(n for _, n in pairs)
    z = bias + (sum(s for s, _ in pairs) / total if total else 0.0)
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def train(
    docs: DataFrame, labels: DataFrame, chosen: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", texts_per_class: int = 2000, max_chars: int = 20_000, **options,
) -> Model | None:
    """A model from a bounded sample of labelled rows; None if there are none.

    Of the rows that ``chosen`` (over ``doc_id``) allows, with a label and 1 to ``max_chars``
    characters, each class gives the ``texts_per_class`` ones with the smallest hash of the id. Ids
    whose labels contradict each other are left out. The driver takes the sample text by text and
    keeps bags of buckets only.
    """
    marked = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label")).where(
        "doc_id is not null and label in (0, 1)"
    ).where(chosen).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).where(
        "text is not null and text != ''"
    ).where(F.length("text") <= max_chars)
    usable = written(marked.join(rows.select("doc_id").distinct(), "doc_id").select("doc_id", "label"), "labelled-ids")
    wanted = smallest_hashes(usable, "label", "doc_id", texts_per_class)
    sample = written(rows.join(F.broadcast(wanted), "doc_id").distinct(), "labelled-texts")
    known, bags, label = WordBuckets(), Bags(), []
    for r in sample.orderBy("doc_id", "text").toLocalIterator():  # the texts themselves are not kept
        bags.add(r["text"], known)
        label.append(r["label"])
    del known
    return fit(bags, label, **options) if label else None


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), from the whole text alone.

    Null and empty texts, and texts without a word, get the model's bias alone; without a model
    every score is 0. Repeated rows are scored each for itself. Other columns are not read.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    shared = rows.sparkSession.sparkContext.broadcast((model.bucket_scores(), model.bias))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, bias = shared.value
        words = WordScores(scores)
        for batch in batches:
            out = [probability(t.as_py() or "", words, bias) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    return rows.mapInArrow(scored, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores under ``threshold``, all columns, by one pass over the rows."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast((model.bucket_scores(), model.bias))

    @F.pandas_udf("double")
    def toxic(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scores, bias = shared.value
        words = WordScores(scores)
        for texts in parts:
            yield texts.map(lambda t: probability(t, words, bias)).astype("float64")

    return docs.where(toxic(F.coalesce(docs[text_col], F.lit(""))) < threshold)
