"""Quality classifier: supervised subword embeddings.

A text is a bag of hashed features: each word, its character n-grams between word ends (over whole
words, at any length), and the word bigrams of the whole text, in their order; those of two equal
words also share one bucket that counts eightfold. Every bucket has a learned
vector; a document is the mean of the vectors of its features, and a softmax layer turns the mean
into class probabilities. Vectors and layer are trained by stochastic gradient descent in numpy
on at most ``max_docs`` labelled documents (whole texts, hashed on the executors; the driver gets
buckets and counts only).

Scoring reads every whole text once, without a shuffle. As the output layer is linear in the mean,
each word adds a number (the margin of its features) that is computed once per distinct word, and
each pair of neighbours the margin of its bucket.

Defined cases: a null or empty text has no features and gets the probability of the bias alone.
Without labels the score is 0.5. Repeated rows are scored alike. A null doc_id is not held out.
Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, slices, text_bytes
from .labelled import labelled_sample

BUCKETS = 1 << 16
DIM = 12
_REPEAT = 0  # the bucket of a bigram of two equal words
_MOST_WORDS = 400_000  # distinct words remembered by a task before it starts afresh
_PIECE = 1 << 15  # words or buckets handled at a time


def buckets(word: bytes, low: int = 3, high: int = 5) -> Iterator[list[int]]:
    """Buckets of a word and of its character n-grams (over bytes, with word ends), in bounded pieces."""
    bounded, found = b"<" + word + b">", [1 + crc32(word) % (BUCKETS - 1)]
    for n in range(low, high + 1):
        for at in range(0, len(bounded) - n + 1, _PIECE):
            last = min(at + _PIECE, len(bounded) - n + 1)
            found += [1 + crc32(bounded[i : i + n], n) % (BUCKETS - 1) for i in range(at, last)]
            if len(found) >= _PIECE:
                yield found
                found = []
    yield found


def bigrams(hashes: np.ndarray) -> np.ndarray:
    """Buckets of the pairs of neighbours, from the hashes of the words in text order."""
    a, b = hashes[:-1], hashes[1:]
    pair = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1))
    pair = (pair ^ pair >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93)
    return (1 + (pair >> np.uint64(32)) % np.uint64(BUCKETS - 1)).astype(np.int64)


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    words = text.split()
    total: Counter[int] = Counter()
    counted = Counter(words)
    for word, n in counted.items():
        for part in buckets(word):
            for b in part:
                total[b] += n
    hashed = {word: crc32(word) for word in counted}
    hashes = np.fromiter(map(hashed.__getitem__, words), np.uint64, len(words))
    for b, n in zip(*(x.tolist() for x in np.unique(bigrams(hashes), return_counts=True)), strict=True):
        total[b] += n
    if same := int((hashes[1:] == hashes[:-1]).sum()):
        total[_REPEAT] += same * 8
    ids = np.fromiter(total.keys(), np.int32, len(total))
    order = np.argsort(ids)
    return ids[order], np.fromiter(total.values(), np.int32, len(total))[order]


class Scorer(dict):
    """Probabilities of texts; holds the place of each known word in tables of margin, features and hash."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.margins, self.counts = np.zeros(_MOST_WORDS), np.zeros(_MOST_WORDS, np.int64)
        self.hashes = np.zeros(_MOST_WORDS, np.uint64)

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        margin, n = 0.0, 0
        for part in buckets(word):
            margin += float(self.weights[part].sum())
            n += len(part)
        self.margins[at], self.counts[at], self.hashes[at] = margin, n, crc32(word)
        return at

    def score(self, text: bytes) -> float:
        words = text.split()
        margin, n, last = 0.0, 0, np.zeros(0, np.uint64)
        for start in range(0, len(words), _PIECE):
            part = words[start : start + _PIECE]
            if len(self) + len(part) > _MOST_WORDS:
                self.clear()
            at = np.fromiter(map(self.__getitem__, part), np.int64, len(part))
            hashes = np.concatenate([last, self.hashes[at]])
            pairs, same = bigrams(hashes), 8 * int((hashes[1:] == hashes[:-1]).sum())
            margin += float(self.margins[at].sum() + self.weights[pairs].sum() + same * self.weights[_REPEAT])
            n += int(self.counts[at].sum()) + len(pairs) + same
            last = hashes[-1:]
        return float(1 / (1 + np.exp(-np.clip(margin / max(n, 1) + self.bias, -500, 500))))


class Model:
    """Bucket vectors, output layer and bias of two classes."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
        self.layer = np.zeros((2, DIM), np.float32)
        self.bias = np.zeros(2, np.float32)
        self.trained = False

    def train(self, bags: list, labels: np.ndarray, epochs: int = 8, rate: float = 0.5, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        steps, done = epochs * len(bags), 0
        for _ in range(epochs):
            for i in rng.permutation(len(bags)):
                ids, counts = bags[i]
                lr = rate * (1 - done / steps)
                done += 1
                share = (counts / counts.sum()).astype(np.float32) if len(ids) else counts.astype(np.float32)
                mean = share @ self.vectors[ids] if len(ids) else np.zeros(DIM, np.float32)
                logits = self.layer @ mean + self.bias
                odds = np.exp(logits - logits.max())
                error = (odds / odds.sum()).astype(np.float32)
                error[labels[i]] -= 1
                back = error @ self.layer
                self.layer -= lr * np.outer(error, mean)
                self.bias -= lr * error
                if len(ids):  # the buckets are distinct, so this updates each once
                    self.vectors[ids] -= lr * np.outer(share, back) * min(len(ids), 64)
        self.trained = True

    def margins(self) -> tuple[np.ndarray, float]:
        """What each bucket adds to the margin of class 1, and the bias."""
        return self.vectors @ (self.layer[1] - self.layer[0]), float(self.bias[1] - self.bias[0])


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 2000, where: str = "true") -> Model:
    """Train on at most ``max_docs`` labelled documents whose label row meets ``where``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            bags = [bag(t) for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array([a.tobytes() for a, _ in bags], pa.binary()),
                    pa.array([b.tobytes() for _, b in bags], pa.binary()),
                ],
                names=["doc_id", "label", "ids", "counts"],
            )
        release()

    sample = labelled_sample(docs, labels, "quality", max_docs, where)
    rows = (
        sample.mapInArrow(hashed, "doc_id long, label int, ids binary, counts binary")
        .groupBy("doc_id")
        .agg(F.min(F.struct("label", "ids", "counts")).alias("r"))
        .orderBy("doc_id")
        .select("r.*")
        .collect()
    )
    model = Model()
    if rows:
        bags = [(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["counts"], np.int32)) for r in rows]
        model.train(bags, np.array([min(1, max(0, r["label"])) for r in rows]))
    return model


def score(docs: DataFrame, model: Model, carry: list[str], text: str = "text") -> DataFrame:
    """The ``carry`` columns of every document and ``score``, the probability of label 1."""
    carry = [c for c in carry if c != "score"]
    weights, bias = model.margins()
    # BUCKETS float32 numbers: a fixed size
    shared = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float64), bias))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Scorer(*shared.value)
        for batch in slices(batches, text, 8 << 20):
            scores = [known.score(t) for t in text_bytes(batch.column(text))]
            kept = [batch.column(c) for c in carry]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], names=[*carry, "score"])
        known.clear()
        release()

    types = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in carry] + ["score double"])
    return docs.select(*dict.fromkeys([*carry, text])).mapInArrow(judge, schema)
