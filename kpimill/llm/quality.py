"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

The n-grams are single words and pairs of words, of two word streams: the lower-cased words and their shapes (runs of
upper case, lower case, digits; other characters stand for themselves; a word that repeats the one before it has its own
shape). A text's features are the hashed n-grams, each weighted by its share of the stream; its score is a sparse dot
product with the weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpimill.llm.base import by_batch, texts_of
from kpimill.llm.labelled import training_rows

BITS = 20
PER_CLASS = 4000
EPOCHS = 3
GAIN = 8.0  # share of a stream to feature value
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-4, 1e-5
KEPT_WORDS = 400_000
_M = np.uint64(0x9E3779B97F4A7C15)


def _hash(text: str) -> int:
    data = text.encode()
    return (zlib.crc32(data) << 32 | zlib.crc32(data, 0x5BD1E995)) & 0xFFFFFFFFFFFFFFFF


def shape(word: str) -> str:
    out = []
    for c in word:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


class Features:
    """Texts to hashed n-gram places, with a bounded cache of words."""

    def __init__(self, bits: int = BITS, kept: int = KEPT_WORDS):
        self.shift, self.kept = np.uint64(64 - bits), kept
        self.word: dict[str, int] = {}
        self.codes = np.zeros((kept + 1, 2), np.uint64)

    def _code(self, words: list[str]) -> np.ndarray:
        found = list(map(self.word.get, words))
        if None in found:
            new = {w for w, f in zip(words, found) if f is None}
            if len(self.word) + len(new) > self.kept:
                self.word.clear()
                new = set(words)
                if len(new) > self.kept:  # one text with more words than the cache holds
                    return np.array([(_hash(w.lower()), _hash(shape(w) + "\0")) for w in words], np.uint64)
            for w in new:
                self.codes[len(self.word)] = _hash(w.lower()), _hash(shape(w) + "\0")
                self.word[w] = len(self.word)
            found = list(map(self.word.__getitem__, words))
        return self.codes[found]

    def __call__(self, text: str) -> np.ndarray:
        """Places of all n-grams of both streams."""
        words = text.split()
        if not words:
            return np.zeros(0, np.int64)
        codes = self._code(words)
        plain, shapes = codes[:, 0], codes[:, 1].copy()
        again = np.flatnonzero(plain[1:] == plain[:-1]) + 1
        shapes[again] += np.uint64(12345)
        grams = [plain, shapes + np.uint64(1)]
        for k, stream in enumerate((plain, shapes)):
            grams.append(stream[:-1] * np.uint64(0xD6E8FEB86659FD93) + stream[1:] * np.uint64(0xA0761D6478BD642F) + np.uint64(k + 2))
        keys = np.concatenate(grams)
        keys ^= keys >> np.uint64(29)
        return ((keys * _M) >> self.shift).astype(np.int64)


def train(texts: list[str], y: np.ndarray, weight: np.ndarray, bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """FTRL-proximal over the examples in a fixed shuffled order: weights per place and the bias."""
    places = Features(bits)
    examples = []
    for t in texts:
        at, n = np.unique(places(t), return_counts=True)
        examples.append((at, (GAIN * n / max(1, n.sum() / 4)).astype(np.float64)))
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bias_z = bias_n = 0.0
    weight = weight / weight.mean() if len(weight) else weight

    def now(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            at, x = examples[i]
            w = now(z[at], n[at])
            b = -bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA)
            p = 1 / (1 + np.exp(-np.clip(w @ x + b, -30, 30)))
            g = weight[i] * (p - y[i])
            gx = g * x
            new = n[at] + gx * gx
            z[at] += gx - (np.sqrt(new) - np.sqrt(n[at])) / ALPHA * w
            n[at] = new
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / ALPHA * b
            bias_n += g * g
    return now(z, n).astype(np.float32), float(-bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA))


def fit(documents: DataFrame, labels: DataFrame, label: str, in_training: Column, per_class: int = PER_CLASS, bits: int = BITS) -> tuple[np.ndarray, float]:
    """Fit on a bounded sample of labelled documents (``per_class`` of each class), in one task; the driver gets the weights.
    Without examples every weight is 0."""
    rows = training_rows(documents, labels, label, in_training, per_class)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [r for b in batches for r in zip(b.column("doc_id").to_pylist(), texts_of(b, "text"), b.column("y").to_pylist(), b.column("weight").to_pylist())]
        if found:
            _, texts, y, weight = zip(*sorted(found))
            w, bias = train(list(texts), np.array(y, float), np.array(weight), bits)
            used = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array([used.astype("<u4").tobytes()]), pa.array([w[used].astype("<f4").tobytes()]), pa.array([bias])], ["at", "w", "bias"])

    model = rows.repartition(1).mapInArrow(learn, "at binary, w binary, bias double").collect()
    w = np.zeros(1 << bits, np.float32)
    for r in model:
        w[np.frombuffer(r["at"], "<u4")] = np.frombuffer(r["w"], "<f4")
    return w, model[0]["bias"] if model else 0.0


def score(df: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """One row per input row: doc_id, score (0 to 1). Whole texts; a null or empty text gets the bias's score."""
    weights, bias = df.sparkSession.sparkContext.broadcast(model[0]), model[1]

    def make():
        places, w = Features(bits), weights.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sums = []
            for t in texts_of(batch, "text"):
                at = places(t)
                sums.append(float(w[at].sum(dtype=np.float64)) * GAIN / max(1.0, len(at) / 4))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(np.array(sums) + bias, -30, 30))))], ["doc_id", "score"])

        return step

    return by_batch(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), make, "doc_id long, score double")
