"""Quality of whole texts: random-indexing word vectors, pooled, through a small network.

Random indexing. Every symbol (a word, A-Z lower-cased, hashed into WORDS; or a word's shape: which
kinds of characters it has, how long it is) owns a sparse random index vector of DIM numbers.
One pass over all texts adds to each symbol the index vectors of the words and shapes around it,
REACH to each side. The table of sums has a fixed size; tasks send their share of it and Spark
adds the shares up. Numbers stay integers, so the sums do not depend on the order.

Pooling. A text's features are the mean and the spread of its words' and its shapes' vectors, how
often each shape stands in it, how often a word follows itself, and the logarithm of its length.

Network. Two layers, trained in numpy on up to TRAINED labelled texts by Adam; a tenth of them
stops the training and sets the temperature that the probabilities are calibrated with.

Defined cases: a null or empty text pools to zeros and is scored like any text. Labels of a
document that has several count as their mean, 1 from a half up; null labels and null ids are not
learned from. With no labels, or labels of one kind, every score is that share (0.5 without any).
Rows that repeat are scored alike. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratastar.llm.common import settle
from stratastar.llm.language_id import held_out
from stratastar.llm.words import Words, chunks, stream, words_of

DIM = 48
WORDS = 1 << 14
REACH = 2
NONZERO = 2
TRAINED = 20_000
HIDDEN = 32
CUT = 0.7

#: Kinds of bytes, one bit each: lower case, upper case, digit, sentence marks, other marks, beyond ASCII.
_KIND = np.full(256, 16, np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 4, 32
_KIND[[ord(c) for c in ".,;:?!'\""]] = 8
#: Shapes: kinds present, and four classes of length.
SHAPES = 64 * 4
SYMBOLS = WORDS + SHAPES
FEATURES = 4 * DIM + SHAPES + 2

_RANDOM = stream(61, SYMBOLS * NONZERO).reshape(SYMBOLS, NONZERO)
_PLACE = (_RANDOM % np.uint64(DIM)).astype(np.int64)
_SIGN = np.where((_RANDOM >> np.uint64(40)) & np.uint64(1), 1, -1).astype(np.int64)


def symbols(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word symbol and shape symbol of every word."""
    word = (words.hashes % np.uint64(WORDS)).astype(np.int64)
    if not len(word):
        return word, word
    kinds = np.bitwise_or.reduceat(_KIND[words.data], np.column_stack([words.start, words.end]).ravel()[:-1])[::2].astype(np.int64)
    size = np.digitize(words.end - words.start, [2, 5, 13])
    return word, WORDS + kinds * 4 + size


def contexts(words: Words) -> np.ndarray:
    """(symbol, number): index vectors of what stands around each symbol, added up."""
    word, shape = symbols(words)
    owner = words.owner()
    flat = np.zeros(SYMBOLS * DIM, np.int64)
    for shift in range(-REACH, REACH + 1):
        here = slice(max(0, -shift), len(word) - max(0, shift))
        there = slice(max(0, shift), len(word) - max(0, -shift))
        inside = owner[here] == owner[there]
        centre, around = word[here][inside], (shape if shift == 0 else word)[there][inside]
        pairs = [(centre, around)]
        if shift:
            pairs += [(centre, shape[there][inside]), (shape[here][inside], shape[there][inside])]
        for symbol, near in pairs:
            for k in range(NONZERO):
                at = symbol * DIM + _PLACE[near, k]
                up = _SIGN[near, k] > 0
                flat += np.bincount(at[up], minlength=len(flat)) - np.bincount(at[~up], minlength=len(flat))
    return flat.reshape(SYMBOLS, DIM)


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((SYMBOLS, DIM), np.int64)
    for batch in batches:
        for _, _, data, offsets in chunks(batch.column(0), 4 << 20, 1 << 20):
            total += contexts(words_of(data, offsets, lower=True))
    used = np.flatnonzero(total.any(axis=1))
    for at in range(0, len(used), 2048):
        part = used[at : at + 2048]
        yield pa.RecordBatch.from_arrays([pa.array(part), *(pa.array(total[part, k]) for k in range(DIM))], ["symbol", *_columns()])


def _columns() -> list[str]:
    return [f"c{k}" for k in range(DIM)]


def word_vectors(documents: DataFrame) -> np.ndarray:
    """(symbol, number) unit vectors learned from all texts; SYMBOLS rows whatever the corpus."""
    settle(documents.sparkSession)
    shares = documents.select(F.col("text").cast("string").alias("text")).where("text is not null")
    shares = shares.mapInArrow(_shares, ", ".join(["symbol long", *(f"{c} long" for c in _columns())]))
    sums = shares.groupBy("symbol").agg(*(F.sum(c).alias(c) for c in _columns())).toPandas()
    vectors = np.zeros((SYMBOLS, DIM))
    vectors[sums["symbol"].to_numpy()] = sums[_columns()].to_numpy(np.float64)
    seen = np.abs(vectors).sum(axis=1) > 0
    for part in (slice(0, WORDS), slice(WORDS, SYMBOLS)):
        own = vectors[part][seen[part]]
        if len(own):
            own = own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)
            own -= own.mean(axis=0)
            vectors[part][seen[part]] = own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)
    return vectors.astype(np.float32)


def pooled(words: Words, vectors: np.ndarray) -> np.ndarray:
    """(text, feature) of a chunk."""
    texts = len(words.first) - 1
    word, shape = symbols(words)
    owner = words.owner()
    number = np.maximum(words.counts, 1)[:, None].astype(np.float32)
    out = []
    for symbol, low, high in ((word, 0, WORDS), (shape, WORDS, SYMBOLS)):
        share = np.bincount(owner * (high - low) + symbol - low, minlength=texts * (high - low)).reshape(texts, high - low)
        share = share.astype(np.float32) / number
        mean = share @ vectors[low:high]
        out += [mean, np.sqrt(np.maximum(share @ (vectors[low:high] ** 2) - mean**2, 0))]
    again = (words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1])
    again = np.bincount(owner[1:][again], minlength=texts)[:, None] / number
    return np.hstack([*out, share, again, np.log1p(words.counts)[:, None]]).astype(np.float32)


@dataclass(frozen=True)
class Network:
    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        hidden = np.tanh((features - self.centre) / self.scale @ self.first + self.first_bias)
        value = (hidden @ self.second + self.second_bias) / self.temperature
        return 1 / (1 + np.exp(-np.clip(value, -30, 30)))


def trained(features: np.ndarray, label: np.ndarray, seed: int = 7, most: int = 60, batch: int = 256) -> Network:
    """Adam on the logistic loss; stops at the epoch that is best on a tenth held back."""
    rng = np.random.default_rng(seed)
    n, width = features.shape
    back = np.zeros(n, bool)
    back[rng.permutation(n)[: max(1, n // 10)]] = n >= 20
    if not back.any() or len(np.unique(label[~back])) < 2 or len(np.unique(label[back])) < 2:
        share = float(np.clip(label.mean(), 1e-6, 1 - 1e-6)) if n else 0.5
        if n < 20 or len(np.unique(label)) < 2:
            return Network(np.zeros(width), np.ones(width), np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), float(np.log(share / (1 - share))), 1.0)
        back[:] = True
    centre, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x, y = (features - centre) / scale, label.astype(float)
    use = ~back if (~back).any() else back
    weights = [rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]

    def logits(rows: np.ndarray) -> np.ndarray:
        return np.tanh(rows @ weights[0] + weights[1]) @ weights[2] + weights[3]

    def loss(value: np.ndarray, target: np.ndarray) -> float:
        return float(np.mean(np.logaddexp(0, value) - target * value))

    best, kept, step, waited = np.inf, [w.copy() for w in weights], 0, 0
    rows, targets = x[use], y[use]
    for _ in range(most):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            hidden = np.tanh(rows[some] @ weights[0] + weights[1])
            error = (1 / (1 + np.exp(-(hidden @ weights[2] + weights[3]))) - targets[some]) / len(some)
            inner = error[:, None] * weights[2] * (1 - hidden**2)
            grads = [rows[some].T @ inner + 1e-4 * weights[0], inner.sum(axis=0), hidden.T @ error, error.sum(keepdims=True)]
            step += 1
            for w, g, (m, v) in zip(weights, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 2e-3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        now, waited = loss(logits(x[back]), y[back]), waited + 1
        if now < best:
            best, kept, waited = now, [w.copy() for w in weights], 0
        if waited == 8:
            break
    weights = kept
    value = logits(x[back])
    temperature = min(np.geomspace(0.3, 5, 60), key=lambda t: loss(value / t, y[back]))
    return Network(centre, scale, *weights[:3], float(weights[3][0]), float(temperature))


def _features(batches: Iterator[pa.RecordBatch], vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in chunks(batch.column(0), rows=256):
            rows = pooled(words_of(data, offsets, lower=True), vectors)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows]), batch.column(1).slice(row, end - row)], ["features", "label"])


def train(documents: DataFrame, labels: DataFrame, vectors) -> Network:
    """Learns from labelled documents that are not held out, TRAINED at most, by hash of their id."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINED)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sample = docs.join(F.broadcast(chosen), "doc_id").select("text", "label")  # TRAINED rows of two numbers
    rows = sample.mapInArrow(lambda batches: _features(batches, vectors.value), "features binary, label int").toPandas()
    rows = rows.sort_values(["label", "features"], kind="stable") if len(rows) else rows
    return trained(np.frombuffer(b"".join(rows["features"]), np.float32).reshape(-1, FEATURES).astype(float), rows["label"].to_numpy(int))


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of `documents` (doc_id, text): doc_id, held_out, score, predicted."""
    spark = settle(documents.sparkSession)
    vectors = spark.sparkContext.broadcast(word_vectors(documents))
    network = spark.sparkContext.broadcast(train(documents, labels, vectors))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(1), rows=256):
                value = network.value.scores(pooled(words_of(data, offsets, lower=True), vectors.value))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(value.astype(np.float64))], ["doc_id", "score"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = docs.mapInArrow(score, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
