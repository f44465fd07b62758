"""Language of whole texts by a string kernel.

Kernel: two texts' blended-spectrum presence kernel is the number of byte n-grams (n from 1 to 4,
of the lower-cased text, everything but letters as one blank) that both hold, over the geometric
mean of the numbers that each holds. N-grams are told apart by a hash into BUCKETS.

Training: up to TRAINED distinct labelled texts per language, the first of them LANDMARKS Nyström
landmarks. With K the kernel among landmarks, a text's features are its kernel values to the
landmarks times K to the power -1/2; one-versus-rest kernel ridge regression is then a linear
solve. Landmarks, K and the solution fold into one weight per bucket and language, so that scoring
is one matrix product per batch of presence rows.

How familiar a text is does not depend on how many languages there are: the mean, over its own
n-grams, of the share of a language's landmarks that hold them, for the language where it is
largest. Texts of other languages have rarer n-grams; a short text has few, but common ones.

Defined cases: `und` with score and familiarity 0 where the text is null or has no letter, and for all texts if
nothing could be learned. Ties between languages go to the first by name. A null doc_id is
scored, not held out, and never learned from. Rows that repeat are scored alike and learned from
once. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratastar.llm.common import Scratch, carried, leanly, schema_of, settle
from stratastar.llm.words import chunks

LONGEST = 4
BITS = 15
BUCKETS = 1 << BITS
LANDMARKS = 60
TRAINED = 400
SALTS = 64
RIDGE = 1e-2
#: Sharpness of the softmax over regression values, which lie about -1 and 1.
SHARPNESS = 4.0

_CLASS = np.full(256, 0x20, np.uint32)
_CLASS[97:123] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(text, bucket): 1 where the text holds an n-gram of that bucket."""
    texts = len(offsets) - 1
    out = np.zeros(texts * BUCKETS, np.uint8)
    codes, owner = _CLASS[data], np.repeat(np.arange(texts), np.diff(offsets))
    base = owner * BUCKETS
    gram = np.zeros(len(codes), np.uint32)
    for n in range(1, min(LONGEST, len(codes)) + 1):
        size = len(codes) - n + 1
        gram = (gram[:size] << np.uint32(8)) | codes[n - 1 :]
        bucket = ((gram * np.uint32(0x9E3779B1)) ^ np.uint32(n * 0x5BD1E995 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS)
        inside = owner[:size] == owner[n - 1 :]
        out[(base[:size] + bucket)[inside]] = 1
    return out.reshape(texts, BUCKETS)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # (bucket, language)
    bias: np.ndarray
    common: np.ndarray  # (bucket, language): share of the language's landmarks that hold an n-gram of the bucket

    def judged(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, language) probabilities of presence rows, and how familiar each text is."""
        size = np.maximum(rows.sum(axis=1, dtype=np.int64), 1)
        products = rows.astype(np.float32) @ np.concatenate([self.weights, self.common], axis=1)
        values = products[:, : len(self.bias)] / np.sqrt(size)[:, None] + self.bias
        values = np.exp(SHARPNESS * (values - values.max(axis=1, keepdims=True)))
        return values / values.sum(axis=1, keepdims=True), (products[:, len(self.bias) :] / size[:, None]).max(axis=1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return self.judged(rows)[0]


def normed(rows: np.ndarray) -> np.ndarray:
    """Presence rows of length one, whose products are kernel values."""
    return rows.astype(np.float32) / np.sqrt(np.maximum(rows.sum(axis=1, dtype=np.int64), 1)).astype(np.float32)[:, None]


def learned(rows: np.ndarray, labels: list[str], landmark: np.ndarray) -> Model:
    """Model of presence rows with their labels; `landmark` marks the rows taken as landmarks."""
    languages = tuple(sorted(set(labels)))
    marks = normed(rows[landmark])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    values = np.maximum(values, 1e-6 * values.max())
    root = vectors / np.sqrt(values) @ vectors.T
    parts = [normed(rows[at : at + 64]) @ marks.T for at in range(0, len(rows), 64)]
    features = np.concatenate(parts).astype(np.float64) @ root
    mean = features.mean(axis=0)
    target = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    centred = features - mean
    inner = centred.T @ centred + RIDGE * len(labels) * np.eye(len(mean))
    solution = np.linalg.solve(inner, centred.T @ (target - target.mean(axis=0)))
    bias = target.mean(axis=0) - mean @ solution
    of = np.array(labels)[landmark]
    common = np.stack([rows[landmark][of == name].mean(axis=0) if (of == name).any() else np.zeros(rows.shape[1]) for name in languages], axis=1)
    return Model(languages, (marks.T.astype(np.float64) @ (root @ solution)).astype(np.float32), bias.astype(np.float32), common.astype(np.float32))


def lettered(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in chunks(pc.utf8_lower(batch.column(0)), rows=128):
            bits = np.packbits(presence(data, offsets), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in bits]), *(c.slice(row, end - row) for c in batch.columns[1:])], ["bits", "lang", "place"])


def train(documents: DataFrame) -> Model | None:
    """Learns from rows of (doc_id, text, lang) that are not held out; the sample is bounded per language."""
    spark = settle(documents.sparkSession)
    scratch = Scratch(spark, "language")
    known = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).withColumn("print", F.xxhash64("text"))
    usable = known.where(lettered(F.col("text"))).groupBy("lang", "print").agg(F.min("doc_id").alias("doc_id"))
    # The first of each of SALTS parts of a language, then of those.
    usable = usable.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    for groups in (("lang", "salt"), ("lang",)):
        place = F.row_number().over(W.partitionBy(*groups).orderBy("print"))
        usable = usable.withColumn("place", place).where(F.col("place") <= TRAINED)
    chosen = scratch.store(usable.drop("salt"), "sample")
    # TRAINED rows of three numbers per language.
    sample = known.join(F.broadcast(chosen), ["lang", "print", "doc_id"]).dropDuplicates(["lang", "print"]).select("text", "lang", "place")
    rows = sample.mapInArrow(leanly("language_id", _bits), "bits binary, lang string, place int").orderBy("lang", "place").collect()
    scratch.drop("sample")
    if not rows:
        return None
    unpacked = np.unpackbits(np.frombuffer(b"".join(r["bits"] for r in rows), np.uint8).reshape(len(rows), -1), axis=1)
    return learned(unpacked, [r["lang"] for r in rows], np.array([r["place"] <= LANDMARKS for r in rows]))


def predicted(documents: DataFrame, model: Model | None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, carried (a struct of the columns `carry`), held_out, lang_pred, score, familiar."""
    spark = settle(documents.sparkSession)
    text = F.col("text").cast("string")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), carried(carry), F.when(lettered(text), text).alias("text"))
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            if known is None:
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(["und"] * n), pa.array(np.zeros(n)), pa.array(np.zeros(n))], names)
                continue
            languages = pa.array(known.languages)
            for row, end, data, offsets in chunks(pc.utf8_lower(batch.column(2)), rows=128):
                p, familiar = known.judged(presence(data, offsets))
                none = batch.column(2).slice(row, end - row).is_null()
                found = pc.if_else(none, pa.scalar("und"), languages.take(pa.array(p.argmax(axis=1))))
                values = [pc.if_else(none, pa.scalar(0.0), pa.array(v.astype(np.float64))) for v in (p.max(axis=1), familiar)]
                yield pa.RecordBatch.from_arrays([*(c.slice(row, end - row) for c in batch.columns[:2]), found, *values], names)

    schema = schema_of(doc_id="long", carried=docs.schema["carried"].dataType, lang_pred="string", score="double", familiar="double")
    names = schema.names
    out = docs.mapInArrow(leanly("language_id", score), schema)
    return out.select("doc_id", "carried", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "familiar")
