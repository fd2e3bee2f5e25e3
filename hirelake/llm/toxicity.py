"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features are the distinct words and their stems (so that forms not seen in training
tell something), word pairs and pairs with one word between them, hashed to a fixed number of indices.  Each coordinate has its own learning rate, from
the squares of its past gradients, and the L1 term keeps coordinates at exactly 0 until
there is evidence, so the weights that are not 0 are few and are broadcast.

Labelled rows are fitted up to a bound (``MAX_ROWS``), chosen by hash.  They are hashed
where they lie; one task then passes over their feature indices, as the method learns
row by row.  All documents are scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from hirelake.llm.common import LOWER, table

#: Indices of hashed features: bounds the weights' size.
BITS = 22
#: Labelled rows that are fitted, at most; passes over them.
MAX_ROWS, PASSES = 20_000, 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 1.0
#: Bytes of a word that are its stem.
STEM = 5
#: Words of a text that are hashed at once.
STRETCH = 200_000

_WORDS = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in LOWER)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)


class Hasher:
    """Feature indices of texts; remembers the hashes of frequent words, so many at most."""

    def __init__(self, bits: int, most: int = 200_000):
        self.shift = np.uint64(64 - bits)
        self.known: dict[bytes, int] = {}
        self.most = most

    def _word(self, w: bytes) -> tuple[int, int]:
        h = self.known.get(w)
        if h is None:
            if len(self.known) >= self.most:
                self.known.clear()
            h = self.known[w] = xxh64_intdigest(w) | 1, xxh64_intdigest(w[:STEM], 1) | 1
        return h

    def indices(self, text: str | None) -> np.ndarray:
        """The distinct indices, ascending."""
        words = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()
        found = []
        for start in range(0, len(words), STRETCH):
            both = np.array(list(map(self._word, words[start : start + STRETCH + 2])), np.uint64)
            h, one = both[:, 0], both[:STRETCH].ravel() * _MIX[0]
            pairs = (h[:-1] * _MIX[1]) ^ (h[1:] * _MIX[2] + np.uint64(1))
            skips = (h[:-2] * _MIX[2]) ^ (h[2:] * _MIX[1] + np.uint64(2))
            for x in (one, pairs * _MIX[0], skips * _MIX[0]):
                found.append(np.unique(x >> self.shift).astype(np.int64))
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _probability(z: float) -> float:
    return 1.0 / (1.0 + np.exp(-max(min(z, 35.0), -35.0)))


def fit(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """Indices and weights that are not 0.  Index 2**bits is the bias, which has no L1."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    bias = size - 1

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        l1 = np.where(at == bias, 0.0, L1)
        shrunk = np.sign(own) * np.maximum(np.abs(own) - l1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(passes):
        for at, label in zip(rows, labels, strict=True):
            at = np.r_[at, bias]
            w = weights(at)
            g = _probability(w.sum()) - label
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - rate * w
            n[at] += g * g
    every = np.flatnonzero(z)
    w = weights(every)
    return every[w != 0], w[w != 0]


def train(labelled: DataFrame, bits: int = BITS, passes: int = PASSES) -> DataFrame:
    """(index, weight) from rows (key, text, label 0 or 1), at most 2**bits + 1 of them."""

    def hashed(batches: Iterator[pa.RecordBatch]):
        hasher = Hasher(bits)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                made = [hasher.indices(t).astype(np.int32) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(made, pa.list_(pa.int32()))], ["h", "label", "at"])

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(size=pdf["at"].map(len)).sort_values(["h", "size"])
        at, w = fit([np.asarray(x, np.int64) for x in pdf["at"]], pdf["label"].to_numpy(float), bits, passes)
        return pd.DataFrame({"index": at, "weight": w})

    rows = labelled.select(F.xxhash64("key").alias("h"), "label", "text").mapInArrow(hashed, "h long, label double, at array<int>")
    return rows.groupBy(F.lit(0).alias("all")).applyInPandas(learn, "index long, weight double")


def score(docs: DataFrame, weights: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """(doc, score) of each row; score is the probability of label 1."""
    spark = docs.sparkSession
    # At most 2**bits + 1 rows; a sort in Spark would sample them first, and so fit twice.
    found = weights.toPandas().sort_values("index")
    model = spark.sparkContext.broadcast((found["index"].to_numpy(np.int32), found["weight"].to_numpy(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]):
        dense = np.zeros((1 << bits) + 1, np.float32)
        dense[model.value[0]] = model.value[1]
        hasher = Hasher(bits)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                made = [_probability(float(dense[hasher.indices(t)].sum(dtype=float) + dense[-1])) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.float64())], ["doc", "score"])

    schema = T.StructType([T.StructField("doc", docs.schema[doc_id].dataType), T.StructField("score", T.DoubleType())])
    return docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)


def held_out(key: Column, folds: int = 5) -> Column:
    """Rows that take no part in learning: the CRC-32 of the id as text is divisible by ``folds``."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(True))


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    bits: int = BITS,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """(doc, held_out, score, predicted) of each row of ``docs``.

    ``labels`` has ids like ``docs`` and ``label`` (0 or 1; others and nulls say
    nothing; of several labels of an id the highest holds).  Rows with ``held_out``,
    and rows without an id, are never learned from.  Null and empty texts have the
    score of no evidence, which is the bias.  Repeated rows are scored alike.  Without
    labels all scores are 0.5; extra columns are not read; no documents, no rows.
    """
    known = labels.where(F.col(f"`{label}`").isin(0, 1) & ~held_out(F.col(f"`{doc_id}`"))).groupBy(
        F.col(f"`{doc_id}`").alias("key")
    ).agg(F.max(f"`{label}`").cast("double").alias("label"))
    # Ids beyond the bound leave before texts are joined.
    total = known.count()
    share = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 20))
    known = known.where(share < (1 << 20 if total <= max_rows else int((1 << 20) * max_rows / total)))
    # At most about max_rows ids.
    labelled = docs.select(F.col(f"`{doc_id}`").alias("key"), F.col(f"`{text}`").alias("text")).join(F.broadcast(known), "key")
    scored = score(docs, train(labelled, bits), doc_id, text, bits)
    return scored.select("doc", held_out(F.col("doc")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumnRenamed("doc", "doc_id")
