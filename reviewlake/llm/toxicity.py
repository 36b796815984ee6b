"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct hashed words, word pairs and pairs with one word
between them of the whole text.  Shards of a bounded labelled sample are
trained in parallel, each with per-coordinate rates and L1, and their
accumulators are averaged; the non-zero weights are few and travel to the
tasks with the scoring function.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import held_out, labelled_sample, map_texts, unused

WORD = re.compile(r"\w+")
PAIR, SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Params:
    bits: int = 20            # hashed feature space
    alpha: float = 3.0        # rate
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.0
    epochs: int = 10
    shard_docs: int = 8_000   # labelled rows trained in one sequence; several are averaged
    max_docs: int = 24_000    # bound of the labelled sample
    threshold: float = 0.3


class WordHashes(dict):
    """word -> 64-bit hash, with bounded memory."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode())
        return h


def features(text: str | None, bits: int, cache: WordHashes) -> np.ndarray:
    """Distinct feature indices of a text; none for null, empty or wordless texts."""
    words = WORD.findall(text.lower()) if text else []
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    pairs = h[:-1] * PAIR + h[1:]
    skips = h[:-2] * SKIP + h[2:]
    mixed = np.concatenate([h, pairs ^ (pairs >> np.uint64(29)), skips ^ (skips >> np.uint64(31))])
    mixed = mixed * PAIR >> np.uint64(64 - bits)
    return np.unique(mixed.astype(np.int64))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def ftrl_weights(z: np.ndarray, n: np.ndarray, p: Params) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - p.l1, 0.0)
    return -shrunk / ((p.beta + np.sqrt(n)) / p.alpha + p.l2)


def ftrl(rows: list[np.ndarray], y: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """z and n after ``epochs`` passes; the last coordinate is the bias, without L1 at its update."""
    size = (1 << p.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    rows = [np.append(r, size - 1) for r in rows]
    for epoch in range(p.epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            i = rows[k]
            w = ftrl_weights(z[i], n[i], p)
            g = sigmoid(w.sum()) - y[k]
            root = np.sqrt(n[i] + g * g) - np.sqrt(n[i])
            z[i] += g - root / p.alpha * w
            n[i] += g * g
    return z, n


def train(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> tuple[np.ndarray, np.ndarray, float]:
    """(sorted feature indices, weights, bias) from documents and their (doc_id, y) labels.

    With no labelled row at all nothing is known to be toxic: every score is
    0 but for rounding, and nothing is rejected.
    """
    shards = -(-min(labels.select("doc_id").distinct().count(), p.max_docs) // p.shard_docs)
    sample = labelled_sample(docs, labels, p.max_docs).withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(max(1, shards))))

    def featured():
        cache = WordHashes()
        return lambda texts: [pa.array([features(t, p.bits, cache).astype("<i4").tobytes() for t in texts], pa.binary())]

    # Only the texts' features meet in a shard: 4 bytes for each different one, at most 2 to the power of ``bits`` of a text.
    sample = map_texts(sample, ["doc_id", "y", "shard"], featured, "f binary")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        z, n = ftrl([np.frombuffer(f, "<i4") for f in pdf["f"]], pdf["y"].to_numpy(float), p)
        i = np.flatnonzero((np.abs(z) > p.l1) | (np.arange(len(z)) == len(z) - 1))
        return pd.DataFrame({"docs": [len(pdf)], "i": [i.astype("<i4").tobytes()], "w": [ftrl_weights(z[i], n[i], p).astype("<f8").tobytes()]})

    # One row for each shard, with the non-zero weights alone.
    parts = sample.groupBy("shard").applyInPandas(fit, "docs long, i binary, w binary").collect()
    weights, total = np.zeros((1 << p.bits) + 1), sum(r["docs"] for r in parts)
    for r in parts:
        weights[np.frombuffer(r["i"], "<i4")] += np.frombuffer(r["w"], "<f8") * (r["docs"] / total)
    kept = np.flatnonzero(weights[:-1])
    return kept, weights[kept], float(weights[-1]) if parts else -np.inf


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], p: Params = Params(),
          keep: list[str] | None = None, made: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``keep`` columns (default doc_id) of every row, its score double and predicted int, named by ``made``.

    Null, empty and wordless texts get the bias alone.  Columns that are
    not named in ``keep`` are not read, so extra columns cannot clash.
    """
    index, weights, bias = model

    def scorer():
        cache, dense = WordHashes(), np.zeros(1 << p.bits)
        dense[index] = weights

        def run(texts: list[str | None]) -> list[np.ndarray]:
            s = sigmoid(np.array([dense[features(t, p.bits, cache)].sum() for t in texts], float) + bias)
            return [s, (s >= p.threshold).astype(np.int32)]
        return run

    return map_texts(docs, keep or ["doc_id"], scorer, f"{made[0]} double, {made[1]} int")


def keep_clean(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted toxic; learnt as in ``toxicity``."""
    s, rejected = unused(docs, "score"), unused(docs, "predicted")
    return score(docs, train(docs, training_labels(labels), p), p, docs.columns, (s, rejected)).where(F.col(rejected) == 0).drop(s, rejected)


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.where(~held_out(F.col("doc_id"), 4, 2)).select("doc_id", F.col("toxic").alias("y"))


def toxicity(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; learnt from rows not held out."""
    return score(docs, train(docs, training_labels(labels), p), p).select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")
