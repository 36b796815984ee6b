"""Quality by compression: zstandard dictionaries of good and of bad text.

Each whole text is compressed piece by piece with a dictionary built from
good labelled text, with one from bad text and with none.  The normalised
difference of the sizes, beside the sizes for each byte, is calibrated to a
probability by a logistic curve on labelled rows that built no dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import Scratch, held_out, labelled_sample, map_texts


@dataclass(frozen=True)
class Params:
    piece_bytes: int = 1024       # compressed alone, so that a long text does not drown the dictionary
    dictionary_bytes: int = 65_536
    level: int = 3
    max_docs: int = 24_000        # bound of the labelled sample: half for dictionaries, half for the curve
    max_pieces: int = 4_000       # pieces that build a dictionary, chosen by hash
    ridge: float = 1e-3
    threshold: float = 0.7


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    raw: tuple[bool, bool]        # too little text to train: the text itself is the dictionary
    weights: np.ndarray           # of the standardised terms, the constant first
    mean: np.ndarray
    scale: np.ndarray


def pieces(text: str | None, size: int) -> list[bytes]:
    b = (text or "").encode()
    return [b[i:i + size] for i in range(0, len(b), size)] or [b""]


def dictionary(chosen: list[bytes], p: Params) -> tuple[bytes, bool]:
    try:
        return zstandard.train_dictionary(p.dictionary_bytes, chosen, level=p.level).as_bytes(), False
    except zstandard.ZstdError:
        return b"".join(chosen)[:p.dictionary_bytes], True


def sizes(good: tuple[bytes, bool], bad: tuple[bytes, bool], p: Params):
    """A function from a text to its bytes and its sizes with the good, the bad and no dictionary."""
    plain = zstandard.ZstdCompressor(level=p.level, write_content_size=False)

    def with_dictionary(content: bytes, raw: bool):
        if not content:
            return plain
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_FULLDICT)
        d.precompute_compress(level=p.level)
        return zstandard.ZstdCompressor(dict_data=d, level=p.level, write_content_size=False, write_dict_id=False)

    by_good, by_bad = with_dictionary(*good), with_dictionary(*bad)

    def run(text: str | None) -> tuple[int, int, int, int]:
        parts = pieces(text, p.piece_bytes)
        whole = b"".join(parts)
        return (len(whole), sum(len(by_good.compress(x)) for x in parts), sum(len(by_bad.compress(x)) for x in parts), len(plain.compress(whole)))
    return run


def terms(s: np.ndarray) -> np.ndarray:
    """Normalised difference, size for each byte and ratio without dictionary, with their squares."""
    n, good, bad, plain = s.astype(float).T
    diff, per, ratio = (bad - good) / np.maximum(good, bad), good / (n + 1), plain / (n + 1)
    return np.stack([diff, (bad - good) / (n + 1), per, ratio, diff * diff, per * per, ratio * ratio, diff * ratio], 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Weights by Newton steps, the constant first."""
    z, w = np.c_[np.ones(len(x)), x], np.zeros(x.shape[1] + 1)
    for _ in range(30):
        prob = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (prob * (1 - prob))[:, None]).T @ z + ridge * len(x) * np.eye(len(w))
        step = np.linalg.solve(hessian, z.T @ (y - prob) - ridge * len(x) * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> Model:
    """Fit on documents and their (doc_id, y) labels; what reaches the driver is bounded by ``p``.

    Without labelled rows of both kinds every score is the share of the
    good ones, 0.5 if there is none.
    """
    sample = labelled_sample(docs, labels, p.max_docs).withColumn("curve", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 1)
    sample = Scratch(docs.sparkSession, "quality").store(sample, "sample")  # read for either dictionary and for the curve

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(y, xxhash.xxh64_intdigest(x, k) >> 1, x) for y, t in zip(b.column("y").to_pylist(), b.column("text").to_pylist())
                   for k, x in enumerate(pieces(t, p.piece_bytes))]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()),
                                              pa.array([o[2] for o in out], pa.binary())], ["y", "h", "piece"])

    parts = sample.where("NOT curve").select("y", "text").mapInArrow(split, "y int, h long, piece binary")

    def build(y: int) -> tuple[bytes, bool]:
        rows = parts.where(F.col("y") == y).orderBy("h", "piece").limit(p.max_pieces).select("piece").collect()
        return dictionary([bytes(r["piece"]) for r in rows], p) if rows else (b"", True)

    good, bad = build(1), build(0)

    def start():
        measure = sizes(good, bad, p)

        def run(texts):
            found = np.array([measure(t) for t in texts], np.int64).reshape(-1, 4)
            return [found[:, k] for k in range(4)]
        return run

    rows = map_texts(sample.where("curve"), ["doc_id", "y"], start, "n long, g long, b long, s long").collect()
    x = terms(np.array([(r["n"], r["g"], r["b"], r["s"]) for r in sorted(rows, key=lambda r: r["doc_id"])], float).reshape(-1, 4))
    y = np.array([r["y"] for r in sorted(rows, key=lambda r: r["doc_id"])], float)
    mean, scale = (x.mean(0), x.std(0) + 1e-9) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    if len(x) and 0 < y.mean() < 1:
        weights = logistic((x - mean) / scale, y, p.ridge / 10)
    else:
        share = (y.sum() + 1) / (len(y) + 2)
        weights = np.r_[np.log(share / (1 - share)), np.zeros(x.shape[1])]
    return Model(good[0], bad[0], (good[1], bad[1]), weights, mean, scale)


def score(docs: DataFrame, m: Model, p: Params = Params(), keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id), score and predicted of every row; null texts count as empty."""
    def start():
        measure = sizes((m.good, m.raw[0]), (m.bad, m.raw[1]), p)

        def run(texts):
            x = (terms(np.array([measure(t) for t in texts], float)) - m.mean) / m.scale
            s = 1 / (1 + np.exp(-np.clip(m.weights[0] + x @ m.weights[1:], -30, 30)))
            return [s, (s >= p.threshold).astype(np.int32)]
        return run

    return map_texts(docs, keep or ["doc_id"], start, "score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; learnt from rows not held out."""
    y = labels.where(~held_out(F.col("doc_id"), 4, 2)).select("doc_id", F.col("quality").alias("y"))
    return score(docs, train(docs, y, p), p).select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")
