"""Vector codes of a product quantiser, each part's nearest entry found by slices and bitmasks.

Vectors are cut into equal parts; every part position has a codebook of
integer entries, and a part's code is the index of its nearest entry.  The
entries' coordinates are sorted for each dimension, and every place of the
sorted order carries the mask of the entries before it.  The distance to one
entry is the initial radius: the entries within it along a dimension are a
slice of the sorted order, so two masks name them; the slices of all
dimensions are intersected by AND, and only entries whose bits stay set are
measured.  The nearest entry is always among them, so codes are exact.

Training is Lloyd's rounds as Spark aggregates: a task sends one sum for each
entry that it used, whatever its number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import Scratch, bounded_batches, unused

WORD = 64            # entries that one mask holds
LARGEST = 1 << 26    # of a component times the scale: squared distances and sums stay within 64 bits


@dataclass(frozen=True)
class Params:
    parts: int = 16
    entries: int = 64    # of a codebook, at most; more than 64 take several masks
    rounds: int = 2
    scale: int = 256     # components become floor(scale * x)


class Slices:
    """Search structure of one codebook (entries, dimensions), for many queries at once."""

    def __init__(self, book: np.ndarray):
        self.book = book
        self.order = np.argsort(book[:, 0], kind="stable")
        self.first = book[self.order, 0]
        self.words = []  # (first entry, sorted coordinates, masks before each place) of 64 entries at a time
        for at in range(0, len(book), WORD):
            some = book[at:at + WORD]
            by = np.argsort(some, axis=0, kind="stable")
            bits = np.uint64(1) << by.astype(np.uint64)
            masks = np.concatenate([np.zeros((1, some.shape[1]), np.uint64), np.bitwise_or.accumulate(bits, axis=0)])
            self.words.append((at, np.take_along_axis(some, by, 0), masks))

    def radius(self, x: np.ndarray) -> np.ndarray:
        """Squared distance of each query to the entry that follows it along the first dimension."""
        near = self.order[np.minimum(np.searchsorted(self.first, x[:, 0]), len(self.order) - 1)]
        return ((x - self.book[near]) ** 2).sum(1)

    def candidates(self, x: np.ndarray, reach: np.ndarray, word: int) -> np.ndarray:
        """Mask of the entries of one word that no dimension places farther than ``reach``."""
        _, coordinates, masks = self.words[word]
        both = np.full(len(x), ~np.uint64(0))
        for d in range(x.shape[1]):
            low = np.searchsorted(coordinates[:, d], x[:, d] - reach, "left")
            high = np.searchsorted(coordinates[:, d], x[:, d] + reach, "right")
            both &= masks[high, d] ^ masks[low, d]
        return both

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each query, the lower of equal ones, and the squared distance."""
        best = self.radius(x)
        code = np.full(len(x), -1, np.int64)
        for word, (at, _, _) in enumerate(self.words):
            # The root is rounded up, so that rounding never leaves an entry outside.
            mask = self.candidates(x, np.ceil(np.sqrt(best.astype(np.float64))).astype(np.int64) + 1, word)
            row = np.flatnonzero(mask)
            mask = mask[row]
            while len(row):
                low = mask & (~mask + np.uint64(1))
                entry = at + np.frexp(low.astype(np.float64))[1] - 1  # a power of two: its exponent is exact
                far = ((x[row] - self.book[entry]) ** 2).sum(1)
                better = (far < best[row]) | ((far == best[row]) & (code[row] < 0))
                best[row[better]], code[row[better]] = far[better], entry[better]
                mask ^= low
                left = mask != 0
                row, mask = row[left], mask[left]
        return code, best


UNEQUAL = "vectors must have one length, a multiple of the number of parts"


def integers(batch: pa.RecordBatch, vector: str, p: Params, length: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors of a batch, and their integer components."""
    column = batch.column(vector)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    bad = ~np.isfinite(flat.to_numpy(zero_copy_only=False).astype(np.float64)) if len(flat) else np.zeros(0, bool)
    ends = np.cumsum(sizes)
    broken = np.diff(np.concatenate([[0], np.cumsum(bad)])[np.concatenate([[0], ends])]) > 0  # a null is no number here either
    row = np.flatnonzero((sizes > 0) & ~broken)
    if not len(row):
        return row, np.zeros((0, 0), np.int64)
    if len(np.unique(sizes[row])) > 1 or sizes[row[0]] % p.parts or sizes[row[0]] != (length or sizes[row[0]]):
        raise ValueError(UNEQUAL)
    x = np.floor(p.scale * flat.to_numpy(zero_copy_only=False).astype(np.float64)[(ends[row] - sizes[row])[:, None] + np.arange(sizes[row[0]])])
    if np.abs(x).max() > LARGEST:
        raise ValueError(f"components beyond {LARGEST // p.scale} in size have no code")
    return row, x.astype(np.int64)


def assigned(x: np.ndarray, books: list[Slices]) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, parts): codes and squared distances."""
    found = [book.nearest(np.ascontiguousarray(part)) for book, part in zip(books, np.split(x, len(books), axis=1))]
    return np.stack([c for c, _ in found], 1), np.stack([e for _, e in found], 1)


def first_books(rows: DataFrame, key: str, vector: str, p: Params) -> np.ndarray | None:
    """(part, entry, component) of the vectors with the smallest ids: ``entries`` vectors reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, x = integers(batch, vector, p)
            if len(row):
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(row)), pa.array(list(x), pa.list_(pa.int64()))], [key, "x"])

    kind = rows.schema[key].dataType.simpleString()
    low = rows.select(key, vector).mapInArrow(run, f"`{key}` {kind}, x array<long>").orderBy(F.col(key).asc_nulls_last(), "x").limit(p.entries).collect()
    if len({len(r["x"]) for r in low}) > 1:
        raise ValueError(UNEQUAL)
    return np.array([np.split(np.array(r["x"], np.int64), p.parts) for r in low]).transpose(1, 0, 2) if low else None


def trained_round(rows: DataFrame, vector: str, books: np.ndarray, p: Params) -> np.ndarray:
    """The codebooks after one round: every used entry is the rounded-down mean of its parts.

    A task adds up its vectors and sends at most one row for each entry;
    what reaches the driver is one row for each entry.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices, total = [Slices(b) for b in books], np.zeros(books.shape, np.int64)
        count = np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            row, x = integers(batch, vector, p, books.shape[0] * books.shape[2])
            if not len(row):
                continue
            code, _ = assigned(x, slices)
            for k, part in enumerate(np.split(x, p.parts, axis=1)):
                np.add.at(total[k], code[:, k], part)
                count[k] += np.bincount(code[:, k], minlength=count.shape[1])
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]),
                                          pa.array(list(total[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "x"])

    sums = [F.sum(F.col("x")[d]).alias(f"x{d}") for d in range(books.shape[2])]
    found = rows.select(vector).mapInArrow(run, "part int, entry int, n long, x array<long>").groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect()
    made = books.copy()
    for r in found:
        made[r["part"], r["entry"]] = [r[f"x{d}"] // r["n"] for d in range(books.shape[2])]
    return made


def train(vectors: DataFrame, p: Params = Params(), key: str = "vec_id", vector: str = "embedding") -> np.ndarray | None:
    """Codebooks (part, entry, component) as integers, None without a usable vector.

    They start as the parts of the ``entries`` vectors with the smallest ids
    (all, if fewer; of rows that share an id, the smaller vectors first;
    null ids last) and go through ``rounds`` of assignment and means.
    Their size follows the parameters and the length of a vector alone.
    """
    bounded_batches(vectors.sparkSession)
    books = first_books(vectors, key, vector, p)
    for _ in range(p.rounds if books is not None else 0):
        books = trained_round(vectors, vector, books, p)
    return books


def encode(vectors: DataFrame, books: np.ndarray | None, p: Params = Params(), keep: tuple[str, ...] = ("vec_id",), vector: str = "embedding") -> DataFrame:
    """``keep`` columns, ``codes`` (array of entry indexes in part order) and ``error`` of every usable vector."""
    bounded_batches(vectors.sparkSession)
    keep = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books] if books is not None else []
        for batch in batches:
            row, x = integers(batch, vector, p, books.shape[0] * books.shape[2] if books is not None else None)
            if len(row):
                code, far = assigned(x, slices)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(row)) for c in keep), pa.array(list(code.astype(np.int32)), pa.list_(pa.int32())), pa.array(far.sum(1))],
                                                 [*keep, "codes", "error"])

    kinds = [f"`{c}` {vectors.schema[c].dataType.simpleString()}" for c in keep]
    return vectors.select(*keep, vector).mapInArrow(run, ", ".join([*kinds, "codes array<int>, error long"]))


def decode(books: np.ndarray, codes: np.ndarray, p: Params = Params()) -> np.ndarray:
    """The vectors that rows of codes stand for: the middle of each entry's integer cell."""
    return (np.concatenate([book[codes[:, k]] for k, book in enumerate(books)], axis=1) + 0.5) / p.scale


def digest(books: np.ndarray | None) -> str:
    """SHA-256 of all components as decimal numbers by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, [] if books is None else books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, p: Params = Params(), key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per usable vector: id, label, codes, error, label_error, and the digest of the trained codebooks.

    Rows whose vector is null, empty, or holds null or non-finite components
    are dropped; all other vectors must have one length, a multiple of the
    number of parts, and components whose scaled size is below 2^26: else an
    error is raised.  Every row counts, also repeated ones and those with a
    null id.  ``label_error`` sums the errors of equal labels, nulls
    together.  An empty table gives no row.  Only the three named columns
    are read.
    """
    scratch = Scratch(vectors.sparkSession, "codes")
    books = train(vectors, p, key, vector)
    coded = scratch.store(encode(vectors, books, p, (key, label), vector), "coded")
    # Stored before the join, so that AQE measures the sums and splits a label with very many rows.
    mark = unused(coded, "mark")
    sums = scratch.store(coded.groupBy(F.col(label).alias(mark)).agg(F.sum("error").alias("label_error")), "sums")
    return coded.join(sums, F.col(label).eqNullSafe(F.col(mark)), "left").select(key, label, "codes", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
