"""Exact substring duplicates by bucket-pointer refinement over sampled suffixes.

A suffix matters here by its first ``length`` bytes.  Every window of that
length names one of its suffixes, the one whose q-gram has the smallest
hash, as its anchor; equal windows name the same anchor at the same offset,
so only anchors need buckets.

1. Initial buckets: anchors with equal q-grams.  Anchors alone in a bucket
   are dropped with all their windows.
2. Refinement: the members of a bucket are split by the identifier of all
   bytes that their windows reach, at the later offsets and before.  Members
   that stay together are repeats in every window, and one of them stands
   for all from here on.
3. Buckets that fell apart are refined again, a range of offsets at a time:
   the bytes that all windows of a range share are the next bucket, the
   bytes that any of them reaches the next part.  Ranges get smaller until
   they are single windows, and only those of mixed buckets go on.

Buckets are formed by map-side counts of 128-bit identifiers (bucket and
part together); no bucket is ever gathered in one task.  Texts that occur in
several rows take part once, with their number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import Scratch, bounded_batches, map_texts

BLOCK = 1 << 20  # bytes of a text looked at together


@dataclass(frozen=True)
class Params:
    length: int = 200
    gram: int = 64                       # a power of two, at most the length
    ranges: tuple[int, ...] = (16, 1)  # offsets refined together, ending with 1


def ordered_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """32-bit hashes of all grams, by doubling; ``gram`` is a power of two."""
    h = b.astype(np.uint32) * np.uint32(0x9E3779B1) + np.uint32(0x7F4A7C15)
    h ^= h >> np.uint32(15)
    step = 1
    while step < gram:
        h = (h[:-step] * np.uint32(0x85EBCA6B)) ^ (h[step:] * np.uint32(0xC2B2AE35) + np.uint32(step))
        h ^= h >> np.uint32(13)
        step *= 2
    return h


def anchors(b: bytes, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor) of the runs of windows that name the same anchor."""
    if len(b) < p.length:
        return (np.zeros(0, np.int64),) * 3
    width = p.length - p.gram + 1  # grams in a window
    named = []
    for at in range(0, len(b) - p.length + 1, BLOCK):
        part = np.frombuffer(b, np.uint8, min(len(b), at + BLOCK + p.length - 1) - at, at)
        h = ordered_hashes(part, p.gram)
        low = (h.astype(np.uint64) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)  # leftmost of equal hashes
        span = 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
        named.append((low & np.uint64(0xFFFFFFFF)).astype(np.int64) + at)
    a = np.concatenate(named)
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    return first, np.append(first[1:], len(a)) - 1, a[first]


def text_key(b: bytes) -> int:
    return xxhash.xxh3_64_intdigest(b)


def signed(x) -> pa.Array:
    return pa.array(np.array(x, np.uint64).view(np.int64))


def merged(first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal (start, end) byte runs that the windows first..last cover; both sorted by first."""
    if not len(first):
        return first, first
    end = np.maximum.accumulate(last + length)
    new = np.concatenate([[True], first[1:] > end[:-1]])
    return first[new], np.append(end[:-1][new[1:]], end[-1])


def packed_run(first: np.ndarray, last: np.ndarray, a: np.ndarray) -> np.ndarray:
    """First window, anchor behind it and windows after it, in one long; windows are shorter than 4096 bytes."""
    return first << 24 | (a - first) << 12 | (last - first)


def anchor_rows(texts: DataFrame, p: Params) -> DataFrame:
    """A row for each anchor of a text: text key, window run, bucket and part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]

            def made():
                rows = pa.RecordBatch.from_arrays([signed(np.concatenate(c)) for c in out], ["t", "at", "bucket", "part"])
                for c in out:
                    c.clear()
                return rows

            for text in batch.column("text").to_pylist():
                b = (text or "").encode()
                first, last, a = anchors(b, p)
                if not len(a):
                    continue
                gram = [xxhash.xxh3_64_intdigest(b[i:i + p.gram]) for i in a.tolist()]
                # The anchor's place in its bytes belongs to the identifier.
                part = [xxhash.xxh3_64_intdigest(b[i:j + p.length], k - i) for i, j, k in zip(first.tolist(), last.tolist(), a.tolist())]
                for c, x in zip(out, (np.full(len(a), text_key(b), np.uint64), packed_run(first, last, a).astype(np.uint64), np.array(gram, np.uint64), np.array(part, np.uint64))):
                    c.append(x)
                if sum(map(len, out[0])) > 200_000:
                    yield made()
            if out[0]:
                yield made()

    return texts.select("text").mapInArrow(run, "t long, at long, bucket long, part long")


def packed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, the text's key and its bytes, compressed for the shuffle."""
    def start():
        z = zstandard.ZstdCompressor(level=3)

        def run(texts):
            raw = [(t or "").encode() for t in texts]
            return [signed([text_key(b) for b in raw]), pa.array([z.compress(b) for b in raw], pa.binary())]
        return run

    return map_texts(docs, keep, start, "t long, z binary")


def reached(texts: DataFrame, p: Params) -> DataFrame:
    """(t, at, bytes): the bytes that the windows of some runs reach, from (z, ats) of their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            for t, blob, ats in zip(batch.column("t").to_pylist(), batch.column("z").to_pylist(), batch.column("ats").to_pylist()):
                b = z.decompress(blob)
                for k in range(0, len(ats), 10_000):
                    some = ats[k:k + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), t, np.int64)), pa.array(some, pa.int64()),
                                                      pa.array([b[i >> 24:(i >> 24) + (i & 4095) + p.length] for i in some], pa.binary())], ["t", "at", "bytes"])

    return texts.mapInArrow(run, "t long, at long, bytes binary")


def range_rows(parts: DataFrame, size: int, p: Params) -> DataFrame:
    """A row for each range of ``size`` offsets from the anchor that a run (t, at, low, high, bytes) has.

    Offsets low..high of the run are looked at.  ``bucket`` identifies the
    bytes that all windows of the full range share, ``part`` those that the
    run's windows in it reach; both with their place beside the anchor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[int]] = [[] for _ in range(8)]
            for t, at, low, high, b in zip(*(batch.column(c).to_pylist() for c in ("t", "at", "low", "high", "bytes"))):
                a = at >> 12 & 4095  # the anchor's place in the bytes
                for g in range(low // size, high // size + 1):
                    lo, hi = max(low, g * size), min(high, g * size + size - 1)
                    core = xxhash.xxh3_128_intdigest(b[a - g * size:a - g * size - size + 1 + p.length], g * 8192 + size)
                    span = xxhash.xxh3_128_intdigest(b[a - hi:a - lo + p.length], lo)
                    for c, x in zip(out, (t, at, lo, hi, core >> 64, core, span >> 64, span)):
                        c.append(x & (1 << 64) - 1)
            yield pa.RecordBatch.from_arrays([signed(c) for c in out], ["t", "at", "low", "high", "bucket", "bucket2", "part", "part2"])

    return parts.mapInArrow(run, "t long, at long, low long, high long, bucket long, bucket2 long, part long, part2 long")


def repeats(docs: DataFrame, scratch: Scratch, p: Params = Params()) -> DataFrame:
    """(t, first, last): runs of windows, by text key, whose bytes also start elsewhere."""
    bounded_batches(docs.sparkSession)
    first, behind, more = F.shiftright("at", 24), F.shiftright("at", 12).bitwiseAND(4095), F.col("at").bitwiseAND(4095)
    # Initial buckets: those of one anchor hold no repeat.
    found = scratch.store(anchor_rows(docs, p), "anchors")
    # Counts are stored before they are joined, so that AQE can split a bucket with very many members.
    shared = scratch.store(found.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"), "shared")
    rows = scratch.store(found.join(shared, "bucket").select("t", "at", (behind - more).alias("low"), behind.alias("high"), "bucket", F.lit(0).cast("long").alias("bucket2"),
                                                             "part", F.lit(0).cast("long").alias("part2")), "rows0")
    scratch.drop("anchors")
    bytes_of, gone = None, None
    for size in (*p.ranges, 0):
        # Parts of one bucket; one of its members stands for a part.
        bucket, part = ["bucket", "bucket2"], ["bucket", "bucket2", "part", "part2"]
        parts = scratch.store(rows.groupBy(*part).agg(F.count("*").alias("n"), F.min(F.struct("t", "at", "low", "high")).alias("one")), f"parts{size}")
        same = rows.join(parts.where("n > 1").select(*part), part).select("t", (first + behind - F.col("high")).alias("first"), (first + behind - F.col("low")).alias("last"))
        same = scratch.store(same, f"same{size}")
        gone = same if gone is None else gone.union(same)
        if not size:
            return gone
        mixed = scratch.store(parts.groupBy(*bucket).agg(F.count("*").alias("parts")).where("parts > 1").select(*bucket), f"mixed{size}")
        ahead = parts.join(mixed, bucket).select("one.*")
        if bytes_of is None:
            runs = ahead.groupBy("t").agg(F.collect_set("at").alias("ats"))
            bytes_of = scratch.store(reached(packed(docs, []).dropDuplicates(["t"]).join(runs, "t"), p), "bytes")
        rows = scratch.store(range_rows(ahead.join(bytes_of, ["t", "at"]), size, p), f"rows{size}")


def remove_repeats(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Texts without the bytes that some string of ``length`` bytes covers which also starts elsewhere.

    Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, spans (start and
    end of the maximal removed runs), kept (the remaining bytes) and
    kept_sha256.  Every copy goes, the first one too: strings are judged on
    the input.  A null text counts as empty; matches never cross rows; equal
    rows are copies of each other.  Of ``docs`` only doc_id and text are read.
    """
    scratch = Scratch(docs.sparkSession, "substring")
    found = scratch.store(repeats(docs, scratch, p).groupBy("t").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("runs")), "found")
    scratch.keep_only("found")
    rows = packed(docs.select("doc_id", "text"), ["doc_id"]).join(found, "t", "left").select("doc_id", "z", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            numbers, spans, kept, digests = [[], [], []], [], [], []
            runs = batch.column("runs")
            for k, blob in enumerate(batch.column("z").to_pylist()):
                b = z.decompress(blob)
                own = runs[k].values if runs[k].is_valid else None
                first = own.field("first").to_numpy().astype(np.int64) if own is not None else np.zeros(0, np.int64)
                last = own.field("last").to_numpy().astype(np.int64) if own is not None else first
                start, end = merged(first, last, p.length)
                cuts = [0, *np.stack([start, end], 1).ravel().tolist(), len(b)]
                rest = b"".join(b[i:j] for i, j in zip(cuts[::2], cuts[1::2]))
                for c, x in zip(numbers, (len(b), len(b) - len(rest), len(start))):
                    c.append(x)
                spans.append([{"start": i, "end": j} for i, j in zip(start.tolist(), end.tolist())])
                kept.append(rest)
                digests.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in numbers), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                                              pa.array(kept, pa.binary()), pa.array(digests, pa.string())],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, end: long>>, kept binary, kept_sha256 string")
