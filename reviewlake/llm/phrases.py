"""Exact substring duplicates on words: confirmed passages, sharded automata, all occurrences located.

A window is ``window`` consecutive words of one document.

1. Every window names the word gram with the smallest hash in it as its
   anchor; equal windows name the same one at the same place.  The windows
   that follow each other with one anchor are a piece.  Pieces whose anchor
   occurs once hold no repeat and are dropped.
2. Recurring passages are confirmed by map-side counts of 128-bit
   identifiers: of whole pieces where all pieces of an anchor are equal, of
   single windows, once for each distinct piece, where they differ.  Each
   confirmed window gets one home, its smallest (text, place); neighbouring
   ones are a passage of that text.
3. Passages are dealt to shards of bounded size.  A shard cuts its passages
   into phrases of half a window and compiles them into one Aho-Corasick
   automaton over words; every window of a passage contains a whole phrase.
4. All documents' stretches that hold a piece of a confirmed passage stream
   through the automata of its shards, which locate the phrases; a window
   around a phrase is an occurrence if it is one of the shard's.  A shard
   that very many stretches meet is compiled in several tasks.

No group is gathered: counts are combined before they are shuffled, joins are
on keys that Spark can split, and a task holds one automaton and the stretch
that passes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import Scratch, bounded_batches, map_texts

BLOCK = 1 << 17       # words looked at together
PART = 1 << 19        # bytes whose words are hashed together
HELD = 1 << 21        # bytes of texts whose windows are made together
STREAMED = 1 << 15    # words of the last stretches that are enough to stream
LOW = (1 << 64) - 1
BLANK = re.compile(rb"[\x20\x09-\x0D]")
IN_WORD = np.array([c != 32 and not 9 <= c <= 13 for c in range(256)])
LETTERS = np.random.default_rng(13).integers(0, LOW, (2, 256), np.uint64, endpoint=True)
POWERS = [np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(4095, m, np.uint64)])) for m in (0x9E3779B97F4A7C13, 0xD6E8FEB86659FD9B)]


@dataclass(frozen=True)
class Params:
    window: int = 35
    gram: int = 8                # words of an anchor
    shard_windows: int = 16_000  # confirmed windows of one automaton
    unit: int = 8_192            # places of one text that stay in one shard
    stretch: int = 4_096         # window starts of a text that stream together
    stream: int = 400            # stretches that meet one automaton in one task


def word_lanes(raw: list[bytes]) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Two 64-bit hashes of every word of some texts, and the number of words up to the end of each text.

    A word's hash adds up random numbers of its bytes, each times a power
    of an odd number for its place, so that no word is handled by itself.
    """
    joined = b"\n".join(raw)
    text_ends = np.cumsum([len(b) + 1 for b in raw])
    ends, lanes, at, seen = [], ([], []), 0, 0
    while at < len(joined) or not ends:
        # A part ends with a byte that separates words, or with the last one.
        cut = BLANK.search(joined, at + PART)
        stop = cut.end() if cut else len(joined)
        data = np.frombuffer(joined, np.uint8, stop - at, at)
        inside = IN_WORD[data]
        places = np.flatnonzero(inside)
        first = np.flatnonzero(np.concatenate([[True], np.diff(places) > 1]))[:len(places)]
        length = np.diff(np.append(first, len(places)))
        letters, k = data[places], np.arange(len(places)) - np.repeat(first, length)
        near, far = k & 4095, k >> 12
        for lane, out in enumerate(lanes):
            value = LETTERS[lane][letters] * POWERS[lane][near]
            if len(far) and far.max():
                value *= np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.repeat(POWERS[lane][4095:] * POWERS[lane][1:2], far.max())]))[far]
            out.append(np.add.reduceat(value, first) if len(first) else value)
        ends.append(np.searchsorted(places[first] + at, text_ends[(text_ends > at) & (text_ends <= stop)]) + seen)
        at, seen = stop, seen + len(first)
    if sum(map(len, ends)) < len(raw):
        ends.append(np.full(len(raw) - sum(map(len, ends)), seen))
    return tuple(np.concatenate(x) for x in lanes), np.concatenate(ends)


def mix(a: np.ndarray, b: np.ndarray, lane: int, step: int) -> np.ndarray:
    x = a * np.uint64((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)[lane]) ^ (b + np.uint64(step)) * np.uint64((0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)[lane])
    x ^= x >> np.uint64(31)
    x *= np.uint64((0xFF51AFD7ED558CCD, 0xE7037ED1A0B428DB)[lane])
    return x ^ (x >> np.uint64(29))


def runs_of(h: np.ndarray, width: int, lane: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, by doubling."""
    if len(h) < width:
        return h[:0]
    step = 1
    while step * 2 <= width:
        h = mix(h[:-step], h[step:], lane, step)
        step *= 2
    return h if step == width else mix(h[:len(h) - (width - step)], h[width - step:], lane, width)


def smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of ``width`` hashes from each place on, the first of equal ones."""
    low = (h & np.uint64(LOW ^ 0xFFFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    step = 1
    while step * 2 <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < width:
        low = np.minimum(low[:len(low) - (width - step)], low[width - step:])
    return (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def text_key(b: bytes) -> bytes:
    return xxhash.xxh3_128_digest(b)


def pieces(texts: DataFrame, p: Params) -> DataFrame:
    """A row for each piece of a text: text key, first window and their number, anchor and identifier."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [(t or "").encode() for t in batch.column("text").to_pylist()]
            keys = pa.array([text_key(b) for b in raw], pa.binary())
            hashes, ends = word_lanes(raw)
            del raw
            for at in range(0, max(0, len(hashes[0]) - p.window + 1), BLOCK):
                h = [x[at:at + BLOCK + p.window - 1] for x in hashes]
                whole = [runs_of(x, p.window, lane) for lane, x in enumerate(h)]
                gram = runs_of(h[0], p.gram, 0)
                anchor = smallest(gram, p.window - p.gram + 1)
                start = np.arange(len(anchor)) + at
                owner = np.searchsorted(ends, start, "right")
                inside = np.flatnonzero(start + p.window <= ends[owner])
                if not len(inside):
                    continue
                # A window inside a text has its anchor there, so a new text is a new anchor.
                first = inside[np.concatenate([[True], (anchor[inside][1:] != anchor[inside][:-1])])]
                last = inside[np.concatenate([np.searchsorted(inside, first)[1:], [len(inside)]]) - 1]
                part = [signed(mix(x[first], x[last], lane, p.window) + (last - first).astype(np.uint64)) for lane, x in enumerate(whole)]
                own = owner[first]
                place = start[first] - np.concatenate([[0], ends])[own]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(own)), pa.array(place << 8 | (last - first)), signed(gram[anchor[first]]), *part],
                                                 ["t", "at", "bucket", "part", "part2"])
            del hashes
            pa.default_memory_pool().release_unused()

    return texts.select("text").mapInArrow(run, "t binary, at long, bucket long, part long, part2 long")


def packed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, the text's key and its bytes, compressed for the shuffle."""
    def start():
        z = zstandard.ZstdCompressor(level=3)

        def run(texts):
            raw = [(t or "").encode() for t in texts]
            return [pa.array([text_key(b) for b in raw], pa.binary()), pa.array([z.compress(b) for b in raw], pa.binary())]
        return run

    return map_texts(docs, keep, start, "t binary, z binary")


def windows(texts: DataFrame, p: Params) -> DataFrame:
    """A row for each window of some pieces, from (t, z, ats) of their texts: its place, piece, number of copies and identifier."""
    def rows(batch: pa.RecordBatch, raw: list[bytes]) -> Iterator[pa.RecordBatch]:
        hashes, ends = word_lanes(raw)
        whole = [runs_of(h, p.window, lane) for lane, h in enumerate(hashes)]
        ats = batch.column("ats")
        begin, pieces_of = np.concatenate([[0], ends]), pc.list_value_length(ats).to_numpy(zero_copy_only=False)
        owner, (at, n) = np.repeat(np.arange(batch.num_rows), pieces_of), (ats.flatten().field(c).to_numpy() for c in ("at", "n"))
        for k in range(0, len(at), 1024):
            r = slice(k, k + 1024)
            times = (at[r] & 255) + 1
            place = np.repeat(at[r] >> 8, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            own = np.repeat(owner[r], times)
            a, b = (h[begin[own] + place] for h in whole)
            yield pa.RecordBatch.from_arrays([batch.column("t").take(pa.array(own)), pa.array(place), pa.array(np.repeat(at[r], times)), pa.array(np.repeat(n[r], times)), signed(a), signed(b)],
                                             ["t", "place", "at", "n", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            low, raw, size = 0, [], 0
            for k, blob in enumerate(batch.column("z")):  # some MB of text at a time
                raw.append(z.decompress(blob.as_py()))
                size += len(raw[-1])
                if size > HELD or k == batch.num_rows - 1:
                    yield from rows(batch.slice(low, k + 1 - low), raw)
                    low, raw, size = k + 1, [], 0

    return texts.mapInArrow(run, "t binary, place long, at long, n long, a long, b long")


def stretches(texts: DataFrame, p: Params) -> DataFrame:
    """What the shards get, from (t, z, holds, asks) of texts: passages (kind 0, once for each salt) and stretches (kind 1)."""
    names = ["shard", "salt", "kind", "t", "start", "words", "confirmed"]

    def rows(t: bytes, words: list[bytes], holds: list[dict], asks: list[dict]) -> Iterator[tuple]:
        by: dict[tuple, list] = {}
        for x in holds:
            by.setdefault((x["shard"], x["salts"], x["first"] // p.unit), []).append((x["first"], x["last"]))
        for (shard, salts, _), runs in by.items():
            runs.sort()
            passages = [[runs[0]]]
            end = runs[0][1] + p.window
            for first, last in runs[1:]:
                if first < end:  # passages that share words are one
                    passages[-1].append((first, last))
                else:
                    passages.append([(first, last)])
                end = max(end, last + p.window)
            for some in passages:
                start, stop = some[0][0], max(last for _, last in some) + p.window
                confirmed = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in some])) - start
                for salt in range(salts):
                    yield shard, salt, 0, t, start, b" ".join(words[start:stop]), confirmed.tolist()
        for x in asks:
            start = x["stretch"] * p.stretch
            yield x["shard"], x["salt"], 1, t, start, b" ".join(words[start:start + p.stretch + 2 * p.window]), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, kinds = zstandard.ZstdDecompressor(), [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int32())]

        def made(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names)

        for batch in batches:
            out, size = [], 0
            for t, blob, holds, asks in zip(*(batch.column(c).to_pylist() for c in ("t", "z", "holds", "asks"))):
                for row in rows(t, z.decompress(blob).split(), holds or [], asks or []):
                    out.append(row)
                    size += len(row[5])
                    if size > 4 << 20:
                        yield made(out)
                        out, size = [], 0
            if out:
                yield made(out)

    return texts.mapInArrow(run, "shard int, salt int, kind int, t binary, start long, words binary, confirmed array<int>")


class Automaton:
    """The confirmed passages of one shard: phrases in an Aho-Corasick automaton over words, and the windows' identifiers."""

    def __init__(self, passages: list[tuple[bytes, list[int]]], p: Params):
        self.p, self.phrase = p, (p.window + 1) // 2
        self.numbers: dict[bytes, int] = {}
        lanes, ends = word_lanes([words for words, _ in passages])
        text = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for words, _ in passages for w in words.split()], np.int64)
        self.hashes = []  # of each number; 0 stands for words that no passage has
        for h in lanes:
            self.hashes.append(np.zeros(len(self.numbers) + 1, np.uint64))
            self.hashes[-1][text] = h
        begin = np.concatenate([[0], ends[:-1]])
        start = np.concatenate([np.array(confirmed, np.int64) + b for (_, confirmed), b in zip(passages, begin.tolist())])
        a, b = (runs_of(h, p.window, lane)[start] for lane, h in enumerate(lanes))
        order = np.lexsort((b, a))
        self.a, self.b = a[order], b[order]
        self.found = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        s = self.letters(text)
        for first, last in zip(begin.tolist(), ends.tolist()):
            for k in range(first, last - self.phrase + 1, self.phrase):
                self.found.add_word(s[k:k + self.phrase])
        self.found.make_automaton()

    @staticmethod
    def letters(numbers: np.ndarray) -> str:
        """One character for each word; the surrogates' code points are left out."""
        return (numbers + 1 + 0x800 * (numbers + 1 >= 0xD800)).astype("<u4").tobytes().decode("utf-32-le")

    def occurrences(self, stretches: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """(stretch, start) of the confirmed windows in some stretches of words, which lie behind each other with a word between that no passage has."""
        parts = []
        for words in stretches:
            parts += [np.fromiter(map(self.numbers.get, words, repeat(0)), np.int64, len(words)), np.zeros(1, np.int64)]
        begin = np.cumsum([0, *(len(words) + 1 for words in stretches)])
        numbers = np.concatenate(parts) if parts else begin[:0]
        ends = np.array([end for end, _ in self.found.iter(self.letters(numbers))], np.int64)
        if not len(ends):
            return ends, ends
        # The windows around a phrase.
        edge = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(edge, np.maximum(ends - self.p.window + 1, 0), 1)
        np.add.at(edge, ends - self.phrase + 2, -1)
        at = np.flatnonzero(np.cumsum(edge)[:max(len(numbers) - self.p.window + 1, 0)])
        a, b = (runs_of(h[numbers], self.p.window, lane)[at] for lane, h in enumerate(self.hashes))
        low, high = (np.searchsorted(self.a, a, side) for side in ("left", "right"))
        hit = np.zeros(len(at), bool)
        for k in range(int((high - low).max(initial=0))):
            there = np.minimum(low + k, len(self.a) - 1)
            hit |= (low + k < high) & (self.b[there] == b)
        at = at[hit]
        owner = np.searchsorted(begin, at, "right") - 1
        return owner, at - begin[owner]


def located(feed: DataFrame, p: Params) -> DataFrame:
    """(t, first, last): runs of windows that the automata locate; rows come sorted by shard, salt and kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, passages, automaton = None, [], None
        waiting: list[tuple] = []  # stretches of one shard: text, start and words

        def found() -> pa.RecordBatch:
            owner, at = automaton.occurrences([words for *_, words in waiting])
            new = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(owner, prepend=-1) != 0))
            start = np.array([x for _, x, _ in waiting], np.int64)[owner]
            keys = pa.array([t for t, *_ in waiting], pa.binary())
            waiting.clear()
            last = at[np.append(new[1:], len(at)) - 1] if len(new) else at
            return pa.RecordBatch.from_arrays([keys.take(pa.array(owner[new])), pa.array(at[new] + start[new]), pa.array(last + start[new])], ["t", "first", "last"])

        for batch in batches:
            for s, salt, kind, t, start, blob, confirmed in zip(*(batch.column(c).to_pylist() for c in ("shard", "salt", "kind", "t", "start", "words", "confirmed"))):
                if (s, salt) != shard:
                    if waiting:
                        yield found()
                    shard, passages, automaton = (s, salt), [], None
                if kind == 0:
                    passages.append((blob, confirmed))
                    continue
                if automaton is None:
                    automaton, passages = Automaton(passages, p), []
                waiting.append((t, start, blob.split()))
                if sum(len(words) for *_, words in waiting[-8:]) > STREAMED or len(waiting) >= 64:
                    yield found()
        if waiting:
            yield found()

    return feed.mapInArrow(run, "t binary, first long, last long")


def repeats(docs: DataFrame, scratch: Scratch, p: Params = Params()) -> DataFrame:
    """(t, first, last): runs of windows, by text key, whose words also start elsewhere."""
    spark = docs.sparkSession
    bounded_batches(spark)
    bucket, part = ["bucket"], ["bucket", "part", "part2"]
    first, more = F.shiftright("at", 8), F.col("at").bitwiseAND(255)
    found = scratch.store(pieces(docs, p), "pieces")
    # Counts are stored before they are joined, so that AQE can split a key with very many rows.
    shared = scratch.store(found.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1").select(*bucket), "shared")
    rows = scratch.store(found.join(shared, bucket), "rows")
    scratch.drop("pieces")
    parts = scratch.store(rows.groupBy(*part).agg(F.count("*").alias("n"), F.min(F.struct("t", "at")).alias("one")).select(*part, "n", "one.*"), "parts")
    mixed = scratch.store(parts.groupBy(*bucket).agg(F.count("*").alias("parts")).where("parts > 1").select(*bucket), "mixed")
    # Confirmed passages: whole pieces, and single windows of pieces that differ.
    whole = scratch.store(parts.where("n > 1").join(mixed, bucket, "left_anti"), "whole")
    differ = scratch.store(parts.join(mixed, bucket), "differ")
    texts = packed(docs, []).dropDuplicates(["t"])
    some = differ.groupBy("t").agg(F.collect_list(F.struct("at", "n")).alias("ats"))
    each = scratch.store(windows(texts.join(some, "t"), p), "windows")
    again = each.groupBy("a", "b").agg(F.sum("n").alias("n"), F.min(F.struct("t", "place")).alias("one")).where("n > 1")
    again = scratch.store(again.select("a", "b", F.col("one.t").alias("home"), F.col("one.place").alias("first")), "again")
    confirmed = whole.agg(F.sum(more + 1)).first()[0] or 0
    confirmed += again.count()
    if not confirmed:
        return spark.createDataFrame([], "t binary, first long, last long")
    shards = -(-confirmed // p.shard_windows)

    def shard(t: str, place):
        return F.pmod(F.xxhash64(F.col(t), F.floor(place / p.unit).cast("long")), F.lit(shards)).cast("int")

    ends = whole.withColumn("unit", F.explode(F.array_distinct(F.array(F.floor(first / p.unit), F.floor((first + more) / p.unit)))))
    ends = ends.select(*part, "t", F.greatest(first, F.col("unit") * p.unit).alias("first"), F.least(first + more, (F.col("unit") + 1) * p.unit - 1).alias("last")).withColumn("shard", shard("t", F.col("first")))
    homes = ends.select("t", "first", "last", "shard").unionAll(again.select(F.col("home").alias("t"), "first", F.col("first").alias("last"), shard("home", F.col("first")).alias("shard")))
    # Which shards a piece meets, and with it the stretches of all documents that hold the piece.
    met = each.join(again.select("a", "b", shard("home", F.col("first")).alias("shard")), ["a", "b"]).select("t", "at", "shard").distinct()
    met = differ.join(met, ["t", "at"]).select(*part, "shard")
    met = scratch.store(ends.select(*part, "shard").unionAll(met), "met")
    asks = scratch.store(rows.join(met, part).select("t", F.floor(first / p.stretch).cast("long").alias("stretch"), "shard").distinct(), "asks")
    scratch.drop("windows")
    salts = scratch.store(asks.groupBy("shard").agg(F.ceil(F.count("*") / p.stream).cast("int").alias("salts")), "salts")
    asks = asks.join(salts, "shard").groupBy("t").agg(F.collect_list(F.struct("shard", F.pmod(F.xxhash64("t", "stretch"), F.col("salts")).cast("int").alias("salt"), "stretch")).alias("asks"))
    homes = homes.join(salts, "shard").groupBy("t").agg(F.collect_list(F.struct("shard", "salts", "first", "last")).alias("holds"))
    feed = scratch.store(stretches(texts.join(asks.join(homes, "t", "full"), "t"), p), "feed")
    dealt = feed.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind", "t", "start")
    return scratch.store(located(dealt, p), "located")


def remove_phrases(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Texts without the words that some window covers which also starts elsewhere.

    Per row of ``docs``: doc_id, n_words, n_removed, kept (the words that
    stay, joined by one space, as UTF-8 bytes) and kept_sha256.  Words are
    runs of bytes other than blank and 0x09 to 0x0D, unchanged.  Every
    occurrence goes, the first one too: windows are judged on the input.  A
    null text has no words; windows never cross rows; equal rows are copies
    of each other, and so are rows with null ids.  Of ``docs`` only doc_id
    and text are read; an empty table gives no row.
    """
    if p.window < 2 * p.gram or p.window - p.gram > 255 or p.unit < p.window:
        raise ValueError("a window holds at least two anchors, at most 255 places of one, and fits into a unit")
    scratch = Scratch(docs.sparkSession, "phrases")
    runs = repeats(docs, scratch, p).groupBy("t").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("runs"))
    runs = scratch.store(runs, "runs")
    scratch.keep_only("runs")
    rows = packed(docs.select("doc_id", "text"), ["doc_id"]).join(runs, "t", "left").select("doc_id", "z", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            total, removed, kept = [], [], []
            found = batch.column("runs")
            for k, blob in enumerate(batch.column("z").to_pylist()):
                words = z.decompress(blob).split()
                rest = words
                if found[k].is_valid:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, found[k].values.field("first").to_numpy(), 1)
                    np.add.at(edge, found[k].values.field("last").to_numpy() + p.window, -1)
                    rest = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                total.append(len(words))
                removed.append(len(words) - len(rest))
                kept.append(b" ".join(rest))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()),
                                              pa.array([hashlib.sha256(b).hexdigest() for b in kept], pa.string())], ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept binary, kept_sha256 string")
