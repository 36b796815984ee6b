"""Line deduplication: repeated runs of lines through a suffix array over line ids.

The corpus is a sequence of line ids, documents in their order, cut at their
ends and at every line that occurs once.  Distributed prefix doubling sorts
its suffixes by their first 1, 2, 4, ... lines; a suffix's rank is how many
come before its group, and only groups of several go on.  The stored ranks
of all doublings give the longest common prefix of each suffix and the one
before it in the array.  A repeat counts from ``min_words`` words on: the
suffixes between two places where the common prefix is too short for that
are an interval, which holds all copies of a run; its smallest common prefix
is how far all copies go on together.  All copies but the first go.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from reviewlake.llm.common import Scratch, bounded_batches, map_texts, ranked, unused

WORD = "[^\\x09-\\x0D\\x20]+"
DOC = ["none", "doc", "th"]  # a document: its id (null last) and the hash of its text
BLOCK = 16  # bits of a place inside a block: running sums and maxima go through blocks, then over their totals


@dataclass(frozen=True)
class Params:
    min_words: int = 8  # of a repeated run, over all its lines


def document_key(docs: DataFrame) -> list[Column]:
    """The document that a row is; ids may have any type that can be ordered, and a null one stands in for itself by ``none``."""
    kind = docs.schema["doc_id"].dataType
    some = F.lit(0) if isinstance(kind, NumericType) else F.lit("") if isinstance(kind, StringType) else F.lit(None)
    return [F.isnull("doc_id").alias("none"), F.coalesce("doc_id", some.cast(kind)).alias("doc"), F.xxhash64("text").alias("th")]


def repeated_lines(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(none, doc, th, lines): the lines of a document that occur more than once, with place, id and words.

    Lines without a word are left out and not counted.  Equal rows of
    ``docs`` are one document, here by the set of their lines.  A line is
    known by 128 bits of its hashes; its id is the place of those among all
    that are shared.
    """
    lines = docs.select(*document_key(docs), F.posexplode(F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD))).alias("j", "line")).select(
        *DOC, "j", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), F.regexp_count("line", F.lit(WORD)).alias("words"))
    # Stored before it is joined, so that AQE can split a line that very many documents share.
    shared, _ = ranked(lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2"), ["h1", "h2"], scratch)
    shared = scratch.store(shared.withColumnRenamed("rank", "h"), "shared")
    scratch.drop("placed")
    return lines.join(shared, ["h1", "h2"]).groupBy(*DOC).agg(F.sort_array(F.collect_set(F.struct("j", "h", "words"))).alias("lines"))


def refined(kinds: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``kinds(r, r2, n)``, one row for each pair, with ``rank``: ``r`` and the sum of ``n`` over the smaller r2 of this r."""
    kinds = scratch.store(kinds.withColumn("block", F.shiftright("r2", BLOCK)), name)
    # A very frequent r has many r2: only a block of them goes through one task, then a row for each block.
    behind = Window.partitionBy("r").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = kinds.groupBy("r", "block").agg(F.sum("n").alias("all")).select("r", "block", (F.sum("all").over(behind) - F.col("all")).alias("before"))
    within = Window.partitionBy("r", "block").orderBy("r2").rowsBetween(Window.unboundedPreceding, 0)
    return kinds.withColumn("within", F.sum("n").over(within) - F.col("n")).join(blocks, ["r", "block"]).select(
        "r", "r2", "n", (F.col("r") + F.col("before") + F.col("within")).alias("rank"))


def placed_documents(found: DataFrame, scratch: Scratch) -> DataFrame:
    """(none, doc, th, base): the place of a document's first line when the documents stand in their order."""
    order, _ = ranked(found.select(*DOC, (F.element_at("lines", -1)["j"] + 1).cast("long").alias("n")), DOC, scratch)
    order = scratch.store(order, "order")
    base = refined(order.select(F.lit(0).cast("long").alias("r"), F.col("rank").alias("r2"), "n"), scratch, "lengths")
    placed = scratch.store(order.join(base.select(F.col("r2").alias("rank"), F.col("rank").alias("base")), "rank").select(*DOC, "base"), "documents")
    for name in ("placed", "order", "lengths"):
        scratch.drop(name)
    return placed


def suffixes(found: DataFrame, p: Params) -> DataFrame:
    """(base, pos, h, rest, need) of every repeated line of ``found(base, lines)``.

    ``rest`` is how many repeated lines follow each other from here on in
    this document, this one included; ``need`` is how many of them have
    enough words, 0 if all have not.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = b.column("lines")
            flat, at = lines.flatten(), lines.offsets.to_numpy()
            at = at - at[0]
            j, words = (flat.field(c).to_numpy().astype(np.int64) for c in ("j", "words"))
            owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
            base = b.column("base").to_numpy()[owner]
            total = np.concatenate([[0], np.cumsum(words)])
            # A stretch of neighbouring lines ends before a line that is not repeated or of another document.
            ends = np.flatnonzero(np.concatenate([(j[1:] != j[:-1] + 1) | (owner[1:] != owner[:-1]), [True] * bool(len(j))])) + 1
            stretch_end = ends[np.searchsorted(ends, np.arange(len(j)), "right")] if len(j) else ends
            stop = np.searchsorted(total, total[:-1] + p.min_words)  # the run ends before this line
            need = np.where(stop <= stretch_end, stop - np.arange(len(j)), 0)
            yield pa.RecordBatch.from_arrays([pa.array(base), pa.array(base + j), flat.field("h"), pa.array(stretch_end - np.arange(len(j))), pa.array(need)],
                                             ["base", "pos", "h", "rest", "need"])

    return found.mapInArrow(run, "base long, pos long, h long, rest long, need long")


def suffix_array(lines: DataFrame, scratch: Scratch) -> tuple[DataFrame, dict[int, DataFrame]]:
    """(sa, pos, rest) of ``lines(pos, h, rest)``, and for each doubling (pos, r) of the suffixes that share a rank.

    A suffix goes to the end of its stretch; one that another goes on from
    comes before it, and equal ones stand by their place.
    """
    pairs, size, levels = lines.select("pos", "rest", F.lit(0).cast("long").alias("r"), F.col("h").alias("r2")), 1, {}
    while True:
        pairs = scratch.store(pairs, f"pairs{size}")
        # Stored before they are joined, so that AQE can split a pair that very many suffixes share.
        kinds = scratch.store(refined(pairs.groupBy("r", "r2").agg(F.count("*").alias("n")), scratch, f"kinds{size}"), "new")
        levels[size] = scratch.store(pairs.join(kinds, ["r", "r2"]).select("pos", "rest", F.col("rank").alias("r"), "n"), f"ranks{size}")
        for name in (f"pairs{size}", f"kinds{size}", "new"):
            scratch.drop(name)
        goes_on = levels[size].where((F.col("n") > 1) & (F.col("rest") >= size))
        latest = levels[size]
        for s, level in levels.items():
            if s < size:
                latest = latest.union(level.where((F.col("n") == 1) | (F.col("rest") < s)))
        if goes_on.isEmpty():
            break
        after = latest.select((F.col("pos") - size).alias("pos"), F.col("r").alias("r2"))
        ended = goes_on.where(F.col("rest") == size).select("pos", "rest", "r", F.lit(-1).cast("long").alias("r2"))
        pairs = goes_on.where(F.col("rest") > size).join(after, "pos").select("pos", "rest", "r", "r2").union(ended)
        size *= 2
    equal = latest.where("n > 1")
    places = refined(equal.select("r", F.col("pos").alias("r2"), F.lit(1).cast("long").alias("n")), scratch, "equal")
    array = latest.where("n = 1").select(F.col("r").alias("sa"), "pos", "rest").union(
        equal.select("pos", "rest").join(places.select(F.col("r2").alias("pos"), F.col("rank").alias("sa")), "pos").select("sa", "pos", "rest"))
    array = scratch.store(array, "array")
    scratch.drop("equal")
    return array, {s: level.where("n > 1").select("pos", "r") for s, level in levels.items()}


def common_prefixes(array: DataFrame, levels: dict[int, DataFrame], scratch: Scratch) -> DataFrame:
    """(sa, pos, lcp): the lines that a suffix has in common with the one before it in the array.

    From the longest doubling down, two places with the same rank have that
    many lines in common and go on behind them.
    """
    before = array.select((F.col("sa") + 1).alias("sa"), F.col("pos").alias("pos0"), F.col("rest").alias("rest0"))
    pairs = scratch.store(array.join(before, "sa", "left").withColumn("lcp", F.lit(0).cast("long")), "common0")
    for k, size in enumerate(sorted(levels, reverse=True), 1):
        on = F.col("lcp") < F.least("rest", "rest0")  # neither suffix is at its end
        a, b = (levels[size].select(F.col("pos").alias(at), F.col("r").alias(r)) for at, r in (("at", "a"), ("at0", "b")))
        pairs = pairs.withColumn("at", F.when(on, F.col("pos") + F.col("lcp"))).withColumn("at0", F.when(on, F.col("pos0") + F.col("lcp")))
        more = F.when(F.col("a") == F.col("b"), F.least(F.lit(size).cast("long"), F.col("rest") - F.col("lcp"))).otherwise(F.lit(0))
        pairs = pairs.join(a, "at", "left").join(b, "at0", "left").select("sa", "pos", "rest", "pos0", "rest0", (F.col("lcp") + more).alias("lcp"))
        pairs = scratch.store(pairs, f"common{k}")
        scratch.drop(f"common{k - 1}")
    return pairs.select("sa", "pos", "lcp")


def intervals(common: DataFrame, lines: DataFrame, p: Params) -> DataFrame:
    """(sa, pos, lcp, base, need, start): where the stretch of the array with common prefixes of ``need`` lines or more begins.

    A line has a word at least, so ``need`` goes to ``min_words``.  The last
    place with a shorter common prefix is found in blocks of the array, and
    before a block from the last places of the blocks (a row for each).
    """
    depths = range(1, p.min_words + 1)

    def last(t: int) -> Column:
        return F.max(F.when(F.col("lcp") < t, F.col("sa")))

    block = F.shiftright("sa", BLOCK)
    inside = Window.partitionBy("block").orderBy("sa").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = common.groupBy(block.alias("block")).agg(*(last(t).alias(f"t{t}") for t in depths)).select(
        "block", F.array(*(F.max(f"t{t}").over(earlier) for t in depths)).alias("carried"))
    wanted = common.join(lines.select("pos", "base", "need"), "pos").withColumn("block", block)
    wanted = wanted.withColumn("own", F.array(*(last(t).over(inside) for t in depths))).where("need > 0").join(carried, "block")
    return wanted.select("sa", "pos", "lcp", "base", "need", F.coalesce(F.get("own", F.col("need").cast("int") - 1), F.get("carried", F.col("need").cast("int") - 1)).alias("start"))


def later_copies(docs: DataFrame, scratch: Scratch, p: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """(base, j, len, lcp) of repeated runs that an equal one precedes, by doc_id, text hash and line; and the documents by ``base``.

    ``len`` lines have enough words; ``lcp`` lines are common to all copies.
    """
    bounded_batches(docs.sparkSession)
    found = scratch.store(repeated_lines(docs, scratch), "found")
    placed = placed_documents(found, scratch)
    lines = scratch.store(suffixes(found.join(placed, DOC).select("base", "lines"), p), "lines")
    scratch.drop("found")
    array, levels = suffix_array(lines, scratch)
    common = common_prefixes(array, levels, scratch)
    for name in ("array", *(f"ranks{size}" for size in levels)):
        scratch.drop(name)
    runs = scratch.store(intervals(common, lines, p), "runs")
    scratch.keep_only("runs", "documents")
    first = runs.groupBy("start", "need").agg(F.min("pos").alias("first"), F.count("*").alias("n"), F.min(F.when(F.col("sa") > F.col("start"), F.col("lcp"))).alias("common"))
    first = scratch.store(first.where("n > 1").drop("n"), "first")
    return runs.join(first, ["start", "need"]).where("pos <> first").select("base", (F.col("pos") - F.col("base")).alias("j"), F.col("need").alias("len"), F.col("common").alias("lcp")), placed


def maximal_runs(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(none, doc, th, runs): start and end line of the maximal runs that go, numbered without blank lines.

    A run goes on as far as all its copies do, up to the last line at which
    enough words end; runs that touch are one.
    """
    found, placed = later_copies(docs, Scratch(docs.sparkSession, "lines"), p)
    found = found.groupBy("base").agg(F.sort_array(F.collect_list(F.struct("j", "len", "lcp"))).alias("found")).join(placed, "base").select(*DOC, "found")

    def joined(rows):
        out = []
        for row in rows:
            merged: list[list[int]] = []
            ends = [r["j"] + r["len"] for r in row]
            for r in row:
                stop = ends[bisect_right(ends, r["j"] + r["lcp"]) - 1]
                if merged and r["j"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], stop)
                else:
                    merged.append([r["j"], stop])
            out.append([{"start": a, "stop": b} for a, b in merged])
        return [pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]

    return map_texts(found, DOC, lambda: joined, "runs array<struct<start: long, stop: long>>", text="found")


def without(text: str | None, runs: list[dict] | None) -> tuple[str | None, int, int]:
    """The text without the lines of the runs, how many lines with a word it had, and how many went."""
    lines = text.split("\n") if text is not None else []
    j, removed, kept, k = 0, 0, [], 0
    runs = runs or []
    for line in lines:
        if not line.strip(" \t\n\r\x0b\f"):
            kept.append(line)
            continue
        while k < len(runs) and runs[k]["stop"] <= j:
            k += 1
        if k < len(runs) and runs[k]["start"] <= j:
            removed += 1
        else:
            kept.append(line)
        j += 1
    if not removed:
        return text, j, 0
    return ("\n".join(kept) if removed < j else ""), j, removed


def dedup(docs: DataFrame, p: Params = Params(), counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """All columns of ``docs``, ``text`` without later copies of repeated runs, and how many lines it had and lost.

    Documents come in the order of doc_id (null last; numbers, strings and
    other types that can be ordered), then of the hash of the text; equal rows are one document and keep the same lines.  Null and
    empty texts stay as they are; lines without a word stay unless every
    line with a word goes, which leaves an empty text.  No row is dropped.
    Columns of ``docs`` named as the ``counts`` are replaced.
    """
    names = [c for c in docs.columns if c not in ("text", *counts)]
    key = [unused(docs, f"_{c}") for c in DOC]
    gone = maximal_runs(docs, p).select(F.struct(*DOC).alias("gone"), "runs")
    both, match = unused(docs, "_both"), unused(docs, "_key")
    rows = docs.select(*names, F.struct("text").alias(both), F.struct(*(c.alias(k) for c, k in zip(document_key(docs), DOC))).alias(match)).join(
        gone.select(F.col("gone").alias(key[0]), F.col("runs").alias(key[1])), F.col(match) == F.col(key[0]), "left").select(
        *names, F.col(both).withField("runs", F.col(key[1])).alias(both))

    def edited(parts):
        made = [without(x["text"], x["runs"]) for x in parts]
        return [pa.array([m[0] for m in made], pa.string()), np.array([m[1] for m in made], np.int64), np.array([m[2] for m in made], np.int64)]

    return map_texts(rows, names, lambda: edited, f"text string, {counts[0]} long, {counts[1]} long", text=both).select(
        *[c for c in docs.columns if c not in counts], *counts)
