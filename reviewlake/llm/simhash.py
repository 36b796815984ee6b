"""SimHash near-duplicates through one-wildcard segment variants.

A 64-bit fingerprint is cut into so few segments that, of two linked
fingerprints, one segment differs by at most one bit: three for four bits.
Each segment is indexed as it is and once for each of its bits replaced by
a wildcard.  Fingerprints that share a variant meet in the equality shuffle
and are verified by their whole Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import Scratch, map_texts, unused
from reviewlake.llm.components import components

SEED = 42


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash over the XXH64 of word shingles, unsigned; zero without a word."""
    words = (text or "").encode().lower().split()  # A-Z; the six ASCII blanks
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends - np.fromiter(map(len, words), np.int64, len(words)) - 1
    k = min(shingle, len(words))
    digest, set_bits, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(words) - k + 1
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        a, b = starts[at:min(at + (1 << 16), n)].tolist(), (ends[at + k - 1:min(at + (1 << 16), n) + k - 1] - 1).tolist()
        h = np.array([digest(joined[i:j], SEED) for i, j in zip(a, b)], ">u8")
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; fp is the fingerprint as a signed long."""
    def start():
        return lambda texts: [np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)]

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return map_texts(rows, ["doc_id", "text_hash"], start, "fp long")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the fewest segments of which one differs by at most one bit."""
    count = max_bits // 2 + 1
    cuts = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp): a row for each segment as it is and with each of its bits replaced by a wildcard."""
    keys, tag = [], 0
    for low, width in segments(max_bits):
        part = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(-1, width):
            kept = (1 << width) - 1 if bit < 0 else ((1 << width) - 1) & ~(1 << bit)
            # The tag tells segment and wildcard; widths stay under 57 bits but for one or two segments.
            keys.append(F.xxhash64(F.lit(tag), part.bitwiseAND(F.lit(kept))) if width > 48 else part.bitwiseAND(F.lit(kept)).bitwiseOR(F.lit(tag << 49)))
            tag += 1
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def linked(run: np.ndarray, max_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that connect exactly those fingerprints of one bucket that chains of near ones connect.

    Breadth first: a fingerprint is compared with those that no other has
    reached, so a dense group costs few passes and gives one link for each
    member, not one for each pair.
    """
    left, us, vs, queue = run, [], [], []
    while len(left):
        if queue:
            u = queue.pop()
        else:
            u, left = int(left[0]), left[1:]
        near = np.bitwise_count(left ^ np.uint64(u)) <= max_bits
        if near.any():
            found, left = left[near], left[~near]
            us.append(np.full(len(found), u, np.uint64))
            vs.append(found)
            queue.extend(found.tolist())
    return us, vs


def bucket_links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links of the buckets of one partition, sorted by key; a bucket may run over several batches."""
    def links(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, int)
        sizes = np.diff(np.append(starts, len(k)))
        us, vs = [], []
        two = starts[sizes == 2]
        near = np.bitwise_count(f[two] ^ f[two + 1]) <= max_bits
        us.append(f[two[near]])
        vs.append(f[two[near] + 1])
        for a, n in zip(starts[sizes > 2], sizes[sizes > 2]):
            u, v = linked(f[a:a + n], max_bits)
            us += u
            vs += v
        pairs = np.unique(np.stack([np.concatenate(us), np.concatenate(vs)]).view(np.int64), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["u", "v"])

    held_k, held_f = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for b in batches:
        k = b.column("key").to_numpy()
        f = b.column("fp").to_numpy().view(np.uint64)
        if not len(k):
            continue
        cut = int(np.searchsorted(k, k[-1]))  # what may go on in the next batch stays here
        if cut == 0 and len(held_k[-1]) and held_k[-1][-1] == k[-1]:
            held_k.append(k)
            held_f.append(f)
            continue
        yield links(np.concatenate([*held_k, k[:cut]]), np.concatenate([*held_f, f[:cut]]))
        held_k, held_f = [k[cut:]], [f[cut:]]
    yield links(np.concatenate(held_k), np.concatenate(held_f))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id, root, text_hash): one row for each row of ``docs``.

    Two rows belong together if a chain of fingerprints, each at most
    ``max_bits`` from the next, leads from one to the other; equal
    fingerprints always do.  component_id is the smallest doc_id there; null
    ids are ranked after all others, so it is null only if all are.  Null,
    empty and blank texts have fingerprint zero.  Of ``docs`` only doc_id and
    text are read.  Copies share a fingerprint and enter the search once.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    prints = scratch.store(fingerprints(docs, shingle), "prints")
    distinct = scratch.store(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    # A row becomes many: the few bytes of the fingerprints are dealt to all tasks before that.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = variants(distinct.select("fp").repartition(tasks), max_bits)
    dealt = index.repartition("key").sortWithinPartitions("key")
    links = dealt.mapInArrow(lambda batches: bucket_links(batches, max_bits), "u long, v long")
    roots = components(links, scratch)
    named = scratch.store(distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")), "named")
    # Stored before it is joined, so that AQE can split a root with very many fingerprints.
    smallest = scratch.store(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    members = scratch.store(named.join(smallest, "root").select("fp", "root", "component_id"), "members")
    scratch.keep_only("prints", "members")
    return prints.join(members, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root", "text_hash")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: that of the smallest doc_id.

    Null ids come last.  Of several rows with that id, the one with the
    smallest hash of its text stays, and one of equal rows.
    """
    found = near_duplicates(docs, shingle, max_bits)
    ident, own_hash, chosen_hash, copies = (unused(docs, c) for c in ("_id", "_own_hash", "_hash", "_copies"))
    row = found.groupBy("component_id", "root", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    chosen = row.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_hash", "copies")).alias("c")).select(
        F.col("c.doc_id").alias(ident), F.col("c.text_hash").alias(chosen_hash), F.col("c.copies").alias(copies))
    kept = docs.withColumn(own_hash, F.xxhash64("text")).join(
        chosen, F.col("doc_id").eqNullSafe(F.col(ident)) & (F.col(own_hash) == F.col(chosen_hash)))
    once = kept.where(F.col(copies) > 1).dropDuplicates([ident, chosen_hash])  # only rows that repeat wholly
    return kept.where(F.col(copies) == 1).union(once).select(*docs.columns)
