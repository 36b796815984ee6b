"""Ranked lexical search by range-maximum queries over posting lists.

The documents are tokenised once into blocks of an index: for each term of
the items a posting list of (document, occurrences), documents in order of
their ids.  A term that no item holds is left out by a bitmap of the items'
terms, of fixed size; what it lets through by chance is never asked for.

With the statistics of all documents every posting has an impact, the share
of its term in a score.  A sparse table over a posting list gives the place
of the largest impact between any two documents in constant time.  The sum of
these maxima over an item's terms bounds every score in an interval of
documents.  The search is best-first: the interval with the largest bound is
split at the document with the largest impact in it, that document is scored
exactly, and both sides get bounds of their own; it ends when no bound
reaches the last place.  All items of a block advance together.  A block of
documents sends at most ``top`` rows for each item, and these are merged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import Scratch, bounded_batches, map_texts

#: A-Z to a-z; other letters, digits and all bytes of other characters stay; the rest separates terms.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
BITS = 1 << 23  # of the bitmap of the items' terms


@dataclass(frozen=True)
class Params:
    top: int = 10
    block_docs: int = 2_048           # documents of an index block
    block_postings: int = 500_000     # a block ends with the document that reaches so many postings
    item_bytes: int = 4 << 20         # of the items' texts that are searched together
    popped: int = 8                   # best intervals of an item that are split in one step


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


def term_bitmap(items: DataFrame) -> np.ndarray:
    """Bit xxhash64(term) mod BITS is set for every term of the items: 1 MB, whatever their number."""
    place = F.pmod(F.xxhash64("term"), F.lit(BITS)) + 1
    rows = items.select(F.explode("terms").alias("term")).groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("b")).collect()
    bits = np.zeros(BITS // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["b"]), np.uint8)
        at = (r["k"] - 1) * len(part)
        bits[at:at + len(part)] = part
    return bits


def item_terms(items: DataFrame, key: str) -> DataFrame:
    """(key, terms, times, size) of every item with a term; the distinct texts of one id are one item."""
    whole = items.where("text is not null").groupBy(key).agg(F.concat_ws("\n", F.sort_array(F.collect_set("text"))).alias("text"))

    def start():
        def run(texts):
            counted = [Counter(terms_of(t)) for t in texts]
            return [pa.array([[t.decode() for t in c] for c in counted], pa.list_(pa.string())), pa.array([list(c.values()) for c in counted], pa.list_(pa.int64())),
                    pa.array([len(t) for t in texts], pa.int64())]
        return run

    return map_texts(whole, [key], start, "terms array<string>, times array<long>, size long").where("size(terms) > 0")


def index_blocks(docs: DataFrame, bits: np.ndarray, p: Params) -> DataFrame:
    """One row for each block of documents that hold a term: their ids and lengths, and the posting lists."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def block(ids: list, lengths: list, terms: list, tfs: list, counts: list) -> pa.RecordBatch:
        ids = pa.concat_arrays(ids)
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        coded = pa.array(terms, pa.binary()).dictionary_encode()
        h = np.array([xxhash.xxh64_intdigest(t, 42) for t in coded.dictionary.to_pylist()], np.uint64) % np.uint64(BITS)
        known = (bits[h >> np.uint64(3)] >> (h & np.uint64(7)).astype(np.uint8)) & 1 == 1
        term, doc, tf = coded.indices.to_numpy(), np.repeat(place, counts), np.array(tfs, np.int64)
        kept = known[term]
        term, doc, tf = term[kept], doc[kept], tf[kept]
        by = np.lexsort((doc, term))
        held, df = np.unique(term, return_counts=True)
        n = np.array(lengths, np.int64)
        row = [ids.take(pa.array(order)), pa.array(n[order]), coded.dictionary.take(pa.array(held)).cast(pa.string()), pa.array(df.astype(np.int32)),
               pa.array(doc[by].astype(np.int32)), pa.array(tf[by])]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in row]
        return pa.RecordBatch.from_arrays([*lists, pa.array([len(n)]), pa.array([int(n.sum())])], ["ids", "lengths", "terms", "df", "docs", "tfs", "n_docs", "n_terms"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: tuple[list, ...] = ([], [], [], [], [])
        for batch in batches:
            ids = batch.column("doc_id")
            for k, text in enumerate(batch.column("text").to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                c = Counter(words)
                for kept, more in zip(state, ([ids.slice(k, 1)], [len(words)], c.keys(), c.values(), [len(c)])):
                    kept.extend(more)
                if len(state[0]) >= p.block_docs or len(state[2]) >= p.block_postings:
                    yield block(*state)
                    state = ([], [], [], [], [])
        if state[0]:
            yield block(*state)

    return docs.select("doc_id", "text").mapInArrow(run, f"ids array<{kind}>, lengths array<long>, terms array<string>, df array<int>, docs array<int>, tfs array<long>, n_docs long, n_terms long")


class Postings:
    """The posting lists of some terms in one block, with their range-maximum tables."""

    def __init__(self, df: np.ndarray, docs: np.ndarray, impact: np.ndarray, size: int):
        self.size, self.docs, self.impact = size, docs, impact
        self.keys = np.repeat(np.arange(len(df), dtype=np.int64), df) * (size + 1) + docs  # sorted
        #: tables[k][i]: place of the first largest impact in i .. i + 2^k - 1; no range that is asked leaves its list.
        self.tables = [np.arange(len(docs), dtype=np.int32)]
        while 2 << (len(self.tables) - 1) <= max(df, default=0):
            last, half = self.tables[-1], 1 << (len(self.tables) - 1)
            left, right = last[:len(last) - half], last[half:]
            self.tables.append(np.where(impact[left] >= impact[right], left, right))
        self.starts = np.cumsum([0, *map(len, self.tables)])[:-1]
        self.flat = np.concatenate(self.tables)

    def place(self, term: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The first posting of the term's list at or after a document."""
        return np.searchsorted(self.keys, term * (self.size + 1) + doc)

    def largest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Place of the largest impact among the postings low .. high - 1, -1 where there is none."""
        out = np.full(len(low), -1, np.int64)
        some = np.flatnonzero(high > low)
        low, high = low[some], high[some]
        k = np.frexp((high - low).astype(np.float64))[1] - 1  # floor of the binary logarithm
        a, b = self.flat[self.starts[k] + low], self.flat[self.starts[k] + high - (1 << k)]
        out[some] = np.where(self.impact[a] >= self.impact[b], a, b)
        return out


class Search:
    """Best-first search of many items in one block; items are lists of (term, times) behind each other."""

    def __init__(self, postings: Postings, starts: np.ndarray, term: np.ndarray, times: np.ndarray, top: int, popped: int):
        self.p, self.starts, self.term, self.times, self.top, self.popped = postings, starts, term, times, top, popped

    def spread(self, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For some items: where each one's terms begin in the flat order, their places, and the owner of each."""
        n = self.starts[item + 1] - self.starts[item]
        begin = np.cumsum(n) - n
        owner = np.repeat(np.arange(len(item)), n)
        return begin, np.arange(n.sum()) - begin[owner] + self.starts[item][owner], owner

    def bounds(self, begin: np.ndarray, at: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bound of each interval, and the document with the largest impact in it."""
        best = self.p.largest(low, high)
        share = np.where(best >= 0, self.times[at] * self.p.impact[best], 0)
        largest = np.maximum.reduceat(share, begin)
        hit = np.flatnonzero(share == largest[owner])
        _, first = np.unique(owner[hit], return_index=True)
        return np.add.reduceat(share, begin), self.p.docs[best[hit[first]]]

    def run(self, items: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, document, score): the ``top`` largest scores above 0 of each item, equal ones by document.

        Documents that score below ``least`` of their item may be left out.
        """
        item, low, high = items, np.zeros(len(items), np.int64), np.full(len(items), self.p.size)
        got = (np.zeros(0, np.int64),) * 3
        begin, at, owner = self.spread(item)
        bound, split = self.bounds(begin, at, owner, self.p.place(self.term[at], low[owner]), self.p.place(self.term[at], high[owner]))
        while True:
            # The last place so far: a score and a document for each item; equal scores need an earlier document.
            score, doc = np.maximum(least, 1), np.full(len(least), self.p.size)
            full = np.flatnonzero(np.bincount(got[0], minlength=len(least)) >= self.top)
            last = np.searchsorted(got[0], full, "right") - 1
            full, last = full[got[2][last] >= score[full]], last[got[2][last] >= score[full]]
            score[full], doc[full] = got[2][last], got[1][last]
            open_ = (bound > score[item]) | ((bound == score[item]) & (low <= doc[item]))
            item, low, high, bound, split = item[open_], low[open_], high[open_], bound[open_], split[open_]
            if not len(item):
                return got
            order = np.lexsort((-bound, item))
            rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
            now, rest = order[rank < self.popped], order[rank >= self.popped]
            q, a, x, b = item[now], low[now], split[now].astype(np.int64), high[now]
            begin, at, owner = self.spread(q)
            term = self.term[at]
            first, middle, end = self.p.place(term, a[owner]), self.p.place(term, x[owner]), self.p.place(term, b[owner])
            near = np.minimum(middle, len(self.p.keys) - 1)
            hit = self.p.keys[near] == term * (self.p.size + 1) + x[owner]
            exact = np.add.reduceat(np.where(hit, self.times[at] * self.p.impact[near], 0), begin)
            left, right = self.bounds(begin, at, owner, first, middle), self.bounds(begin, at, owner, middle + hit, end)
            item, low, high = np.r_[item[rest], q, q], np.r_[low[rest], a, x + 1], np.r_[high[rest], x, b]
            bound, split = np.r_[bound[rest], left[0], right[0]], np.r_[split[rest], left[1], right[1]]
            got = tuple(np.r_[old, new] for old, new in zip(got, (q, x, exact)))
            order = np.lexsort((got[1], -got[2], got[0]))
            order = order[np.arange(len(order)) - np.searchsorted(got[0][order], got[0][order]) < self.top]
            got = tuple(c[order] for c in got)


def search_blocks(index: DataFrame, starts: np.ndarray, term: np.ndarray, times: np.ndarray, names: list[str], weight: np.ndarray,
                  n_docs: int, n_terms: int, p: Params) -> DataFrame:
    """(item, doc_id, score): the best documents of every block for some items, whose size is bounded."""
    kind = index.schema["ids"].dataType.elementType.simpleString()
    schema = f"item int, doc_id {kind}, score long"
    number = {t: k for k, t in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.zeros(len(starts) - 1, np.int64)  # last place of each item in the blocks before
        for batch in batches:
            for k in range(batch.num_rows):
                doc_ids, lengths, terms, df, docs, tfs = (batch.column(c)[k].values for c in ("ids", "lengths", "terms", "df", "docs", "tfs"))
                asked = np.array([number.get(t, -1) for t in terms.to_pylist()], np.int64)
                df = df.to_numpy().astype(np.int64)
                held = np.repeat(asked, df)
                docs, tf = docs.to_numpy()[held >= 0], tfs.to_numpy()[held >= 0]
                m = 25 + (75 * lengths.to_numpy() * n_docs) // n_terms
                impact = weight[held[held >= 0]] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[docs]))
                own = np.flatnonzero(asked >= 0)
                if not impact.any():
                    continue
                # The items' terms as places among the block's lists; a term that the block lacks takes no part.
                local = np.full(len(names), -1, np.int64)
                local[asked[own]] = np.arange(len(own))
                here = local[term] >= 0
                ends = np.concatenate([[0], np.cumsum(here)])[starts]
                postings = Postings(df[own], docs, impact, len(doc_ids))
                search = Search(postings, ends, local[term][here], times[here], p.top, p.popped)
                q, doc, score = search.run(np.flatnonzero(np.diff(ends)), least)
                full = np.flatnonzero(np.bincount(q, minlength=len(least)) >= p.top)
                least[full] = np.maximum(least[full], score[np.searchsorted(q, full, "right") - 1])
                yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), doc_ids.take(pa.array(doc)), pa.array(score)], ["item", "doc_id", "score"])

    return index.mapInArrow(run, schema)


def ranked(docs: DataFrame, items: DataFrame, p: Params = Params(), key: str = "item_id") -> DataFrame:
    """(key, rank, doc_id, score): the ``top`` documents of each item, the highest score first, then the smaller doc_id.

    Terms, weights and scores are those of the package's ranked-search
    contract: whole texts, all documents, integers.  Every row of ``docs``
    is a document; rows that share an id are ranked one by one, a null id
    comes after all others of the same score.  Rows of ``items`` that share
    an id are one item: its distinct texts together; a null id is an item of
    its own.  Null texts and texts without a term hold nothing, and items
    without a matching document have no row.  Empty tables give no row.  Of
    ``docs`` only doc_id and text are read.  Items are searched in blocks of
    bounded size, however many there are.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ranked")
    asked = scratch.store(item_terms(items.select(key, "text"), key), "items")
    # Rows are some MB each, and a reader holds a row group at once.
    index = scratch.store(index_blocks(docs, term_bitmap(asked), p), "index", **{"parquet.block.size": 16 << 20})
    facts = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    size = asked.agg(F.sum("size")).first()[0]
    schema = f"`{key}` {items.schema[key].dataType.simpleString()}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long"
    if not facts["n"] or not size:
        return spark.createDataFrame([], schema)
    vocabulary = asked.select(F.explode("terms").alias("term")).distinct()
    listed = index.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.df").alias("df"))
    weights = scratch.store(listed.join(vocabulary, "term", "left_semi").select("term", F.floor(1000 * F.log((2 * F.lit(facts["n"]) + 2) / (2 * F.col("df") + 1))).cast("long").alias("w")), "weights")
    blocks = -(-size // p.item_bytes)
    for k in range(blocks):
        block = asked.where(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(blocks)) == k)
        some = block.select(key, "terms", "times").toArrow()  # bounded by item_bytes
        if not some.num_rows:
            continue
        known = weights.join(block.select(F.explode("terms").alias("term")).distinct(), "term", "left_semi").where("w > 0").toArrow()
        names = known.column("term").to_pylist()
        terms, times = some.column("terms").combine_chunks(), some.column("times").combine_chunks()
        number = {t: n for n, t in enumerate(names)}
        term = np.array([number.get(t, -1) for t in terms.flatten().to_pylist()], np.int64)
        starts = np.concatenate([[0], np.cumsum(term >= 0)])[np.concatenate([[0], np.cumsum(pc.list_value_length(terms).to_numpy())])]
        held = term >= 0
        ids = some.column(key).combine_chunks()
        best = search_blocks(index, starts, term[held], times.flatten().to_numpy()[held], names, known.column("w").to_numpy(), facts["n"], facts["l"], p)
        order = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
        names_of = spark.createDataFrame(pa.table({"item": pa.array(np.arange(len(ids), dtype=np.int32)), key: ids}))
        best = best.withColumn("rank", order).where(F.col("rank") <= p.top).join(F.broadcast(names_of), "item").select(key, "rank", "doc_id", "score")
        scratch.store(best, f"found{k}")
    found = [n for n in scratch.names if n.startswith("found")]
    scratch.keep_only(*found)
    return spark.read.schema(schema).parquet(*(f"{scratch.path}/{n}" for n in found))
