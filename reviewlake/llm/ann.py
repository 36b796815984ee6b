"""Approximate nearest neighbours by balanced posting lists.

Inner products become Euclidean distances by one more coordinate.  A bounded
sample is halved again and again into balanced cells; a cell's mean is the
centroid of a posting list.  Every vector goes to its nearest list, and a
boundary vector to further lists that are nearly as near.  A query finds its
nearest centroids in an in-memory neighbour graph and probes all lists whose
distance is within a ratio of the best one.  Both ratios are fitted: the
boundary to a mean number of lists for a vector of the sample, the query's
ratio to the recall of the true neighbours, among all vectors, of a few of
the sample.  Scores are exact inner products of the original vectors in
double precision.

Lists that lie together form a group; a group's vectors and the queries that
probe one of its lists meet in blocks of bounded size on both sides.  Before
that every query probes one common list, a bounded sample of all vectors:
what it finds there takes part, and its last place bounds what the groups
send on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import Scratch, bounded_batches


@dataclass(frozen=True)
class Params:
    top: int = 20
    list_size: int = 64          # vectors for each posting list, before replication
    max_sample: int = 100_000    # bound of the sample that places the centroids and fits the ratios
    max_asked: int = 256         # of the sample's vectors whose true neighbours fit the ratio
    max_lists: int = 16_384
    replicas: int = 8            # lists that a boundary vector may join
    mean_replicas: float = 2.5   # lists that a vector joins on the average
    recall: float = 0.94         # of those neighbours, by which the query's ratio is fitted
    ratio: float | None = None   # a query probes all lists within this ratio of its nearest centroid's distance; None: fitted
    common_share: int = 16       # one vector in so many, and
    max_common: int = 16_384     # at most so many in all, form a list that every query probes first
    degree: int = 16             # of the centroid graph
    beam: int = 96               # centroids kept by the graph search; a query with more within the ratio meets all centroids
    together: int = 32           # lists of a group
    block: int = 16_384          # vectors of a group that meet in one task
    asked_block: int = 4_096     # queries of a group that meet in one task


def balanced_centroids(x: np.ndarray, lists: int) -> np.ndarray:
    """Means of ``lists`` cells of nearly equal size, by halving along the line between two means."""
    done, todo = [], [(x, lists)]
    while todo:
        part, n = todo.pop()
        if n <= 1 or len(part) < 2:
            done.append(part.mean(0))
            continue
        rng = np.random.default_rng(len(part))
        a, b = part[rng.choice(len(part), 2, replace=False)]
        for _ in range(6):
            order = np.argsort(part @ (a - b), kind="stable")
            cut = len(part) * (n // 2) // n
            a, b = part[order[cut:]].mean(0), part[order[:cut]].mean(0)
        todo += [(part[order[:cut]], n // 2), (part[order[cut:]], n - n // 2)]
    return np.array(done)


class CentroidGraph:
    """Neighbour graph over the centroids and best-first search in it, for many queries at once."""

    def __init__(self, centroids: np.ndarray, degree: int):
        self.c, self.sq = centroids, (centroids * centroids).sum(1)
        n = len(centroids)
        near = np.concatenate([np.argsort(self.sq[None, :] - 2 * centroids[k:k + 512] @ centroids.T, axis=1, kind="stable")[:, 1:degree + 1] for k in range(0, n, 512)]) \
            if n > 1 else np.zeros((1, 0), np.int64)
        far = np.random.default_rng(0).integers(0, n, (n, 4))  # long links keep the graph connected
        self.links = np.concatenate([near, far, np.roll(np.arange(n), 1)[:, None]], 1)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest centroids found for each query, nearest first, and their distances."""
        n, beam = len(self.c), min(beam, len(self.c))
        rows, qq = np.arange(len(q)), (q * q).sum(1)

        def distance(nodes: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(qq[:, None] + self.sq[nodes] - 2 * np.einsum("ijk,ik->ij", self.c[nodes], q), 0))

        entry = np.unique(np.linspace(0, n - 1, min(n, beam)).astype(int))
        ids = np.tile(entry, (len(q), 1))
        seen = np.zeros((len(q), n), bool)
        seen[:, entry] = True
        dist = distance(ids)
        spread = np.zeros(ids.shape, bool)  # whose links were followed
        for _ in range(4 * beam):
            open_dist = np.where(spread, np.inf, dist)
            at = open_dist.argmin(1)
            active = np.isfinite(open_dist[rows, at])
            if not active.any():
                break
            spread[rows, at] |= active
            nodes = self.links[ids[rows, at]]
            fresh = ~seen[rows[:, None], nodes] & active[:, None]
            for k in range(1, nodes.shape[1]):  # a node linked twice counts once
                fresh[:, k] &= ~(nodes[:, :k] == nodes[:, k:k + 1]).any(1)
            seen[rows[:, None], nodes] |= active[:, None]  # one value for a row: a node linked twice is written alike
            ids, dist = np.concatenate([ids, nodes], 1), np.concatenate([dist, np.where(fresh, distance(nodes), np.inf)], 1)
            spread = np.concatenate([spread, ~fresh], 1)
            order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            ids, dist, spread = ids[rows[:, None], order], dist[rows[:, None], order], spread[rows[:, None], order]
        order = np.argsort(dist, axis=1, kind="stable")
        return ids[rows[:, None], order], dist[rows[:, None], order]

    def distances(self, q: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((q * q).sum(1)[:, None] + self.sq - 2 * q @ self.c.T, 0))


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    limit = F.lit(float("inf"))
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == limit)) & F.exists(vector, lambda x: x != 0)


def stacked(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1)


def lifted(v: np.ndarray, norm: float) -> np.ndarray:
    """One more coordinate gives all vectors one norm; then the largest inner product is the smallest distance."""
    return np.c_[v, np.sqrt(np.maximum(norm * norm - (v * v).sum(1), 0))]


def within(graph: CentroidGraph, q: np.ndarray, ratio: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, list) of all lists within the ratio of each query's nearest; where the beam may have cut some, all centroids are met."""
    ids, dist = graph.search(q, beam)
    near = (dist <= ratio * dist[:, :1] + 1e-12) & np.isfinite(dist)
    cut = near[:, -1] if ids.shape[1] < len(graph.c) else np.zeros(len(q), bool)
    row, col = np.nonzero(near & ~cut[:, None])
    lists = ids[row, col]
    if cut.any():
        far = graph.distances(q[cut])
        at, more = np.nonzero(far <= ratio * far.min(1, keepdims=True) + 1e-12)
        row, lists = np.r_[row, np.flatnonzero(cut)[at]], np.r_[lists, more]
    return row, lists


def joined(graph: CentroidGraph, v: np.ndarray, boundary: float, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(vector, list) of the lists that each lifted vector joins."""
    ids, dist = graph.search(v, min(p.beam, 4 * p.replicas))
    near = (dist <= boundary * dist[:, :1] + 1e-12) & np.isfinite(dist)
    near[:, p.replicas:] = False
    row, col = np.nonzero(near)
    return row, ids[row, col]


def fitted(graph: CentroidGraph, x: np.ndarray, norm: float, p: Params, asked: np.ndarray, near: list[np.ndarray]) -> tuple[float, float]:
    """The boundary and the query's ratio, from a sample ``x`` of vectors, some queries and their true neighbours.

    The boundary lets one of these vectors join ``mean_replicas`` lists on
    the average.  A neighbour is found by the ratio of its nearest list to the
    query's nearest one; the fitted ratio finds ``recall`` of them.
    """
    # Most neighbours did not place the centroids; vectors that did lie nearer to them than others.
    some = lifted(np.concatenate(near) if any(map(len, near)) else x[spaced(len(x), 8 * p.max_asked)], norm)
    d = graph.search(some, min(p.beam, 4 * p.replicas))[1]
    ratios = np.sort((d / np.maximum(d[:, :1], 1e-12))[:, :p.replicas].ravel())
    boundary = float(ratios[min(len(ratios), max(1, int(p.mean_replicas * len(some)))) - 1])
    need = []
    for q, v in zip(asked, near):
        if len(v):
            row, lists = joined(graph, lifted(v, norm), boundary, p)
            far = graph.distances(np.append(q, 0.0)[None])[0]
            order = np.argsort(row, kind="stable")
            need.append(np.minimum.reduceat(far[lists[order]], np.searchsorted(row[order], np.arange(len(v)))) / max(far.min(), 1e-12))
    return boundary, float(np.quantile(np.concatenate(need), p.recall)) if need else 1.0


def spaced(n: int, count: int) -> np.ndarray:
    """At most ``count`` places among n, evenly spaced."""
    return np.unique(np.linspace(0, n - 1, min(n, count)).astype(int))


def true_neighbours(distinct: DataFrame, asked: np.ndarray, p: Params) -> list[np.ndarray]:
    """The nearest vectors of a few queries among all: a task keeps the best of its batches for every query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, score, one, v = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros((0, asked.shape[1]))
        for batch in batches:
            if batch.num_rows:
                here, ids = stacked(batch.column("v")), smallest(batch.column("ids"))
                new, at, more = best_rows(asked, here, ids, p.top + 1)
                row, score, one, v = np.r_[row, new], np.r_[score, more], np.r_[one, ids[at]], np.r_[v, here[at]]
                kept = first_rows(row, score, one, p.top + 1)
                row, score, one, v = row[kept], score[kept], one[kept], v[kept]
        yield pa.RecordBatch.from_arrays([pa.array(row.astype(np.int32)), pa.array(score), pa.array(one), pa.array(list(v), pa.list_(pa.float64()))], ["q", "score", "one", "v"])

    order = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "one"))
    best = distinct.select("v", "ids").mapInArrow(run, "q int, score double, one long, v array<double>").withColumn("k", order).where(F.col("k") <= p.top + 1).select("q", "v").toArrow()
    q, v = best.column("q").to_numpy(), stacked(best.column("v").combine_chunks())
    return [v[(q == k) & (v != asked[k]).any(1)][:p.top] for k in range(len(asked))]


def lists_of(rows: DataFrame, graph: CentroidGraph, norm: float, boundary: float, p: Params) -> DataFrame:
    """(list, v, ids) for each list that a vector joins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                row, lists = joined(graph, lifted(stacked(part.column("v")), norm), boundary, p)
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), taken.column("v"), taken.column("ids")], ["list", "v", "ids"])

    return rows.select("v", "ids").mapInArrow(run, "list int, v array<double>, ids array<long>")


def common_best(rows: DataFrame, v: np.ndarray, ids: pa.Array, p: Params) -> DataFrame:
    """(vid, score, ids): the nearest vectors of each query in the common list, which is broadcast."""
    one = smallest(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                row, at, score = best_rows(stacked(part.column("v")), v, one, p.top + 1)
                yield pa.RecordBatch.from_arrays([part.column("vid").take(pa.array(row)), pa.array(score), ids.take(pa.array(at))], ["vid", "score", "ids"])

    return rows.select("v", "vid").mapInArrow(run, "vid long, score double, ids array<long>")


def probed(rows: DataFrame, graph: CentroidGraph, ratio: float | None, p: Params) -> DataFrame:
    """(group, lists, v, vid, least) for each group with lists that a query probes: those within the ratio, or all (None)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                n = len(graph.c)
                if ratio is None:
                    row, lists = np.repeat(np.arange(part.num_rows), n), np.tile(np.arange(n), part.num_rows)
                else:
                    row, lists = within(graph, np.c_[stacked(part.column("v")), np.zeros(part.num_rows)], ratio, p.beam)
                order = np.lexsort((lists, row))
                row, lists = row[order], lists[order]
                group = lists // p.together
                new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (group[1:] != group[:-1])]))
                held = pa.ListArray.from_arrays(pa.array(np.append(new, len(row)).astype(np.int32)), pa.array(lists.astype(np.int32)))
                taken = part.take(pa.array(row[new]))
                yield pa.RecordBatch.from_arrays([pa.array(group[new].astype(np.int32)), held, taken.column("v"), taken.column("vid"), taken.column("least")],
                                                 ["group", "lists", "v", "vid", "least"])

    return rows.select("v", "vid", "least").mapInArrow(run, "group int, lists array<int>, v array<double>, vid long, least double")


def nearest(vectors: DataFrame, queries: Column, p: Params = Params(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of each id that ``queries`` selects: its nearest others by inner product.

    Nearest first, equal scores by the smaller id; all candidates if there
    are fewer than ``top``.  Vectors null, zero or with null or non-finite
    components take no part, and neither do rows with a null id; all others
    must have one length, else an error is raised.  An id has one vector:
    equal rows count once, and of an id's different vectors the greatest,
    by its components in order, counts.  Ids with equal vectors are searched
    once: of them only the ``top`` + 1 smallest can be among the nearest of
    anything.  A query whose lists hold too few others probes all lists.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "ann")
    rows = vectors.where(usable(F.col(vector)) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double") + F.lit(0.0)).alias("v"), queries.alias("asks"))
    lengths = [r[0] for r in rows.select(F.size("v")).distinct().limit(2).collect()]
    schema = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], schema)
    if len(lengths) > 1:
        raise ValueError("vectors differ in length")
    rows = scratch.store(rows.groupBy("id").agg(F.max("v").alias("v"), F.max("asks").alias("asks")), "rows")
    # Equal vectors: their smallest ids.  The limit is applied before the shuffle, so a frequent vector stays spread.
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    first = rows.withColumn("k", place).where(F.col("k") <= p.top + 1)
    distinct = scratch.store(first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("vid", F.element_at("ids", 1)), "distinct")
    asked = scratch.store(rows.where("asks").select("v", "id").join(distinct.select("v", "vid"), "v").select(F.col("id").alias("query_id"), "vid"), "asked")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    facts = distinct.agg(F.count("*").alias("n"), F.sqrt(F.max(square)).alias("norm"), F.sum(F.size("ids")).alias("ids")).first()
    n, norm = facts["n"], facts["norm"]
    count = int(min(p.max_lists, max(1, n // p.list_size)))
    sample = distinct.orderBy(F.xxhash64("v"), "vid").limit(p.max_sample).select("v") if n > p.max_sample else distinct.select("v")
    x = stacked(sample.toArrow().column("v").combine_chunks())  # at most max_sample vectors
    x = x[np.lexsort(x.T)]
    graph = CentroidGraph(balanced_centroids(lifted(x, norm), count), p.degree)
    some = x[spaced(len(x), p.max_asked)]
    boundary, ratio = fitted(graph, x, norm, p, some, true_neighbours(distinct, some, p))
    posted = scratch.store(lists_of(distinct, graph, norm, boundary, p), "posted")
    askers = distinct.join(asked.select("vid").distinct(), "vid").select("v", "vid")
    # The last place in the common list is a bound: of other lists only what reaches it is sent on.
    some = distinct.orderBy(F.xxhash64("v", F.lit(1)), "vid").limit(max(1, min(p.max_common, n // p.common_share))).select("v", "ids").toArrow()
    first = scratch.store(common_best(askers, stacked(some.column("v").combine_chunks()), some.column("ids").combine_chunks(), p), "first")
    bound = first.groupBy("vid").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    askers = scratch.store(askers.join(bound, "vid").select("v", "vid", F.when(F.col("n") > p.top, F.col("least")).otherwise(float("-inf")).alias("least")), "askers")
    probes = scratch.store(probed(askers, graph, ratio if p.ratio is None else p.ratio, p), "probes")
    found = scratch.store(merge(met(posted, probes, p).union(first), p.top), "found")
    got = found.groupBy("vid").agg(F.sum(F.size("ids")).alias("got"))
    few = askers.join(got, "vid", "left").where(F.coalesce("got", F.lit(0)) < min(facts["ids"], p.top + 1)).select("v", "vid", "least")
    few = scratch.store(few, "few")
    if not few.isEmpty():
        more = merge(met(posted, scratch.store(probed(few, graph, None, p), "all"), p), p.top)
        found = scratch.store(found.join(few.select("vid"), "vid", "left_anti").union(more), "found_all")
    # The smallest ids of each near vector, without the query itself.
    each = asked.join(found, "vid").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", order).where(F.col("rank") <= p.top).select("query_id", "rank", "vec_id", "score")


def met(posted: DataFrame, probes: DataFrame, p: Params) -> DataFrame:
    """(vid, score, ids): the nearest vectors of each query in each group of lists, block by block on both sides.

    A group's numbers of vectors and queries decide its blocks; there are as
    many groups as lists by ``together``, which bounds the broadcast.
    """
    group = F.floor(F.col("list") / p.together).cast("int")
    sizes = posted.groupBy(group.alias("group")).agg(F.ceil(F.count("*") / p.block).cast("int").alias("blocks"))
    asks = probes.groupBy("group").agg(F.ceil(F.count("*") / p.asked_block).cast("int").alias("asked"))
    plan = F.broadcast(sizes.join(asks, "group"))
    left = posted.withColumn("group", group).join(plan, "group").withColumn("block", F.pmod(F.xxhash64("ids"), "blocks").cast("int"))
    left = left.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("asked") - 1))).select("group", "block", "turn", "list", "v", "ids")
    right = probes.join(plan, "group").withColumn("turn", F.pmod(F.xxhash64("vid"), "asked").cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("group", "block", "turn", "lists", "v", "vid", "least")
    keys = ("group", "block", "turn")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda a, b: best_in_block(a, b, p.top), "vid long, score double, ids array<long>")


def smallest(ids: pa.Array) -> np.ndarray:
    return pc.list_element(ids, 0).to_numpy(zero_copy_only=False)


def first_rows(row: np.ndarray, score: np.ndarray, one: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` largest scores of each row, equal ones by the smaller id; an id found twice counts once."""
    order = np.lexsort((one, -score, row))
    same = np.zeros(len(order), bool)
    same[1:] = (row[order][1:] == row[order][:-1]) & (one[order][1:] == one[order][:-1])  # found in two lists: the score is the same
    order = order[~same]
    counts = np.unique(row[order], return_counts=True)[1]
    return order[np.arange(len(order)) - np.repeat(np.cumsum(counts) - counts, counts) < top]


def best_rows(q: np.ndarray, v: np.ndarray, one: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of the ``top`` largest inner products of each query, equal ones by the smaller id ``one``.

    Every score is summed alike; the matrix product only leaves out what is
    below the last place by more than its rounding.
    """
    rough = q @ v.T
    kept = min(top, len(v))
    last = np.partition(rough, len(v) - kept, axis=1)[:, len(v) - kept]
    rounding = 4 * q.shape[1] * np.finfo(np.float64).eps * np.linalg.norm(q, axis=1) * np.linalg.norm(v, axis=1).max()
    row, at = np.nonzero(rough >= (last - rounding)[:, None])
    exact = np.concatenate([(q[row[k:k + 65536]] * v[at[k:k + 65536]]).sum(1) for k in range(0, len(row), 65536)])
    first = first_rows(row, exact, one[at], top)
    return row[first], at[first], exact[first]


def best_in_block(a: pa.Table, b: pa.Table, top: int) -> pa.Table:
    """The nearest vectors of one block to the queries that probe some of its lists."""
    schema = pa.schema([("vid", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])
    if not a.num_rows or not b.num_rows:
        return schema.empty_table()
    a = a.take(pc.sort_indices(a.column("list")))
    v, ids, q = stacked(a.column("v").combine_chunks()), a.column("ids").combine_chunks(), stacked(b.column("v").combine_chunks())
    one, lists = smallest(ids), a.column("list").to_numpy()
    asked = b.column("lists").combine_chunks()
    owner = np.repeat(np.arange(len(q)), pc.list_value_length(asked).to_numpy(zero_copy_only=False))
    wanted = asked.flatten().to_numpy()
    order = np.argsort(wanted, kind="stable")
    owner, wanted = owner[order], wanted[order]
    row, at, score = [], [], []
    for k in np.unique(lists):
        low, high = np.searchsorted(lists, [k, k + 1])
        mine = owner[slice(*np.searchsorted(wanted, [k, k + 1]))]
        for c in range(0, len(mine), 512):
            r, t, s = best_rows(q[mine[c:c + 512]], v[low:high], one[low:high], top + 1)
            row.append(mine[c:c + 512][r])
            at.append(low + t)
            score.append(s)
    if not row:
        return schema.empty_table()
    row, at, score = np.concatenate(row), np.concatenate(at), np.concatenate(score)
    near = score >= b.column("least").to_numpy()[row]
    row, at, score = row[near], at[near], score[near]
    kept = first_rows(row, score, one[at], top + 1)
    return pa.table([b.column("vid").take(pa.array(row[kept])), pa.array(score[kept]), ids.take(pa.array(at[kept]))], schema=schema)


def merge(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` + 1 nearest distinct vectors of each query; one found in several lists counts once."""
    once = found.groupBy("vid", F.element_at("ids", 1).alias("one")).agg(F.max("score").alias("score"), F.max("ids").alias("ids"))
    order = F.row_number().over(Window.partitionBy("vid").orderBy(F.desc("score"), "one"))
    return once.withColumn("k", order).where(F.col("k") <= top + 1).select("vid", "score", "ids")
