"""The most frequent items of each group, exactly, without a count of every item.

A frequent-items sketch of fixed size for each group, merged map-side, names
candidates with estimates that no true count exceeds.  A second pass counts
the candidates alone.  An item that is no candidate occurs at most as often
as the least estimate among them: if the wanted ones are more frequent, or
the candidates are all there is, the result is exact.  Else the sketch grows,
and at its largest size every item is counted.  What is shuffled follows the
size of the sketch, not the number of different items.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from reviewlake.plans.broadcast import bounded_broadcast
from reviewlake.plans.materialize import materialize

LARGEST = 1_000_000  # items that Spark's sketch can track


def sketches(items: DataFrame, by: str, item: str, listed: int, tracked: int) -> DataFrame:
    """(by, total, least, some) of each group: its rows, and the sketch's most frequent items with their least estimate.

    Items that the sketch leaves out occur no more often than that; without
    any item listed nothing is known.
    """
    found = items.groupBy(by).agg(F.expr(f"approx_top_k({item}, {listed}, {tracked})").alias("t"), F.count(F.lit(1)).alias("total"))
    return found.select(by, "total", F.array_min(F.transform("t", lambda x: x["count"])).alias("least"), F.transform("t", lambda x: x["item"]).alias("some"))


def frequent(items: DataFrame, by: str, item: str, k: int, count: Callable[[DataFrame | None], DataFrame], kept: Callable[[DataFrame], DataFrame] | None = None,
             listed: int | None = None, tracked: int = 20_000) -> DataFrame:
    """Counts that hold the ``k`` most frequent items of each group that ``kept`` keeps.

    ``items`` has a row for each occurrence (by, item).  ``count`` counts
    the candidates (by, item), or all items if there are none, exactly and
    returns by, item, count and what else is wanted.
    """
    listed = listed or 8 * k
    while tracked <= LARGEST:
        found = materialize(sketches(items, by, item, listed, tracked), "candidates")
        # At most ``listed`` rows for each group.
        counts = materialize(count(bounded_broadcast(found.select(by, F.explode("some").alias(item)), "candidates")), "counts")
        facts = found.select(F.col(by).alias("_by"), "least", "total")
        ranks = (kept(counts) if kept else counts).groupBy(by).agg(F.slice(F.sort_array(F.collect_list("count"), asc=False), 1, k).alias("best"))
        sums = counts.groupBy(F.col(by).alias("_b")).agg(F.sum("count").alias("counted"))
        open_ = (facts.join(ranks, F.col("_by").eqNullSafe(F.col(by)), "left").join(sums, F.col("_by").eqNullSafe(F.col("_b")), "left")
                 .filter((F.coalesce("counted", F.lit(0)) < F.col("total")) & ~F.coalesce(F.try_element_at("best", F.lit(k)) > F.col("least"), F.lit(False))))
        if open_.isEmpty():
            return counts
        listed, tracked = 8 * listed, 8 * tracked
        if listed > tracked:
            tracked = listed
    return count(None)
