"""User behaviour: activity, score mix, and change between first and last review.

Everything groups on user_name.  The aggregates used (count, min_by /
max_by, sum) all combine map-side, so a user holding a large share of the
rows costs one partial row per input partition, never one huge group in a
single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from reviewlake.functions.stats import round_div
from reviewlake.operators import stats
from reviewlake.plans.enrich import active_users, with_activity


def active_user_semi(reviews: DataFrame, min_reviews: int = 2) -> DataFrame:
    """Reviews written by users with at least ``min_reviews`` reviews (semi
    join; AQE picks broadcast or sort-merge from the measured user set)."""
    return reviews.join(active_users(reviews, min_reviews), "user_name", "left_semi")


def user_review_counts(reviews: DataFrame) -> DataFrame:
    return (reviews.filter(F.col("user_name").isNotNull()).groupBy("user_name")
                   .agg(F.count(F.lit(1)).alias("review_count"))
                   .orderBy(F.desc("review_count"), "user_name"))


def user_activity_summary(reviews: DataFrame, digits: int = 6) -> DataFrame:
    """unique_users, active_users (> 1 review) and their share."""
    per_user = (reviews.filter(F.col("user_name").isNotNull()).groupBy("user_name")
                       .agg(F.count(F.lit(1)).alias("n")))
    return per_user.agg(F.count(F.lit(1)).alias("unique_users"),
                        F.count_if(F.col("n") > 1).alias("active_users")) \
                   .withColumn("active_share", round_div(F.col("active_users"), F.col("unique_users"), digits))


def score_by_activity(enriched: DataFrame) -> DataFrame:
    """Count of reviews per (is_active_user, score), zero-filled over the
    observed flags x observed scores (two flags and the score domain)."""
    e = enriched if "is_active_user" in enriched.columns else with_activity(enriched)
    base = e.filter(F.col("score").isNotNull() & F.col("review_id").isNotNull())
    counts = base.groupBy("is_active_user", "score").agg(F.count("review_id").alias("review_count"))
    seen = counts.agg(F.collect_set("is_active_user").alias("flags"), F.collect_set("score").alias("scores"))
    grid = seen.select(F.explode("flags").alias("is_active_user"), "scores").select("is_active_user", F.explode("scores").alias("score"))
    return grid.join(counts, ["is_active_user", "score"], "left").select(
        "is_active_user", F.col("score").cast("int").alias("score"),
        F.coalesce("review_count", F.lit(0)).cast("bigint").alias("review_count"))


def score_share_by_activity(counts: DataFrame, digits: int = 6) -> DataFrame:
    """Row-normalised shares of ``score_by_activity`` (a tiny frame)."""
    w = Window.partitionBy("is_active_user")
    return counts.withColumn("share", round_div(F.col("review_count"), F.sum("review_count").over(w), digits)) \
        .drop("review_count")


def user_change(enriched: DataFrame, digits: int = 6, min_reviews: int = 2) -> DataFrame:
    """Per active user: first and last non-null sentiment, score, length and
    date in time order (undated reviews last, ties by review_id), deltas and
    the whole-day gap.

    No join: every user is aggregated with map-side partial aggregation
    (min_by/max_by/count combine per input partition, so a user holding a
    third of the rows is one partial row per task), and the activity test
    (``count >= min_reviews``) is a filter on the aggregated rows.  A semi
    join followed by a grouping on the same key would pin a hot user to one
    task, since the skew split cannot break the grouping's distribution.
    """
    e = enriched.filter(F.col("user_name").isNotNull())
    order = F.struct(F.col("created_at").isNull(), F.col("created_at"), F.col("review_id"))

    def first(c):
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order))

    def last(c):
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order))

    e = e.withColumn("review_length", F.char_length("content"))
    g = e.groupBy("user_name").agg(
        F.count(F.lit(1)).alias("_n"),
        first("sentiment").alias("sent_first"), last("sentiment").alias("sent_last"),
        first("score").alias("score_first"), last("score").alias("score_last"),
        first("review_length").alias("len_first"), last("review_length").alias("len_last"),
        F.min("created_at").alias("date_first"), F.max("created_at").alias("date_last"))
    g = g.filter(F.col("_n") >= min_reviews).drop("_n")
    return g.select(
        "*",
        F.round(F.col("sent_last") - F.col("sent_first"), digits).alias("sent_delta"),
        (F.col("score_last") - F.col("score_first")).alias("score_delta"),
        (F.col("len_last") - F.col("len_first")).alias("len_delta"),
        F.expr("timestampdiff(DAY, date_first, date_last)").alias("days_gap"))


def delta_direction(changes: DataFrame, digits: int = 6) -> DataFrame:
    """Share of active users whose score went up, down or stayed (null delta
    counts in the denominator, like a NaN comparison)."""
    d = F.col("score_delta")
    share = lambda cond: round_div(F.count_if(F.coalesce(cond, F.lit(False))), F.count(F.lit(1)), digits)
    return changes.agg(share(d > 0).alias("up_share"), share(d < 0).alias("down_share"),
                       share(d == 0).alias("same_share"))


DELTAS = ["sent_delta", "score_delta", "len_delta", "days_gap"]


def short_gap_filter(changes: DataFrame, max_gap: int = 365) -> DataFrame:
    """Active users whose first and last reviews are less than ``max_gap``
    whole days apart (the population of the gap histogram)."""
    return changes.filter(F.col("days_gap") < max_gap)


def delta_describe(changes: DataFrame, digits: int = 3) -> DataFrame:
    return stats.describe_many(changes, DELTAS, digits, scales={c: 4 if c == "sent_delta" else 0 for c in DELTAS})


def user_change_histograms(changes: DataFrame, bins: int = 30, max_gap: int = 365) -> DataFrame:
    """30-bin histograms of the three deltas and of days_gap < max_gap,
    all from one pass (columns stacked into (metric, x))."""
    gap = F.when(F.col("days_gap") < max_gap, F.col("days_gap"))  # short_gap_filter, per column
    long = stats.to_long(changes.withColumn("days_gap", gap), DELTAS)
    return stats.histogram_by(long, "metric", "x", bins)


def user_change_density(changes: DataFrame, grid: int = 200, binned: bool = False) -> DataFrame:
    """Kernel densities of the three deltas; ``binned`` sums over a fine lattice in place of every different value."""
    long = stats.to_long(changes, DELTAS[:3])
    return (stats.kde_binned_by if binned else stats.kde_by)(long, "metric", "x", grid)
