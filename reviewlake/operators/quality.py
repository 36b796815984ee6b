"""Data-quality and rating overviews (single-pass aggregations)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reviewlake.functions.stats import exact_mean, round_div
from reviewlake.functions.text import is_blank
from reviewlake.operators import stats
from reviewlake.operators.quantiles import exact_quantiles


def preview(df: DataFrame, n: int = 5, order_by: str = "review_id") -> DataFrame:
    """First ``n`` rows in an explicit order (TakeOrderedAndProject)."""
    return df.orderBy(order_by).limit(n)


def column_types(df: DataFrame) -> DataFrame:
    """Name, type and number of present values of every column, in one pass."""
    present = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    return present.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("data_type"), F.col(c).alias("non_null_count"))
        for c, kind in df.dtypes])))


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n.lower() not in {c.lower() for c in df.columns}]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def first_present(df: DataFrame, candidates) -> str:
    cols = {c.lower(): c for c in df.columns}
    for c in candidates:
        if c.lower() in cols:
            return cols[c.lower()]
    raise ValueError("none of the columns found: " + ", ".join(candidates))


def missing_counts(df: DataFrame) -> DataFrame:
    """(column_name, missing_count) for every column, one scan."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "missing_count")


def missing_pct(df: DataFrame, digits: int = 6) -> DataFrame:
    """(column_name, missing_pct) in percent, largest first."""
    wide = df.agg(*[round_div(100 * F.count_if(F.col(c).isNull()), F.count(F.lit(1)), digits).alias(c)
                    for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "missing_pct") \
               .orderBy(F.desc("missing_pct"), "column_name")


def duplicate_id_count(df: DataFrame, key: str = "review_id") -> DataFrame:
    """Rows minus distinct ids; null is one more distinct value."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(key)
                   - F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))).alias("duplicate_count"))


def rating_distribution(reviews: DataFrame) -> DataFrame:
    """Count per score, null score included, in score order."""
    return reviews.groupBy("score").agg(F.count(F.lit(1)).alias("review_count")) \
                  .orderBy(F.asc_nulls_last("score"))


def score_bands(reviews: DataFrame, high: int = 4, low: int = 2) -> DataFrame:
    """Number of reviews with text in the high (>= high) and low (<= low) bands."""
    band = F.when(F.col("score") >= high, "high").when(F.col("score") <= low, "low")
    return (reviews.filter(F.col("content").isNotNull())
                   .select(band.alias("band")).filter(F.col("band").isNotNull())
                   .groupBy("band").agg(F.count(F.lit(1)).alias("review_count")))


def band_column(high: int = 4, low: int = 2):
    return F.when(F.col("score") >= high, "high").when(F.col("score") <= low, "low")


def complete_rows(enriched: DataFrame, value: str = "sentiment") -> DataFrame:
    """Rows with both value and score present and score in 1..5."""
    return enriched.dropna(subset=[value, "score"]).filter(F.col("score").isin(1, 2, 3, 4, 5))


def word_count_describe(features: DataFrame) -> DataFrame:
    """Words of a review: texts have no longest length, so quartiles come with bounded state."""
    return stats.describe(features, "word_count", scale=0, unbounded=True)


def length_by_rating(features: DataFrame, digits: int = 6) -> DataFrame:
    """mean, median, std of word count per (non-null) score."""
    rated = features.filter(F.col("score").isNotNull())
    sums = rated.groupBy("score").agg(exact_mean("word_count", 0, digits).alias("mean"),
                                      F.round(F.stddev_samp(F.col("word_count").cast("double")), digits).alias("std"))
    median = exact_quantiles(rated, "word_count", [0.5], "score").select("score", F.round(F.col("q")[0], digits).alias("median"))
    return sums.join(median, "score", "left").select("score", "mean", "median", "std").orderBy("score")


def field_check(reviews: DataFrame, task_name: str = "review_update") -> DataFrame:
    """One row of field completeness counts for the dashboard view."""
    blank = is_blank("content")
    n = F.count(F.lit(1))
    return reviews.agg(
        F.lit(task_name).alias("task_name"),
        F.count_if(F.col("review_id").isNull()).alias("missing_review_id"),
        F.count_if(blank).alias("missing_content"),
        F.count_if(F.col("score").isNull()).alias("missing_score"),
        n.alias("total_rows"),
        round_div(100 * F.count_if(blank), n, 2).alias("missing_content_pct"))


def max_created_at(reviews: DataFrame) -> DataFrame:
    return reviews.agg(F.max("created_at").alias("max_created_at"))
