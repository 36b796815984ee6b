"""Per-version analyses (grouped on app_version, naturally ordered)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from reviewlake.functions.stats import exact_mean
from reviewlake.functions.versions import version_key


def version_natural_sort(df: DataFrame, col: str = "app_version") -> DataFrame:
    """Sort a (small, per-version) frame by the natural version key, ties by text."""
    return df.orderBy(version_key(col), F.col(col))


def version_order(reviews: DataFrame, col: str = "app_version") -> DataFrame:
    """Distinct versions with their 1-based natural position.

    The global row_number runs on the distinct-version frame (one row per
    release, tiny), never on reviews.
    """
    versions = reviews.filter(F.col(col).isNotNull()).select(col).distinct()
    w = Window.orderBy(version_key(col), F.col(col))
    return versions.select(col, F.row_number().over(w).alias("version_order"))


def version_volume_rating(reviews: DataFrame) -> DataFrame:
    """review_count (non-null ids) and avg_score per version, null versions dropped."""
    agg = (reviews.filter(F.col("app_version").isNotNull())
                  .groupBy("app_version")
                  .agg(F.count("review_id").alias("review_count"),
                       exact_mean("score").alias("avg_score")))
    return version_natural_sort(agg)


def version_score_sentiment(enriched: DataFrame) -> DataFrame:
    agg = (enriched.filter(F.col("app_version").isNotNull())
                   .groupBy("app_version")
                   .agg(exact_mean("score").alias("mean_score"),
                        exact_mean("sentiment", 4).alias("mean_sent"),
                        F.count("review_id").alias("review_count")))
    return version_natural_sort(agg)


def having_min_count(df: DataFrame, count_col: str = "review_count", min_count: int = 50) -> DataFrame:
    return df.filter(F.col(count_col) >= min_count)


def version_score_sentiment_min50(enriched: DataFrame, min_count: int = 50) -> DataFrame:
    return version_natural_sort(having_min_count(version_score_sentiment(enriched), min_count=min_count))


def sarcastic_by_version(sarcastic: DataFrame) -> DataFrame:
    agg = (sarcastic.filter(F.col("app_version").isNotNull())
                    .groupBy("app_version").agg(F.count("review_id").alias("sarcastic_count")))
    return version_natural_sort(agg)


def sarcastic_top_versions(sarcastic: DataFrame, n: int = 10) -> DataFrame:
    agg = (sarcastic.filter(F.col("app_version").isNotNull())
                    .groupBy("app_version").agg(F.count("review_id").alias("sarcastic_count")))
    return agg.orderBy(F.desc("sarcastic_count"), F.asc("app_version")).limit(n)
