"""Monthly series over reviews.

Aggregations group on the month (a few hundred keys at most); partial
aggregation happens map-side, so the exchange carries one row per month per
input partition.  The calendar (``sequence`` of months between the observed
bounds) and the unpartitioned rolling window only ever touch these small
monthly frames, never the reviews.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from reviewlake.functions.stats import exact_mean, safe_corr
from reviewlake.plans.enrich import year_month


def _with_month(df: DataFrame, month_col: str = "year_month") -> DataFrame:
    if month_col in df.columns:
        return df
    return df.withColumn(month_col, year_month("created_at"))


def calendar(df: DataFrame, month_col: str = "year_month") -> DataFrame:
    """Every month from the first to the last observed month of ``df``."""
    b = _with_month(df, month_col).agg(F.min(month_col).alias("lo"), F.max(month_col).alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias(month_col))


def calendar_join(monthly: DataFrame, bounds_from: DataFrame, month_col: str = "year_month",
                  fill: dict | None = None) -> DataFrame:
    """Left join a monthly frame onto the regular calendar of ``bounds_from``."""
    out = calendar(bounds_from, month_col).join(monthly, month_col, "left")
    if fill:
        out = out.fillna(fill)
    return out


def monthly_score_sentiment(enriched: DataFrame, digits: int = 6) -> DataFrame:
    e = _with_month(enriched)
    m = (e.filter(F.col("year_month").isNotNull()).groupBy("year_month")
          .agg(exact_mean("score", 0, digits).alias("mean_score"),
               exact_mean("sentiment", 4, digits).alias("mean_sent")))
    return calendar_join(m, e).orderBy("year_month")


def monthly_corr(enriched: DataFrame, digits: int = 6) -> DataFrame:
    e = _with_month(enriched)
    return (e.filter(F.col("year_month").isNotNull()).groupBy("year_month")
             .agg(F.round(safe_corr("score", "sentiment"), digits).alias("corr"))
             .orderBy("year_month"))


def sarcastic_by_month(enriched: DataFrame, sarcastic: DataFrame) -> DataFrame:
    """Sarcastic reviews per month on the calendar of all reviews, 0-filled."""
    s = _with_month(sarcastic)
    m = (s.filter(F.col("year_month").isNotNull()).groupBy("year_month")
          .agg(F.count("review_id").alias("sarcastic_count")))
    return calendar_join(m, _with_month(enriched), fill={"sarcastic_count": 0}).orderBy("year_month")


def rolling_trend(monthly: DataFrame, value: str, month_col: str = "year_month",
                  before: int = 1, after: int = 1, digits: int = 6, name: str = "trend") -> DataFrame:
    """Centred moving mean; null unless the whole window is present.

    Unpartitioned window: only for monthly frames (one row per month).
    """
    w = Window.orderBy(month_col).rowsBetween(-before, after)
    size = before + after + 1
    return monthly.withColumn(
        name, F.when(F.count(F.col(value)).over(w) == size, F.round(F.avg(value).over(w), digits)))


def monthly_avg_length(features: DataFrame, digits: int = 6) -> DataFrame:
    f = _with_month(features)
    return (f.filter(F.col("year_month").isNotNull()).groupBy("year_month")
             .agg(exact_mean("word_count", 0, digits).alias("avg_word_count"))
             .orderBy("year_month"))


def monthly_volume_rating(reviews: DataFrame, digits: int = 6) -> DataFrame:
    r = _with_month(reviews)
    return (r.filter(F.col("year_month").isNotNull()).groupBy("year_month")
             .agg(F.count("review_id").alias("review_count"),
                  exact_mean("score", 0, digits).alias("avg_score"))
             .orderBy("year_month"))
