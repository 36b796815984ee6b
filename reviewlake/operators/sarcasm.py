"""Reviews whose text sentiment contradicts a 1-star rating."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sarcastic_reviews(enriched: DataFrame, score: int = 1, min_sentiment: float = 0.5) -> DataFrame:
    return enriched.filter((F.col("score") == score) & (F.col("sentiment") > min_sentiment))


def sarcastic_examples(sarcastic: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` flagged reviews (by review_id) with rounded sentiment."""
    return (sarcastic.orderBy("review_id").limit(n)
                     .select("review_id", "content", F.round("sentiment", 2).alias("sentiment"),
                             "score", "app_version"))


def sarcastic_count(sarcastic: DataFrame) -> DataFrame:
    return sarcastic.agg(F.count(F.lit(1)).alias("sarcastic_count"))
