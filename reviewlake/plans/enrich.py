"""Derived review columns, composable so each analysis pays only for the
shuffles it needs.

* ``with_text_features`` - narrow: word_count, char_length, year_month,
  clean_content (no exchange).
* ``with_sentiment`` - one exchange of lexicon hits on review_id and a join
  back (see operators.sentiment).
* ``with_activity`` - per-user counts with map-side partial aggregation,
  joined back on user_name; a hot user only costs one partial-agg row per
  input partition, and AQE splits the skewed join partition.
* ``enrich_reviews`` - all of the above (operator 19).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reviewlake.functions import text
from reviewlake.functions.versions import version_key
from reviewlake.operators.sentiment import with_sentiment, with_sentiment_rules


def year_month(c="created_at"):
    col = F.col(c) if isinstance(c, str) else c
    return F.trunc(col.cast("date"), "month")


def with_text_features(reviews: DataFrame) -> DataFrame:
    return reviews.withColumns({
        "word_count": text.word_count("content"),
        "char_length": text.char_length("content"),
        "year_month": year_month("created_at"),
        "clean_content": text.clean_text("content"),
    })


def active_users(reviews: DataFrame, min_reviews: int = 2) -> DataFrame:
    """user_name of users with at least ``min_reviews`` reviews (nulls never)."""
    return (reviews.filter(F.col("user_name").isNotNull())
                   .groupBy("user_name").count()
                   .filter(F.col("count") >= min_reviews)
                   .select("user_name"))


def with_activity(reviews: DataFrame, min_reviews: int = 2, counted: DataFrame | None = None) -> DataFrame:
    """Adds is_active_user.  The active-user set is a partially aggregated
    count (a hot user costs one row per input partition), joined back on
    user_name.  It grows with the data, so no broadcast is forced: AQE
    broadcasts it when the measured stage is under the adaptive threshold,
    otherwise the sort-merge join runs with skew-partition splitting.
    ``counted`` are the same rows before other columns were added: only
    their names are read for the count."""
    act = active_users(reviews if counted is None else counted, min_reviews).select(F.col("user_name").alias("_user"), F.lit(True).alias("_active"))
    # Rows without a name are never active and would all meet in one partition: they get keys that no user has.
    nobody = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*reviews.columns), F.lit(4096)).cast("string"))
    keyed = reviews.withColumn("_user_key", F.coalesce("user_name", nobody))
    return (keyed.join(act, F.col("_user_key") == F.col("_user"), "left")
                 .withColumn("is_active_user", F.coalesce(F.col("_active") & F.col("user_name").isNotNull(), F.lit(False)))
                 .drop("_user_key", "_user", "_active"))


def enrich_reviews(reviews: DataFrame, lexicon: DataFrame, modifiers: DataFrame | None = None,
                   version_sort_key: bool = False) -> DataFrame:
    """All derived columns; with ``modifiers`` the rule-based sentiment, and
    with ``version_sort_key`` also ``version_key`` for the natural order.
    Text features are added last, so the joins move the text only once."""
    cols = reviews.columns
    scored = with_sentiment(reviews, lexicon) if modifiers is None else with_sentiment_rules(reviews, lexicon, modifiers)
    e = with_text_features(with_activity(scored, counted=reviews))
    extra = []
    if version_sort_key:
        e, extra = e.withColumn("version_key", version_key("app_version")), ["version_key"]
    return e.select(*cols, "word_count", "char_length", "year_month", "clean_content",
                    "sentiment", "is_active_user", *extra)
