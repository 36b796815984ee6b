"""Registered queries: ratings, versions, time series, sarcasm."""

from __future__ import annotations

from reviewlake.operators import versions as V
from reviewlake.plans import oracle as O
from reviewlake.plans.registry import register

VK = O.version_key()


@register("version_volume_rating", O.with_ctes(["reviews"], f"""
SELECT app_version, count(review_id) AS review_count, {O.exact_mean("score")} AS avg_score
FROM reviews WHERE app_version IS NOT NULL GROUP BY app_version"""))
def _version_volume_rating(I):
    return V.version_volume_rating(I.reviews)


@register("version_natural_sort", O.with_ctes(["reviews"], f"""
SELECT app_version, CAST(row_number() OVER (ORDER BY {VK}, app_version) AS INTEGER) AS version_order
FROM (SELECT DISTINCT app_version FROM reviews WHERE app_version IS NOT NULL)"""))
def _version_natural_sort(I):
    return V.version_order(I.reviews)


# ---------------------------------------------------------------- versions
from reviewlake.operators import sarcasm as SC, timeseries as TS  # noqa: E402

SARC = ", sarc AS (SELECT * FROM E WHERE score = 1 AND sentiment > 0.5)\n"
CAL = (", cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS year_month\n"
       "  FROM (SELECT min(year_month) AS lo, max(year_month) AS hi FROM {src}))\n")


@register("version_score_sentiment", O.with_ctes(["E"], f"""
SELECT app_version, {O.exact_mean("score")} AS mean_score, {O.exact_mean("sentiment", 4)} AS mean_sent,
  count(review_id) AS review_count
FROM E WHERE app_version IS NOT NULL GROUP BY app_version"""))
def _version_score_sentiment(I):
    return V.version_score_sentiment(I.enriched)


@register("version_score_sentiment_min50", O.with_ctes(["E"], f"""
SELECT app_version, {O.exact_mean("score")} AS mean_score, {O.exact_mean("sentiment", 4)} AS mean_sent,
  count(review_id) AS review_count
FROM E WHERE app_version IS NOT NULL GROUP BY app_version HAVING count(review_id) >= 50"""))
def _version_score_sentiment_min50(I):
    return V.version_score_sentiment_min50(I.enriched)


@register("having_min_count", O.with_ctes(["reviews"], f"""
SELECT app_version, count(review_id) AS review_count, {O.exact_mean("score")} AS avg_score
FROM reviews WHERE app_version IS NOT NULL GROUP BY app_version HAVING count(review_id) >= 100"""))
def _having_min_count(I):
    return V.having_min_count(V.version_volume_rating(I.reviews), min_count=100)


# ---------------------------------------------------------------- sarcasm
@register("sarcastic_reviews", O.with_ctes(["E"], SARC + """
SELECT review_id, user_name, content, score, created_at, app_version, sentiment FROM sarc"""))
def _sarcastic_reviews(I):
    return SC.sarcastic_reviews(I.enriched).select(
        "review_id", "user_name", "content", "score", "created_at", "app_version", "sentiment")


@register("sarcastic_examples", O.with_ctes(["E"], SARC + """
SELECT review_id, content, round(sentiment, 2) AS sentiment, score, app_version
FROM sarc ORDER BY review_id LIMIT 5"""))
def _sarcastic_examples(I):
    return SC.sarcastic_examples(SC.sarcastic_reviews(I.enriched))


@register("sarcastic_count", O.with_ctes(["E"], SARC + "SELECT count(*) AS sarcastic_count FROM sarc"))
def _sarcastic_count(I):
    return SC.sarcastic_count(SC.sarcastic_reviews(I.enriched))


@register("sarcastic_by_version", O.with_ctes(["E"], SARC + """
SELECT app_version, count(review_id) AS sarcastic_count FROM sarc
WHERE app_version IS NOT NULL GROUP BY app_version"""))
def _sarcastic_by_version(I):
    return V.sarcastic_by_version(SC.sarcastic_reviews(I.enriched))


@register("sarcastic_top_versions", O.with_ctes(["E"], SARC + """
SELECT app_version, count(review_id) AS sarcastic_count FROM sarc
WHERE app_version IS NOT NULL GROUP BY app_version ORDER BY sarcastic_count DESC, app_version LIMIT 10"""))
def _sarcastic_top_versions(I):
    return V.sarcastic_top_versions(SC.sarcastic_reviews(I.enriched))


SARC_MONTH = SARC + CAL.format(src="E") + """, sm AS (
SELECT cal.year_month, CAST(coalesce(m.n, 0) AS BIGINT) AS sarcastic_count FROM cal LEFT JOIN (
  SELECT year_month, count(review_id) AS n FROM sarc WHERE year_month IS NOT NULL GROUP BY year_month) m
  ON m.year_month = cal.year_month)
"""


@register("sarcastic_by_month", O.with_ctes(["E"], SARC_MONTH + "SELECT * FROM sm"))
def _sarcastic_by_month(I):
    e = I.enriched
    return TS.sarcastic_by_month(e, SC.sarcastic_reviews(e))


@register("rolling_trend", O.with_ctes(["E"], SARC_MONTH + """
SELECT year_month, sarcastic_count,
  CASE WHEN count(sarcastic_count) OVER w = 3 THEN round(avg(sarcastic_count) OVER w, 6) END AS trend
FROM sm WINDOW w AS (ORDER BY year_month ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"""))
def _rolling_trend(I):
    e = I.enriched
    return TS.rolling_trend(TS.sarcastic_by_month(e, SC.sarcastic_reviews(e)), "sarcastic_count")


# ---------------------------------------------------------------- months
@register("calendar_join", O.with_ctes(["tf"], CAL.format(src="tf") + """
SELECT cal.year_month, CAST(coalesce(m.n, 0) AS BIGINT) AS review_count FROM cal LEFT JOIN (
  SELECT year_month, count(*) AS n FROM tf WHERE year_month IS NOT NULL GROUP BY year_month) m
  ON m.year_month = cal.year_month"""))
def _calendar_join(I):
    from pyspark.sql import functions as F
    tf = I.text_features
    m = tf.filter(F.col("year_month").isNotNull()).groupBy("year_month") \
          .agg(F.count(F.lit(1)).alias("review_count"))
    return TS.calendar_join(m, tf, fill={"review_count": 0})


@register("monthly_score_sentiment", O.with_ctes(["E"], CAL.format(src="E") + f"""
SELECT cal.year_month, m.mean_score, m.mean_sent FROM cal LEFT JOIN (
  SELECT year_month, {O.exact_mean("score")} AS mean_score, {O.exact_mean("sentiment", 4)} AS mean_sent
  FROM E WHERE year_month IS NOT NULL GROUP BY year_month) m ON m.year_month = cal.year_month"""))
def _monthly_score_sentiment(I):
    return TS.monthly_score_sentiment(I.enriched)


@register("monthly_corr", O.with_ctes(["E"], f"""
SELECT year_month, round({O.corr_sql('score', 'sentiment')}, 6) AS corr
FROM E WHERE year_month IS NOT NULL GROUP BY year_month"""))
def _monthly_corr(I):
    return TS.monthly_corr(I.enriched)


@register("monthly_avg_length", O.with_ctes(["tf"], f"""
SELECT year_month, {O.exact_mean("word_count")} AS avg_word_count
FROM tf WHERE year_month IS NOT NULL GROUP BY year_month"""))
def _monthly_avg_length(I):
    return TS.monthly_avg_length(I.text_features)


@register("monthly_volume_rating", O.with_ctes(["tf"], f"""
SELECT year_month, count(review_id) AS review_count, {O.exact_mean("score")} AS avg_score
FROM tf WHERE year_month IS NOT NULL GROUP BY year_month"""))
def _monthly_volume_rating(I):
    return TS.monthly_volume_rating(I.text_features)
