"""Registered queries: scans, data quality, rating and length statistics."""

from __future__ import annotations

from reviewlake.operators import quality as Q, stats as S
from reviewlake.plans import oracle as O
from reviewlake.plans.registry import register
from reviewlake.schemas import REVIEW_COLUMNS

W = O.with_ctes


@register("scan_reviews", W(["reviews"], "SELECT * FROM reviews"))
def _scan_reviews(I):
    return I.reviews


@register("scan_app_metadata", W(["app_meta"], "SELECT * FROM app_meta"))
def _scan_app_metadata(I):
    return I.app_metadata


@register("preview", W(["reviews"], "SELECT * FROM reviews ORDER BY review_id LIMIT 5"))
def _preview(I):
    return Q.preview(I.reviews)


# DuckDB type names -> Spark's simple type strings (the types used here).
_TYPE_MAP = ("CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' "
             "WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'BOOLEAN' THEN 'boolean' "
             "WHEN 'DATE' THEN 'date' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END")


@register("column_types", f"SELECT t.column_name, {_TYPE_MAP} AS data_type, n.non_null_count FROM (DESCRIBE "
          + W(["reviews"], "SELECT * FROM reviews") + ") t JOIN ("
          + W(["reviews"], " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS non_null_count FROM reviews" for c in REVIEW_COLUMNS))
          + ") n ON n.column_name = t.column_name")
def _column_types(I):
    return Q.column_types(I.reviews)


@register("require_columns", W(["reviews"], "SELECT review_id, score FROM reviews"))
def _require_columns(I):
    return Q.require_columns(I.reviews, "review_id", "score").select("review_id", "score")


@register("missing_counts", W(["reviews"], "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing_count FROM reviews"
    for c in REVIEW_COLUMNS)))
def _missing_counts(I):
    return Q.missing_counts(I.reviews)


@register("missing_pct", W(["reviews"], "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {O.round_div(f'100 * count(*) FILTER (WHERE {c} IS NULL)', 'count(*)')} AS missing_pct "
    "FROM reviews"
    for c in REVIEW_COLUMNS)))
def _missing_pct(I):
    return Q.missing_pct(I.reviews)


@register("duplicate_id_count", W(["reviews"], """
SELECT count(*) - count(DISTINCT review_id) - coalesce(max(CAST(review_id IS NULL AS INT)), 0) AS duplicate_count
FROM reviews"""))
def _duplicate_id_count(I):
    return Q.duplicate_id_count(I.reviews)


@register("rating_distribution", W(["reviews"],
          "SELECT score, count(*) AS review_count FROM reviews GROUP BY score"))
def _rating_distribution(I):
    return Q.rating_distribution(I.reviews)


@register("score_bands", W(["reviews"], """
SELECT band, count(*) AS review_count FROM (
  SELECT CASE WHEN score >= 4 THEN 'high' WHEN score <= 2 THEN 'low' END AS band
  FROM reviews WHERE content IS NOT NULL) WHERE band IS NOT NULL GROUP BY band"""))
def _score_bands(I):
    return Q.score_bands(I.reviews)


def describe_sql(src, col, by=None, scale=0, digits=6):
    keys = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    x = f"CAST({col} AS DOUBLE)"
    r = lambda e: O.round_decimal(e, digits, scale + 2)
    return f"""SELECT {keys}count({x}) AS count, {O.exact_mean(x, scale, digits)} AS mean,
  round(stddev_samp({x}), {digits}) AS std, min({x}) AS min, {r(f"quantile_cont({x}, 0.25)")} AS p25,
  {r(f"quantile_cont({x}, 0.5)")} AS p50, {r(f"quantile_cont({x}, 0.75)")} AS p75, max({x}) AS max FROM {src}{group}"""


@register("word_count_describe", W(["tf"], describe_sql("tf", "word_count")))
def _word_count_describe(I):
    return Q.word_count_describe(I.text_features)


@register("length_by_rating", W(["tf"], f"""
SELECT score, {O.exact_mean("word_count")} AS mean,
  round(median(CAST(word_count AS DOUBLE)), 6) AS median,
  round(stddev_samp(CAST(word_count AS DOUBLE)), 6) AS std
FROM tf WHERE score IS NOT NULL GROUP BY score"""))
def _length_by_rating(I):
    return Q.length_by_rating(I.text_features)


@register("sentiment_score_corr", W(["E"], f"SELECT round({O.corr_sql('sentiment', 'score')}, 6) AS corr FROM E"))
def _sentiment_score_corr(I):
    return S.corr(I.enriched, "sentiment", "score")


def histogram_sql(src, col, bins):
    return f"""
v AS (SELECT CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL),
b AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
             CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v),
i0 AS (SELECT x, lo, (hi - lo) / CAST({bins} AS DOUBLE) AS step,
         least(greatest(CAST(floor((x - lo) * (CAST({bins} AS DOUBLE) / (hi - lo))) AS INT), 0), {bins - 1}) AS idx
       FROM v, b),
i1 AS (SELECT x, lo, step, CASE WHEN x < lo + CAST(idx AS DOUBLE) * step THEN idx - 1 ELSE idx END AS idx FROM i0),
i2 AS (SELECT CASE WHEN x >= lo + CAST(idx + 1 AS DOUBLE) * step AND idx <> {bins - 1} THEN idx + 1 ELSE idx END AS bin FROM i1),
c AS (SELECT bin, count(*) AS n FROM i2 GROUP BY bin),
g AS (SELECT CAST(r.range AS INTEGER) AS bin, lo, hi FROM range(0, {bins}) r, b)
SELECT g.bin, round(lo + CAST(g.bin AS DOUBLE) * ((hi - lo) / CAST({bins} AS DOUBLE)), 9) AS bin_lo,
  round(CASE WHEN g.bin = {bins - 1} THEN hi ELSE lo + CAST(g.bin + 1 AS DOUBLE) * ((hi - lo) / CAST({bins} AS DOUBLE)) END, 9) AS bin_hi,
  CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM g LEFT JOIN c ON c.bin = g.bin"""


def _hist_ctes(names, src, col, bins):
    return W(names, ", " + histogram_sql(src, col, bins).lstrip())


@register("histogram", _hist_ctes(["tf"], "tf", "word_count", 60))
def _histogram(I):
    return S.histogram(I.text_features, "word_count", 60)


@register("field_check", W(["reviews"], f"""
SELECT 'review_update' AS task_name,
  count(*) FILTER (WHERE review_id IS NULL) AS missing_review_id,
  count(*) FILTER (WHERE content IS NULL OR trim(content) = '') AS missing_content,
  count(*) FILTER (WHERE score IS NULL) AS missing_score,
  count(*) AS total_rows,
  {O.round_div("100 * count(*) FILTER (WHERE content IS NULL OR trim(content) = '')", "count(*)", 2)}
    AS missing_content_pct
FROM reviews"""))
def _field_check(I):
    return Q.field_check(I.reviews)


@register("max_created_at", W(["reviews"], "SELECT max(created_at) AS max_created_at FROM reviews"))
def _max_created_at(I):
    return Q.max_created_at(I.reviews)


@register("complete_rows", W(["E"], """
SELECT review_id, sentiment, score FROM E
WHERE sentiment IS NOT NULL AND score IS NOT NULL AND score IN (1, 2, 3, 4, 5)"""))
def _complete_rows(I):
    return Q.complete_rows(I.enriched).select("review_id", "sentiment", "score")


@register("sentiment_box_stats", W(["E"], f"""
, d AS (SELECT score, sentiment AS v FROM E
         WHERE sentiment IS NOT NULL AND score IS NOT NULL AND score IN (1, 2, 3, 4, 5)),
q AS (SELECT score, count(v) AS n, {O.exact_mean("v", 4)} AS mean, quantile_cont(v, 0.25) AS q1,
             quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM d GROUP BY score),
w AS (SELECT d.score, min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)) AS wlo,
             max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)) AS whi
      FROM d JOIN q ON q.score = d.score GROUP BY d.score)
SELECT q.score, n, mean, round(q1, 6) AS q1, round(median, 6) AS median,
  round(q3, 6) AS q3, round(coalesce(wlo, q1), 6) AS whisker_low, round(coalesce(whi, q3), 6) AS whisker_high
FROM q JOIN w ON w.score = q.score"""))
def _sentiment_box_stats(I):
    return S.box_stats(Q.complete_rows(I.enriched), "sentiment", "score")
