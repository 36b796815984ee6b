"""Registered queries: user activity and behaviour change."""

from __future__ import annotations

from reviewlake.operators import users as U
from reviewlake.plans import oracle as O
from reviewlake.plans.registry import register

W = O.with_ctes


@register("active_user_semi", W(["reviews", "active"], """
SELECT review_id, user_name FROM reviews WHERE user_name IN (SELECT user_name FROM active)"""))
def _active_user_semi(I):
    return U.active_user_semi(I.reviews).select("review_id", "user_name")


@register("user_review_counts", W(["reviews"], """
SELECT user_name, count(*) AS review_count FROM reviews WHERE user_name IS NOT NULL GROUP BY user_name"""))
def _user_review_counts(I):
    return U.user_review_counts(I.reviews)


@register("user_activity_summary", W(["reviews"], f"""
SELECT count(*) AS unique_users, count(*) FILTER (WHERE n > 1) AS active_users,
  {O.round_div("count(*) FILTER (WHERE n > 1)", "count(*)")} AS active_share
FROM (SELECT user_name, count(*) AS n FROM reviews WHERE user_name IS NOT NULL GROUP BY user_name)"""))
def _user_activity_summary(I):
    return U.user_activity_summary(I.reviews)


SBA = """
, base AS (SELECT is_active_user, score, review_id FROM E WHERE score IS NOT NULL AND review_id IS NOT NULL)
, sba AS (SELECT f.is_active_user, s.score, CAST(count(b.review_id) AS BIGINT) AS review_count
  FROM (SELECT DISTINCT is_active_user FROM base) f CROSS JOIN (SELECT DISTINCT score FROM base) s
  LEFT JOIN base b ON b.is_active_user = f.is_active_user AND b.score = s.score
  GROUP BY f.is_active_user, s.score)
"""


@register("score_by_activity", W(["E"], SBA + "SELECT * FROM sba"))
def _score_by_activity(I):
    return U.score_by_activity(I.enriched)


@register("score_share_by_activity", W(["E"], SBA + f"""
SELECT is_active_user, score,
  {O.round_div("review_count", "sum(review_count) OVER (PARTITION BY is_active_user)")} AS share
FROM sba"""))
def _score_share_by_activity(I):
    return U.score_share_by_activity(U.score_by_activity(I.enriched))


ORD = "(created_at IS NULL, created_at, review_id)"


def _fl(col, name):
    return (f"arg_min({col}, {ORD}) FILTER (WHERE {col} IS NOT NULL) AS {name}_first, "
            f"arg_max({col}, {ORD}) FILTER (WHERE {col} IS NOT NULL) AS {name}_last")


UC = f"""
, uc0 AS (SELECT user_name, {_fl('sentiment', 'sent')}, {_fl('score', 'score')}, {_fl('review_length', 'len')},
    min(created_at) AS date_first, max(created_at) AS date_last
  FROM (SELECT *, CAST(length(content) AS INTEGER) AS review_length FROM E
        WHERE user_name IN (SELECT user_name FROM active)) GROUP BY user_name)
, uc AS (SELECT *, round(sent_last - sent_first, 6) AS sent_delta, score_last - score_first AS score_delta,
    len_last - len_first AS len_delta, date_sub('day', date_first, date_last) AS days_gap FROM uc0)
"""


@register("user_change", W(["E", "active"], UC + "SELECT * FROM uc"))
def _user_change(I):
    return U.user_change(I.enriched)


@register("short_gap_filter", W(["E", "active"], UC + "SELECT user_name, days_gap FROM uc WHERE days_gap < 365"))
def _short_gap_filter(I):
    return U.short_gap_filter(U.user_change(I.enriched)).select("user_name", "days_gap")


@register("delta_direction", W(["E", "active"], UC + f"""
SELECT {O.round_div("count(*) FILTER (WHERE score_delta > 0)", "count(*)")} AS up_share,
  {O.round_div("count(*) FILTER (WHERE score_delta < 0)", "count(*)")} AS down_share,
  {O.round_div("count(*) FILTER (WHERE score_delta = 0)", "count(*)")} AS same_share FROM uc"""))
def _delta_direction(I):
    return U.delta_direction(U.user_change(I.enriched))


def _describe_row(col):
    x = f"CAST({col} AS DOUBLE)"
    sc = 4 if col == "sent_delta" else 0
    r = lambda e: O.round_decimal(e, 3, sc + 2)
    return (f"SELECT '{col}' AS metric, count({x}) AS count, {O.exact_mean(x, sc, 3)} AS mean, "
            f"round(stddev_samp({x}), 3) AS std, {r(f'min({x})')} AS min, "
            f"{r(f'quantile_cont({x}, 0.25)')} AS p25, {r(f'quantile_cont({x}, 0.5)')} AS p50, "
            f"{r(f'quantile_cont({x}, 0.75)')} AS p75, {r(f'max({x})')} AS max FROM uc")


@register("delta_describe", W(["E", "active"], UC + "\nUNION ALL\n".join(_describe_row(c) for c in U.DELTAS)))
def _delta_describe(I):
    return U.delta_describe(U.user_change(I.enriched))


LONG = """
, lg AS (SELECT 'sent_delta' AS metric, CAST(sent_delta AS DOUBLE) AS x FROM uc
  UNION ALL SELECT 'score_delta', CAST(score_delta AS DOUBLE) FROM uc
  UNION ALL SELECT 'len_delta', CAST(len_delta AS DOUBLE) FROM uc
  UNION ALL SELECT 'days_gap', CASE WHEN days_gap < 365 THEN CAST(days_gap AS DOUBLE) END FROM uc)
"""


def histogram_by_sql(src, bins):
    nb = f"CAST({bins} AS DOUBLE)"
    return f"""
, hv AS (SELECT metric, x FROM {src} WHERE x IS NOT NULL)
, hb AS (SELECT metric, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
             CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM hv GROUP BY metric)
, h0 AS (SELECT hv.metric, x, lo, (hi - lo) / {nb} AS step,
         least(greatest(CAST(floor((x - lo) * ({nb} / (hi - lo))) AS INT), 0), {bins - 1}) AS idx
       FROM hv JOIN hb ON hb.metric = hv.metric)
, h1 AS (SELECT metric, x, lo, step, CASE WHEN x < lo + CAST(idx AS DOUBLE) * step THEN idx - 1 ELSE idx END AS idx FROM h0)
, h2 AS (SELECT metric, CASE WHEN x >= lo + CAST(idx + 1 AS DOUBLE) * step AND idx <> {bins - 1} THEN idx + 1 ELSE idx END AS bin FROM h1)
, hc AS (SELECT metric, bin, count(*) AS n FROM h2 GROUP BY metric, bin)
, hg AS (SELECT metric, CAST(r.range AS INTEGER) AS bin, lo, hi FROM range(0, {bins}) r, hb)
SELECT hg.metric, hg.bin, round(lo + CAST(hg.bin AS DOUBLE) * ((hi - lo) / {nb}), 9) AS bin_lo,
  round(CASE WHEN hg.bin = {bins - 1} THEN hi ELSE lo + CAST(hg.bin + 1 AS DOUBLE) * ((hi - lo) / {nb}) END, 9) AS bin_hi,
  CAST(coalesce(hc.n, 0) AS BIGINT) AS count
FROM hg LEFT JOIN hc ON hc.metric = hg.metric AND hc.bin = hg.bin"""


@register("user_change_histograms", W(["E", "active"], UC + LONG + histogram_by_sql("lg", 30)))
def _user_change_histograms(I):
    return U.user_change_histograms(U.user_change(I.enriched))


def kde_by_sql(src, grid):
    return f"""
, kv AS (SELECT metric, x FROM {src} WHERE x IS NOT NULL)
, ks AS (SELECT metric, count(x) AS n, stddev_samp(x) * pow(CAST(count(x) AS DOUBLE), -0.2) AS h,
                min(x) AS mn, max(x) AS mx FROM kv GROUP BY metric)
, ks2 AS (SELECT metric, n, h, mn - 3.0 * h AS g0, mx + 3.0 * h AS g1 FROM ks)
, kd AS (SELECT metric, x, count(*) AS m FROM kv GROUP BY metric, x)
, kp AS (SELECT kd.metric, x, m, n, h, g0, g1, r.range AS i,
           g0 + CAST(r.range AS DOUBLE) * ((g1 - g0) / CAST({grid - 1} AS DOUBLE)) AS gx
         FROM kd JOIN ks2 ON ks2.metric = kd.metric, range(0, {grid}) r)
SELECT metric, CAST(i AS INTEGER) AS grid_index, round(gx, 9) AS x,
  round(sum(m * exp(-0.5 * ((gx - x) / h) * ((gx - x) / h))) / (CAST(n AS DOUBLE) * h * sqrt(2 * pi())), 9) AS density
FROM kp GROUP BY metric, i, n, h, gx"""


@register("user_change_density", W(["E", "active"], UC + """
, lg AS (SELECT 'sent_delta' AS metric, CAST(sent_delta AS DOUBLE) AS x FROM uc
  UNION ALL SELECT 'score_delta', CAST(score_delta AS DOUBLE) FROM uc
  UNION ALL SELECT 'len_delta', CAST(len_delta AS DOUBLE) FROM uc)
""" + kde_by_sql("lg", 200)))
def _user_change_density(I):
    return U.user_change_density(U.user_change(I.enriched))


@register("user_change_density_binned", W(["E", "active"], UC + """
, lg AS (SELECT 'sent_delta' AS metric, CAST(sent_delta AS DOUBLE) AS x FROM uc
  UNION ALL SELECT 'score_delta', CAST(score_delta AS DOUBLE) FROM uc
  UNION ALL SELECT 'len_delta', CAST(len_delta AS DOUBLE) FROM uc)
, st0 AS (SELECT metric, count(x) AS n, stddev_samp(x) * pow(CAST(count(x) AS DOUBLE), -0.2) AS h, min(x) AS mn, max(x) AS mx FROM lg WHERE x IS NOT NULL GROUP BY metric)
, st1 AS (SELECT metric, n, h, mn - 3.0 * h AS g0, mx + 3.0 * h AS g1 FROM st0 WHERE h > 0)
, st AS (SELECT *, (g1 - g0) / least(ceil((g1 - g0) * 32 / h), 1048576.0) AS d FROM st1)
, pl AS (SELECT lg.metric, floor((x - g0) / d) AS b, (x - g0) / d - floor((x - g0) / d) AS s FROM lg JOIN st ON st.metric = lg.metric WHERE x IS NOT NULL)
, la AS (SELECT metric, c, sum(m) AS m FROM (SELECT metric, b AS c, 1 - s AS m FROM pl UNION ALL SELECT metric, b + 1, s FROM pl) GROUP BY metric, c)
SELECT la.metric, CAST(i.range AS INTEGER) AS grid_index, round(g0 + i.range * ((g1 - g0) / 199.0), 9) AS x,
  round(sum(m * exp(-0.5 * pow((g0 + i.range * ((g1 - g0) / 199.0) - (g0 + c * d)) / h, 2))) / (n * h * sqrt(2 * pi())), 9) AS density
FROM la JOIN st ON st.metric = la.metric, range(200) i GROUP BY la.metric, i.range, g0, g1, n, h"""))
def _user_change_density_binned(I):
    return U.user_change_density(U.user_change(I.enriched), binned=True)
