"""Registered queries: run log, anomaly flags, alerts, dashboard view."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from reviewlake.operators import monitoring as M
from reviewlake.plans import oracle as O
from reviewlake.plans.registry import register

W = O.with_ctes

PREV = """
, rp AS (SELECT *, coalesce(sum(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) OVER (
           ORDER BY "timestamp", event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev_succ FROM runs)
, sp AS (SELECT rows_loaded AS prev_rows, row_number() OVER (ORDER BY "timestamp", event_id) AS succ_no
         FROM runs WHERE status = 'SUCCESS')
, rprev AS (SELECT rp.* EXCLUDE (prev_succ), sp.prev_rows FROM rp LEFT JOIN sp ON sp.succ_no = rp.prev_succ - 1)
, flagged AS (SELECT *, CASE WHEN status <> 'SUCCESS' THEN NULL
    WHEN prev_rows IS NULL OR prev_rows <= 0 THEN 'FIRST_RUN'
    WHEN CAST(rows_loaded AS DOUBLE) / CAST(prev_rows AS DOUBLE) < 0.2
      THEN 'WARNING: Only ' || CAST(rows_loaded AS VARCHAR) || ' rows vs ' || CAST(prev_rows AS VARCHAR) || ' last month'
    ELSE 'OK' END AS anomaly_flag FROM rprev)
"""

VIEW = f"""
, bad AS (SELECT
    (SELECT count(*) FROM reviews WHERE review_id IS NULL) AS no_id,
    (SELECT count(*) FROM reviews WHERE coalesce(trim(content), '') = '') AS no_text,
    (SELECT count(*) FROM reviews WHERE score IS NULL) AS no_score,
    (SELECT {O.round_div("100 * count(*) FILTER (WHERE coalesce(trim(content), '') = '')", "count(*)", 2)} FROM reviews) AS no_text_pct)
, vw AS (SELECT "date" AS run_date, task_name, status, rows_loaded, duration_sec, error_message,
    CASE WHEN rows_loaded = 0 THEN 'NO_DATA'
         WHEN error_message IS NOT NULL THEN 'PIPELINE_ERROR'
         WHEN task_name = 'review_update' AND (SELECT no_text_pct FROM bad) > 10 THEN 'MISSING_FIELDS' END AS final_anomaly_flag,
    CASE WHEN task_name = 'review_update' THEN (SELECT no_id FROM bad) END AS missing_review_id,
    CASE WHEN task_name = 'review_update' THEN (SELECT no_text FROM bad) END AS missing_content,
    CASE WHEN task_name = 'review_update' THEN (SELECT no_score FROM bad) END AS missing_score,
    CASE WHEN task_name = 'review_update' THEN (SELECT no_text_pct FROM bad) END AS missing_content_pct
  FROM runs)
"""


def _flagged(I):
    return M.run_anomaly_flag(M.previous_success_rows(I.runs))


def _view(I):
    return M.pipeline_monitoring_with_anomaly(I.runs, I.reviews)


@register("previous_success_rows", W(["runs"], PREV + """
SELECT event_id, "timestamp", status, rows_loaded, prev_rows FROM rprev"""))
def _previous_success_rows(I):
    return M.previous_success_rows(I.runs).select("event_id", "timestamp", "status", "rows_loaded", "prev_rows")


@register("run_anomaly_flag", W(["runs"], PREV + """
SELECT event_id, status, rows_loaded, prev_rows, anomaly_flag FROM flagged"""))
def _run_anomaly_flag(I):
    return _flagged(I).select("event_id", "status", "rows_loaded", "prev_rows", "anomaly_flag")


@register("run_log_row", W(["runs"], PREV + """
SELECT "date", task_name, status, rows_loaded,
  CASE WHEN length(error_message) > 800 THEN substr(error_message, 1, 800) || ' ...' ELSE error_message END
    AS error_message,
  round(duration_sec, 2) AS duration_sec, anomaly_flag, "timestamp" FROM flagged"""))
def _run_log_row(I):
    return M.format_run_log(_flagged(I)).select(
        "date", "task_name", "status", "rows_loaded", "error_message", "duration_sec", "anomaly_flag",
        "timestamp")


@register("alert_rows", W(["runs"], PREV + """
, logged AS (SELECT event_id, task_name, status, rows_loaded, anomaly_flag, round(duration_sec, 2) AS duration_sec,
    CASE WHEN length(error_message) > 800 THEN substr(error_message, 1, 800) || ' ...' ELSE error_message END
      AS error_message FROM flagged)
SELECT event_id, '[Pipeline Alert] ' || task_name || ' ' || status AS subject,
  'Status: ' || status || chr(10) || 'Rows Loaded: ' || CAST(rows_loaded AS VARCHAR) || chr(10) ||
  'Duration: ' || CAST(duration_sec AS VARCHAR) || 's' || chr(10) || chr(10) || coalesce(anomaly_flag, '') ||
  chr(10) || chr(10) || coalesce(error_message, '') AS body
FROM logged WHERE status = 'FAILURE' OR coalesce(starts_with(anomaly_flag, 'WARNING'), false)"""))
def _alert_rows(I):
    return M.alert_rows(M.format_run_log(_flagged(I))).select("event_id", "subject", "body")


@register("pipeline_flag", W(["runs"], """
SELECT event_id, CASE WHEN rows_loaded = 0 THEN 'NO_DATA' WHEN error_message IS NOT NULL THEN 'PIPELINE_ERROR' END
  AS pipeline_flag FROM runs"""))
def _pipeline_flag(I):
    return M.pipeline_flag(I.runs).select("event_id", "pipeline_flag")


@register("pipeline_monitoring_with_anomaly", W(["runs", "reviews"], VIEW + "SELECT * FROM vw ORDER BY run_date DESC"))
def _pmwa(I):
    return _view(I)


@register("create_anomaly_view", W(["runs", "reviews"], VIEW + "SELECT * FROM vw"))
def _create_anomaly_view(I):
    return M.create_anomaly_view(I.spark, I.runs, I.reviews)


@register("anomaly_join", W(["runs", "reviews"], VIEW + """
SELECT run_date, task_name, missing_review_id, missing_content, missing_score, missing_content_pct FROM vw"""))
def _anomaly_join(I):
    return _view(I).select("run_date", "task_name", "missing_review_id", "missing_content", "missing_score",
                           "missing_content_pct")


@register("latest_runs_sort", W(["runs"], """
, dated AS (SELECT CASE WHEN event_id % 50 = 0 THEN NULL ELSE "date" END AS run_date FROM runs)
, days AS (SELECT run_date, count(*) AS run_count FROM dated GROUP BY run_date)
SELECT run_date, run_count, CAST(count(*) OVER (ORDER BY run_date IS NOT NULL, run_date DESC) AS INTEGER) AS position FROM days"""))
def _latest_runs_sort(I):
    """Position of each day in the sorted view, runs without a date first."""
    undated = I.runs.withColumn("date", F.when(F.col("event_id") % 50 == 0, None).otherwise(F.col("date")))
    days = M.pipeline_monitoring_with_anomaly(undated, I.reviews).groupBy("run_date").agg(F.count(F.lit(1)).alias("run_count"))
    order = Window.orderBy(F.desc_nulls_first("run_date"))  # one row for each day
    return days.withColumn("position", F.row_number().over(order)).select("run_date", "run_count", "position")


@register("run_history", W(["runs"], """
SELECT * FROM runs WHERE task_name = 'review_update' ORDER BY "timestamp" DESC"""))
def _run_history(I):
    return M.run_history(I.runs)


@register("duration_trend", W(["runs", "reviews"], VIEW + f"""
SELECT run_date, {O.exact_mean("duration_sec", 2)} AS avg_duration_sec FROM vw GROUP BY run_date"""))
def _duration_trend(I):
    return M.duration_trend(_view(I))


@register("duration_describe", W(["runs"], """
SELECT task_name, count(duration_sec) AS count, round(avg(duration_sec), 6) AS mean, round(stddev_samp(duration_sec), 6) AS std, min(duration_sec) AS min,
  round(quantile_cont(duration_sec, 0.25), 6) AS p25, round(quantile_cont(duration_sec, 0.5), 6) AS p50, round(quantile_cont(duration_sec, 0.75), 6) AS p75,
  max(duration_sec) AS max FROM runs GROUP BY task_name"""))
def _duration_describe(I):
    return M.duration_describe(I.runs)


@register("rows_loaded_trend", W(["runs", "reviews"], VIEW + """
SELECT run_date, CAST(sum(rows_loaded) AS BIGINT) AS total_rows_loaded FROM vw GROUP BY run_date"""))
def _rows_loaded_trend(I):
    return M.rows_loaded_trend(_view(I))


@register("missing_content_trend", W(["runs", "reviews"], VIEW + """
SELECT run_date, max(missing_content_pct) AS missing_content_pct FROM vw GROUP BY run_date"""))
def _missing_content_trend(I):
    return M.missing_content_trend(_view(I))


_MISSING = ("(count(*) FILTER (WHERE review_id IS NULL) + count(*) FILTER (WHERE content IS NULL OR "
            "trim(content) = '') + count(*) FILTER (WHERE score IS NULL))")


@register("review_completeness", W(["reviews"], f"""
SELECT {O.round_div(f"100 * (3 * count(*) - {_MISSING})", "3 * count(*)")} AS completeness_pct FROM reviews"""))
def _review_completeness(I):
    return M.review_completeness(I.reviews)


@register("anomaly_count_trend", W(["runs", "reviews"], VIEW + """
SELECT run_date, count(final_anomaly_flag) AS anomaly_count FROM vw GROUP BY run_date"""))
def _anomaly_count_trend(I):
    return M.anomaly_count_trend(_view(I))


@register("anomaly_type_distribution", W(["runs", "reviews"], VIEW + """
SELECT final_anomaly_flag, count(*) AS run_count FROM vw WHERE final_anomaly_flag IS NOT NULL
GROUP BY final_anomaly_flag"""))
def _anomaly_type_distribution(I):
    return M.anomaly_type_distribution(_view(I))
