"""Pipeline run log: row building, anomaly flags, alerts, dashboard view.

Runs are windowed hour by hour, on top of a window over one row for each
hour, so no task sees the whole log.
``reviews`` is reduced to one field-check row (a global aggregate) before
it meets the log.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from reviewlake import schemas
from reviewlake.functions.stats import exact_mean, round_div
from reviewlake.functions.text import truncate_with_suffix
from reviewlake.operators.quality import field_check
from reviewlake.operators.stats import describe

ERROR_LIMIT = 800
RATIO = 0.2


def previous_success_rows(runs: DataFrame, offset: int = 1, ts: str = "timestamp",
                          tie: str | None = "event_id", by: str | None = None) -> DataFrame:
    """Adds ``prev_rows``: rows_loaded of the (offset+1)-th latest SUCCESS
    strictly before each run (offset=1 is the second latest, as the loader's
    ``LIMIT 1 OFFSET 1`` query returns before the current run is logged).

    The log is windowed once, inside each hour: the last success before a run
    there carries the one ``offset`` before it.  What an hour takes over from
    earlier ones, their last ``offset`` + 1 successes, comes from one row for
    each hour.  Rows without a timestamp come first.
    """
    need = offset + 1
    cols = [F.col(ts)] + ([F.col(tie)] if tie and tie in runs.columns else [])
    keys = [by] if by else []
    succ = F.col("status") == "SUCCESS"
    value = F.struct(F.col("rows_loaded").alias("v"))
    timed = runs.withColumn("_hour", F.coalesce(F.date_trunc("hour", ts).cast("timestamp_ntz"), F.lit("0001-01-01").cast("timestamp_ntz")))
    # The last successes of each hour, then of all hours up to it: ``need`` hours with one hold that many.
    last = lambda rows: F.slice(rows, F.greatest(F.size(rows) - (need - 1), F.lit(1)), need)
    hours = timed.groupBy(*keys, "_hour").agg(F.sort_array(F.collect_list(F.when(succ, F.struct(*cols, value.alias("s"))))).alias("_all"))
    hours = hours.withColumn("_own", last(F.transform("_all", lambda x: x["s"]))).drop("_all")
    some = F.size("_own") > 0
    in_order = Window.partitionBy(*keys, some).orderBy("_hour").rowsBetween(-(need - 1), 0)
    hours = hours.withColumn("_upto", F.when(some, last(F.flatten(F.collect_list("_own").over(in_order)))))
    before = Window.partitionBy(*keys).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_hour").alias("_at"),
                         F.last("_upto", ignorenulls=True).over(before).alias("_before"))
    same = [F.col("_hour") == F.col("_at")] + [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    order = Window.partitionBy(*keys, "_hour", succ).orderBy(*cols)
    so_far = Window.partitionBy(*keys, "_hour").orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    inside = timed.repartition(*keys, "_hour").withColumn("_lag", F.when(succ, F.struct((F.lag(value, offset).over(order) if offset else value).alias("p"))))
    inside = inside.withColumn("_here", F.last("_lag", ignorenulls=True).over(so_far)["p"]).withColumn("_n", F.count(F.when(succ, 1)).over(so_far).cast("int"))
    r = inside.join(hours, same, "left")
    earlier = F.try_element_at("_before", F.col("_n") - need)  # counted from the end
    return r.withColumn("prev_rows", F.when(F.col("_n") >= need, F.col("_here")["v"]).otherwise(earlier["v"])).select(*runs.columns, "prev_rows")


def run_anomaly_flag(runs_with_prev: DataFrame, ratio: float = RATIO, offset: int = 1) -> DataFrame:
    """FIRST_RUN / WARNING: Only {rows} rows vs {prev} last month / OK for
    successful runs; failed runs carry no flag.  ``prev_rows`` is computed
    with ``previous_success_rows(offset)`` when the input lacks it."""
    if "prev_rows" not in runs_with_prev.columns:
        runs_with_prev = previous_success_rows(runs_with_prev, offset=offset)
    rows, prev = F.col("rows_loaded"), F.col("prev_rows")
    flag = (F.when(F.col("status") != "SUCCESS", F.lit(None))
             .when(prev.isNull() | (prev <= 0), F.lit("FIRST_RUN"))
             .when(rows.cast("double") / prev.cast("double") < ratio,
                   F.concat(F.lit("WARNING: Only "), rows.cast("string"), F.lit(" rows vs "),
                            prev.cast("string"), F.lit(" last month")))
             .otherwise(F.lit("OK")))
    return runs_with_prev.withColumn("anomaly_flag", flag)


def format_run_log(runs: DataFrame, limit: int = ERROR_LIMIT) -> DataFrame:
    """Column rules of a stored log row: error text cut to ``limit``
    characters plus " ..." only when longer; duration to 2 decimals."""
    return runs.withColumn("error_message", truncate_with_suffix("error_message", limit)) \
               .withColumn("duration_sec", F.round("duration_sec", 2))


def run_log_row(spark: SparkSession, status: str, rows_loaded: int, error_message: str | None,
                duration_sec: float, anomaly_flag: str | None, task_name: str = "review_update",
                now: _dt.datetime | None = None, limit: int = ERROR_LIMIT) -> DataFrame:
    """One log row for a finished run (date = today, timestamp = now)."""
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = [(now.date(), task_name, status, int(rows_loaded), error_message, float(duration_sec),
            anomaly_flag, now)]
    return format_run_log(spark.createDataFrame(row, schemas.PIPELINE_MONITORING), limit)


def alert_rows(runs: DataFrame, extra=()) -> DataFrame:
    """Runs that need an alert: FAILURE, or a WARNING flag (plus optional
    extra flags such as NO_DATA), with subject and body text."""
    cond = (F.col("status") == "FAILURE") | F.coalesce(F.col("anomaly_flag").startswith("WARNING"), F.lit(False))
    for f in extra:
        cond = cond | F.coalesce(F.col("anomaly_flag") == f, F.lit(False))
    shown = lambda c: F.coalesce(c.cast("string"), F.lit("None"))  # a missing value must not empty the whole text
    subject = F.concat(F.lit("[Pipeline Alert] "), shown(F.col("task_name")), F.lit(" "), shown(F.col("status")))
    body = F.concat(F.lit("Status: "), shown(F.col("status")),
                    F.lit("\nRows Loaded: "), shown(F.col("rows_loaded")),
                    F.lit("\nDuration: "), shown(F.round("duration_sec", 2)), F.lit("s\n\n"),
                    F.coalesce(F.col("anomaly_flag"), F.lit("")), F.lit("\n\n"),
                    F.coalesce(F.col("error_message"), F.lit("")))
    return runs.filter(cond).withColumn("subject", subject).withColumn("body", body)


def pipeline_flag(runs: DataFrame) -> DataFrame:
    flag = (F.when(F.col("rows_loaded") == 0, F.lit("NO_DATA"))
             .when(F.col("error_message").isNotNull(), F.lit("PIPELINE_ERROR")))
    return runs.withColumn("pipeline_flag", flag)


def pipeline_monitoring_with_anomaly(runs: DataFrame, reviews: DataFrame, missing_pct: float = 10.0,
                                     task_name: str = "review_update") -> DataFrame:
    """Run log left-joined to today's field check of the reviews table.

    The field check is a global aggregate: exactly one row, broadcast.
    """
    base = pipeline_flag(runs).select(
        F.col("date").alias("run_date"), "task_name", "status", "rows_loaded", "duration_sec",
        "error_message", "pipeline_flag")
    fc = field_check(reviews, task_name).drop("total_rows")
    j = base.join(F.broadcast(fc), "task_name", "left")
    final = F.coalesce(F.col("pipeline_flag"),
                       F.when(F.col("missing_content_pct") > missing_pct, F.lit("MISSING_FIELDS")))
    return j.select("run_date", "task_name", "status", "rows_loaded", "duration_sec", "error_message",
                    final.alias("final_anomaly_flag"), "missing_review_id", "missing_content",
                    "missing_score", "missing_content_pct") \
            .orderBy(F.desc_nulls_first("run_date"))


def create_anomaly_view(spark: SparkSession, runs: DataFrame, reviews: DataFrame,
                        name: str = "pipeline_monitoring_with_anomaly") -> DataFrame:
    """Register the dashboard view (lazy, re-evaluated on every read)."""
    pipeline_monitoring_with_anomaly(runs, reviews).createOrReplaceTempView(name)
    return spark.table(name)


def run_history(runs: DataFrame, task_name: str = "review_update") -> DataFrame:
    return runs.filter(F.col("task_name") == task_name).orderBy(F.desc_nulls_first("timestamp"))


# ---------------------------------------------------------------- dashboard series
def duration_trend(view: DataFrame, digits: int = 6) -> DataFrame:
    # durations are logged with 2 decimals, so the mean is taken exactly
    return view.groupBy("run_date").agg(exact_mean("duration_sec", 2, digits).alias("avg_duration_sec"))


def duration_describe(runs: DataFrame, by: str | None = "task_name", digits: int = 6) -> DataFrame:
    """Count, mean, deviation, quartiles and range of the runs' seconds per task; durations may have any fraction."""
    return describe(runs, "duration_sec", by, digits, unbounded=True)


def rows_loaded_trend(view: DataFrame) -> DataFrame:
    return view.groupBy("run_date").agg(F.sum("rows_loaded").cast("bigint").alias("total_rows_loaded"))


def missing_content_trend(view: DataFrame) -> DataFrame:
    return view.groupBy("run_date").agg(F.max("missing_content_pct").alias("missing_content_pct"))


def review_completeness(reviews: DataFrame, digits: int = 6) -> DataFrame:
    fc = field_check(reviews)
    missing = F.col("missing_review_id") + F.col("missing_content") + F.col("missing_score")
    total = 3 * F.col("total_rows")
    return fc.select(round_div(100 * (total - missing), total, digits).alias("completeness_pct"))


def anomaly_count_trend(view: DataFrame) -> DataFrame:
    return view.groupBy("run_date").agg(F.count("final_anomaly_flag").alias("anomaly_count"))


def anomaly_type_distribution(view: DataFrame) -> DataFrame:
    return view.filter(F.col("final_anomaly_flag").isNotNull()).groupBy("final_anomaly_flag") \
               .agg(F.count(F.lit(1)).alias("run_count"))
