"""Registered queries: landed pages, typing, staging, high-water mark, merge."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.operators import ingest as G
from reviewlake.plans import oracle as O
from reviewlake.plans.registry import register
from reviewlake.sources import fixtures

W = O.with_ctes

RAW = """
, raw AS (SELECT review_id, user_name, content,
    CASE WHEN CAST(substr(review_id, 2) AS BIGINT) % 127 = 0 THEN 'n/a' ELSE CAST(score AS VARCHAR) END AS score,
    CASE WHEN CAST(substr(review_id, 2) AS BIGINT) % 113 = 0 THEN 'not-a-date'
         WHEN CAST(substr(review_id, 2) AS BIGINT) % 7 = 0 THEN strftime(created_at, '%Y-%m-%d %H:%M:%S') || '.5'
         ELSE strftime(created_at, '%Y-%m-%d %H:%M:%S') END AS created_at,
    app_version FROM reviews)
"""
COERCE = """SELECT review_id, user_name, content, CAST(trunc(TRY_CAST(score AS DOUBLE)) AS INTEGER) AS score,
  date_trunc('second', TRY_CAST(created_at AS TIMESTAMP)) AS created_at, app_version FROM raw"""

DEFAULTS = dict(default_developer="unknown developer", default_genre="Productivity",
                default_url="https://store.example/app")


def _pages(I):
    return G.parse_pages(G.reviews_to_pages(I.reviews))


@register("normalize_raw_reviews", W(["reviews"], """
SELECT review_id, user_name, content, CAST(score AS VARCHAR) AS score,
  strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, app_version FROM reviews"""))
def _normalize_raw_reviews(I):
    return G.normalize_raw_reviews(G.explode_pages(_pages(I)))


@register("scan_review_pages", W(["reviews"], "SELECT * FROM reviews"))
def _scan_review_pages(I):
    """Pages landed as JSON files, read by the reader of the load."""
    path = _fresh(I, "pages")
    G.reviews_to_pages(I.reviews).write.text(path)
    return readers.scan_review_pages(I.spark, path)


@register("coerce_types", W(["reviews"], RAW + COERCE))
def _coerce_types(I):
    return G.coerce_types(I.raw_reviews)


@register("stage_reviews", W(["merge_batch"], "SELECT * FROM merge_batch"))
def _stage_reviews(I):
    return G.stage_reviews(I.merge_batch)


@register("new_reviews_since", W(["merge_batch", "merge_target"], """
SELECT * FROM merge_batch WHERE created_at > (
  SELECT coalesce(max(created_at), CAST(current_timestamp AS TIMESTAMP) - INTERVAL 30 DAY) FROM merge_target)"""))
def _new_reviews_since(I):
    return G.new_reviews_since(I.merge_batch, I.merge_target)


MERGE = """
, src AS (SELECT * FROM merge_batch WHERE review_id IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY created_at DESC NULLS LAST,
            content ASC NULLS LAST, user_name ASC NULLS LAST, app_version ASC NULLS LAST, score ASC NULLS LAST) = 1)
"""


@register("merge_reviews", W(["merge_batch", "merge_target"], MERGE + """
SELECT t.review_id, t.user_name,
  CASE WHEN s.review_id IS NOT NULL THEN s.content ELSE t.content END AS content,
  CASE WHEN s.review_id IS NOT NULL THEN s.score ELSE t.score END AS score,
  CASE WHEN s.review_id IS NOT NULL THEN s.created_at ELSE t.created_at END AS created_at,
  CASE WHEN s.review_id IS NOT NULL THEN s.app_version ELSE t.app_version END AS app_version
FROM merge_target t LEFT JOIN src s ON s.review_id = t.review_id
UNION ALL
SELECT * FROM src WHERE review_id NOT IN (SELECT review_id FROM merge_target WHERE review_id IS NOT NULL)"""))
def _merge_reviews(I):
    return G.merge_reviews(I.merge_target, I.merge_batch)


@register("merge_report", W(["merge_batch", "merge_target"], MERGE + """
SELECT (SELECT count(*) FROM merge_batch) AS batch_rows,
  (SELECT count(*) FROM merge_batch WHERE review_id IS NULL) AS null_ids,
  (SELECT count(*) FROM merge_batch) - (SELECT count(*) FROM merge_batch WHERE review_id IS NULL)
    - (SELECT count(*) FROM src) AS duplicates_dropped,
  (SELECT count(*) FROM src WHERE review_id IN (SELECT review_id FROM merge_target)) AS updated,
  (SELECT count(*) FROM src) - (SELECT count(*) FROM src WHERE review_id IN (SELECT review_id FROM merge_target))
    AS inserted"""))
def _merge_report(I):
    return G.merge_report(I.merge_target, I.merge_batch)


@register("map_app_metadata", W(["app_meta"], f"""
SELECT app_version, title, coalesce(developer, '{DEFAULTS['default_developer']}') AS developer,
  coalesce(genre, '{DEFAULTS['default_genre']}') AS genre, score, ratings_count, reviews_count, installs,
  real_installs, is_free, price, currency, coalesce(sale, false) AS sale, offers_iap, iap_price_range,
  coalesce(url, '{DEFAULTS['default_url']}') AS url
FROM app_meta"""))
def _map_app_metadata(I):
    return G.map_app_metadata(G.metadata_to_json(I.app_metadata), **DEFAULTS).drop("fetched_at")


@register("empty_batch_guard", W(["merge_batch", "merge_target"], """
SELECT count(*) AS rows_loaded, count(*) = 0 AS is_empty FROM merge_batch WHERE created_at > (
  SELECT coalesce(max(created_at), CAST(current_timestamp AS TIMESTAMP) - INTERVAL 30 DAY) FROM merge_target)"""))
def _empty_batch_guard(I):
    new = G.new_reviews_since(I.merge_batch, I.merge_target)
    return new.agg(F.count(F.lit(1)).alias("rows_loaded"), (F.count(F.lit(1)) == 0).alias("is_empty"))


# ---------------------------------------------------------------- sinks
# Write-then-read round trips: the data goes through the real writer and
# reader into a fresh folder under the shared checkpoint directory, and the
# result must equal the input (so the oracle is the input itself).
import uuid  # noqa: E402

from reviewlake import schemas  # noqa: E402
from reviewlake.operators import monitoring as M  # noqa: E402
from reviewlake.session import checkpoint_dir  # noqa: E402
from reviewlake.sources import readers, sinks  # noqa: E402


def _fresh(I, name):
    return f"{checkpoint_dir(I.spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@register("append_batches", W(["reviews"], "SELECT * FROM reviews"))
def _append_batches(I):
    path = _fresh(I, "reviews-table")
    sinks.create_reviews_table(I.spark, path)
    sinks.append_batches(I.reviews, path, max_records=sinks.BATCH_SIZE)
    return readers.scan_reviews(I.spark, path)


@register("scan_reviews_csv", W(["reviews"], "SELECT * FROM reviews"))
def _scan_reviews_csv(I):
    path = _fresh(I, "reviews-csv")
    export = I.reviews.select(
        F.col("review_id").alias("reviewId"), F.col("user_name").alias("userName"),
        F.col("score").cast("string").alias("score"), "content", F.lit("0").alias("thumbsUpCount"),
        F.col("app_version").alias("reviewCreatedVersion"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("at"),
        F.lit(None).cast("string").alias("replyContent"), F.lit(None).cast("string").alias("repliedAt"))
    (export.write.option("header", True).option("escape", '"').option("quoteAll", True)
           .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return readers.scan_reviews_csv(I.spark, path)


@register("append_run_log", W(["runs"], """
SELECT "date", task_name, status, rows_loaded,
  CASE WHEN length(error_message) > 800 THEN substr(error_message, 1, 800) || ' ...' ELSE error_message END
    AS error_message, round(duration_sec, 2) AS duration_sec, CAST(NULL AS VARCHAR) AS anomaly_flag, "timestamp"
FROM runs"""))
def _append_run_log(I):
    path = _fresh(I, "run-log")
    sinks.create_monitoring_table(I.spark, path)
    rows = M.format_run_log(I.runs).withColumn("anomaly_flag", F.lit(None).cast("string"))
    sinks.append_run_log(rows, path)
    return readers.scan_run_log(I.spark, path)


@register("create_reviews_table", W(["reviews"], "SELECT * FROM reviews"))
def _create_reviews_table(I):
    """A second creation leaves the rows of the first in place."""
    path = _fresh(I, "created-reviews")
    sinks.create_reviews_table(I.spark, path)
    sinks.append_batches(I.reviews, path)
    sinks.create_reviews_table(I.spark, path)
    return readers.scan_reviews(I.spark, path)


@register("create_app_metadata_table", W(["app_meta"], "SELECT app_version, title, score FROM app_meta"))
def _create_app_metadata_table(I):
    path = _fresh(I, "created-metadata")
    sinks.create_app_metadata_table(I.spark, path)
    sinks.append_app_metadata(G.map_app_metadata(G.metadata_to_json(I.app_metadata)), path)
    sinks.create_app_metadata_table(I.spark, path)
    return readers.scan_app_metadata(I.spark, path).select("app_version", "title", "score")


@register("create_monitoring_table", W(["runs"], 'SELECT "date", task_name, status, rows_loaded, "timestamp" FROM runs'))
def _create_monitoring_table(I):
    path = _fresh(I, "created-log")
    sinks.create_monitoring_table(I.spark, path)
    sinks.append_run_log(M.format_run_log(I.runs).withColumn("anomaly_flag", F.lit(None).cast("string")), path)
    sinks.create_monitoring_table(I.spark, path)
    return readers.scan_run_log(I.spark, path).select("date", "task_name", "status", "rows_loaded", "timestamp")


@register("append_app_metadata", W(["app_meta"], f"""
SELECT app_version, title, coalesce(developer, '{DEFAULTS['default_developer']}') AS developer,
  coalesce(genre, '{DEFAULTS['default_genre']}') AS genre, score, ratings_count, reviews_count, installs,
  real_installs, is_free, price, currency, coalesce(sale, false) AS sale, offers_iap, iap_price_range,
  coalesce(url, '{DEFAULTS['default_url']}') AS url, TIMESTAMP '2025-01-01 00:00:00' AS fetched_at
FROM app_meta"""))
def _append_app_metadata(I):
    path = _fresh(I, "app-metadata")
    sinks.create_app_metadata_table(I.spark, path)
    snap = G.map_app_metadata(G.metadata_to_json(I.app_metadata), fetched_at="2025-01-01 00:00:00", **DEFAULTS)
    sinks.append_app_metadata(snap, path)
    return readers.scan_app_metadata(I.spark, path)


@register("incremental_ingest", W(["merge_batch", "merge_target"], MERGE + """
SELECT t.review_id, t.user_name,
  CASE WHEN s.review_id IS NOT NULL THEN s.content ELSE t.content END AS content,
  CASE WHEN s.review_id IS NOT NULL THEN s.score ELSE t.score END AS score,
  CASE WHEN s.review_id IS NOT NULL THEN s.created_at ELSE t.created_at END AS created_at,
  CASE WHEN s.review_id IS NOT NULL THEN s.app_version ELSE t.app_version END AS app_version
FROM merge_target t LEFT JOIN src s ON s.review_id = t.review_id
UNION ALL
SELECT * FROM src WHERE review_id NOT IN (SELECT review_id FROM merge_target WHERE review_id IS NOT NULL)"""))
def _incremental_ingest(I):
    """Two landings (target pages, then batch pages) ingested by the
    streaming job; the final table equals the batch merge."""
    from reviewlake.streaming.incremental import incremental_ingest
    landing, table, ckpt = _fresh(I, "landing"), _fresh(I, "reviews"), _fresh(I, "ingest-ckpt")
    G.reviews_to_pages(I.merge_target).write.option("compression", "gzip").text(f"{landing}/part-1")
    incremental_ingest(I.spark, f"{landing}/*", table, ckpt)
    G.reviews_to_pages(I.merge_batch).write.option("compression", "gzip").text(f"{landing}/part-2")
    incremental_ingest(I.spark, f"{landing}/*", table, ckpt)
    return readers.scan_reviews(I.spark, table).select(*schemas.REVIEW_COLUMNS)
