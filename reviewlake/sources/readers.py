"""Readers for stored tables and landed files (declared schemas, no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlake import schemas
from reviewlake.operators.ingest import bad_pages, coerce_types, explode_pages, normalize_raw_reviews, parse_pages
from reviewlake.sources.csv_records import read_csv
from reviewlake.sources.sinks import read_buckets


def _read_table(spark: SparkSession, path_or_table: str) -> DataFrame:
    if "/" in path_or_table or path_or_table.startswith("file:"):
        rows = read_buckets(spark, path_or_table)
        return spark.read.parquet(path_or_table) if rows is None else rows
    return spark.table(path_or_table)


def scan_reviews(spark: SparkSession, path_or_table: str) -> DataFrame:
    """The reviews table (Parquet path, table of buckets or catalog table).
    Column pruning and filter pushdown reach the Parquet scan."""
    return _read_table(spark, path_or_table).select(*schemas.REVIEW_COLUMNS)


def scan_app_metadata(spark: SparkSession, path_or_table: str) -> DataFrame:
    return _read_table(spark, path_or_table)


def scan_run_log(spark: SparkSession, path_or_table: str) -> DataFrame:
    return _read_table(spark, path_or_table)


def scan_review_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed store pages (JSON, one page record per line, each holding an
    array of reviews) -> typed review rows.  Lines that are no page are
    given by ``bad_review_pages``."""
    return coerce_types(normalize_raw_reviews(explode_pages(parse_pages(spark.read.text(path)))))


def bad_review_pages(spark: SparkSession, path: str) -> DataFrame:
    """(value) of the landed lines that cannot be read as a page."""
    return bad_pages(spark.read.text(path))


def scan_reviews_csv(spark: SparkSession, path: str) -> DataFrame:
    """The older single-file export layout -> typed review rows; a large file
    is read by many tasks, also where quoted texts hold line breaks."""
    raw = read_csv(spark, path, schemas.REVIEWS_CSV)
    return coerce_types(raw.select(
        F.col("reviewId").alias("review_id"), F.col("userName").alias("user_name"), "content", "score",
        F.col("at").alias("created_at"), F.col("reviewCreatedVersion").alias("app_version")))
