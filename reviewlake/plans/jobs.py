"""End-to-end jobs: the first full load, the monthly incremental update with
run logging and alerts, the metadata snapshot ingest, and the analysis
report that enriches the reviews once.
"""

from __future__ import annotations

import datetime as _dt
import time
import traceback

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlake.operators import (clusters as C, monitoring as M, quality as Q, sarcasm as SC, stats as S,
                                  timeseries as TS, users as U, versions as V, words as WD)
from reviewlake.plans.enrich import enrich_reviews
from reviewlake.plans.materialize import materialize
from reviewlake.sources import readers, sinks


def monthly_update(spark: SparkSession, pages_dir: str, reviews_base: str, run_log_path: str,
                   checkpoint: str | None = None, task_name: str = "review_update",
                   now: _dt.datetime | None = None, offset: int = 1,
                   metadata: tuple[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Ingest newly landed pages, then log the run with its anomaly flag.

    Only reviews newer than the table's newest are loaded and counted.
    ``metadata`` names the landed metadata JSON and its history table: a
    snapshot is appended in every run, also when no review is new.  Any
    error in the load is recorded as FAILURE with its traceback, and lines
    that are no page are named in the error text (the run is never logged as
    a silent success).  Returns (logged row, alert rows).
    """
    from reviewlake.streaming.incremental import QUARANTINE, incremental_ingest

    start = time.monotonic()
    status, rows, error = "SUCCESS", 0, None
    try:
        lines: list[int] = []
        rows = int(sum(incremental_ingest(spark, pages_dir, reviews_base, checkpoint, since_mark=True, now=now, bad_lines=lines)))
        if bad := sum(lines):
            status, error = "FAILURE", f"{bad} landed lines are no review page; see {QUARANTINE} in {reviews_base}"
        if metadata:
            ingest_app_metadata(spark, *metadata, fetched_at=now)
    except Exception:  # noqa: BLE001 - the failure itself is the logged result
        status, error = "FAILURE", traceback.format_exc()
    duration = round(time.monotonic() - start, 2)
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)

    sinks.create_monitoring_table(spark, run_log_path)
    history = readers.scan_run_log(spark, run_log_path).withColumn("_new", F.lit(0))
    new = M.run_log_row(spark, status, rows, error, duration, None, task_name, now).withColumn("_new", F.lit(1))
    # The comparison reads the log before this run is appended: prev_rows of
    # the new row counts only earlier successes (the new row sorts last).
    flagged = M.run_anomaly_flag(M.previous_success_rows(
        history.unionByName(new), offset=offset, tie="_new"))
    row = flagged.filter(F.col("_new") == 1).drop("_new", "prev_rows")
    row = materialize(row, "run-log-row")
    sinks.append_run_log(row, run_log_path)
    return row, M.alert_rows(row)


def analysis_report(reviews: DataFrame, lexicon: DataFrame, stopwords: DataFrame,
                    ngram_stopwords: list[str], out_dir: str, modifiers: DataFrame | None = None) -> dict[str, str]:
    """Enrich once (written to the shared checkpoint folder), then write
    every analysis table under ``out_dir``; returns name -> path.  The
    k-means fit also runs once: its user labels are materialised and feed
    both the cluster summary and the per-version mix."""
    e = materialize(enrich_reviews(reviews, lexicon, modifiers), "enriched-reviews")
    clusters = materialize(C.user_clusters(C.user_features(e, digits=6)), "user-clusters")
    sarcastic = SC.sarcastic_reviews(e)
    changes = U.user_change(e)
    raw_words = WD.word_freq_raw(e)
    freq = WD.word_freq_filtered(e, stopwords)
    tables = {
        "preview": Q.preview(e),
        "missing_counts": Q.missing_counts(reviews),
        "duplicate_id_count": Q.duplicate_id_count(reviews),
        "missing_pct": Q.missing_pct(reviews),
        "word_count_histogram": S.histogram(e, "word_count"),
        "sarcastic_examples": SC.sarcastic_examples(sarcastic),
        "monthly_avg_length": TS.monthly_avg_length(e),
        "word_freq_raw": raw_words,
        "word_freq_comparison": WD.word_freq_comparison(freq),
        "word_sentiment_weight": WD.word_sentiment_weight(freq, lexicon),
        "user_activity_summary": U.user_activity_summary(reviews),
        "user_change_density": U.user_change_density(changes),
        "rating_distribution": Q.rating_distribution(e),
        "word_count_describe": Q.word_count_describe(e),
        "length_by_rating": Q.length_by_rating(e),
        "sentiment_score_corr": S.corr(e, "sentiment", "score"),
        "sentiment_box_stats": S.box_stats(Q.complete_rows(e), "sentiment", "score"),
        "monthly_score_sentiment": TS.monthly_score_sentiment(e),
        "monthly_corr": TS.monthly_corr(e),
        "sarcastic_by_month": TS.rolling_trend(TS.sarcastic_by_month(e, sarcastic), "sarcastic_count"),
        "sarcastic_top_versions": V.sarcastic_top_versions(sarcastic),
        "version_volume_rating": V.version_volume_rating(e),
        "version_score_sentiment_min50": V.version_score_sentiment_min50(e),
        "top_words": WD.top_words(freq, 200),
        "top_ngrams": WD.top_ngrams(e, ngram_stopwords),
        "score_share_by_activity": U.score_share_by_activity(U.score_by_activity(e)),
        "delta_direction": U.delta_direction(changes),
        "delta_describe": U.delta_describe(changes),
        "user_change_histograms": U.user_change_histograms(changes),
        "user_clusters": clusters,
        "cluster_summary": C.cluster_summary(clusters),
        "cluster_mix_by_version": C.cluster_mix_by_version(e, clusters),
    }
    paths = {}
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


def full_load(spark: SparkSession, pages_dir: str, reviews_base: str, buckets: int | None = None) -> int:
    """Batch load of every landed page into the reviews table (the first
    full sync; later runs use ``monthly_update``).  The pages are merged into
    the table, or form it with the given number of buckets; done again, it
    changes nothing.  Lines that are no page go to the quarantine folder.
    Returns the number of review rows read."""
    from reviewlake.streaming.incremental import merge_rows, quarantine
    rows = materialize(readers.scan_review_pages(spark, pages_dir), "landed-reviews")
    quarantine(readers.bad_review_pages(spark, pages_dir), reviews_base, "full")
    merge_rows(rows, reviews_base, buckets)
    return rows.count()


def ingest_app_metadata(spark: SparkSession, metadata_json_path: str, metadata_table: str,
                        fetched_at: _dt.datetime | None = None, **defaults) -> DataFrame:
    """Append one metadata snapshot per landed JSON record (history table)."""
    from reviewlake.operators.ingest import map_app_metadata
    raw = spark.read.text(metadata_json_path)
    fetched = fetched_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    snap = map_app_metadata(raw, fetched_at=fetched, **defaults)
    sinks.create_app_metadata_table(spark, metadata_table)
    sinks.append_app_metadata(snap, metadata_table)
    return readers.scan_app_metadata(spark, metadata_table)
