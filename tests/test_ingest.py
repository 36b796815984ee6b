"""Merge, typing, readers, sinks and the streaming ingest."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.operators import ingest as G
from reviewlake.sources import fixtures, readers, sinks
from tests.conftest import SF_SMALL


def T(*a):
    return dt.datetime(*a)


def _reviews(spark, rows):
    return spark.createDataFrame(rows, schemas.REVIEWS)


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merge_rules_duplicates_and_null_ids(spark):
    target = _reviews(spark, [("a", "ann", "old", 1, T(2024, 1, 1), "1.0"),
                              ("b", "bob", "keep", 2, T(2024, 1, 2), "1.0")])
    batch = _reviews(spark, [("a", "renamed", None, 5, T(2024, 2, 1), "2.0"),      # update, null overwrites
                             ("c", "cat", "new", 4, T(2024, 2, 2), "2.0"),          # insert
                             ("c", "cat", "older dup", 3, T(2024, 1, 2), "2.0"),    # duplicate id: dropped
                             (None, "x", "no id", 1, T(2024, 2, 3), "2.0")])        # quarantined
    got = {r.review_id: r for r in G.merge_reviews(target, batch).collect()}
    assert set(got) == {"a", "b", "c"}
    assert got["a"].user_name == "ann" and got["a"].content is None and got["a"].score == 5
    assert got["b"].content == "keep"
    assert got["c"].content == "new"
    rep = G.merge_report(target, batch).first()
    assert (rep.batch_rows, rep.null_ids, rep.duplicates_dropped, rep.updated, rep.inserted) == (4, 1, 1, 1, 1)


def test_merge_idempotent_and_keeps_ids_unique(spark):
    t = fixtures.merge_target(spark, SF_SMALL)
    b = fixtures.merge_batch(spark, SF_SMALL)
    once = G.merge_reviews(t, b)
    twice = G.merge_reviews(once, b)
    assert _sorted(once) == _sorted(twice)
    assert once.count() == once.select("review_id").distinct().count() == fixtures.reviews(spark, SF_SMALL).count()


def test_high_water_mark_excludes_equal(spark):
    target = _reviews(spark, [("a", "u", "x", 1, T(2024, 1, 1), "1")])
    batch = _reviews(spark, [("b", "u", "x", 1, T(2024, 1, 1), "1"), ("c", "u", "x", 1, T(2024, 1, 1, 0, 0, 1), "1")])
    assert [r.review_id for r in G.new_reviews_since(batch, target).collect()] == ["c"]
    empty = spark.createDataFrame([], schemas.REVIEWS)
    got = G.new_reviews_since(batch, empty, now=dt.datetime(2024, 1, 20)).count()
    assert got == 2  # mark = now - 30 days


def test_coerce_types(spark):
    raw = spark.createDataFrame([("a", "u", "t", "4.0", "2024-01-01 10:00:00.75", "1"),
                                 ("b", "u", "t", "x", "garbage", "1"),
                                 ("c", "u", "t", None, "2024-01-01T10:00:05", "1")],
                                "review_id string, user_name string, content string, score string, "
                                "created_at string, app_version string")
    got = {r.review_id: r for r in G.coerce_types(raw).collect()}
    assert got["a"].score == 4 and got["a"].created_at == T(2024, 1, 1, 10)
    assert got["b"].score is None and got["b"].created_at is None
    assert got["c"].created_at == T(2024, 1, 1, 10, 0, 5)


def _write_pages(path, reviews_rows, page_no):
    os.makedirs(path, exist_ok=True)
    page = {"page_no": page_no, "reviews": [
        {"reviewId": r[0], "userName": r[1], "content": r[2], "score": None if r[3] is None else str(r[3]),
         "at": None if r[4] is None else r[4].strftime("%Y-%m-%d %H:%M:%S"), "appVersion": r[5]}
        for r in reviews_rows]}
    with open(os.path.join(path, f"page-{page_no:05d}.json"), "w") as f:
        f.write(json.dumps(page) + "\n")


def test_pages_reader_and_csv_reader(spark, tmpdir_path):
    rows = [("a", "u", "hello, \"quoted\"\nline", 5, T(2024, 1, 1), "1.0"), ("b", None, None, None, None, None)]
    pages = os.path.join(tmpdir_path, "pages")
    _write_pages(pages, rows, 0)
    assert _sorted(readers.scan_review_pages(spark, pages)) == _sorted(_reviews(spark, rows))
    csv_path = os.path.join(tmpdir_path, "export.csv")
    with open(csv_path, "w") as f:
        f.write("reviewId,userName,score,content,thumbsUpCount,reviewCreatedVersion,at,replyContent,repliedAt\n")
        f.write('a,u,5,"hello, ""quoted""\nline",0,1.0,2024-01-01 00:00:00,,\n')
    got = readers.scan_reviews_csv(spark, csv_path).first()
    assert got.content == 'hello, "quoted"\nline' and got.score == 5 and got.app_version == "1.0"


def test_sinks_buckets_and_appends(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "reviews")
    assert sinks.create_reviews_table(spark, os.path.join(tmpdir_path, "empty")) is True
    assert sinks.create_reviews_table(spark, os.path.join(tmpdir_path, "empty")) is False
    df = fixtures.reviews(spark, SF_SMALL)
    sinks.write_reviews(df, base, buckets=5, max_records=500)
    assert sinks.bucket_count(spark, base) == 5 and _sorted(readers.scan_reviews(spark, base)) == _sorted(df)
    one = df.filter(sinks.bucket_of(5) == 2)
    sinks.write_reviews(one.limit(10), base, buckets=64)  # the table's own number counts
    assert sinks.bucket_count(spark, base) == 5
    assert readers.scan_reviews(spark, base).count() == df.count() - one.count() + 10
    assert sinks.read_buckets(spark, base, [2]).count() == 10
    log = os.path.join(tmpdir_path, "log")
    from reviewlake.operators.monitoring import run_log_row
    sinks.append_run_log(run_log_row(spark, "SUCCESS", 3, None, 1.234, "OK"), log)
    sinks.append_run_log(run_log_row(spark, "FAILURE", 0, "x" * 900, 2.0, None), log)
    got = readers.scan_run_log(spark, log).orderBy("status").collect()
    assert [r.status for r in got] == ["FAILURE", "SUCCESS"] and len(got[0].error_message) == 804
    meta = G.map_app_metadata(spark.createDataFrame([('{"version": "1.2", "title": "t"}',)], "value string"),
                              fetched_at=T(2024, 1, 1), default_developer="dev", default_genre="g")
    mpath = os.path.join(tmpdir_path, "meta")
    sinks.append_app_metadata(meta, mpath)
    sinks.append_app_metadata(meta, mpath)
    m = readers.scan_app_metadata(spark, mpath).collect()
    assert len(m) == 2 and m[0].developer == "dev" and m[0].sale is False


def test_streaming_ingest_matches_batch_merge(spark, tmpdir_path):
    from reviewlake.streaming.incremental import incremental_ingest
    pages = os.path.join(tmpdir_path, "landing")
    target = os.path.join(tmpdir_path, "reviews")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    first = [("a", "ann", "v1", 3, T(2024, 1, 1), "1.0"), ("b", "bob", "v1", 4, T(2024, 1, 2), "1.0")]
    second = [("a", "renamed", "v2", 5, T(2024, 2, 1), "1.1"), ("c", "cy", "v1", 1, T(2024, 2, 2), "1.1")]
    _write_pages(pages, first, 0)
    assert incremental_ingest(spark, pages, target, ckpt) == [2]
    _write_pages(pages, second, 1)
    assert incremental_ingest(spark, pages, target, ckpt) == [2]
    assert incremental_ingest(spark, pages, target, ckpt) == []  # nothing new
    streamed = readers.scan_reviews(spark, target)
    batch = G.merge_reviews(_reviews(spark, first), _reviews(spark, second))
    assert _sorted(streamed) == _sorted(batch)
    assert {r.review_id: r.user_name for r in streamed.collect()}["a"] == "ann"


def test_monthly_update_logs_and_alerts(spark, tmpdir_path):
    from reviewlake.plans.jobs import monthly_update
    pages = os.path.join(tmpdir_path, "landing")
    table, log, ckpt = (os.path.join(tmpdir_path, n) for n in ("reviews", "log", "ckpt"))
    rows = [(f"r{i}", f"u{i}", "good", 5, T(2024, 1, 15, 0, 0, i), "1.0") for i in range(20)]
    _write_pages(pages, rows[:10], 0)
    r1, a1 = monthly_update(spark, pages, table, log, ckpt, now=T(2024, 2, 1))
    assert r1.first().anomaly_flag == "FIRST_RUN" and r1.first().rows_loaded == 10 and a1.count() == 0
    _write_pages(pages, rows[10:], 1)
    r2, _ = monthly_update(spark, pages, table, log, ckpt, now=T(2024, 3, 1))
    assert r2.first().anomaly_flag == "FIRST_RUN"  # OFFSET 1: only one earlier success
    r3, a3 = monthly_update(spark, pages, table, log, ckpt, now=T(2024, 4, 1))
    assert r3.first().rows_loaded == 0
    assert r3.first().anomaly_flag == "WARNING: Only 0 rows vs 10 last month" and a3.count() == 1
    assert readers.scan_run_log(spark, log).count() == 3
    assert readers.scan_reviews(spark, table).count() == 20


def test_monthly_update_failure_is_logged(spark, tmpdir_path):
    from reviewlake.plans.jobs import monthly_update
    log = os.path.join(tmpdir_path, "log")
    missing = os.path.join(tmpdir_path, "does-not-exist")
    r, alerts = monthly_update(spark, missing, os.path.join(tmpdir_path, "t"), log,
                               os.path.join(tmpdir_path, "ck"), now=T(2024, 2, 1))
    row = r.first()
    assert row.status == "FAILURE" and row.anomaly_flag is None and row.error_message
    assert alerts.count() == 1


def test_analysis_report_writes_tables(spark, tmpdir_path):
    from reviewlake.plans.jobs import analysis_report
    from reviewlake.sources import reference_data as ref
    paths = analysis_report(fixtures.reviews(spark, SF_SMALL), ref.seed_lexicon(spark), ref.stopwords(spark),
                            ref.base_stopwords(), os.path.join(tmpdir_path, "report"))
    assert spark.read.parquet(paths["version_volume_rating"]).count() > 0
    assert spark.read.parquet(paths["top_ngrams"]).count() > 0
    for name in ("preview", "missing_counts", "duplicate_id_count", "word_count_histogram", "sarcastic_examples", "monthly_avg_length",
                 "word_freq_raw", "word_freq_comparison", "word_sentiment_weight", "user_activity_summary", "user_change_density"):
        assert spark.read.parquet(paths[name]).columns
    assert spark.read.parquet(paths["cluster_summary"]).count() == 4


def test_full_load_then_metadata(spark, tmpdir_path):
    from reviewlake.plans.jobs import full_load, ingest_app_metadata
    pages = os.path.join(tmpdir_path, "landing")
    rows = [(f"r{i}", f"u{i}", "ok", 3, T(2024, 1, 1, 0, 0, i), "1.0") for i in range(30)]
    _write_pages(pages, rows[:15], 0)
    _write_pages(pages, rows[10:], 1)  # overlapping ids: merged, not duplicated
    table = os.path.join(tmpdir_path, "reviews")
    assert full_load(spark, pages, table) == 35
    got = readers.scan_reviews(spark, table)
    assert got.count() == 30 and got.select("review_id").distinct().count() == 30
    meta = os.path.join(tmpdir_path, "meta.json")
    with open(meta, "w") as f:
        f.write(json.dumps({"version": "1.2.3", "title": "App", "score": 4.5, "free": True}) + "\n")
    m = ingest_app_metadata(spark, meta, os.path.join(tmpdir_path, "meta_table"), T(2024, 1, 2),
                            default_developer="dev", default_genre="Tools").first()
    assert (m.app_version, m.developer, m.genre, m.sale, m.fetched_at) == ("1.2.3", "dev", "Tools", False, T(2024, 1, 2))


def test_dedupe_many_copies_and_ties(spark):
    rows = [("x", "u", f"copy{i:03d}", 1, T(2024, 1, 1), "1") for i in range(300)]  # hot id: many copies
    rows += [("x", "u", "late", 2, None, "1"),                  # undated copy never wins
             ("y", "b", "zzz", 1, T(2024, 1, 2), "1"), ("y", "a", "aaa", 1, T(2024, 1, 2), "1")]
    got = {r.review_id: r for r in G.dedupe_batch(_reviews(spark, rows)).collect()}
    assert got["x"].content == "copy000" and got["y"].content == "aaa"
