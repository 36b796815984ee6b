"""Lossless loading, row-wise sentiment, and statistics of any fraction."""

from __future__ import annotations

import datetime as dt
import json
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.operators import ingest as G, monitoring as M, sentiment as SE, stats as S, users as U
from reviewlake.plans.jobs import full_load, monthly_update
from reviewlake.sources import fixtures, reference_data as ref, readers, sinks
from reviewlake.streaming import incremental as inc
from reviewlake.streaming.incremental import incremental_ingest, quarantined

T = dt.datetime
SF = "/root/testdata/sf0.001"


def land(folder, rows, no, tail=""):
    os.makedirs(folder, exist_ok=True)
    page = {"page_no": no, "reviews": [{"reviewId": i, "userName": "u", "content": c, "score": "3", "at": t, "appVersion": "1.0"} for i, c, t in rows]}
    with open(os.path.join(folder, f"p{no}.json"), "w") as f:
        f.write(json.dumps(page) + "\n" + tail)


def rows_from(first, last, day="2024-01-20"):
    return [(f"r{k}", f"text {k}", f"{day} 00:00:{k % 60:02d}") for k in range(first, last)]


def test_a_restarted_stream_goes_on(spark, tmpdir_path):
    pages, target = f"{tmpdir_path}/in", f"{tmpdir_path}/t"
    land(pages, rows_from(0, 40), 0)
    assert incremental_ingest(spark, pages, target) == [40]
    land(pages, rows_from(40, 41), 1)
    # A new session has another random checkpoint folder; the stream's own lies beside the target.
    assert incremental_ingest(spark.newSession(), pages, target) == [1]
    assert incremental_ingest(spark, pages, target) == []
    assert readers.scan_reviews(spark, target).count() == 41


def test_two_targets_do_not_share_a_checkpoint(spark, tmpdir_path):
    pages = f"{tmpdir_path}/in"
    land(pages, rows_from(0, 12), 0)
    for name in ("a", "b"):
        assert incremental_ingest(spark, pages, f"{tmpdir_path}/{name}") == [12]
        assert readers.scan_reviews(spark, f"{tmpdir_path}/{name}").count() == 12


def files_of(target):
    return {n: sorted(f for f in os.listdir(f"{target}/{n}") if f.startswith("part-")) for n in os.listdir(target) if n.startswith("bucket=")}


def test_untouched_buckets_keep_their_files(spark, tmpdir_path):
    pages, target = f"{tmpdir_path}/in", f"{tmpdir_path}/t"
    land(pages, rows_from(0, 500), 0)
    incremental_ingest(spark, pages, target, buckets=16)
    before = files_of(target)
    land(pages, [("r7", "edited", "2024-01-21 00:00:00"), ("new", "first", "2024-01-21 00:00:00")], 1)
    incremental_ingest(spark, pages, target)
    after = files_of(target)
    touched = {r["b"] for r in spark.createDataFrame([("r7",), ("new",)], "review_id string").select(sinks.bucket_of(16).alias("b")).collect()}
    assert len(after) == 16 == sinks.bucket_count(spark, target)
    assert {b for b in after if before.get(b) != after[b]} == {f"bucket={b}" for b in touched}
    got = {r["review_id"]: r["content"] for r in readers.scan_reviews(spark, target).collect()}
    assert len(got) == 501 and got["r7"] == "edited" and got["r8"] == "text 8"


class Killed(Exception):
    pass


def die(*args, **kwargs):
    raise Killed


def half_way(rows, base, buckets, *args):
    """A run that ends while the overwrite is committed: some of its buckets are gone already."""
    for r in rows.select("bucket").distinct().limit(3).collect():
        shutil.rmtree(f"{base}/bucket={r['bucket']}", ignore_errors=True)
    raise Killed


def after(f):
    def run(*args, **kwargs):
        f(*args, **kwargs)
        raise Killed
    return run


#: Where a run is killed: before a decision, before its note, before, while and after buckets are replaced, after the note became the last batch.
KILLS = {
    "before the image": (inc, "decide", lambda f: die), "after the image": (inc, "merge_reviews", lambda f: die), "after the note": (inc, "decide", after),
    "half way": (sinks, "overwrite_buckets", lambda f: half_way), "after the overwrite": (sinks, "overwrite_buckets", after), "before the checkpoint": (inc, "merge_pages_batch", after),
}


@pytest.mark.parametrize("where", KILLS)
def test_a_killed_run_is_replayed_exactly(spark, tmpdir_path, monkeypatch, where):
    """Rows, quarantine and logged counts are those of a run that was not killed."""
    made = {}
    for name in ("whole", "killed"):
        pages, target, log = (f"{tmpdir_path}/{name}/{n}" for n in ("in", "t", "log"))
        land(pages, rows_from(0, 40, "2024-02-20"), 0)
        monthly_update(spark, pages, target, log, now=T(2024, 3, 1))
        land(pages, rows_from(30, 60, "2024-03-20") + rows_from(60, 65, "2024-02-01") + [("r5", "edited", "2024-03-25 00:00:00")], 1, tail="no page\n")
        if name == "killed":
            module, f, kill = KILLS[where]
            monkeypatch.setattr(module, f, kill(getattr(module, f)))
            row, _ = monthly_update(spark, pages, target, log, now=T(2024, 4, 1))
            assert row.first().status == "FAILURE" and row.first().rows_loaded == 0
            monkeypatch.undo()
        row, _ = monthly_update(spark, pages, target, log, now=T(2024, 4, 2))
        again, _ = monthly_update(spark, pages, target, log, now=T(2024, 4, 3))
        made[name] = (row.first().rows_loaded, row.first().error_message.split(" landed")[0], again.first().rows_loaded,
                      sorted(map(tuple, readers.scan_reviews(spark, target).collect())), [r["value"] for r in quarantined(spark, target).collect()])
        assert not {n for n in os.listdir(target) if n.startswith("_")} - {"_ingest_checkpoint", "_quarantine", "_applied"}
    assert made["killed"] == made["whole"]
    assert made["whole"][:3] == (31, "1", 0) and len(made["whole"][3]) == 60 and made["whole"][4] == ["no page"]


def test_the_mark_holds_for_all_batches_of_a_run(spark, tmpdir_path):
    """Older rows of a landing are loaded although a batch before them was newer."""
    pages, target = f"{tmpdir_path}/in", f"{tmpdir_path}/t"
    land(pages, rows_from(0, 3, "2024-01-20"), 0)
    incremental_ingest(spark, pages, target)
    for k, day in enumerate(("2024-03-03", "2024-03-02", "2024-03-01", "2024-01-01"), 1):
        land(pages, rows_from(10 * k, 10 * k + 2, day), k)
        os.utime(f"{pages}/p{k}.json", (time.time() + k, time.time() + k))
    assert incremental_ingest(spark, pages, target, since_mark=True, max_files_per_trigger=1) == [2, 2, 2, 0]
    assert readers.scan_reviews(spark, target).count() == 9


def test_a_full_load_again_changes_nothing(spark, tmpdir_path):
    pages, target = f"{tmpdir_path}/in", f"{tmpdir_path}/t"
    land(pages, rows_from(0, 30), 0, tail="no page\n")
    for _ in range(2):
        assert full_load(spark, pages, target, buckets=3) == 30
        assert readers.scan_reviews(spark, target).count() == 30 and quarantined(spark, target).count() == 1
        assert sinks.bucket_count(spark, target) == 3


def test_bad_lines_are_kept_and_reported(spark, tmpdir_path):
    pages, target, log = (f"{tmpdir_path}/{n}" for n in ("in", "t", "log"))
    land(pages, rows_from(0, 5), 0, tail='{"page_no": 1, "reviews": [{"reviewId": "cut\n\n{"page_no": 2}\n')
    row, alerts = monthly_update(spark, pages, target, log, now=T(2024, 2, 1))
    assert (row.first().status, row.first().rows_loaded, alerts.count()) == ("FAILURE", 5, 1)
    assert "2 landed lines" in row.first().error_message and quarantined(spark, target).count() == 2
    assert readers.bad_review_pages(spark, pages).count() == 2 and readers.scan_review_pages(spark, pages).count() == 5


def test_only_rows_after_the_mark_are_loaded_and_metadata_is_appended(spark, tmpdir_path):
    pages, target, log, meta = (f"{tmpdir_path}/{n}" for n in ("in", "t", "log", "meta"))
    with open(f"{tmpdir_path}/meta.json", "w") as f:
        f.write(json.dumps({"version": "2.0", "title": "App"}) + "\n")
    land(pages, rows_from(0, 10), 0)
    monthly_update(spark, pages, target, log, now=T(2024, 2, 1), metadata=(f"{tmpdir_path}/meta.json", meta))
    land(pages, rows_from(10, 12, "2023-12-01") + rows_from(12, 15, "2024-02-20"), 1)
    row, _ = monthly_update(spark, pages, target, log, now=T(2024, 3, 1), metadata=(f"{tmpdir_path}/meta.json", meta))
    assert row.first().rows_loaded == 3 and readers.scan_reviews(spark, target).count() == 13
    row, _ = monthly_update(spark, pages, target, log, now=T(2024, 4, 1), metadata=(f"{tmpdir_path}/meta.json", meta))
    assert row.first().rows_loaded == 0
    got = readers.scan_app_metadata(spark, meta).collect()
    assert len(got) == 3 and got[0].genre == "Productivity" and got[0].developer


def test_slices_of_a_document_join_up_to_its_text(spark):
    docs = {r["doc_id"]: r["text"] for r in fixtures.table(spark, SF, "documents").collect()}
    orders = fixtures.table(spark, SF, "orders").select("o_orderkey").collect()
    keys = sorted(r["o_orderkey"] for r in orders)
    content = {int(r["review_id"][1:]): r["content"] for r in fixtures.reviews(spark, SF).collect()}
    assert sorted(content) == keys
    joined = {}
    for k in keys:
        if content[k] is not None and content[k].strip():
            phrase = next(p for p in fixtures.PHRASES if content[k].startswith(p + " "))
            joined[k % len(docs)] = joined.get(k % len(docs), "") + content[k][len(phrase) + 1:]
    assert joined == {d: t for d, t in docs.items() if d in joined} and len(joined) == len(docs)


def test_long_keys_are_not_cut(spark):
    df = spark.createDataFrame([(123456789,)], "o_orderkey long")
    k = F.col("o_orderkey")
    assert df.select(F.when(k < 10_000_000, F.lpad(k.cast("string"), 8, "0")).otherwise(k.cast("string"))).first()[0] == "123456789"
    lines = G.reviews_to_pages(spark.createDataFrame([("not a number", "u", "c", 1, None, "1"), ("r99999999999", "u", "c", 1, None, "1"), (None, "u", "c", 1, None, "1")], schemas.REVIEWS))
    assert G.explode_pages(G.parse_pages(lines)).count() == 3


def test_reviews_that_share_an_id_keep_their_own_sentiment(spark):
    rows = [("a", "great"), ("a", "terrible"), ("a", "great"), (None, "great"), (None, None), ("b", "nothing here"), ("c", "not good"), (None, "not good")]
    df = spark.createDataFrame(rows, "review_id string, content string")
    lex = spark.createDataFrame([("great", 3.1), ("great", 3.1), ("terrible", -2.1), ("good", 1.9)], "word string, valence double")
    score = lambda s: round(s / (s * s + 15) ** 0.5, 4)
    want = {"great": score(3.1), "terrible": score(-2.1), "nothing here": 0.0, "not good": score(1.9), None: None}
    got = SE.with_sentiment(df, lex).collect()
    assert sorted((str(r[0]), str(r[1])) for r in got) == sorted((str(a), str(b)) for a, b in rows)
    assert all(r["sentiment"] == want[r["content"]] for r in got)
    mods = spark.createDataFrame([("not", "negation", 0.0), ("not", "negation", 0.0)], "word string, kind string, weight double")
    want["not good"] = score(1.9 * ref.NEGATION_SCALAR)
    assert all(r["sentiment"] == want[r["content"]] for r in SE.with_sentiment_rules(df, lex, mods).collect())


def test_describe_of_fractions(spark):
    df = spark.createDataFrame([(0.6249,), (0.7351,), (0.9,)], "x double")
    r = S.describe(df, "x").first()
    assert (r["mean"], r["p25"], r["p50"], r["p75"]) == (0.753333, 0.68, 0.7351, 0.81755)
    m = S.describe_many(df, ["x"], 6).first()
    assert (m["mean"], m["p25"], m["min"]) == (0.753333, 0.68, 0.6249)


def test_wall_clocks_do_not_depend_on_the_session_zone(spark):
    raw = spark.createDataFrame([("a", "u", "c", "5", "2024-03-10 02:30:00.9", "1")], "review_id string, user_name string, content string, score string, created_at string, app_version string")
    meta = spark.createDataFrame([('{"version": "1"}',)], "value string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert G.coerce_types(raw).select(F.col("created_at").cast("string")).first()[0] == "2024-03-10 02:30:00"
        fetched = dt.datetime.fromisoformat(G.map_app_metadata(meta).select(F.col("fetched_at").cast("string")).first()[0])
        assert abs((fetched - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_alerts_keep_their_text_when_a_value_is_missing(spark):
    rows = [(dt.date(2024, 1, 1), "review_update", "FAILURE", None, "boom", None, None, T(2024, 1, 1))]
    body = M.alert_rows(spark.createDataFrame(rows, schemas.PIPELINE_MONITORING)).first().body
    assert body == "Status: FAILURE\nRows Loaded: None\nDuration: Nones\n\n\n\nboom"


def test_runs_are_numbered_across_hours_and_zero_time(spark):
    rows = [(k, None if k % 13 == 0 else T(2024, 1, 1) + dt.timedelta(minutes=17 * (k // 2)), ("SUCCESS", "FAILURE")[k % 3 == 0], k * 10) for k in range(120)]
    df = spark.createDataFrame(rows, "event_id int, timestamp timestamp_ntz, status string, rows_loaded int").repartition(4)
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or T.min, r[0]))
    for offset in (0, 1, 3):
        want, done = {}, []
        for r in order:
            want[r[0]] = done[-1 - offset] if len(done) > offset else None
            done += [r[3]] if r[2] == "SUCCESS" else []
        assert {r["event_id"]: r["prev_rows"] for r in M.previous_success_rows(df, offset).collect()} == want


def test_scores_by_activity_need_no_job_before_they_run(spark):
    e = spark.createDataFrame([("a", 5, True), ("b", 5, False), ("c", 1, False), ("d", None, True)], "review_id string, score int, is_active_user boolean")
    assert sorted(tuple(r) for r in U.score_by_activity(e).collect()) == [(False, 1, 1), (False, 5, 1), (True, 1, 0), (True, 5, 1)]
    sample = S.stratified_sample(spark.range(1000).select(F.col("id"), (F.col("id") % 2).alias("g")), "g", "id", 30)
    assert sorted(r["count"] for r in sample.groupBy("g").count().collect()) == [30, 30]
