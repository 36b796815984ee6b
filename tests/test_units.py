"""Hand-computed edge cases."""

import datetime as dt

from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.functions import text
from reviewlake.functions.stats import safe_corr
from reviewlake.functions.versions import version_key
from reviewlake.operators import monitoring as M, stats as S, timeseries as TS, users as U, words as WD
from reviewlake.operators import quality as Q


def _reviews(spark, rows):
    return spark.createDataFrame(rows, schemas.REVIEWS)


def T(*a):
    return dt.datetime(*a)


def test_version_natural_order(spark):
    vs = ["1.10", "1.2.1", "beta", "1.2", "v1.9", "0", "1." + "9" * 20]
    df = spark.createDataFrame([(v,) for v in vs], "app_version string")
    got = [r[0] for r in df.orderBy(version_key("app_version"), "app_version").collect()]
    assert got == ["0", "beta", "1.2", "1.2.1", "v1.9", "1.10", "1." + "9" * 20]


def test_word_count_and_clean(spark):
    df = spark.createDataFrame([("",), ("  a  b ",), (None,), ("don't",), ("Héllo wörld http://x.y/z www.a.b ok",),
                                ("a b　c",)], "content string")
    rows = df.select(text.word_count("content").alias("n"), text.clean_text("content").alias("c")).collect()
    assert [r.n for r in rows] == [0, 2, None, 1, 5, 3]
    assert [r.c for r in rows] == ["", "a b", None, "dont", "hllo wrld ok", "a b c"]


def test_ngrams_expression(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "toks array<string>")
    got = [r[0] for r in df.select(text.ngrams("toks", 2)).collect()]
    assert got == [["a b", "b c"], [], []]


def test_safe_corr_zero_variance_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 1.0)], "x double, y double")
    assert df.agg(safe_corr("x", "y")).first()[0] is None
    df2 = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None)], "x double, y double")
    assert abs(df2.agg(safe_corr("x", "y")).first()[0] - 1.0) < 1e-12


def test_calendar_fills_gap_and_rolling_trend(spark):
    m = spark.createDataFrame([(dt.date(2020, 1, 1), 3), (dt.date(2020, 3, 1), 6), (dt.date(2020, 4, 1), 9)],
                              "year_month date, n int")
    cal = TS.calendar_join(m, m, fill={"n": 0}).orderBy("year_month")
    rows = cal.collect()
    assert [r.year_month for r in rows] == [dt.date(2020, m_, 1) for m_ in (1, 2, 3, 4)]
    assert [r.n for r in rows] == [3, 0, 6, 9]
    tr = [r.trend for r in TS.rolling_trend(cal, "n").orderBy("year_month").collect()]
    assert tr == [None, 3.0, 5.0, None]


def test_histogram_counts_sum_and_constant_column(spark):
    df = spark.createDataFrame([(float(i % 7),) for i in range(100)] + [(None,)], "x double")
    h = S.histogram(df, "x", 5).collect()
    assert len(h) == 5 and sum(r["count"] for r in h) == 100
    c = S.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x", 3).orderBy("bin").collect()
    assert [r["count"] for r in c] == [0, 2, 0] and c[0].bin_lo == 1.5 and c[-1].bin_hi == 2.5


def test_box_stats_whiskers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(1, v) for v in vals], "score int, v double")
    r = S.box_stats(df, "v", "score").first()
    assert (r.q1, r.median, r.q3) == (2.0, 3.0, 4.0)
    assert r.whisker_low == 1.0 and r.whisker_high == 4.0  # 100 is beyond q3 + 1.5 * IQR


def test_percentile_interpolation(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,)], "review_count int")
    kept = Q.stats  # noqa: F841 - module import check
    from reviewlake.operators.clusters import outlier_filter
    assert sorted(r[0] for r in outlier_filter(df).collect()) == [1, 2, 3]  # 0.99 quantile = 9.79


def test_user_change_edge_cases(spark):
    rows = [
        # first score null -> first non-null score is the second review's
        ("r1", "u1", "a", None, T(2020, 1, 1), "1.0"),
        ("r2", "u1", "a b", 4, T(2020, 1, 5), "1.0"),
        ("r3", "u1", "a b c", 2, None, "1.0"),          # undated -> sorts last
        # same instant: tie broken by review_id
        ("r4", "u2", "x", 5, T(2020, 2, 1, 12), "1.0"),
        ("r5", "u2", "xy", 1, T(2020, 2, 1, 12), "1.0"),
        ("r6", None, "n", 3, T(2020, 1, 1), "1.0"),      # null user: never active
        ("r7", None, "n", 3, T(2020, 1, 2), "1.0"),
        ("r8", "u3", "solo", 3, T(2020, 1, 1), "1.0"),
    ]
    e = _reviews(spark, rows).withColumn("sentiment", F.lit(0.5))
    uc = {r.user_name: r for r in U.user_change(e).collect()}
    assert set(uc) == {"u1", "u2"}
    assert (uc["u1"].score_first, uc["u1"].score_last, uc["u1"].len_last) == (4, 2, 5)
    assert uc["u1"].days_gap == 4
    assert (uc["u2"].score_first, uc["u2"].score_last, uc["u2"].days_gap) == (5, 1, 0)
    d = U.delta_direction(U.user_change(e)).first()
    assert (d.up_share, d.down_share, d.same_share) == (0.0, 1.0, 0.0)


def test_active_flag_null_user_false(spark):
    from reviewlake.plans.enrich import with_activity
    rows = [("r1", None, "a", 1, None, None), ("r2", None, "a", 1, None, None), ("r3", "u", "a", 1, None, None)]
    got = {r.review_id: r.is_active_user for r in with_activity(_reviews(spark, rows)).collect()}
    assert got == {"r1": False, "r2": False, "r3": False}


def _runs(spark, rows):
    return spark.createDataFrame(rows, "event_id long, timestamp timestamp_ntz, date date, task_name string, "
                                       "status string, rows_loaded int, error_message string, duration_sec double")


def test_anomaly_flags_offset_and_ratio(spark):
    d = dt.date(2024, 1, 1)
    rows = [(1, T(2024, 1, 1), d, "review_update", "SUCCESS", 100, None, 1.0),
            (2, T(2024, 2, 1), d, "review_update", "SUCCESS", 50, None, 1.0),
            (3, T(2024, 3, 1), d, "review_update", "SUCCESS", 20, None, 1.0),   # 20/100 = 0.2 exactly -> OK
            (4, T(2024, 4, 1), d, "review_update", "FAILURE", 0, "boom", 1.0),
            (5, T(2024, 5, 1), d, "review_update", "SUCCESS", 9, None, 1.0)]   # 9/50 < 0.2 -> WARNING
    out = {r.event_id: r for r in M.run_anomaly_flag(M.previous_success_rows(_runs(spark, rows))).collect()}
    assert [out[i].prev_rows for i in range(1, 6)] == [None, None, 100, 50, 50]
    assert [out[i].anomaly_flag for i in range(1, 6)] == ["FIRST_RUN", "FIRST_RUN", "OK", None,
                                                          "WARNING: Only 9 rows vs 50 last month"]
    alerts = M.alert_rows(M.run_anomaly_flag(M.previous_success_rows(_runs(spark, rows))))
    assert sorted(r.event_id for r in alerts.collect()) == [4, 5]


def test_error_text_cut(spark):
    rows = [(1, T(2024, 1, 1), dt.date(2024, 1, 1), "t", "FAILURE", 0, "e" * 800, 1.234),
            (2, T(2024, 1, 1), dt.date(2024, 1, 1), "t", "FAILURE", 0, "e" * 801, 1.235)]
    out = {r.event_id: r for r in M.format_run_log(_runs(spark, rows)).collect()}
    assert out[1].error_message == "e" * 800
    assert out[2].error_message == "e" * 800 + " ..."
    assert out[1].duration_sec == 1.23


def test_missing_fields_threshold_exactly_ten_percent(spark):
    rows = [(f"r{i}", "u", None if i == 0 else "text", 5, None, None) for i in range(10)]
    runs = _runs(spark, [(1, T(2024, 1, 1), dt.date(2024, 1, 1), "review_update", "SUCCESS", 5, None, 1.0)])
    v = M.pipeline_monitoring_with_anomaly(runs, _reviews(spark, rows)).first()
    assert v.missing_content_pct == 10.0 and v.final_anomaly_flag is None
    rows[1] = ("r1", "u", "  ", 5, None, None)
    v = M.pipeline_monitoring_with_anomaly(runs, _reviews(spark, rows)).first()
    assert v.final_anomaly_flag == "MISSING_FIELDS"


def test_top_k_is_prefix(spark):
    freq = spark.createDataFrame([("high", f"w{i}", i % 5) for i in range(40)], "band string, word string, count long")
    top5 = [r.word for r in WD.top_words(freq, 5).orderBy("rank").collect()]
    top6 = [r.word for r in WD.top_words(freq, 6).orderBy("rank").collect()]
    assert top6[:5] == top5


def test_shares_sum_to_one(spark):
    rows = [(f"r{i}", "u" if i % 2 else f"g{i}", "x", 1 + i % 5, None, None) for i in range(50)]
    from reviewlake.plans.enrich import with_activity
    counts = U.score_by_activity(with_activity(_reviews(spark, rows)))
    sums = U.score_share_by_activity(counts).groupBy("is_active_user").agg(F.sum("share")).collect()
    assert all(abs(r[1] - 1.0) < 1e-9 for r in sums)


def test_missing_counts_and_duplicates(spark):
    rows = [("r1", None, "a", 1, None, None), ("r1", "u", None, None, None, None), (None, "u", "a", 1, None, "v")]
    df = _reviews(spark, rows)
    mc = {r.column_name: r.missing_count for r in Q.missing_counts(df).collect()}
    assert mc == {"review_id": 1, "user_name": 1, "content": 1, "score": 1, "created_at": 3, "app_version": 2}
    assert Q.duplicate_id_count(df).first()[0] == 1


def test_schema_guards(spark):
    import pytest
    df = spark.createDataFrame([(1, 0.5)], "SCORE int, sentiment_vader_raw double")
    assert Q.require_columns(df, "score") is df
    with pytest.raises(ValueError):
        Q.require_columns(df, "score", "content")
    assert Q.first_present(df, ["SENTIMENT", "SENTIMENT_VADER_CLEAN", "SENTIMENT_VADER_RAW"]) == "sentiment_vader_raw"


def test_kde_density_integrates_to_one(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 1, 2, 2, 2, 3, 3, 4, 8]], "x double")
    rows = sorted(S.kde_density(df, "x", grid=400).collect(), key=lambda r: r.grid_index)
    step = rows[1].x - rows[0].x
    assert abs(sum(r.density for r in rows) * step - 1.0) < 0.01


def test_api_conveniences(spark):
    from reviewlake.operators import sentiment as SE
    from reviewlake.sources import reference_data as ref
    d = dt.date(2024, 1, 1)
    runs = _runs(spark, [(1, T(2024, 1, 1), d, "t", "SUCCESS", 100, None, 1.0),
                         (2, T(2024, 2, 1), d, "t", "SUCCESS", 50, None, 1.0),
                         (3, T(2024, 3, 1), d, "t", "SUCCESS", 5, None, 1.0)])
    flags = {r.event_id: r.anomaly_flag for r in M.run_anomaly_flag(runs).collect()}
    assert flags[3] == "WARNING: Only 5 rows vs 100 last month"
    flags0 = {r.event_id: r.anomaly_flag for r in M.run_anomaly_flag(runs, offset=0).collect()}
    assert flags0[3] == "WARNING: Only 5 rows vs 50 last month"
    df = spark.createDataFrame([("a", "not good"), ("b", "good")], "review_id string, content string")
    l1 = {r.review_id: r.sentiment for r in SE.sentiment_score(df, ref.seed_lexicon(spark)).collect()}
    l2 = {r.review_id: r.sentiment for r in SE.sentiment_score(df, ref.seed_lexicon(spark),
                                                                ref.modifiers(spark)).collect()}
    assert l1["a"] == l1["b"] > 0 and l2["a"] < 0 < l2["b"]
    e = spark.createDataFrame([(s, 0.1 * s) for s in (1, 2, 2, 5)] + [(None, 0.3)], "score int, sentiment double")
    assert S.sentiment_box_stats(e).count() == 3
    row = M.run_log_row(spark, "FAILURE", 0, "x" * 20, 1.0, None, limit=10).first()
    assert row.error_message == "x" * 10 + " ..."


def test_histogram_matches_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    a = np.round(rng.normal(0, 1, 500), 4)
    b = rng.integers(0, 40, 300).astype(float)
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b]
    df = spark.createDataFrame(rows, "metric string, x double")
    got = {}
    for r in S.histogram_by(df, "metric", "x", 30).collect():
        got.setdefault(r.metric, {})[r.bin] = r["count"]
    for name, arr in (("a", a), ("b", b)):
        want, _ = np.histogram(arr, bins=30)
        assert [got[name][i] for i in range(30)] == list(want)
    single = {r.bin: r["count"] for r in S.histogram(df.filter("metric = 'b'"), "x", 30).collect()}
    assert [single[i] for i in range(30)] == list(np.histogram(b, bins=30)[0])


def test_describe_exact_and_approx(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    ex = S.describe(df, "x").first()
    ap = S.describe(df, "x", approx=True).first()
    assert (ex.p25, ex.p50, ex.p75, ex.mean) == (25.75, 50.5, 75.25, 50.5)
    assert abs(ap.p50 - 50.5) <= 1.0 and ap["count"] == 100
