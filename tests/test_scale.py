"""Steps that keep the same rows but move or read less: one derivation of the texts, no exchange for short lists, one pass."""

from pyspark.sql import functions as F

from reviewlake.operators import clusters, ingest, sentiment, words
from reviewlake.plans.inputs import Inputs
from reviewlake.sources import reference_data as ref
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_inputs_select_from_the_stored_reviews(spark):
    inputs = Inputs(spark, SF_SMALL)
    files = set(inputs.reviews.inputFiles())
    for made in (inputs.merge_target, inputs.merge_batch, inputs.raw_reviews):
        assert set(made.inputFiles()) == files


def test_batch_is_deduplicated_with_each_text_once(spark):
    rows = [("a", "u", "x", 1, None, "1"), ("a", "u", "y", 2, None, None), (None, "u", "z", 3, None, "1"), ("b", None, None, None, None, None)]
    batch = ingest.stage_reviews(spark.createDataFrame(rows, "review_id string, user_name string, content string, score int, created_at timestamp_ntz, app_version string"))
    made = ingest.dedupe_batch(batch)
    assert "min_by" not in plan(made)
    assert sorted((r["review_id"], r["user_name"], r["content"], r["score"]) for r in made.collect()) == [("a", "u", "x", 1), ("b", None, None, None)]


def test_short_lexicon_is_looked_up_without_an_exchange(spark, monkeypatch):
    rows = [("a", "good don't bad"), ("a", "good"), (None, "it's"), ("b", None), ("c", "")] * 2
    reviews = spark.createDataFrame(rows, "review_id string, content string")
    lexicon = spark.createDataFrame([("good", 1.9), ("good", 1.5), ("don't", -0.5), ("bad", -2.5), ("back\\slash", 1.0), ("it's", None), (None, 1.0), ("", 3.0)], "word string, valence double")
    short = sentiment.with_sentiment(reviews, lexicon)
    assert "Exchange" not in plan(short)
    key = lambda df: sorted(map(str, df.collect()))
    found = key(short)
    monkeypatch.setattr(sentiment, "LISTED", 1)
    assert key(sentiment.with_sentiment(reviews, lexicon)) == found


def test_rule_words_are_found_inside_the_row(spark, monkeypatch):
    rows = [("a", "This is NOT good, but very helpful :)"), ("b", "not very good"), (None, "bad"), ("c", None)]
    reviews = spark.createDataFrame(rows, "review_id string, content string")
    args = (reviews, ref.rule_lexicon(spark), ref.modifiers(spark))
    found = sorted(map(str, sentiment.with_sentiment_rules(*args).collect()))
    assert sentiment._rule_words(*args[1:]) is not None
    monkeypatch.setattr(sentiment, "LISTED", 1)
    assert sorted(map(str, sentiment.with_sentiment_rules(*args).collect())) == found


def test_frequent_words_are_the_top_of_each_band(spark):
    features = spark.createDataFrame([(5, "aaa bbb aaa the"), (5, "ccc bbb aaa"), (1, "ddd"), (3, "eee")], "score int, clean_content string")
    found = words.frequent_words(features, spark.createDataFrame([("the",)], "word string"), 2)
    assert sorted(map(tuple, found.collect())) == [("high", "aaa", 3), ("high", "bbb", 2), ("low", "ddd", 1)]


def test_passes_read_each_place_once(spark, monkeypatch):
    from reviewlake.plans import materialize as m
    stored = {}
    real = m.materialize
    monkeypatch.setattr(m, "materialize", lambda df, name: stored.setdefault(name, real(df, name)))
    rows = [(f"u{i}", 1, float(i % 3), 0.5 * (i % 2), 4.0) for i in range(60)]
    users = spark.createDataFrame(rows, "user_name string, review_count long, avg_score double, avg_sentiment double, avg_length double")
    assert clusters.user_clusters(users).count() == 60
    assert stored["user-places"].count() == 6 and stored["user-places"].agg(F.sum("users")).first()[0] == 60
