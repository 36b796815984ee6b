"""A user holding a third of all reviews: results equal a brute-force
computation and the per-user work stays partially aggregated."""

import collections

from pyspark.sql import functions as F

from reviewlake.operators import clusters as C, users as U
from reviewlake.plans.enrich import enrich_reviews, with_activity
from reviewlake.sources import fixtures, reference_data as ref
from tests.conftest import SF_SMALL


def _hot(spark):
    r = fixtures.reviews(spark, SF_SMALL)
    no = F.substring("review_id", 2, 100).cast("int")
    return r.withColumn("user_name", F.when(no % 3 == 0, F.lit("hot_user")).otherwise(F.col("user_name")))


def test_hot_user_activity_and_counts(spark):
    r = _hot(spark)
    rows = r.select("review_id", "user_name").collect()
    n = collections.Counter(x.user_name for x in rows if x.user_name is not None)
    assert n["hot_user"] > len(rows) // 4  # about a third of all reviews
    got = {x.review_id: x.is_active_user for x in with_activity(r).collect()}
    want = {x.review_id: (x.user_name is not None and n[x.user_name] > 1) for x in rows}
    assert got == want
    counts = {x.user_name: x.review_count for x in U.user_review_counts(r).collect()}
    assert counts == dict(n)


def test_hot_user_change_and_features(spark):
    e = enrich_reviews(_hot(spark), ref.seed_lexicon(spark))
    rows = e.select("review_id", "user_name", "score", "created_at").collect()
    mine = [x for x in rows if x.user_name == "hot_user"]
    dated = sorted((x for x in mine if x.score is not None),
                   key=lambda x: (x.created_at is None, x.created_at or 0, x.review_id))
    uc = {x.user_name: x for x in U.user_change(e).collect()}
    assert uc["hot_user"].score_first == dated[0].score
    assert uc["hot_user"].score_last == dated[-1].score
    feats = {x.user_name: x for x in C.user_features(e).collect()}
    assert feats["hot_user"].review_count == len(mine)
    plan = U.user_change(e)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan or "partial_max_by" in plan  # map-side combine before the exchange
