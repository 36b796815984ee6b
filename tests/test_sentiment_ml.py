"""Sentiment scoring against a brute-force computation, rule checks, k-means."""

import math
import re

import regex
import pytest
from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.operators import clusters as C, sentiment as SE
from reviewlake.sources import fixtures, reference_data as ref
from tests.conftest import SF_SMALL

EMOTICON = regex.compile(r"[^\p{L}\p{N}](?:[\p{L}\p{N}]?[^\p{L}\p{N}])*[\p{L}\p{N}]?")
TOKEN = regex.compile(r"[\p{L}\p{N}]+(?:'[\p{L}\p{N}]+)*")


def brute_force(text, lex):
    if text is None:
        return None
    s = sum(lex.get(t, 0.0) for t in TOKEN.findall(text.lower()))
    return round(s / math.sqrt(s * s + 15), 4)


def test_level1_matches_brute_force(spark):
    reviews = fixtures.reviews(spark, SF_SMALL)
    lex = dict(ref.SEED_LEXICON)
    got = {r.review_id: r.sentiment for r in SE.sentiment_score(reviews, ref.seed_lexicon(spark)).collect()}
    want = {r.review_id: brute_force(r.content, lex) for r in reviews.select("review_id", "content").collect()}
    assert got.keys() == want.keys()
    bad = [k for k in got if (got[k] is None) != (want[k] is None)
           or (got[k] is not None and abs(got[k] - want[k]) > 1e-9)]
    assert not bad, bad[:5]


def _score(spark, texts):
    df = spark.createDataFrame([(f"r{i}", t) for i, t in enumerate(texts)], "review_id string, content string")
    out = SE.with_sentiment_rules(df, ref.seed_lexicon(spark), ref.modifiers(spark))
    return [r.sentiment for r in out.orderBy("review_id").collect()]


def test_level2_rules(spark):
    plain, neg, boost, caps, excl, but, none = _score(spark, [
        "the app is good", "the app is not good", "the app is very good", "the app is GOOD",
        "the app is good!!", "good app but bad update", None])
    assert plain > 0 and neg < 0
    assert boost > plain and caps > plain and excl > plain
    assert none is None
    # contrast: "good" halved before "but", "bad" amplified after it
    assert but < 0


def test_kmeans_repeatable_and_labelled(spark):
    from reviewlake.plans.enrich import enrich_reviews
    e = enrich_reviews(fixtures.reviews(spark, SF_SMALL), ref.seed_lexicon(spark))
    feats = C.user_features(e, digits=6)
    a = {r.user_name: r.cluster for r in C.user_clusters(feats, restarts=3).collect()}
    b = {r.user_name: r.cluster for r in C.user_clusters(feats.repartition(7), restarts=3).collect()}
    assert a == b and set(a.values()) <= {0, 1, 2, 3}
    summ = C.cluster_summary(C.user_clusters(feats, restarts=3)).orderBy("cluster").collect()
    keys = [(r.avg_score, r.avg_length, r.review_count) for r in summ]
    assert keys == sorted(keys)


def _slow_lloyd(points, k, restarts, max_iter):
    """Labels by plain Python: the same integers, one point at a time."""
    import hashlib
    import math
    n = len(points)
    units = {u: [math.floor(x * 10_000 + 0.5) for x in v] for u, v in points.items()}
    z = {u: [] for u in points}
    for d in range(4):
        mean = float(sum(v[d] for v in units.values())) / n
        sd = math.sqrt(max(float(sum(v[d] ** 2 for v in units.values())) / n - mean * mean, 0.0))
        for u, v in units.items():
            z[u].append(math.floor((v[d] - mean) / sd * 10_000 + 0.5) if sd else 0)
    def near(x, cs):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cs))
    best = None
    for r in range(restarts):
        first = sorted(z, key=lambda u: (hashlib.md5(f"{42 + r}:{u}".encode()).hexdigest(), u))[:k]
        cs = [tuple(z[u]) for u in first]
        for _ in range(max_iter):
            held = {u: near(x, cs)[1] for u, x in z.items()}
            new = list(cs)
            for j in range(len(cs)):
                mine = [z[u] for u, g in held.items() if g == j]
                if mine:
                    new[j] = tuple(sum(c) // len(mine) for c in zip(*mine))
            if new == cs:
                break
            cs = new
        cost = sum(near(x, cs)[0] for x in z.values())
        if best is None or cost < best[0]:
            best = (cost, cs)
    cs = best[1]
    order = sorted(range(len(cs)), key=lambda j: (cs[j][1], cs[j][3], cs[j][0], j))
    return {u: order.index(near(x, cs)[1]) for u, x in z.items()}


@pytest.mark.parametrize("n, k, restarts, max_iter", [(120, 4, 5, 300), (60, 3, 4, 2), (3, 4, 2, 300), (1, 4, 1, 5)])
def test_kmeans_equals_plain_python(spark, n, k, restarts, max_iter):
    import random
    rng = random.Random(n)
    points = {f"u{i}": [rng.randint(1, 9), round(rng.uniform(1, 5), 6), round(rng.uniform(-1, 1), 6), round(rng.expovariate(0.02), 6)] for i in range(n)}
    points |= {f"same{i}": [2, 3.0, 0.0, 10.0] for i in range(n // 4)}
    df = spark.createDataFrame([(u, *v) for u, v in points.items()], "user_name string, review_count long, avg_score double, avg_sentiment double, avg_length double").repartition(3)
    got = C.user_clusters(df, k=k, restarts=restarts, max_iter=max_iter, outlier_q=None)
    assert {r.user_name: r.cluster for r in got.collect()} == _slow_lloyd(points, k, restarts, max_iter)
    assert got.columns == ["user_name", *C.FEATURES, "cluster"]
    assert C.user_clusters(df.where("false")).count() == 0


def test_cluster_mix_matches_brute_force(spark):
    import collections

    from reviewlake.plans.enrich import enrich_reviews
    reviews = fixtures.reviews(spark, SF_SMALL)
    users = C.user_clusters(C.user_features(enrich_reviews(reviews, ref.seed_lexicon(spark)), digits=6), restarts=2)
    got = {(r.app_version, r.cluster): (r.review_count, r.share)
           for r in C.cluster_mix_by_version(reviews, users).collect()}
    label = {r.user_name: r.cluster for r in users.collect()}
    per = collections.defaultdict(collections.Counter)
    for r in reviews.select("user_name", "app_version").collect():
        c = label.get(r.user_name)
        if r.app_version is not None and c is not None:
            per[r.app_version][c] += 1
    want = {}
    for v, cnt in per.items():
        total = sum(cnt.values())
        for c in range(4):
            want[(v, c)] = (cnt[c], round(cnt[c] / total, 6))
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in got)


def test_monthly_corr_single_review_month_is_null(spark):
    import datetime as dt

    from reviewlake.operators import timeseries as TS
    rows = [("a", dt.datetime(2024, 1, 5), 5, 0.5), ("b", dt.datetime(2024, 2, 1), 1, -0.2),
            ("c", dt.datetime(2024, 2, 9), 5, 0.7)]
    e = spark.createDataFrame(rows, "review_id string, created_at timestamp_ntz, score int, sentiment double")
    got = {r.year_month.month: r.corr for r in TS.monthly_corr(e).collect()}
    assert got[1] is None and got[2] == 1.0


def _rules_brute_force(text, lex, negations, boosters):
    if text is None:
        return None
    raws = []
    for chunk in re.split(r"[ \t\n\r\f\x0b]+", text):
        raws += [chunk] if len(chunk) <= 8 and EMOTICON.fullmatch(chunk) else TOKEN.findall(chunk)
    toks, low = list(enumerate(raws)), {i: t.lower() for i, t in enumerate(raws)}
    entries, phrases, inside = {k: v for k, v in lex.items() if " " not in k}, {}, set()
    for p, _ in toks:
        here = [e for e in lex if " " in e and e.split() == [low.get(p + i) for i in range(len(e.split()))]]
        if here:
            phrases[p] = max(here, key=lambda e: len(e.split()))
    for p, e in phrases.items():
        inside |= set(range(p, p + len(e.split())))
    low = {i: "" if i in inside else t for i, t in low.items()}
    but = next((i for i, _ in toks if low[i] == "but"), None)
    all_caps = text == text.upper() and text != text.lower()
    s = 0.0
    for p, raw in toks:
        v = lex[phrases[p]] if p in phrases else entries.get(low[p])
        if v is None:
            continue
        words = raws[p:p + len(phrases[p].split())] if p in phrases else [raw]
        sign = (v > 0) - (v < 0)
        boost = sum(boosters.get(low.get(p - d), 0.0) * sc for d, sc in ((1, 1.0), (2, 0.95), (3, 0.9)))
        v = v + sign * boost
        if all(r == r.upper() and r != r.lower() for r in words) and not all_caps:
            v += sign * ref.CAPS_INCR
        for q in range(p - 3, p):
            if low.get(q) in negations:
                v *= ref.NEGATION_SCALAR
        if but is not None:
            v *= ref.BUT_BEFORE if p < but else ref.BUT_AFTER if p > but else 1.0
        s += v
    n_q = text.count("?")
    emph = min(text.count("!"), ref.EXCLAIM_MAX) * ref.EXCLAIM_INCR + (
        ref.QUESTION_MAX_BONUS if n_q > 3 else n_q * ref.QUESTION_INCR if n_q > 1 else 0.0)
    s = s + emph if s > 0 else s - emph if s < 0 else s
    return s / math.sqrt(s * s + ref.COMPOUND_ALPHA)


@pytest.mark.parametrize("key", [True, False])
def test_phrases_and_emoticons_match_brute_force(spark, key):
    import random
    rng = random.Random(4)
    vocab = ["good", "BAD", "not", "very", "but", "easy", "to", "use", "Easy", "TO", "USE", "waste", "of", "time", "no", "problem", "worth", "it", "the", "app", "and", "useful",
             "really", "free", "version", ":)", ":-(", ":D", "<3", ":)!", "-", "!!", "(good)", "\"a", "x:)", ":))", ":'(", "8)", "slow"]
    texts = [None, "", "  ", ":)", "not bad", "NOT BAD :D", "very useful and easy to use", "easy to", "not not bad but no problem", "=" * 9, "\u00a0:) :)"]
    texts += ["".join(rng.choice([" ", "  ", "\n", "\t"]) + rng.choice(vocab) for _ in range(rng.randint(1, 25))) for _ in range(300)]
    rows = [(f"r{k}" if key else None, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[:40], "review_id string, content string").repartition(4)
    got = sorted(((r.content or "", r.sentiment) for r in SE.with_sentiment_rules(df, ref.rule_lexicon(spark), ref.modifiers(spark)).collect()), key=str)
    lex = dict(ref.SEED_LEXICON + ref.SEED_PHRASES + ref.SEED_EMOTICONS)
    boosters = {w: s * ref.BOOSTER_INCR for w, s in ref.SEED_BOOSTERS}
    want = sorted(((t or "", _rules_brute_force(t, lex, set(ref.SEED_NEGATIONS), boosters)) for t in texts + texts[:40]), key=str)
    assert len(got) == len(want)
    for (a, x), (b, y) in zip(sorted(got, key=lambda r: (r[0], r[1] is None)), sorted(want, key=lambda r: (r[0], r[1] is None))):
        assert a == b and (x is None) == (y is None) and (x is None or abs(x - y) <= 0.00005 + 1e-9), (a, x, y)


def test_level2_matches_brute_force(spark):
    reviews = fixtures.reviews(spark, SF_SMALL).select("review_id", "content")
    got = {r.review_id: r.sentiment for r in SE.with_sentiment_rules(
        reviews, ref.seed_lexicon(spark), ref.modifiers(spark)).collect()}
    lex = dict(ref.SEED_LEXICON)
    boosters = {w: s * ref.BOOSTER_INCR for w, s in ref.SEED_BOOSTERS}
    for r in reviews.collect():
        want = _rules_brute_force(r.content, lex, set(ref.SEED_NEGATIONS), boosters)
        if want is None:
            assert got[r.review_id] is None
        else:
            assert abs(got[r.review_id] - want) <= 0.00005 + 1e-9, (r.review_id, r.content, got[r.review_id], want)
