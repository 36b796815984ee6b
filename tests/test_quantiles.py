"""Exact quantiles by sketches against numpy, on domains of all shapes."""

import numpy as np
import pytest

from reviewlake.operators import quantiles as Q

QS = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]


def check(spark, x, g=None, distinct=Q.DISTINCT):
    rows = [(None if g is None else g[k], None if v is None else float(v)) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    got = {r["g"]: (r["n"], r["q"]) for r in Q.exact_quantiles(df, "x", QS, "g", distinct).collect()}
    want = {}
    for k in set(r[0] for r in rows):
        own = np.array([v for i, v in rows if i == k and v is not None and not np.isnan(v)])
        if len(own):
            want[k] = (len(own), np.quantile(own, QS).tolist())
    assert set(got) == set(want)
    for k, (n, q) in want.items():
        assert got[k][0] == n and np.allclose(got[k][1], q, rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("distinct", [5, 200, Q.DISTINCT])
def test_quantiles_of_any_domain(spark, distinct):
    rng = np.random.default_rng(distinct)
    x = np.concatenate([rng.lognormal(0, 3, 4000), rng.normal(0, 1e-6, 3000), np.repeat([1.5, 2.5], 2500), rng.integers(-3, 3, 2000)])
    g = rng.choice(["a", "b", None], len(x), p=[0.8, 0.15, 0.05]).tolist()
    check(spark, rng.permutation(x).tolist(), g, distinct)


def test_few_values_and_none(spark):
    check(spark, [3.0, None, float("nan")], ["a", "a", "b"])
    check(spark, [1.0, 2.0, 7.0, -3.0, 5.0])
    ends = spark.createDataFrame([(float("inf"),), (float("-inf"),), (5.0,)], "x double")
    assert Q.exact_quantiles(ends, "x", [0.0, 0.5, 1.0]).first()["q"] == [float("-inf"), 5.0, float("inf")]
    empty = spark.createDataFrame([], "x double")
    assert [tuple(r) for r in Q.exact_quantiles(empty, "x", QS).collect()] == [(0, None)]


def test_state_is_bounded(spark, monkeypatch):
    """No value of a wide domain is grouped but those between two bounds."""
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(None, v) for v in rng.normal(size=60_000).tolist()], "g string, x double")
    seen = []
    plain = Q.materialize
    monkeypatch.setattr(Q, "materialize", lambda d, name: seen.append(name) or plain(d, name))
    q = Q.exact_quantiles(df, "x", [0.5], "g", distinct=500).collect()[0]["q"][0]
    x = np.array([r["x"] for r in df.collect()])
    assert q == pytest.approx(np.quantile(x, 0.5), abs=1e-15) and seen.count("quantile-state") > 1


def test_weighted_samples_draw_in_proportion(spark):
    from reviewlake.operators import stats as S
    rows = [(k, "g", [1.0, 3.0, 0.0, None, -1.0][k % 5]) for k in range(5000)] + [(9000 + k, "h", 1.0) for k in range(3)]
    df = spark.createDataFrame(rows, "id long, g string, w double").repartition(5)
    got = [S.weighted_sample(df, "g", "id", "w", 200, seed=s).collect() for s in range(8)]
    light = sum(r["w"] == 1.0 and r["g"] == "g" for x in got for r in x)
    assert all(sorted(r["g"] for r in x).count("g") == 200 and sum(r["g"] == "h" for r in x) == 3 for x in got)
    assert 0.19 < light / 1600 < 0.33  # a quarter, a little more as heavy rows run out
    assert {r["w"] for x in got for r in x} == {1.0, 3.0}
    assert sorted(r["id"] for r in got[0]) == sorted(r["id"] for r in S.weighted_sample(df.repartition(2), "g", "id", "w", 200, seed=0).collect())


def test_binned_density_keeps_its_error_bound(spark):
    import math

    from reviewlake.operators import stats as S
    rng = np.random.default_rng(3)
    rows = [("a", v) for v in rng.normal(size=800)] + [("b", v) for v in rng.standard_cauchy(400)] + [("c", 1.0), ("c", 1.0), (None, 2.0), (None, 3.0)]
    df = spark.createDataFrame([(k, float(v)) for k, v in rows], "metric string, x double").repartition(4)
    exact = {(r["metric"], r["grid_index"]): r["density"] for r in S.kde_by(df.filter("metric IN ('a', 'b')"), "metric", "x", digits=15).collect()}
    got = {(r["metric"], r["grid_index"]): r["density"] for r in S.kde_binned_by(df, "metric", "x", digits=15).collect()}
    assert {k for k, _ in got} == {"a", "b", None} and set(exact) < set(got)
    for k in "ab":
        x = np.array([v for m, v in rows if m == k])
        h = x.std(ddof=1) * len(x) ** -0.2
        span = x.max() - x.min() + 6 * h
        d = span / min(math.ceil(span * 32 / h), 1 << 20)
        bound = d * d / (8 * h ** 3 * math.sqrt(2 * math.pi))
        off = max(abs(exact[k, i] - got[k, i]) for i in range(200))
        assert 0 < off <= bound
