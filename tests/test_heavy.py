"""Most frequent items by sketches against plain counts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewlake.operators import heavy as H, words as WD


def slow_top(rows, k):
    out = {}
    for g in {g for g, _ in rows}:
        c = Counter(w for b, w in rows if b == g)
        out[g] = sorted(c.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


@pytest.mark.parametrize("shape", ["skewed", "flat", "ties", "few"])
@pytest.mark.parametrize("listed, tracked", [(None, 20_000), (12, 16)])
def test_frequent_items_are_exact(spark, shape, listed, tracked):
    rng = random.Random(shape)
    draw = {"skewed": lambda: f"w{int(rng.paretovariate(0.7)) % 5000}", "flat": lambda: f"w{rng.randint(0, 3000)}",
            "ties": lambda: f"w{rng.randint(0, 40)}", "few": lambda: f"w{rng.randint(0, 3)}"}[shape]
    rows = [(rng.choice(["high", "high", "low", None]), draw()) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "band string, word string").repartition(6)
    asked = []

    def count(some):
        asked.append(some)
        mine = df if some is None else df.join(some, ["band", "word"], "left_semi")
        return mine.groupBy("band", "word").agg(F.count(F.lit(1)).alias("count"))

    named = df.filter("band IS NOT NULL")
    got = {}
    for r in WD.top_words(H.frequent(named, "band", "word", 10, count, listed=listed, tracked=tracked), 10).filter("band IS NOT NULL").collect():
        got.setdefault(r["band"], []).append((r["rank"], r["word"], r["count"]))
    want = slow_top([r for r in rows if r[0]], 10)
    assert {g: [(w, c) for _, w, c in sorted(x)] for g, x in got.items()} == want
    if shape == "skewed" and listed is None:
        assert len(asked) == 1 and asked[0].count() <= 2 * 80  # the second pass counts few words


def test_what_is_kept_decides_when_it_is_enough(spark):
    rows = [("a", f"w{k}") for k in range(60) for _ in range(100 - k)]
    df = spark.createDataFrame(rows, "band string, word string").repartition(3)

    def count(some):
        return (df if some is None else df.join(some, ["band", "word"], "left_semi")).groupBy("band", "word").agg(F.count(F.lit(1)).alias("count"))

    late = lambda counts: counts.filter(F.substring("word", 2, 9).cast("int") >= 50)
    got = late(H.frequent(df, "band", "word", 3, count, late, listed=4, tracked=100)).orderBy(F.desc("count")).limit(3).collect()
    assert [r["word"] for r in got] == ["w50", "w51", "w52"]


def test_no_rows(spark):
    df = spark.createDataFrame([], "band string, word string")
    assert H.frequent(df, "band", "word", 5, lambda some: df.groupBy("band", "word").agg(F.count(F.lit(1)).alias("count"))).count() == 0
