"""Exact quantiles of unbounded domains with bounded state.

``percentile`` keeps every distinct value.  Here a KLL sketch, whose size
does not depend on the data, bounds each wanted order statistic between two
values; a pass counts exactly what lies below and between them and sketches
only what lies between, until few different values are left there.  These
are counted one by one, and the wanted one is among them.  A sketch that
misses costs one more pass, never a wrong value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlake.plans.materialize import materialize

SKETCH = 4096                          # KLL parameter
RANK_ERROR = 3 * 2.296 / SKETCH ** 0.9021  # three times the sketch's error as a share of all values
GRID = 512                             # ranks at which a sketch is read
DISTINCT = 20_000                      # different values that may be left between two bounds


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _bracket(rank: Column, low: Column, high: Column) -> list[Column]:
    """Values of the sketch at ranks of the grid, RANK_ERROR before and behind a rank at least, not wider than low .. high."""
    grid = F.kll_sketch_get_quantile_double("sketch", F.lit([k / GRID for k in range(GRID + 1)]))
    before, behind = F.floor((rank - RANK_ERROR) * GRID).cast("int"), F.ceil((rank + RANK_ERROR) * GRID).cast("int")
    return [F.when(before > 0, F.greatest(F.get(grid, before), low)).otherwise(low).alias("lo"),
            F.when(behind < GRID, F.least(F.get(grid, behind), high)).otherwise(high).alias("hi")]


def _facts(x: Column) -> list[Column]:
    return [F.kll_sketch_agg_double(x, SKETCH).alias("sketch"), F.approx_count_distinct(x, 0.02).alias("different")]


def order_statistics(data: DataFrame, wanted: DataFrame, distinct: int = DISTINCT) -> DataFrame:
    """(g, at, x): the value at place ``at``, from 0, among the sorted values x of each g.

    ``data`` has g and x (double, no null, no NaN), ``wanted`` g and at, a
    few places for each g; g may be null.
    """
    whole = data.groupBy("g").agg(*_facts(F.col("x")), F.count("x").alias("n"))
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    few = F.col("different") <= distinct
    state = wanted.withColumnRenamed("g", "_g").join(whole, _same("_g", "g")).select("g", "at", F.lit(0).cast("bigint").alias("below"), few.alias("done"),
                                                                                     *_bracket((F.col("at") + 0.5) / F.col("n"), low, high))
    state = state.select("g", "at", "below", "done", F.when(F.col("done"), low).otherwise(F.col("lo")).alias("lo"), F.when(F.col("done"), high).otherwise(F.col("hi")).alias("hi"))
    state = materialize(state, "quantile-state")
    while not state.filter("NOT done").isEmpty():
        todo = state.filter("NOT done").select(F.col("g").alias("_g"), "at", "lo", "hi")
        inside = F.when(F.col("x") >= F.col("lo"), F.col("x"))
        met = todo.join(data.filter("x IS NOT NULL"), _same("_g", "g") & (F.col("x") <= F.col("hi")), "left")
        met = met.groupBy("_g", "at", "lo", "hi").agg(F.count_if(F.col("x") < F.col("lo")).alias("below"), F.count(inside).alias("between"), *_facts(inside))
        place = F.col("at") - F.col("below")
        miss_low, miss_high = place < 0, place >= F.col("between")
        narrow = _bracket((place + 0.5) / F.col("between"), F.col("lo"), F.col("hi"))
        hit = ~miss_low & ~miss_high
        done = hit & ((F.col("different") <= distinct) | (F.col("lo") == F.col("hi")))
        met = met.select(
            F.col("_g").alias("g"), "at", "below", done.alias("done"),
            F.when(done, F.col("lo")).when(miss_low, low).when(miss_high, F.col("hi")).otherwise(narrow[0]).alias("lo"),
            F.when(done, F.col("hi")).when(miss_low, F.col("lo")).when(miss_high, high).otherwise(narrow[1]).alias("hi"))
        state = materialize(state.filter("done").unionByName(met), "quantile-state")
    bounds = state.select(F.col("g").alias("_g"), "at", "below", "lo", "hi")
    counts = data.join(bounds, _same("g", "_g") & F.col("x").between(F.col("lo"), F.col("hi"))).groupBy("_g", "at", "below", "x").agg(F.count(F.lit(1)).alias("f"))
    upto = F.sum("f").over(Window.partitionBy("_g", "at").orderBy("x"))
    return counts.withColumn("upto", F.col("below") + upto).filter(F.col("upto") > F.col("at")).groupBy(F.col("_g").alias("g"), "at").agg(F.min("x").alias("x"))


def exact_quantiles(df: DataFrame, value: str, qs: list[float], by: str | None = None, distinct: int = DISTINCT) -> DataFrame:
    """(by, n, q): the number of values and their quantiles, interpolated between neighbours, of each group.

    Without ``by`` there is one row, with n 0 and null quantiles if there is
    no value.  Null and NaN values are left out; rows whose ``by`` is null
    are a group.
    """
    rows = df.select((F.col(by) if by else F.lit(0)).alias("g"), F.col(value).cast("double").alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    data = materialize(rows, "quantile-values")
    sizes = data.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    spots = F.array(*[F.struct(F.lit(k).alias("k"), ((F.col("n") - 1) * q).alias("h")) for k, q in enumerate(qs)])
    places = sizes.select("g", "n", F.inline(spots)).withColumn("a", F.floor("h").cast("bigint")).withColumn("b", F.ceil("h").cast("bigint"))
    wanted = places.select("g", F.col("a").alias("at")).union(places.select("g", F.col("b").alias("at"))).distinct()
    found = order_statistics(data, wanted, distinct)
    first, second = (found.select(F.col("g").alias(f"_{n}"), F.col("at").alias(f"_at_{n}"), F.col("x").alias(f"_x_{n}")) for n in "ab")
    both = places.join(first, _same("g", "_a") & (F.col("a") == F.col("_at_a"))).join(second, _same("g", "_b") & (F.col("b") == F.col("_at_b")))
    share = F.col("h") - F.col("a")
    out = both.groupBy("g", "n").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", F.when(F.col("_x_a") == F.col("_x_b"), F.col("_x_a")).otherwise(F.col("_x_a") + (F.col("_x_b") - F.col("_x_a")) * share).alias("x")))), lambda s: s["x"]).alias("q"))
    if by:
        return out.withColumnRenamed("g", by)
    none = df.sparkSession.createDataFrame([(0,)], "g int")
    return none.join(out, "g", "left").select(F.coalesce("n", F.lit(0)).alias("n"), "q")
