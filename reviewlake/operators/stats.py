"""Descriptive statistics as aggregations (no driver round trips).

Exact percentiles (``percentile``, linear interpolation like the pandas /
numpy default) keep a value->count map per group.  They are applied to
discrete, bounded domains only (word counts, scores, 4-decimal sentiment,
day gaps), so the map is bounded by the value domain, not the row count.
Domains without a bound get exact quartiles from sketches and counts
(``unbounded=True``, operators.quantiles); ``approx=True`` takes
``percentile_approx``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlake.functions.stats import exact_mean, round_decimal, round_div, safe_corr
from reviewlake.operators.quantiles import exact_quantiles

QUARTILES = [0.25, 0.5, 0.75]


def _pct(c: Column, qs, approx: bool = False) -> Column:
    arr = F.array(*[F.lit(q) for q in qs])
    if approx:
        return F.percentile_approx(c, arr, 100000).cast("array<double>")
    return F.percentile(c, arr)


def describe(df: DataFrame, col: str, by: str | list | None = None, digits: int | None = 6,
             approx: bool = False, scale: int | None = None, unbounded: bool = False) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 %, max of ``col`` [per ``by``].

    ``unbounded`` takes exact quartiles by sketches and counts
    (operators.quantiles), whose state does not grow with the different
    values; ``by`` is then one column at most.

    ``scale`` = decimals that all values carry (0 for counts, 4 for
    sentiment): the mean is then exact and quartiles are rounded in DECIMAL.
    Without it values may have any fraction: plain mean and quartiles,
    rounded to ``digits``."""
    c = F.col(col).cast("double")
    exact = digits is not None and scale is not None
    r = (lambda x: round_decimal(x, digits, scale + 2)) if exact else (lambda x: F.round(x, digits)) if digits is not None else (lambda x: x)
    mean = exact_mean(c, scale, digits) if exact else r(F.avg(c))
    aggs = [F.count(c).alias("count"), mean.alias("mean"),
            F.round(F.stddev_samp(c), digits).alias("std") if digits is not None else F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"),
            F.max(c).alias("max")] + ([] if unbounded else [_pct(c, QUARTILES, approx).alias("_q")])
    keys = [by] if isinstance(by, str) else list(by or [])
    g = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    if unbounded:
        q = exact_quantiles(df, col, QUARTILES, *keys).select(*[F.col(k).alias("_g") for k in keys], F.col("q").alias("_q"))
        g = g.join(q, F.col(keys[0]).eqNullSafe(F.col("_g")), "left") if keys else g.join(q, how="cross")  # one row each
    return g.select(*keys, "count", "mean", "std", "min",
                    r(F.col("_q")[0]).alias("p25"), r(F.col("_q")[1]).alias("p50"),
                    r(F.col("_q")[2]).alias("p75"), "max")


def corr(df: DataFrame, x: str, y: str, by=None, digits: int = 6, name: str = "corr") -> DataFrame:
    keys = [by] if isinstance(by, str) else list(by or [])
    e = F.round(safe_corr(x, y), digits).alias(name)
    return df.groupBy(*keys).agg(e) if keys else df.agg(e)


def histogram_by(df: DataFrame, key: str, value: str, bins: int = 60, digits: int = 9) -> DataFrame:
    """Equal-width histogram of ``value`` per ``key`` like numpy: bounds
    [min, max] of the group, last bin closed, every bin present (0-filled),
    constant input widened by +-0.5.

    The input is read once and collapsed to (key, value, multiplicity);
    both the bounds (one row per key; AQE broadcasts a few) and the binning read that aggregate, whose exchange Spark reuses.  The bin
    index is a narrow expression with numpy's edge corrections, then one
    partial+final aggregation on (key, bin).
    """
    vals = df.select(F.col(key), F.col(value).cast("double").alias("x")).filter(F.col("x").isNotNull())
    vals = vals.groupBy(key, "x").agg(F.count(F.lit(1)).alias("f"))
    b = vals.groupBy(key).agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
    b = b.select(key,
                 F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
                 F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    norm = F.lit(float(bins)) / (hi - lo)
    step = (hi - lo) / F.lit(float(bins))
    x = F.col("x")
    idx = F.least(F.greatest(F.floor((x - lo) * norm).cast("int"), F.lit(0)), F.lit(bins - 1))
    idx1 = F.when(x < lo + idx.cast("double") * step, idx - 1).otherwise(idx)
    idx2 = F.when((x >= lo + (idx1 + 1).cast("double") * step) & (idx1 != bins - 1), idx1 + 1).otherwise(idx1)
    binned = vals.join(b, key).select(key, idx2.alias("bin"), "f")
    counts = binned.groupBy(key, "bin").agg(F.sum("f").alias("n"))
    grid = b.select(key, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(counts, [key, "bin"], "left")
    return out.select(
        key, "bin",
        F.round(lo + F.col("bin").cast("double") * step, digits).alias("bin_lo"),
        F.round(F.when(F.col("bin") == bins - 1, hi)
                 .otherwise(lo + (F.col("bin") + 1).cast("double") * step), digits).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("count"))


def histogram(df: DataFrame, col: str, bins: int = 60, digits: int = 9) -> DataFrame:
    """Histogram of one column (same rules as ``histogram_by``).  The bounds
    come from one scalar subquery over the collapsed (value, multiplicity)
    table and are attached as columns, so the binning is one narrow
    projection and one partial+final aggregation."""
    vals = (df.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull())
              .groupBy("x").agg(F.count(F.lit(1)).alias("f")))
    mn, mx = F.min("x"), F.max("x")
    bounds = vals.agg(F.struct(F.when(mn == mx, mn - 0.5).otherwise(mn).alias("lo"),
                               F.when(mn == mx, mx + 0.5).otherwise(mx).alias("hi"))).scalar()
    v = vals.select("x", "f", bounds.alias("b")).select("x", "f", "b.lo", "b.hi")
    lo, hi, x = F.col("lo"), F.col("hi"), F.col("x")
    step = (hi - lo) / F.lit(float(bins))
    idx = F.least(F.greatest(F.floor((x - lo) * (F.lit(float(bins)) / (hi - lo))).cast("int"), F.lit(0)),
                  F.lit(bins - 1))
    idx1 = F.when(x < lo + idx.cast("double") * step, idx - 1).otherwise(idx)
    idx2 = F.when((x >= lo + (idx1 + 1).cast("double") * step) & (idx1 != bins - 1), idx1 + 1).otherwise(idx1)
    counts = v.select(idx2.alias("bin"), "f", "lo", "hi").groupBy("bin", "lo", "hi").agg(F.sum("f").alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), bounds.alias("b"))
    out = grid.join(counts.select("bin", "n"), "bin", "left").select("bin", "n", "b.lo", "b.hi")
    b = F.col("bin").cast("double")
    return out.select(
        "bin", F.round(lo + b * step, digits).alias("bin_lo"),
        F.round(F.when(F.col("bin") == bins - 1, hi).otherwise(lo + (b + 1) * step), digits).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("count"))


def to_long(df: DataFrame, cols, key: str = "metric", value: str = "x") -> DataFrame:
    """Stack columns into (key, value) rows with one narrow ``inline``."""
    structs = [F.struct(F.lit(c).alias(key), F.col(c).cast("double").alias(value)) for c in cols]
    return df.select(F.inline(F.array(*structs)))


def box_stats(df: DataFrame, value: str, by: str, whisker: float = 1.5, digits: int = 6,
              scale: int = 4) -> DataFrame:
    """Per group n, mean, Q1, median, Q3 and whiskers at the furthest data
    points within ``whisker`` * IQR of the box (outliers not shown).

    The rows are read once and collapsed to (group, value, multiplicity) -
    a bounded table for a value domain like 4-decimal sentiment.  Quartiles
    (``percentile`` with frequencies), the exact mean and the whiskers are
    then computed from that compact table; its per-group quartiles (one row
    per group) are joined back to it.
    """
    from reviewlake.functions.stats import units
    data = df.select(F.col(by), F.col(value).cast("double").alias("v")) \
             .filter(F.col(by).isNotNull() & F.col("v").isNotNull())
    hist = data.groupBy(by, "v").agg(F.count(F.lit(1)).alias("f"))
    q = hist.groupBy(by).agg(
        F.sum("f").alias("n"),
        round_div(F.sum(units("v", scale) * F.col("f")), F.sum("f") * F.lit(10 ** scale), digits).alias("mean"),
        F.percentile("v", F.array(*[F.lit(x) for x in QUARTILES]), F.col("f")).alias("_q"))
    q = q.select(by, "n", "mean", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                 F.col("_q")[2].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    lo_fence = F.col("q1") - whisker * iqr
    hi_fence = F.col("q3") + whisker * iqr
    w = (hist.join(q.select(by, lo_fence.alias("lo_f"), hi_fence.alias("hi_f")), by)
             .groupBy(by).agg(F.min(F.when(F.col("v") >= F.col("lo_f"), F.col("v"))).alias("wlo"),
                              F.max(F.when(F.col("v") <= F.col("hi_f"), F.col("v"))).alias("whi")))
    out = q.join(w, by)
    r = lambda c: F.round(c, digits)
    return out.select(by, "n", "mean", r(F.col("q1")).alias("q1"),
                      r(F.col("median")).alias("median"), r(F.col("q3")).alias("q3"),
                      r(F.coalesce(F.col("wlo"), F.col("q1"))).alias("whisker_low"),
                      r(F.coalesce(F.col("whi"), F.col("q3"))).alias("whisker_high"))


def kde_by(df: DataFrame, key: str, value: str, grid: int = 200, cut: float = 3.0,
           digits: int = 9) -> DataFrame:
    """Gaussian kernel density of ``value`` per ``key`` on a regular grid
    (Scott bandwidth h = sd * n^(-1/5), grid from min - cut*h to max + cut*h).

    Values are collapsed to (value, multiplicity) first - a bounded domain
    for the deltas this serves - and each distinct value contributes to the
    ``grid`` points through a fixed-size ``sequence`` explode and a sum per
    grid point.  The per-key statistics are one row per metric.
    """
    vals = df.select(F.col(key), F.col(value).cast("double").alias("x")).filter(F.col("x").isNotNull())
    st = vals.groupBy(key).agg(F.count("x").alias("n"), F.stddev_samp("x").alias("sd"),
                               F.min("x").alias("mn"), F.max("x").alias("mx"))
    h = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    st = st.select(key, "n", h.alias("h"), (F.col("mn") - cut * h).alias("g0"),
                   (F.col("mx") + cut * h).alias("g1"))
    distinct = vals.groupBy(key, "x").agg(F.count(F.lit(1)).alias("m"))
    step = (F.col("g1") - F.col("g0")) / F.lit(float(grid - 1))
    pts = distinct.join(st, key).select(
        key, "x", "m", "n", "h", "g0", "g1", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"))
    gx = F.col("g0") + F.col("i").cast("double") * step
    z = F.try_divide(gx - F.col("x"), F.col("h"))
    contrib = F.col("m") * F.exp(F.lit(-0.5) * z * z)
    dens = pts.groupBy(key, "i", "n", "h", "g0", "g1").agg(F.sum(contrib).alias("s"))
    norm = F.col("n").cast("double") * F.col("h") * F.lit(math.sqrt(2 * math.pi))
    return dens.select(key, F.col("i").alias("grid_index"), F.round(gx, digits).alias("x"),
                       F.round(F.try_divide(F.col("s"), norm), digits).alias("density"))


CELLS_PER_BANDWIDTH = 32  # of the binned density
MAX_CELLS = 1 << 20


def kde_binned_by(df: DataFrame, key: str, value: str, grid: int = 200, cut: float = 3.0, digits: int = 9) -> DataFrame:
    """The density of ``kde_by`` for values without a bound on how many differ.

    Values are shared out between the two nearest points of a fine lattice
    over the grid's range, in proportion to how near they are, as map-side
    sums; the kernel then runs over the lattice points that have weight.
    A bandwidth h has 32 lattice steps d, so a density differs from that of
    ``kde_by`` by at most d^2 / 8 h^3 sqrt(2 pi), 1/8192 of a single
    value's peak; ranges of more than 2^20 steps get wider ones, and the
    same bound with their d.
    """
    vals = df.select(F.col(key), F.col(value).cast("double").alias("x")).filter(F.col("x").isNotNull())
    st = vals.groupBy(key).agg(F.count("x").alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("mn"), F.max("x").alias("mx"))
    h = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    st = st.select(F.col(key).alias("_k"), "n", h.alias("h"), (F.col("mn") - cut * h).alias("g0"), (F.col("mx") + cut * h).alias("g1"))
    cells = F.least(F.ceil((F.col("g1") - F.col("g0")) * CELLS_PER_BANDWIDTH / F.col("h")), F.lit(MAX_CELLS).cast("bigint"))
    # One row for each key; keys are few, as in every density here.
    st = st.filter(F.col("h") > 0).withColumn("d", (F.col("g1") - F.col("g0")) / cells.cast("double"))
    at = (F.col("x") - F.col("g0")) / F.col("d")
    placed = vals.join(F.broadcast(st), F.col(key).eqNullSafe(F.col("_k"))).withColumn("b", F.floor(at)).withColumn("s", at - F.col("b"))
    shares = F.inline(F.array(F.struct(F.col("b").alias("c"), (1 - F.col("s")).alias("m")), F.struct((F.col("b") + 1).alias("c"), F.col("s").alias("m"))))
    lattice = placed.select(key, shares).groupBy(key, "c").agg(F.sum("m").alias("m"))
    step = (F.col("g1") - F.col("g0")) / F.lit(float(grid - 1))
    pts = lattice.join(F.broadcast(st), F.col(key).eqNullSafe(F.col("_k"))).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    gx = F.col("g0") + F.col("i").cast("double") * step
    z = (gx - (F.col("g0") + F.col("c").cast("double") * F.col("d"))) / F.col("h")
    dens = pts.groupBy(key, "i", "n", "h", "g0", "g1").agg(F.sum(F.col("m") * F.exp(F.lit(-0.5) * z * z)).alias("s"))
    norm = F.col("n").cast("double") * F.col("h") * F.lit(math.sqrt(2 * math.pi))
    return dens.select(key, F.col("i").alias("grid_index"), F.round(gx, digits).alias("x"), F.round(F.col("s") / norm, digits).alias("density"))


def kde_density(df: DataFrame, col: str, grid: int = 200, cut: float = 3.0, digits: int = 9) -> DataFrame:
    k = kde_by(df.select(F.lit(col).alias("_metric"), F.col(col)), "_metric", col, grid, cut, digits)
    return k.drop("_metric")


def describe_many(df: DataFrame, cols, digits: int = 3, key: str = "metric", scales=None) -> DataFrame:
    """``describe`` of several columns in one aggregation, one row per column.
    ``scales`` maps a column to the decimals its values carry; columns not
    named there may have any fraction."""
    scales = scales or {}
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        sc = scales.get(c)
        aggs += [F.count(x).alias(f"c{i}"), (F.round(F.avg(x), digits) if sc is None else exact_mean(x, sc, digits)).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.percentile(x, F.array(*[F.lit(q) for q in QUARTILES])).alias(f"q{i}"),
                 F.max(x).alias(f"hi{i}")]
    one = df.agg(*aggs)

    def r(x, c):
        return F.round(x, digits) if scales.get(c) is None else round_decimal(x, digits, scales[c] + 2)

    rows = [F.struct(F.lit(c).alias(key), F.col(f"c{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                     F.round(F.col(f"s{i}"), digits).alias("std"), r(F.col(f"lo{i}"), c).alias("min"),
                     r(F.col(f"q{i}")[0], c).alias("p25"), r(F.col(f"q{i}")[1], c).alias("p50"),
                     r(F.col(f"q{i}")[2], c).alias("p75"), r(F.col(f"hi{i}"), c).alias("max"))
            for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*rows)))


def fixed_sample(df: DataFrame, key: str, n: int = 3000, seed: int = 1) -> DataFrame:
    """At most ``n`` rows, chosen by a seeded hash of the key: repeatable
    and engine independent (top-n by md5 -> TakeOrdered, no full sort)."""
    h = F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def stratified_sample(df: DataFrame, by: str, key: str, n: int, seed: int = 1) -> DataFrame:
    """Up to ``n`` rows per ``by`` group, seeded hash order.

    Uses a window ``row_number`` in two steps: first by stratum and a salt
    from the hash, then by stratum.  Spark inserts a per-partition limit
    before each exchange (window group limit), and the second step sees at
    most ``n`` rows per salt of a stratum, however many partitions it has.
    """
    return _first_of_each(df, by, key, [_seeded_hash(key, seed), F.col(key)], n)


def _seeded_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))


def _first_of_each(df: DataFrame, by: str, key: str, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group, by a salt of the group first: no task sorts a whole hot group."""
    def top(rows, *groups):
        w = Window.partitionBy(by, *groups).orderBy(*order)
        return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")

    return top(top(df.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(64))), "_salt")).drop("_salt")


def weighted_sample(df: DataFrame, by: str, key: str, weight: str, n: int, seed: int = 1) -> DataFrame:
    """Up to ``n`` rows per ``by`` group, drawn one after another without replacement in proportion to their weights.

    Each row gets an exponential waiting time, -ln(u) / weight, with u from
    52 bits of the seeded hash of its key, and the ``n`` shortest times of a
    group win: that is the same as drawing in turn.  Repeatable, one pass,
    and rows that share a key share u.  Rows with a null, zero, negative or
    NaN weight are never drawn.
    """
    u = (F.conv(F.substring(_seeded_hash(key, seed), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    w = F.col(weight).cast("double")
    rows = df.filter((w > 0) & ~F.isnan(w)).withColumn("_wait", -F.log(u) / w)
    return _first_of_each(rows, by, key, [F.col("_wait"), F.col(key)], n).drop("_wait")


def length_weights(features: DataFrame, by: str = "score", value: str = "word_count",
                   min_value: int | None = None, digits: int = 6) -> DataFrame:
    """weight = value / mean(value) of the row's group (optionally only rows
    with ``value >= min_value``).  Group means come from one partial
    aggregation and are joined back (AQE broadcasts a few groups); no window
    over the skewed groups."""
    f = features if min_value is None else features.filter(F.col(value) >= min_value)
    sums = f.filter(F.col(by).isNotNull()).groupBy(by).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    j = f.join(sums, by, "left")
    mean = F.try_divide(F.col("_sum").cast("double"), F.col("_n").cast("double"))
    return j.withColumn("weight", F.round(F.try_divide(F.col(value).cast("double"), mean), digits)) \
            .drop("_sum", "_n")


def sentiment_box_stats(enriched: DataFrame, whisker: float = 1.5, digits: int = 6) -> DataFrame:
    """Box statistics of sentiment per score 1..5 (rows with both present)."""
    rows = enriched.dropna(subset=["sentiment", "score"]).filter(F.col("score").isin(1, 2, 3, 4, 5))
    return box_stats(rows, "sentiment", "score", whisker, digits)
