"""User features, outlier filter and k-means clustering.

K-means is Lloyd's iteration as DataFrame aggregates on integers: the driver
holds only the centres, and an iteration is one distributed pass for all
restarts.  The per-user features are written once to the shared checkpoint
folder, so that every pass reads materialised rows instead of re-running the
feature aggregation, and a lost executor recomputes from those files, not
from the raw reviews.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlake.functions.stats import exact_mean
from reviewlake.functions.versions import version_key

FEATURES = ["review_count", "avg_score", "avg_sentiment", "avg_length"]
UNIT = 10_000  # features are taken to 4 decimals
GRID = 10_000  # steps of a standardised feature in one deviation
_UNITS = [f"u{d}" for d in range(len(FEATURES))]
_GRID = [f"z{d}" for d in range(len(FEATURES))]


def user_features(enriched: DataFrame, digits: int | None = None) -> DataFrame:
    """Per user: review count, mean score, mean sentiment, mean word count;
    users with any null mean are dropped.  ``digits`` rounds the means
    exactly (for reports); clustering uses the full-precision means."""
    if digits is None:
        means = [F.avg("score"), F.avg("sentiment"), F.avg("word_count")]
    else:
        means = [exact_mean("score", 0, digits), exact_mean("sentiment", 4, digits),
                 exact_mean("word_count", 0, digits)]
    g = (enriched.filter(F.col("user_name").isNotNull()).groupBy("user_name")
                 .agg(F.count("review_id").alias("review_count"), means[0].alias("avg_score"),
                      means[1].alias("avg_sentiment"), means[2].alias("avg_length")))
    return g.dropna(subset=["avg_score", "avg_sentiment", "avg_length"])


def outlier_filter(features: DataFrame, col: str = "review_count", q: float = 0.99, stored: bool = False) -> DataFrame:
    """Keep rows with ``col`` at or below its ``q`` quantile (linear
    interpolation; the threshold is a scalar subquery, not a driver value).
    The quantile and the rows both read the features: they are stored first,
    so that the aggregation behind them runs once, unless they are
    ``stored`` already."""
    from reviewlake.plans.materialize import materialize

    features = features if stored else materialize(features, "user-features")
    thr = features.agg(F.percentile(F.col(col), F.lit(q))).scalar()
    return features.filter(F.col(col) <= thr)


def clustering_features(enriched: DataFrame) -> DataFrame:
    return outlier_filter(user_features(enriched))


def _moments(points: DataFrame) -> tuple[int, list[tuple[float, float]]]:
    """Number of points, and mean and deviation of each coordinate, from exact integer sums."""
    wide = [F.col(u).cast("decimal(19,0)") for u in _UNITS]
    row = points.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{d}") for d, c in enumerate(wide)],
                     *[F.sum(c * c).alias(f"q{d}") for d, c in enumerate(wide)]).first()
    out, n = [], row["n"]
    for d in range(len(wide) if n else 0):
        mean = float(int(row[f"s{d}"])) / n
        out.append((mean, math.sqrt(max(float(int(row[f"q{d}"])) / n - mean * mean, 0.0))))
    return n, out


def _nearest(k: int) -> Column:
    """Squared distance to the nearest centre, times ``k``, plus its number: the lower one of equal distances."""
    far = [sum(((F.col(z) - F.col(f"c{j}_{d}")) * (F.col(z) - F.col(f"c{j}_{d}")) for d, z in enumerate(_GRID)), F.lit(0).cast("bigint")) * k + j for j in range(k)]
    return F.least(*far) if k > 1 else far[0]


def _against(points: DataFrame, centres: dict[int, list[tuple[int, ...]]]) -> DataFrame:
    """Every point once for each restart, with the restart's centres beside it (one row for each restart)."""
    k = len(next(iter(centres.values())))
    names = [f"c{j}_{d}" for j in range(k) for d in range(len(_GRID))]
    rows = [(r, *(x for c in cs for x in c)) for r, cs in centres.items()]
    table = points.sparkSession.createDataFrame(rows, "r int, " + ", ".join(f"{n} bigint" for n in names))
    numbered = points.withColumn("r", F.explode(F.array(*[F.lit(r) for r in centres])))
    return numbered.join(F.broadcast(table), "r").withColumn("near", _nearest(k))


def _seeds(points: DataFrame, k: int, seed: int, restarts: int) -> dict[int, list[tuple[int, ...]]]:
    """The ``k`` users with the smallest MD5 of seed + restart and name start a restart."""
    each = points.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))))
    each = each.withColumn("h", F.md5(F.concat((F.col("r") + seed).cast("string"), F.lit(":"), "user_name")))
    place = F.row_number().over(Window.partitionBy("r").orderBy("h", "user_name"))
    found = each.withColumn("j", place).where(F.col("j") <= k).select("r", "j", *_GRID).collect()
    out: dict[int, list[tuple[int, ...]]] = {}
    for row in sorted(found, key=lambda x: (x["r"], x["j"])):
        out.setdefault(row["r"], []).append(tuple(row[z] for z in _GRID))
    return out


def user_clusters(features: DataFrame, k: int = 4, seed: int = 42, restarts: int = 10,
                  max_iter: int = 300, outlier_q: float | None = 0.99) -> DataFrame:
    """Drop review-count outliers (``outlier_q``), standardise the four
    features and run Lloyd's iterations from ``restarts`` sets of seeds; the
    set of centres with the least sum of squared distances wins.

    Everything after the standardisation is integer arithmetic: features are
    taken to 4 decimals, standardised values to 1/10 000 of a deviation, and
    a centre is the rounded-down mean of its points.  So the result depends
    neither on the partitions nor on the order of sums.  Equal distances go
    to the lower centre, equal costs to the lower restart; a centre without
    points stays.  One pass over the users moves the centres of all restarts
    that still move, as map-side sums; the driver holds ``restarts`` times
    ``k`` centres.  Labels are numbered by score, length and review count of
    the centres.  Returns user_name, the features and ``cluster``.
    """
    from reviewlake.plans.materialize import materialize

    base = materialize(features.select("user_name", *FEATURES), "user-features")
    if outlier_q is not None:
        base = outlier_filter(base, q=outlier_q, stored=True)
    points = materialize(base.select("*", *[F.floor(F.col(c) * UNIT + 0.5).cast("bigint").alias(u) for c, u in zip(FEATURES, _UNITS)]), "user-points")
    n, moments = _moments(points)
    if not n:
        return points.select("user_name", *FEATURES, F.lit(None).cast("int").alias("cluster"))
    grid = [(F.floor((F.col(u) - F.lit(m)) / F.lit(s) * GRID + 0.5) if s else F.lit(0)).cast("bigint").alias(z)
            for u, z, (m, s) in zip(_UNITS, _GRID, moments)]
    points = points.select("user_name", *FEATURES, *grid)
    k = min(k, n)
    centres = _seeds(points, k, seed, restarts)
    # Users at one place always move together: the passes read each place once, with the number of its users.
    places = materialize(points.groupBy(*_GRID).agg(F.count(F.lit(1)).alias("users")), "user-places")
    moving = dict(centres)
    for _ in range(max_iter):
        sums = _against(places, moving).groupBy("r", F.pmod("near", F.lit(k)).alias("j")).agg(
            F.sum("users").alias("n"), *[F.sum(F.col(z) * F.col("users")).alias(z) for z in _GRID]).collect()
        moved = {r: list(cs) for r, cs in moving.items()}
        for row in sums:
            moved[row["r"]][row["j"]] = tuple(row[z] // row["n"] for z in _GRID)
        moving = {r: cs for r, cs in moved.items() if cs != moving[r]}
        centres |= moving
        if not moving:
            break
    far = ((F.col("near") - F.pmod("near", F.lit(k))) / k).cast("decimal(38,0)")
    costs = _against(places, centres).groupBy("r").agg(F.sum((far * F.col("users")).cast("decimal(38,0)")).alias("cost")).collect()
    best = min(costs, key=lambda row: (row["cost"], row["r"]))["r"]
    order = sorted(range(k), key=lambda j: (centres[best][j][1], centres[best][j][3], centres[best][j][0], j))
    label = F.element_at(F.array(*[F.lit(order.index(j)) for j in range(k)]), (F.pmod("near", F.lit(k)) + 1).cast("int"))
    return _against(points, {best: centres[best]}).select("user_name", *FEATURES, label.cast("int").alias("cluster"))


def cluster_summary(users: DataFrame, digits: int = 2) -> DataFrame:
    """Users and mean features of each cluster; the means of features with 6 decimals are exact, rounded half up."""
    return users.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("users"), exact_mean("review_count", 0, digits).alias("review_count"),
        *[exact_mean(c, 6, digits).alias(c) for c in FEATURES[1:]]).orderBy("cluster")


def attach_clusters(reviews: DataFrame, users: DataFrame) -> DataFrame:
    """reviews LEFT JOIN user clusters on user_name (shuffle join: the user
    table grows with the data and is never force-broadcast).  Rows without a
    name have no cluster and stay out of the join."""
    named = reviews.filter(F.col("user_name").isNotNull()).join(users.select("user_name", "cluster"), "user_name", "left")
    bare = reviews.filter(F.col("user_name").isNull()).withColumn("cluster", F.lit(None).cast("int"))
    return named.unionByName(bare)


def cluster_mix_by_version(reviews: DataFrame, users: DataFrame, k: int = 4, digits: int = 6) -> DataFrame:
    """Per version, the share of each cluster among its reviews (null
    clusters and versions excluded, zero-filled), in natural version order."""
    j = attach_clusters(reviews, users).filter(F.col("app_version").isNotNull() & F.col("cluster").isNotNull())
    wide = j.groupBy("app_version").pivot("cluster", list(range(k))).agg(F.count(F.lit(1)))
    cols = [str(i) for i in range(k)]
    wide = wide.fillna(0, subset=cols)
    total = sum((F.col(c) for c in cols), F.lit(0))
    long = wide.select("app_version", total.alias("_t"), *cols) \
               .unpivot(["app_version", "_t"], cols, "cluster", "n")
    return (long.select("app_version", F.col("cluster").cast("int").alias("cluster"),
                        F.col("n").cast("bigint").alias("review_count"),
                        F.round(F.try_divide(F.col("n").cast("double"), F.col("_t").cast("double")), digits)
                         .alias("share"))
                .orderBy(version_key("app_version"), "app_version", "cluster"))
