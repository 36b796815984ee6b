"""Registered queries: user features, clustering, samples and weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.operators import clusters as C, stats as S
from reviewlake.plans import oracle as O
from reviewlake.plans.registry import register

W = O.with_ctes

UF = f"""
, uf0 AS (SELECT user_name, count(review_id) AS review_count, {O.exact_mean("score")} AS avg_score,
    {O.exact_mean("sentiment", 4)} AS avg_sentiment, {O.exact_mean("word_count")} AS avg_length
  FROM E WHERE user_name IS NOT NULL GROUP BY user_name)
, uf1 AS (SELECT * FROM uf0 WHERE avg_score IS NOT NULL AND avg_sentiment IS NOT NULL AND avg_length IS NOT NULL)
, uf AS (SELECT * FROM uf1 WHERE review_count <= (SELECT quantile_cont(review_count, 0.99) FROM uf1))
"""
UF_OUT = "user_name, review_count, avg_score, avg_sentiment, avg_length"


def _features(I):
    return C.user_features(I.enriched, digits=6)


@register("user_features", W(["E"], UF + f"SELECT {UF_OUT} FROM uf1"))
def _user_features(I):
    return _features(I)


@register("outlier_filter", W(["E"], UF + f"SELECT {UF_OUT} FROM uf"))
def _outlier_filter(I):
    return C.outlier_filter(_features(I))


@register("fixed_sample", W(["E"], UF + f"""
SELECT {UF_OUT} FROM uf ORDER BY md5('1' || user_name), user_name LIMIT 3000"""))
def _fixed_sample(I):
    return S.fixed_sample(C.outlier_filter(_features(I)), "user_name", 3000, seed=1)


def _clusters(I):
    """One fit for all queries of a session, stored like the other inputs."""
    return I.clusters


# Lloyd's iteration over the same integers as a recursive query: ten restarts
# of four centres, seeds by the smallest MD5, until no centre moves.
_Z = [f"z{d}" for d in range(4)]
_FLOOR = "(sum({z}) - ((sum({z}) % count(*)) + count(*)) % count(*)) // count(*)"
_DIST = " + ".join(f"(p.z{d} - s.c{d}) * (p.z{d} - s.c{d})" for d in range(4))
KM = UF + f"""
, pu AS (SELECT *, {", ".join(f"CAST(floor({c} * 10000 + 0.5) AS BIGINT) AS u{d}" for d, c in enumerate(C.FEATURES))} FROM uf)
, mo AS (SELECT {", ".join(f"CAST(sum(u{d}) AS DOUBLE) / count(*) AS m{d}, CAST(sum(CAST(u{d} AS HUGEINT) * u{d}) AS DOUBLE) / count(*) AS q{d}" for d in range(4))} FROM pu)
, sd AS (SELECT *, {", ".join(f"sqrt(greatest(q{d} - m{d} * m{d}, 0)) AS s{d}" for d in range(4))} FROM mo)
, pz AS MATERIALIZED (SELECT {UF_OUT}, {", ".join(f"CASE WHEN s{d} = 0 THEN 0 ELSE CAST(floor((u{d} - m{d}) / s{d} * 10000 + 0.5) AS BIGINT) END AS z{d}" for d in range(4))} FROM pu, sd)
, seeds AS (SELECT r, row_number() OVER (PARTITION BY r ORDER BY md5(CAST(42 + r AS VARCHAR) || ':' || user_name), user_name) - 1 AS j, {", ".join(_Z)}
  FROM pz, range(10) t(r))
, lloyd AS (
  SELECT 0 AS i, r, j, {", ".join(f"CAST(z{d} AS HUGEINT) AS c{d}" for d in range(4))} FROM seeds WHERE j < 4
  UNION ALL
  SELECT i + 1, r, j, {", ".join(f"n{d}" for d in range(4))} FROM (
    SELECT o.i, o.r, o.j, {", ".join(f"coalesce(n.n{d}, o.c{d}) AS n{d}" for d in range(4))},
      max(CASE WHEN n.n0 IS NOT NULL AND ({" OR ".join(f"n.n{d} <> o.c{d}" for d in range(4))}) THEN 1 ELSE 0 END) OVER (PARTITION BY o.r) AS moved
    FROM lloyd o LEFT JOIN (
      SELECT r, near % 4 AS j, {", ".join(_FLOOR.format(z=z) + f" AS n{d}" for d, z in enumerate(_Z))}
      FROM (SELECT s.r, p.user_name, min(({_DIST}) * 4 + s.j) AS near, {", ".join(f"any_value(p.{z}) AS {z}" for z in _Z)}
            FROM pz p, lloyd s GROUP BY s.r, p.user_name)
      GROUP BY r, near % 4) n ON o.r = n.r AND o.j = n.j)
  WHERE moved = 1 AND i < 300)
, fin AS (SELECT * FROM lloyd QUALIFY i = max(i) OVER (PARTITION BY r))
, asg AS (SELECT s.r, p.user_name, min(({_DIST}) * 4 + s.j) AS near FROM pz p, fin s GROUP BY s.r, p.user_name)
, best AS (SELECT r FROM (SELECT r, sum(near // 4) AS cost FROM asg GROUP BY r) ORDER BY cost, r LIMIT 1)
, lab AS (SELECT j, row_number() OVER (ORDER BY c1, c3, c0, j) - 1 AS cluster FROM fin WHERE r = (SELECT r FROM best))
, km AS (SELECT {", ".join("pz." + c.strip() for c in UF_OUT.split(","))}, CAST(lab.cluster AS INTEGER) AS cluster
  FROM pz JOIN (SELECT * FROM asg WHERE r = (SELECT r FROM best)) a ON a.user_name = pz.user_name JOIN lab ON lab.j = a.near % 4)
"""


def _recursive(body: str, names: list[str]) -> str:
    return W(names, body).replace("WITH ", "WITH RECURSIVE ", 1)


@register("user_clusters", _recursive(KM + f"SELECT {UF_OUT}, cluster FROM km", ["E"]))
def _user_clusters(I):
    return _clusters(I)


@register("cluster_summary", _recursive(KM + f"""
SELECT cluster, count(*) AS users, {O.exact_mean("review_count", 0, 2)} AS review_count,
  {", ".join(f"{O.exact_mean(c, 6, 2)} AS {c}" for c in C.FEATURES[1:])} FROM km GROUP BY cluster""", ["E"]))
def _cluster_summary(I):
    return C.cluster_summary(_clusters(I))


@register("attach_clusters", _recursive(KM + """
SELECT r.review_id, r.user_name, km.cluster FROM reviews r LEFT JOIN km ON km.user_name = r.user_name""", ["E"]))
def _attach_clusters(I):
    return C.attach_clusters(I.reviews, _clusters(I)).select("review_id", "user_name", "cluster")


@register("cluster_mix_by_version", _recursive(KM + """
, mix AS (SELECT r.app_version, km.cluster FROM reviews r JOIN km ON km.user_name = r.user_name WHERE r.app_version IS NOT NULL)
, cells AS (SELECT app_version, CAST(c AS INTEGER) AS cluster FROM (SELECT DISTINCT app_version FROM mix), range(4) t(c))
SELECT cells.app_version, cells.cluster, count(mix.cluster) AS review_count,
  round(CAST(count(mix.cluster) AS DOUBLE) / CAST(sum(count(mix.cluster)) OVER (PARTITION BY cells.app_version) AS DOUBLE), 6) AS share
FROM cells LEFT JOIN mix ON mix.app_version = cells.app_version AND mix.cluster = cells.cluster GROUP BY cells.app_version, cells.cluster""", ["E"]))
def _cluster_mix_by_version(I):
    return C.cluster_mix_by_version(I.reviews, _clusters(I))


# What of the clustering does not depend on where k-means starts.
@register("user_clusters_members", W(["E"], UF + f"SELECT {UF_OUT}, TRUE AS numbered FROM uf"))
def _user_clusters_members(I):
    return _clusters(I).select("user_name", F.col("review_count").cast("bigint").alias("review_count"),
                               *[F.round(c, 6).alias(c) for c in ("avg_score", "avg_sentiment", "avg_length")],
                               F.col("cluster").between(0, 3).alias("numbered"))


@register("cluster_summary_total", W(["E"], UF + "SELECT 4 AS clusters, count(*) AS users FROM uf"))
def _cluster_summary_total(I):
    return C.cluster_summary(_clusters(I)).agg(F.count(F.lit(1)).cast("int").alias("clusters"), F.sum("users").alias("users"))


_MATCHED = """
SELECT app_version, count(*) AS review_count FROM reviews WHERE user_name IN (SELECT user_name FROM uf)"""


@register("attach_clusters_matched", W(["E"], UF + _MATCHED + " GROUP BY app_version"))
def _attach_clusters_matched(I):
    return C.attach_clusters(I.reviews, _clusters(I)).filter(F.col("cluster").isNotNull()) \
        .groupBy("app_version").agg(F.count(F.lit(1)).alias("review_count"))


@register("cluster_mix_shares", W(["E"], UF + f"""
SELECT app_version, review_count, 4 AS clusters, TRUE AS adds_up FROM ({_MATCHED} AND app_version IS NOT NULL GROUP BY app_version)"""))
def _cluster_mix_shares(I):
    return C.cluster_mix_by_version(I.reviews, _clusters(I)).groupBy("app_version").agg(
        F.sum("review_count").alias("review_count"), F.count(F.lit(1)).cast("int").alias("clusters"),
        (F.abs(F.sum("share") - 1) < 1e-5).alias("adds_up"))


@register("stratified_sample", W(["reviews"], """
SELECT review_id, score FROM (SELECT review_id, score,
  row_number() OVER (PARTITION BY score ORDER BY md5('7' || review_id), review_id) AS rn FROM reviews) WHERE rn <= 500"""))
def _stratified_sample(I):
    return S.stratified_sample(I.reviews, "score", "review_id", 500, seed=7).select("review_id", "score")


@register("weighted_sample", W(["tf"], """
, m AS (SELECT score AS s, sum(word_count) AS total, count(word_count) AS n FROM tf WHERE score IS NOT NULL GROUP BY score)
, wt AS (SELECT review_id, score, round(CAST(word_count AS DOUBLE) / (CAST(m.total AS DOUBLE) / CAST(m.n AS DOUBLE)), 6) AS weight
  FROM tf LEFT JOIN m ON m.s = tf.score)
SELECT review_id, score, weight FROM (SELECT *, row_number() OVER (PARTITION BY score ORDER BY
    -ln((CAST(CAST('0x' || substr(md5('3' || review_id), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0) / weight, review_id) AS rn
  FROM wt WHERE weight > 0) WHERE rn <= 500"""))
def _weighted_sample(I):
    """Longer reviews are drawn more often, in proportion to their length within the score."""
    weighted = S.length_weights(I.text_features)
    return S.weighted_sample(weighted, "score", "review_id", "weight", 500, seed=3).select("review_id", "score", "weight")


@register("length_weights", W(["tf"], """
SELECT review_id, score, word_count, round(CAST(word_count AS DOUBLE) / (CAST(m.total AS DOUBLE) / CAST(m.n AS DOUBLE)), 6) AS weight
FROM tf LEFT JOIN (SELECT score AS s, sum(word_count) AS total, count(word_count) AS n
                   FROM tf WHERE score IS NOT NULL GROUP BY score) m
  ON m.s = tf.score"""))
def _length_weights(I):
    return S.length_weights(I.text_features).select("review_id", "score", "word_count", "weight")
