"""DuckDB text of the test inputs and shared derived columns.

Only the generated tables are registered in the oracle engine, so every
oracle query starts with the CTEs it needs.  The patterns are the same
strings the Spark column helpers use (functions.text).
"""

from __future__ import annotations

from reviewlake.functions import text
from reviewlake.sources import reference_data as ref

REVIEWS_SQL = """
SELECT review_id, user_name,
  CASE WHEN k % 89 = 0 THEN NULL WHEN k % 9 = 0 THEN '   '
       ELSE phrase || ' ' || substr(d.text, 1 + (length(d.text) * slice) // slices,
                                    (length(d.text) * (slice + 1)) // slices - (length(d.text) * slice) // slices) END AS content,
  score, created_at,
  CASE WHEN k % 14 = 0 THEN NULL WHEN k % 211 = 0 THEN 'beta'
       ELSE (CASE WHEN k % 5 = 0 THEN 'v1.' ELSE '1.' END) || CAST(year(ots) AS STRING) || '.' || CAST(month(ots) AS STRING) END AS app_version
FROM (
  SELECT *, CAST(sum(has_text) OVER (PARTITION BY doc_key) AS BIGINT) AS slices,
    CAST(sum(has_text) OVER (PARTITION BY doc_key ORDER BY k) - 1 AS BIGINT) AS slice
  FROM (
  SELECT o_orderkey AS k, o_orderdate AS ots, o_orderkey % (SELECT max(doc_id) + 1 FROM documents) AS doc_key,
    CASE WHEN o_orderkey % 89 <> 0 AND o_orderkey % 9 <> 0 THEN 1 ELSE 0 END AS has_text,
    'r' || CASE WHEN o_orderkey < 10000000 THEN lpad(CAST(o_orderkey AS STRING), 8, '0') ELSE CAST(o_orderkey AS STRING) END AS review_id,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL
         WHEN o_orderkey % 3 = 0 THEN 'user_' || CAST(o_custkey AS STRING)
         ELSE 'guest_' || CAST(o_orderkey AS STRING) END AS user_name,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE 6 - CAST(substr(o_orderpriority, 1, 1) AS INT) END AS score,
    CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderdate + to_seconds(CAST((o_orderkey * 7919) % 86400 AS BIGINT)) END AS created_at,
    CASE CAST((CASE WHEN o_orderkey % 4 = 0 THEN 3 ELSE 0 END) + (CASE WHEN substr(o_orderpriority,1,1) IN ('1','2') THEN 0 ELSE 3 END) AS INT) % 6 + (CAST(o_orderkey % 3 AS INT))
         WHEN 0 THEN 'GREAT app, love it!!! very helpful http://x.example/a?b=1'
         WHEN 1 THEN 'good app, really useful and easy to use'
         WHEN 2 THEN 'the best and awesome helpful app'
         WHEN 3 THEN 'bad experience, wrong answer and slow. www.example.org/x'
         WHEN 4 THEN 'not good, the free version is terrible'
         ELSE 'love the idea, but login problem and bad update' END AS phrase
  FROM (SELECT o_orderkey, o_custkey, o_orderpriority,
          CASE WHEN o_orderdate >= TIMESTAMP '1997-06-01 00:00:00' AND o_orderdate < TIMESTAMP '1997-07-01 00:00:00'
               THEN o_orderdate + INTERVAL 30 DAY ELSE o_orderdate END AS o_orderdate FROM orders))
) r JOIN documents d ON d.doc_id = r.doc_key
"""

RUNS_SQL = """
SELECT CAST(ts AS DATE) AS "date", event_id, CASE WHEN user_id % 10 = 0 THEN 'review_sync' ELSE 'review_update' END AS task_name,
 CASE WHEN event_type = 'error' THEN 'FAILURE' ELSE 'SUCCESS' END AS status,
 CASE WHEN event_type IN ('error','signup') AND event_id % 20 = 0 THEN 0 ELSE CAST(floor(value * 10) AS INT) END AS rows_loaded,
 CASE WHEN event_type = 'error' THEN repeat(props || ' ', CAST(1 + event_id % 150 AS INT)) ELSE NULL END AS error_message,
 value AS duration_sec, ts AS "timestamp"
FROM events
"""

APP_METADATA_SQL = """
SELECT '1.' || CAST(1995 + p_partkey % 7 AS STRING) || '.' || CAST(1 + p_partkey % 12 AS STRING) AS app_version,
  p_name AS title, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS developer,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS genre,
  CAST(p_size AS DOUBLE) / 10 AS score, p_partkey * 100 AS ratings_count, p_partkey * 10 AS reviews_count,
  CAST(p_partkey * 1000 AS STRING) || '+' AS installs, p_partkey * 1234 AS real_installs,
  p_size < 25 AS is_free, p_retailprice AS price, 'USD' AS currency,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size > 40 END AS sale,
  p_size % 2 = 0 AS offers_iap, CASE WHEN p_size % 2 = 0 THEN '$0.99 - $9.99' ELSE NULL END AS iap_price_range,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 'https://store.example/' || CAST(p_partkey AS STRING) END AS url
FROM part
"""

MERGE_TARGET_SQL = "SELECT * FROM reviews WHERE CAST(substr(review_id, 2) AS BIGINT) % 10 <> 0"
MERGE_BATCH_SQL = """
SELECT review_id, 'renamed' AS user_name, content || ' (edited)' AS content,
  CAST(CASE WHEN score IS NULL THEN NULL ELSE 6 - score END AS INT) AS score,
  CASE WHEN CAST(substr(review_id, 2) AS BIGINT) % 30 = 0 THEN created_at + INTERVAL 4000 DAY ELSE created_at END AS created_at, app_version
FROM reviews WHERE CAST(substr(review_id, 2) AS BIGINT) % 5 = 0
"""


def _values(rows, cols):
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({', '.join(cols)})"


def _lit(v):
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return str(v)


def lexicon_sql():
    return _values(ref.SEED_LEXICON, ["word", "valence"])


def stopwords_sql(words):
    return _values([(w,) for w in words], ["word"])


def sq(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


WORD_COUNT = f"CAST(len(regexp_extract_all(content, {sq(text.WORD_RUN)})) AS INTEGER)"
CLEAN = ("trim(regexp_replace(regexp_replace(regexp_replace(lower(content), "
         f"{sq(text.URL_RUN)}, '', 'g'), {sq(text.NON_ALPHA)}, '', 'g'), {sq(text.BLANK_RUN)}, ' ', 'g'))")

TF_SQL = f"""
SELECT *, {WORD_COUNT} AS word_count, CAST(length(content) AS INTEGER) AS char_length,
  CAST(date_trunc('month', created_at) AS DATE) AS year_month, {CLEAN} AS clean_content
FROM reviews
"""

SENT_SQL = f"""
SELECT r.review_id,
  CASE WHEN r.content IS NULL THEN NULL
       ELSE round(coalesce(h.s, 0) / sqrt(coalesce(h.s, 0) * coalesce(h.s, 0) + 15), 4) END AS sentiment
FROM reviews r LEFT JOIN (
  SELECT t.review_id, CAST(sum(CAST(l.valence AS DECIMAL(12,4))) AS DOUBLE) AS s
  FROM (SELECT review_id, unnest(regexp_extract_all(lower(content), {sq(text.LEXICON_TOKEN)})) AS token FROM reviews) t
  JOIN lexicon l ON l.word = t.token GROUP BY t.review_id) h ON h.review_id = r.review_id
"""

ACTIVE_SQL = """
SELECT user_name FROM reviews WHERE user_name IS NOT NULL GROUP BY user_name HAVING count(*) >= 2
"""

E_SQL = """
SELECT tf.*, sent.sentiment, (a.user_name IS NOT NULL) AS is_active_user
FROM tf LEFT JOIN sent ON sent.review_id = tf.review_id
LEFT JOIN active a ON a.user_name = tf.user_name
"""

VERSION_KEY = ("CASE WHEN len(regexp_extract_all({c}, '\\d+')) = 0 THEN [CAST(0 AS DECIMAL(38,0))] "
               "ELSE list_transform(regexp_extract_all({c}, '\\d+'), lambda x: TRY_CAST(x AS DECIMAL(38,0))) END")


def version_key(c="app_version"):
    return VERSION_KEY.format(c=c)


_CTES = {
    "reviews": (REVIEWS_SQL, []),
    "runs": (RUNS_SQL, []),
    "app_meta": (APP_METADATA_SQL, []),
    "lexicon": (None, []),
    "stopwords": (None, []),
    "tf": (TF_SQL, ["reviews"]),
    "sent": (SENT_SQL, ["reviews", "lexicon"]),
    "active": (ACTIVE_SQL, ["reviews"]),
    "E": (E_SQL, ["tf", "sent", "active"]),
    "merge_target": (MERGE_TARGET_SQL, ["reviews"]),
    "merge_batch": (MERGE_BATCH_SQL, ["reviews"]),
}


def with_ctes(names, body: str, extra: dict | None = None) -> str:
    """``WITH`` clause holding ``names`` and their dependencies, then body.

    ``extra`` maps further CTE names to (sql, deps) for one query.
    """
    table = dict(_CTES)
    table.update(extra or {})
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in table[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        sql = table[n][0]
        if n == "lexicon" and sql is None:
            sql = lexicon_sql()
        if n == "stopwords" and sql is None:
            sql = stopwords_sql(ref.stopword_list())
        parts.append(f"{n} AS ({sql})")
    return "WITH " + ",\n".join(parts) + "\n" + body


# ---- exact rounding (same arithmetic as functions.stats) ---------------
def round_div(num: str, den: str, digits: int = 6) -> str:
    scale = 10 ** digits
    n = f"(CAST({num} AS HUGEINT) * {scale})"
    d = f"CAST({den} AS HUGEINT)"
    return (f"(CASE WHEN {d} <> 0 THEN CAST(sign({n}) * sign({d}) * ((abs({n}) * 2 + abs({d})) // (abs({d}) * 2))"
            f" AS DOUBLE) / CAST({scale} AS DOUBLE) END)")


def units(x: str, scale: int = 0) -> str:
    return f"CAST(round({x} * {10 ** scale}) AS BIGINT)" if scale else f"CAST({x} AS BIGINT)"


def exact_mean(x: str, scale: int = 0, digits: int = 6) -> str:
    return round_div(f"sum({units(x, scale)})", f"(count({x}) * {10 ** scale})", digits)


def round_decimal(x: str, digits: int, exact_scale: int = 6) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,{exact_scale})), {digits}) AS DOUBLE)"


def corr_sql(x: str, y: str) -> str:
    """Pearson r over rows with both values, NULL on zero variance."""
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    return (f"covar_pop({x}, {y}) FILTER (WHERE {both}) / "
            f"nullif(stddev_pop({x}) FILTER (WHERE {both}) * stddev_pop({y}) FILTER (WHERE {both}), 0)")
