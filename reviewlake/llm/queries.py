"""Registered queries of the corpus operators and their DuckDB texts, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm import ann, codes, decontam, langid, linededup, phrases, quality, ranked, sharding, simhash, spm, substring, toxicity
from reviewlake.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("th")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup(docs).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH lined AS (
  SELECT doc_id, text, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x09-\x0D\x20]')) AS lines
  FROM documents),
starts AS (
  SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS j,
         unnest(list_transform(lines, lambda x: len(regexp_extract_all(x, '[^\x09-\x0D\x20]+')))) AS words
  FROM lined),
summed AS (
  SELECT doc_id, lines, j, sum(words) OVER w AS upto, sum(words) OVER w - words AS before
  FROM starts WINDOW w AS (PARTITION BY doc_id ORDER BY j)),
runs AS (
  SELECT a.doc_id, a.j, b.j AS last, array_to_string(list_slice(a.lines, a.j, b.j), chr(10)) AS run
  FROM summed a ASOF JOIN summed b ON a.doc_id = b.doc_id AND a.before + 8 <= b.upto),
copies AS (
  SELECT doc_id, j, last, row_number() OVER (PARTITION BY run ORDER BY doc_id, j) AS k FROM runs),
gone AS (SELECT DISTINCT doc_id, unnest(range(j, last + 1)) AS j FROM copies WHERE k > 1),
counted AS (SELECT doc_id, count(*) AS n, list(j) AS js FROM gone GROUP BY doc_id),
numbered AS (
  SELECT doc_id, text, x, i, sum(has) OVER (PARTITION BY doc_id ORDER BY i) AS j, has
  FROM (SELECT doc_id, text, x, i, CAST(regexp_matches(x, '[^\x09-\x0D\x20]') AS INT) AS has
        FROM (SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS x,
                     unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents))),
kept AS (
  SELECT n.doc_id, string_agg(x, chr(10) ORDER BY i) FILTER (has = 0 OR g.j IS NULL) AS rest, sum(has) AS n_lines,
         count(g.j) FILTER (has = 1) AS n_removed
  FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.j = g.j AND has = 1
  GROUP BY n.doc_id)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(CASE WHEN n_removed > 0 AND n_removed = n_lines THEN '' ELSE coalesce(rest, '') END) AS kept_sha256
FROM kept
"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.round_trip(table(spark, sf_dir, "documents"))


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
facts AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM pieces WHERE len(ts) > 0),
postings AS (SELECT doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS term FROM pieces) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), facts),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), facts GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat_ws("", F.transform("codes", lambda k: F.lower(F.lpad(F.hex(k), 2, "0"))))
    return codes.compress(table(spark, sf_dir, "embeddings")).select("vec_id", code.alias("code"), "error", "label_error", "codebooks_sha256")


def _op12_round(k: int, last: bool = False) -> str:
    """Codes by the codebooks ``book{k}``, and the codebooks after them."""
    nearest = f"""
near{k} AS MATERIALIZED (
  SELECT r, part, entry, d FROM (
    SELECT r, part, entry, d, row_number() OVER (PARTITION BY r, part ORDER BY d, entry) AS place FROM (
      SELECT x.r, x.part, b.entry, sum((x.x - b.x) * (x.x - b.x)) AS d FROM comps x JOIN book{k} b ON x.part = b.part AND x.pos = b.pos GROUP BY ALL))
  WHERE place = 1)"""
    return nearest if last else nearest + f""",
book{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, CASE WHEN m.n IS NULL THEN b.x ELSE CAST(floor(CAST(m.total AS DOUBLE) / m.n) AS BIGINT) END AS x
  FROM book{k} b LEFT JOIN (SELECT n.part, n.entry, x.pos, sum(x.x) AS total, count(*) AS n FROM near{k} n JOIN comps x ON n.r = x.r AND n.part = x.part GROUP BY ALL) m
  ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos)"""


OP12_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (SELECT r, unnest(v) AS x, unnest(range(len(v))) AS i, len(v) // 16 AS width FROM kept),
comps AS MATERIALIZED (SELECT r, i // width AS part, i % width AS pos, x FROM flat),
book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, pos, x FROM comps WHERE r <= 64),
{_op12_round(0)},
{_op12_round(1)},
{_op12_round(2, last=True)},
coded AS (SELECT r, string_agg(format('{{:02x}}', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near2 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book2) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.remove_phrases(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_substring, op3_language, op4_neighbours, op5_hilbert, op6_decontam, op7_simhash, op8_lines, op9_toxicity, op10_sentencepiece, op11_ranked, op12_codes, op13_phrases)}


def oracle_sql() -> dict[str, str]:
    return {"op8_lines": OP8_SQL, "op11_ranked": OP11_SQL, "op12_codes": OP12_SQL}
