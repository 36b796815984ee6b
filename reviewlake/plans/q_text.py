"""Registered queries: word frequencies, lexicon, sentiment, n-grams."""

from __future__ import annotations

from reviewlake.functions import text
from reviewlake.operators import sentiment as SE, words as WD
from reviewlake.plans import oracle as O
from reviewlake.plans.registry import register
from reviewlake.sources import reference_data as ref

W = O.with_ctes
BAND = "CASE WHEN score >= 4 THEN 'high' WHEN score <= 2 THEN 'low' END"

BAND_WORDS = f"""
, bw AS (SELECT band, unnest(list_filter(string_split(clean_content, ' '), lambda w: length(w) >= 3)) AS word
  FROM (SELECT {BAND} AS band, clean_content FROM tf) WHERE band IS NOT NULL AND clean_content IS NOT NULL)
"""
FILTERED = BAND_WORDS + """
, ff AS (SELECT band, word, count(*) AS count FROM bw
  WHERE NOT EXISTS (SELECT 1 FROM stopwords s WHERE s.word = bw.word) GROUP BY band, word)
, tw AS (SELECT band, word, count, CAST(row_number() OVER (PARTITION BY band ORDER BY count DESC, word) AS INTEGER) AS rank
  FROM ff)
"""
VOCAB = FILTERED + """
, vocab AS (SELECT word FROM tw WHERE band = 'high' AND rank <= 200
            UNION SELECT word FROM tw WHERE band = 'low' AND rank <= 200)
, wv AS (SELECT v.word, coalesce(round(l.valence / sqrt(l.valence * l.valence + 15), 4), 0.0) AS sentiment
         FROM vocab v LEFT JOIN lexicon l ON l.word = v.word)
"""


@register("word_freq_raw", W(["tf"], BAND_WORDS + "SELECT band, word, count(*) AS count FROM bw GROUP BY band, word"))
def _word_freq_raw(I):
    return WD.word_freq_raw(I.text_features)


@register("word_freq_filtered", W(["tf", "stopwords"], FILTERED + "SELECT band, word, count FROM ff"))
def _word_freq_filtered(I):
    return WD.word_freq_filtered(I.text_features, I.stopwords)


@register("stopword_anti", W(["tf", "stopwords"], BAND_WORDS + """
SELECT band, word FROM bw WHERE NOT EXISTS (SELECT 1 FROM stopwords s WHERE s.word = bw.word)"""))
def _stopword_anti(I):
    return WD.stopword_anti(WD._band_words(I.text_features, 3, 4, 2), I.stopwords)


@register("top_words", W(["tf", "stopwords"], FILTERED + "SELECT band, word, count, rank FROM tw WHERE rank <= 200"))
def _top_words(I):
    return WD.top_words(WD.frequent_words(I.text_features, I.stopwords, 200), 200)


@register("word_freq_comparison", W(["tf", "stopwords"], FILTERED + """
SELECT coalesce(p.rank, n.rank) AS rank, p.word AS pos_word, p.count AS pos_count,
  n.word AS neg_word, n.count AS neg_count
FROM (SELECT * FROM tw WHERE band = 'high' AND rank <= 20) p
FULL OUTER JOIN (SELECT * FROM tw WHERE band = 'low' AND rank <= 20) n ON p.rank = n.rank"""))
def _word_freq_comparison(I):
    return WD.word_freq_comparison(WD.frequent_words(I.text_features, I.stopwords, 20), 20)


@register("vocabulary_union", W(["tf", "stopwords", "lexicon"], VOCAB + "SELECT word FROM vocab"))
def _vocabulary_union(I):
    return WD.vocabulary_union(WD.frequent_words(I.text_features, I.stopwords, 200), 200)


@register("word_valence_lookup", W(["tf", "stopwords", "lexicon"], VOCAB + "SELECT word, sentiment FROM wv"))
def _word_valence_lookup(I):
    vocab = WD.vocabulary_union(WD.word_freq_filtered(I.text_features, I.stopwords), 200)
    return WD.word_valence_lookup(vocab, I.lexicon)


@register("word_sentiment_weight", W(["tf", "stopwords", "lexicon"], VOCAB + """
SELECT word, sentiment, round(sign(sentiment) * pow(abs(sentiment), 0.7), 6) AS weight,
  abs(sign(sentiment) * pow(abs(sentiment), 0.7)) < 0.15 AS is_neutral FROM wv"""))
def _word_sentiment_weight(I):
    vocab = WD.vocabulary_union(WD.word_freq_filtered(I.text_features, I.stopwords), 200)
    return WD.word_sentiment_weight(vocab, I.lexicon)


@register("lexicon_join", W(["reviews", "lexicon"], f"""
SELECT t.review_id, CAST(t.pos AS INTEGER) AS pos, t.token, l.valence FROM (
  SELECT review_id, unnest(range(0, len(toks))) AS pos, unnest(toks) AS token
  FROM (SELECT review_id, regexp_extract_all(lower(content), {O.sq(text.LEXICON_TOKEN)}) AS toks FROM reviews)) t
JOIN lexicon l ON l.word = t.token"""))
def _lexicon_join(I):
    return SE.lexicon_hits(I.reviews, I.lexicon)


@register("sentiment_score", W(["sent"], "SELECT review_id, sentiment FROM sent"))
def _sentiment_score(I):
    return SE.sentiment_score(I.reviews, I.lexicon)


@register("enrich_reviews", W(["E"], "SELECT * FROM E"))
def _enrich_reviews(I):
    return I.enriched


def _stoplist_sql():
    return "[" + ", ".join(O.sq(w) for w in ref.base_stopwords()) + "]"


def _ngrams_sql(n):
    return (f"list_transform(range(1, len(toks) - {n} + 2), "
            f"lambda i: array_to_string(toks[i:i + {n - 1}], ' '))")


NGRAMS = f"""
, nb AS (SELECT {BAND} AS band,
    list_filter(regexp_extract_all(lower(content), {O.sq(text.NGRAM_TOKEN)}), lambda t: NOT list_contains({{stop}}, t)) AS toks
  FROM reviews WHERE content IS NOT NULL)
, ng AS (SELECT band, list_concat({_ngrams_sql(2)}, {_ngrams_sql(3)}) AS grams FROM nb WHERE band IS NOT NULL)
, cnt AS (SELECT band, ngram, CAST(sum(o) AS BIGINT) AS count, CAST(sum(d) AS BIGINT) AS doc_freq FROM (
    SELECT band, unnest(grams) AS ngram, 1 AS o, 0 AS d FROM ng
    UNION ALL SELECT band, unnest(list_distinct(grams)) AS ngram, 0 AS o, 1 AS d FROM ng) GROUP BY band, ngram)
, sz AS (SELECT band, count(*) AS n FROM (SELECT {BAND} AS band FROM reviews WHERE content IS NOT NULL)
         WHERE band IS NOT NULL GROUP BY band)
, kept AS (SELECT c.* FROM cnt c JOIN sz ON sz.band = c.band
           WHERE c.doc_freq >= CASE WHEN sz.n >= 200 THEN 10 ELSE 2 END)
SELECT band, CAST(rank AS INTEGER) AS rank, ngram, count FROM (
  SELECT *, row_number() OVER (PARTITION BY band ORDER BY count DESC, ngram) AS rank FROM kept) WHERE rank <= 25
"""


@register("top_ngrams", W(["reviews"], NGRAMS.replace("{stop}", _stoplist_sql())))
def _top_ngrams(I):
    return WD.top_ngrams(I.reviews, ref.base_stopwords())


@register("top_ngrams_k", W(["reviews"], NGRAMS.replace("{stop}", _stoplist_sql()).replace("rank <= 25", "rank <= 5")))
def _top_ngrams_k(I):
    return WD.top_ngrams(I.reviews, ref.base_stopwords(), k=5)


def _rules_sql():
    mods = O._values(ref.modifier_rows(), ["word", "kind", "weight"])
    return W(["reviews"], f"""
, mods AS ({mods})
, ck AS (SELECT review_id, regexp_split_to_array(content, {O.sq(text.BLANKS)}) AS chunks FROM reviews)
, tl AS (SELECT review_id, flatten(list_transform(chunks, lambda c:
    CASE WHEN length(c) <= {text.EMOTICON_LENGTH} AND regexp_matches(c, {O.sq(text.EMOTICON)}) THEN [c] ELSE regexp_extract_all(c, {O.sq(text.LEXICON_TOKEN)}) END)) AS toks FROM ck)
, tk AS (SELECT review_id, pos, raw, raw = upper(raw) AND raw <> lower(raw) AS caps
         FROM (SELECT review_id, unnest(range(0, len(toks))) AS pos, unnest(toks) AS raw FROM tl))
, rlex AS ({O._values(ref.SEED_LEXICON + ref.SEED_PHRASES + ref.SEED_EMOTICONS, ["word", "valence"])})
, parts AS (SELECT word AS entry, valence, len(ws) AS words, unnest(range(len(ws))) AS i, unnest(ws) AS part
            FROM (SELECT word, valence, string_split(word, ' ') AS ws FROM rlex WHERE contains(word, ' ')))
, ph AS (SELECT review_id, pos, words, valence, caps FROM (
           SELECT review_id, tk.pos - parts.i AS pos, entry, words, valence, bool_and(caps) AS caps
           FROM tk JOIN parts ON parts.part = lower(tk.raw) GROUP BY ALL HAVING count(*) = words)
         QUALIFY row_number() OVER (PARTITION BY review_id, pos ORDER BY words DESC) = 1)
, cov AS (SELECT DISTINCT review_id, unnest(range(pos, pos + words)) AS pos FROM ph)
, tg AS (SELECT tk.review_id, tk.pos, tk.caps, lower(tk.raw) AS token, l.valence, m.kind, m.weight
         FROM tk LEFT JOIN rlex l ON l.word = lower(tk.raw) LEFT JOIN mods m ON m.word = lower(tk.raw)
         WHERE (l.valence IS NOT NULL OR m.kind IS NOT NULL OR lower(tk.raw) = 'but')
           AND NOT EXISTS (SELECT 1 FROM cov WHERE cov.review_id = tk.review_id AND cov.pos = tk.pos)
         UNION ALL SELECT review_id, pos, caps, '', valence, NULL, NULL FROM ph)
, bp AS (SELECT review_id, min(pos) AS but_pos FROM tg WHERE token = 'but' GROUP BY review_id)
, caps AS (SELECT review_id, (content = upper(content) AND content <> lower(content)) AS all_caps FROM reviews)
, hit AS (
  SELECT h.review_id, h.pos, h.caps, h.valence,
    coalesce(sum(CASE WHEN b.kind = 'booster' THEN b.weight *
        CASE h.pos - b.pos WHEN 1 THEN 1.0 WHEN 2 THEN 0.95 ELSE 0.9 END END), 0.0) AS boost,
    count(*) FILTER (WHERE b.kind = 'negation') AS n_neg
  FROM tg h LEFT JOIN tg b ON b.review_id = h.review_id AND b.pos BETWEEN h.pos - 3 AND h.pos - 1
  WHERE h.valence IS NOT NULL GROUP BY h.review_id, h.pos, h.caps, h.valence)
, sc AS (
  SELECT hit.review_id, sum(
    ((hit.valence + sign(hit.valence) * hit.boost)
      + CASE WHEN hit.caps AND NOT c.all_caps
             THEN sign(hit.valence) * {ref.CAPS_INCR} ELSE 0.0 END)
    * pow({ref.NEGATION_SCALAR}, hit.n_neg)
    * CASE WHEN bp.but_pos IS NULL THEN 1.0 WHEN hit.pos < bp.but_pos THEN {ref.BUT_BEFORE}
           WHEN hit.pos > bp.but_pos THEN {ref.BUT_AFTER} ELSE 1.0 END) AS s
  FROM hit JOIN caps c ON c.review_id = hit.review_id LEFT JOIN bp ON bp.review_id = hit.review_id
  GROUP BY hit.review_id)
, fin AS (
  SELECT r.review_id, r.content, coalesce(sc.s, 0.0) AS s,
    least(length(r.content) - length(replace(r.content, '!', '')), {ref.EXCLAIM_MAX}) AS n_excl,
    length(r.content) - length(replace(r.content, '?', '')) AS n_q
  FROM reviews r LEFT JOIN sc ON sc.review_id = r.review_id)
, emph AS (SELECT *, n_excl * {ref.EXCLAIM_INCR} + CASE WHEN n_q > 3 THEN {ref.QUESTION_MAX_BONUS}
                       WHEN n_q > 1 THEN n_q * {ref.QUESTION_INCR} ELSE 0.0 END AS e FROM fin)
SELECT review_id, CASE WHEN content IS NULL THEN NULL ELSE round(sf / sqrt(sf * sf + 15), 4) END AS sentiment
FROM (SELECT review_id, content, CASE WHEN s > 0 THEN s + e WHEN s < 0 THEN s - e ELSE s END AS sf FROM emph)""")


@register("sentiment_score_rules", _rules_sql())
def _sentiment_score_rules(I):
    """Level-2 scorer (phrases, emoticons, negation, boosters, contrast, capitals, punctuation)."""
    return SE.with_sentiment_rules(I.reviews.select("review_id", "content"), ref.rule_lexicon(I.spark),
                                   ref.modifiers(I.spark)).select("review_id", "sentiment")
