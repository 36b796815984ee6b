"""Word, vocabulary and n-gram frequencies by rating band.

All counting is explode + partial aggregation (map-side combine), so a
very frequent word costs one row per input partition in the exchange.
Top-k per band uses ``row_number() <= k``; Spark turns that into a
per-partition group limit before the exchange, so only k rows per band per
partition move.  Stop lists are broadcast after a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from reviewlake.functions import text
from reviewlake.operators.heavy import frequent
from reviewlake.operators.quality import band_column
from reviewlake.operators.sentiment import compound, unique_words
from reviewlake.plans.broadcast import bounded_broadcast
from reviewlake.plans.materialize import materialize


LISTED = 2_000  # candidates that are looked up inside a row


def _band_words(features: DataFrame, min_len: int, high: int, low: int) -> DataFrame:
    """(band, word) for every word of the cleaned text of banded reviews."""
    f = features
    if "clean_content" not in f.columns:
        f = f.withColumn("clean_content", text.clean_text("content"))
    banded = (f.select(band_column(high, low).alias("band"), "clean_content")
                .filter(F.col("band").isNotNull() & F.col("clean_content").isNotNull()))
    return text.explode_items(banded, text.clean_words("clean_content", min_len), "word", keep=["band"])


def word_freq_raw(features: DataFrame, min_len: int = 3, high: int = 4, low: int = 2) -> DataFrame:
    """(band, word, count) before stop-word removal."""
    return _band_words(features, min_len, high, low).groupBy("band", "word") \
        .agg(F.count(F.lit(1)).alias("count"))


def stopword_anti(words: DataFrame, stopwords: DataFrame, col: str = "word") -> DataFrame:
    """Remove stop words (left anti join against the broadcast stop list)."""
    sw = bounded_broadcast(stopwords.select(F.col("word").alias("_sw")), "stopwords")
    return words.join(sw, words[col] == sw["_sw"], "left_anti")


def word_freq_filtered(features: DataFrame, stopwords: DataFrame, min_len: int = 3,
                       high: int = 4, low: int = 2) -> DataFrame:
    """(band, word, count) after stop-word removal."""
    words = stopword_anti(_band_words(features, min_len, high, low), stopwords)
    return words.groupBy("band", "word").agg(F.count(F.lit(1)).alias("count"))


def top_words(freq: DataFrame, k: int = 200, by: str = "band") -> DataFrame:
    """Top ``k`` words per band by count (ties: word ascending), with rank."""
    w = Window.partitionBy(by).orderBy(F.desc("count"), F.asc("word"))
    return freq.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def frequent_words(features: DataFrame, stopwords: DataFrame, k: int = 200, min_len: int = 3, high: int = 4, low: int = 2) -> DataFrame:
    """(band, word, count): the top ``k`` of each band, for ``top_words`` and what builds on it.

    One pass over the texts: words are counted map-side, so a task sends
    each different word once, and the few rows left are stored for the
    several readers.
    """
    return materialize(top_words(word_freq_filtered(features, stopwords, min_len, high, low), k).drop("rank"), "frequent-words")


def word_freq_comparison(freq: DataFrame, k: int = 20) -> DataFrame:
    """Side-by-side ranks: rank, pos_word, pos_count, neg_word, neg_count."""
    top = top_words(freq, k)
    pos = top.filter(F.col("band") == "high").select("rank", F.col("word").alias("pos_word"),
                                                      F.col("count").alias("pos_count"))
    neg = top.filter(F.col("band") == "low").select("rank", F.col("word").alias("neg_word"),
                                                     F.col("count").alias("neg_count"))
    return pos.join(neg, "rank", "full_outer").orderBy("rank")


def vocabulary_union(freq: DataFrame, k: int = 200) -> DataFrame:
    """Distinct words of the positive and negative top-k vocabularies."""
    top = top_words(freq, k)
    pos = top.filter(F.col("band") == "high").select("word")
    neg = top.filter(F.col("band") == "low").select("word")
    return pos.union(neg).distinct()


def word_valence_lookup(words: DataFrame, lexicon: DataFrame, default: float = 0.0) -> DataFrame:
    """word -> single-word compound sentiment; words outside the lexicon get ``default``.

    Of a word that the lexicon lists more than once the greatest valence
    counts, as in the scoring of texts: each row of ``words`` stays one.
    """
    lex = bounded_broadcast(unique_words(lexicon).select(F.col("word").alias("_w"), "valence"), "lexicon")
    j = words.join(lex, words["word"] == lex["_w"], "left")
    return j.select(words["*"], F.coalesce(compound(F.col("valence")), F.lit(default)).alias("sentiment"))


def word_sentiment_weight(words: DataFrame, lexicon: DataFrame, power: float = 0.7,
                          neutral: float = 0.15, digits: int = 6) -> DataFrame:
    """Signed power of each word's sentiment and the neutral flag (|w| < neutral)."""
    s = word_valence_lookup(words, lexicon)
    wgt = F.signum("sentiment") * F.pow(F.abs("sentiment"), F.lit(power))
    return s.withColumn("weight", F.round(wgt, digits)) \
            .withColumn("is_neutral", F.abs(wgt) < neutral)


# ---------------------------------------------------------------- n-grams
def _ngram_band_rows(reviews: DataFrame, stopwords: list[str], n_range, high: int, low: int):
    toks = F.filter(text.ngram_tokens("content"), lambda t: ~t.isin(*stopwords)) \
        if stopwords else text.ngram_tokens("content")
    base = (reviews.select(band_column(high, low).alias("band"), "content")
                   .filter(F.col("band").isNotNull() & F.col("content").isNotNull())
                   .select("band", toks.alias("toks")))
    grams = F.concat(*[text.ngrams("toks", n) for n in range(n_range[0], n_range[1] + 1)])
    return base.select("band", grams.alias("grams"))


def ngram_counts(reviews: DataFrame, stopwords: list[str], n_range=(2, 3), high: int = 4,
                 low: int = 2, some: DataFrame | None = None) -> DataFrame:
    """(band, ngram, count, doc_freq): occurrences and number of reviews, of all n-grams or ``some`` (band, ngram).

    Document frequency comes from exploding the per-review distinct grams
    next to the full list, so one partial+final aggregation computes both
    (no count-distinct expansion).
    """
    rows = _ngram_band_rows(reviews, stopwords, n_range, high, low)
    # One array per review: every gram tagged (1, 0) for occurrences, every
    # distinct gram tagged (0, 1) for document frequency -> one explode,
    # one partial+final aggregation.
    tag = lambda o, d: (lambda g: F.struct(g.alias("ngram"), F.lit(o).alias("o"), F.lit(d).alias("d")))
    if some is not None and len(names := some.select("ngram").distinct().limit(LISTED + 1).collect()) <= LISTED:
        # Grams of no candidate leave inside the row; the join below tells the bands apart.
        rows = rows.withColumn("grams", F.filter("grams", lambda g: g.isin([r["ngram"] for r in names])))
    items = F.concat(F.transform("grams", tag(1, 0)), F.transform(F.array_distinct("grams"), tag(0, 1)))
    it = text.explode_items(rows, items, "it", keep=["band"]).select("band", "it.ngram", "it.o", "it.d")
    if some is not None:
        it = it.join(some, ["band", "ngram"], "left_semi")
    return it.groupBy("band", "ngram").agg(F.sum("o").cast("bigint").alias("count"), F.sum("d").cast("bigint").alias("doc_freq"))


def band_sizes(reviews: DataFrame, high: int = 4, low: int = 2) -> DataFrame:
    return (reviews.filter(F.col("content").isNotNull())
                   .select(band_column(high, low).alias("band")).filter(F.col("band").isNotNull())
                   .groupBy("band").agg(F.count(F.lit(1)).alias("band_reviews")))


def top_ngrams(reviews: DataFrame, stopwords: list[str], n_range=(2, 3), k: int = 25,
               min_df: int | None = None, high: int = 4, low: int = 2) -> DataFrame:
    """Top ``k`` n-grams per band by total count among n-grams present in at
    least ``min_df`` reviews (default: 10 if the band has >= 200 reviews,
    else 2).

    Only candidates of a frequent-items sketch are counted
    (operators.heavy), so what is shuffled does not follow the number of
    different n-grams.
    """
    sizes = band_sizes(reviews, high, low)
    thr = F.lit(min_df) if min_df is not None else \
        F.when(F.col("band_reviews") >= 200, F.lit(10)).otherwise(F.lit(2))
    # ``sizes`` has one row per band (two rows): a bounded broadcast side.
    enough = lambda counts: counts.join(F.broadcast(sizes), "band").filter(F.col("doc_freq") >= thr)
    grams = text.explode_items(_ngram_band_rows(reviews, stopwords, n_range, high, low), F.col("grams"), "ngram", keep=["band"])
    counts = frequent(grams, "band", "ngram", k, lambda some: ngram_counts(reviews, stopwords, n_range, high, low, some), enough, tracked=100_000)
    kept = enough(counts)
    w = Window.partitionBy("band").orderBy(F.desc("count"), F.asc("ngram"))
    return (kept.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
                .select("band", "rank", "ngram", "count"))
