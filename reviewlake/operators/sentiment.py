"""Lexicon sentiment scoring as a distributed join.

Level 1 (the oracle-checked contract): tokens of each review are exploded,
joined to the lexicon, the valences summed per review and normalised to
the compound score s / sqrt(s^2 + 15), rounded to 4 decimals.  Null text
gives null; text without a lexicon hit gives 0.0.

Plan shape: a lexicon of up to ``LISTED`` words is a set inside each row's
expression, without a join or exchange.  A longer one: scan -> explode ->
broadcast hash join (lexicon, size checked) -> partial sum per review (map
side) -> exchange of the sums on review_id -> join back to the reviews.
Nothing leaves the JVM.

Level 2 adds the rule-based modifiers (negation, boosters, "but",
capitals, ! and ?) from token positions with ``lag`` windows over the
tagged tokens of each review: linear in the text, codegen'd, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlake.functions import text
from reviewlake.sources import reference_data as ref
from reviewlake.plans.broadcast import bounded_broadcast
from reviewlake.plans.materialize import materialize


# A lexicon of at most so many words is looked up inside each row, so that no text moves; a longer one is joined.
LISTED = 2_000


def unique_words(lexicon: DataFrame) -> DataFrame:
    # One row per word, or the join would multiply valences: of a word listed
    # more than once the greatest valence counts.
    return lexicon.groupBy("word").agg(F.max("valence").alias("valence"))


def _unique_modifiers(modifiers: DataFrame) -> DataFrame:
    # Of a word listed more than once the first kind (booster before negation) and its weight count.
    return modifiers.groupBy(F.col("word").alias("mword")).agg(F.min(F.struct("kind", "weight")).alias("m")).select("mword", "m.kind", "m.weight")


def _row_by_row(reviews: DataFrame, key: str, score) -> DataFrame:
    """``score(rows, keys)`` with keys that tell rows of different text apart.

    The id alone does not: several reviews may share one, and it may be
    null.  Rows with an id are keyed by it and a hash of the text, so a
    layout bucketed by the id stays useful; the others by the hash alone.
    """
    keyed = reviews.withColumn("_text_hash", F.xxhash64("content"))
    named = score(keyed.filter(F.col(key).isNotNull()), [key, "_text_hash"])
    bare = score(keyed.filter(F.col(key).isNull()), ["_text_hash"])
    return named.unionByName(bare).drop("_text_hash")


def lexicon_hits(reviews: DataFrame, lexicon: DataFrame, key: str | list[str] = "review_id") -> DataFrame:
    """(key, pos, token, valence) for every token found in the lexicon."""
    keys = [key] if isinstance(key, str) else key
    toks = text.explode_items(reviews, text.lexicon_tokens("content"), "token", keep=keys, with_pos=True)
    lex = bounded_broadcast(unique_words(lexicon), "lexicon")
    return toks.join(lex, toks.token == lex.word).select(*keys, "pos", "token", "valence")


def valence_sums(reviews: DataFrame, lexicon: DataFrame, key: str | list[str] = "review_id") -> DataFrame:
    """(key, valence_sum) of the rows of each key, which all must have one text.

    Valences are summed map-side as counts of 1/10 000, so that the score
    does not depend on the order.  Equal rows give every hit as often as
    there are rows; one token more for each row, which no text has, tells
    how many they are.
    """
    keys = [key] if isinstance(key, str) else key
    tokens = F.concat(F.array(F.lit("")), text.lexicon_tokens("content"))
    toks = text.explode_items(reviews, tokens, "token", keep=keys)
    row_mark = lexicon.sparkSession.createDataFrame([("", 0)], "word string, units long")
    units = F.round(F.col("valence").cast("decimal(12,4)") * 10_000).cast("bigint").alias("units")
    lex = bounded_broadcast(unique_words(lexicon.filter("word <> ''")).select("word", units).unionByName(row_mark), "lexicon")
    sums = toks.join(lex, toks.token == lex.word).groupBy(*keys).agg(F.sum("units").alias("s"), F.count_if(F.col("token") == "").alias("n"))
    return sums.select(*keys, (F.expr("s div n") / F.lit(10_000.0)).alias("valence_sum"))


def _listed(words) -> str:
    """The words as SQL literals, for a set that is looked up inside each row."""
    return ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)


def listed_units(lexicon: DataFrame) -> dict[str, int] | None:
    """Valence in 1/10 000 of each word, of a lexicon of at most ``LISTED`` words; None if it is longer."""
    units = F.round(F.col("valence").cast("decimal(12,4)") * 10_000).cast("bigint").alias("units")
    rows = unique_words(lexicon.filter("word <> ''")).select("word", units).limit(LISTED + 1).collect()
    return None if len(rows) > LISTED else {r["word"]: r["units"] for r in rows if r["units"] is not None}


def valence_of_row(units: dict[str, int]) -> Column:
    """The valence sum of the row's own text: its tokens that the lexicon lists, one set of words for each value."""
    by_value: dict[int, list[str]] = {}
    for word, value in sorted(units.items()):
        by_value.setdefault(value, []).append(word)
    if not units:
        return F.lit(0.0)
    case = " ".join(f"WHEN t IN ({_listed(words)}) THEN {value}L" for value, words in by_value.items())
    return F.expr(f"aggregate(filter(_tokens, t -> t IN ({_listed(units)})), 0L, (a, t) -> a + CASE {case} END) / 10000.0D")


def compound(s: Column, alpha: float = ref.COMPOUND_ALPHA) -> Column:
    return F.round(s / F.sqrt(s * s + F.lit(alpha)), 4)


def with_sentiment(reviews: DataFrame, lexicon: DataFrame, key: str = "review_id",
                   out: str = "sentiment") -> DataFrame:
    """Adds the level-1 compound score of each row's own text; ids may repeat or be null."""
    units = listed_units(lexicon)
    if units is not None:
        # One step each: the compound reads the sum three times.
        rows = reviews.withColumn("_tokens", text.lexicon_tokens("content")).withColumn("_sum", valence_of_row(units))
        return rows.withColumn(out, F.when(F.col("content").isNull(), None).otherwise(compound(F.col("_sum")))).drop("_tokens", "_sum")
    s = F.coalesce(F.col("valence_sum"), F.lit(0.0))

    def score(rows: DataFrame, keys: list[str]) -> DataFrame:
        joined = rows.join(valence_sums(rows, lexicon, keys), keys, "left")
        return joined.withColumn(out, F.when(F.col("content").isNull(), None).otherwise(compound(s))).drop("valence_sum")

    return _row_by_row(reviews, key, score)


def sentiment_score(reviews: DataFrame, lexicon: DataFrame, modifiers: DataFrame | None = None) -> DataFrame:
    """review_id, sentiment: level 1, or level 2 when a modifier table is given."""
    base = reviews.select("review_id", "content")
    scored = with_sentiment(base, lexicon) if modifiers is None else \
        with_sentiment_rules(base, lexicon, modifiers)
    return scored.select("review_id", "sentiment")


# ---------------------------------------------------------------- level 2
def with_sentiment_rules(reviews: DataFrame, lexicon: DataFrame, modifiers: DataFrame,
                         key: str = "review_id", out: str = "sentiment") -> DataFrame:
    """Compound score with the rule-based modifiers.

    Tokens are words and emoticons.  Entries of several words are found by
    all their tokens (``phrase_hits``) and stand for them: what an entry
    covers neither counts by itself nor changes anything.  For every hit at
    position p, a phrase's first token, the three preceding tokens are
    inspected: a negation multiplies by -0.74; a booster adds its weight
    toward the valence's sign, scaled 1, 0.95, 0.9 by distance; an
    all-capitals hit in mixed-case text adds 0.733 toward its sign.  Hits
    before the first "but" are halved and after it multiplied by 1.5.  The
    sum then gains sign(s) * punctuation emphasis (0.292 per "!" up to 4;
    "?" 0.18 each for 2-3, 0.96 for more) before normalisation.

    Plan: tokens -> broadcast joins to lexicon and modifiers -> keep only
    tagged tokens (hits, modifiers, "but") -> ``lag`` 1..3 over the tagged
    tokens of a review ordered by position (a modifier within three tokens
    is always among the three previous tagged tokens) -> per-hit value ->
    per-review sums -> join back.  Linear in the text length; on a table
    bucketed by review_id the window, the sums and the join stay inside each
    bucket.  Ids may repeat or be null: each row is scored by its own text.
    """
    return _row_by_row(reviews, key, lambda rows, keys: _rules(rows, lexicon, modifiers, keys, out))


def phrase_hits(toks: DataFrame, phrases: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, words, valence, caps): where the tokens of a text are those of an entry of several words, one after another.

    Every word of an entry meets the tokens equal to it; a place is a hit
    if all words of the entry, each at its own distance, point to it.  Only
    tokens that some entry has are grouped.  Of entries that begin at one
    place the longest counts.
    """
    words = F.split("word", " +")
    parts = phrases.select(F.col("word").alias("entry"), "valence", F.size(words).alias("words"), F.posexplode(words).alias("i", "part"))
    parts = bounded_broadcast(parts.withColumnRenamed("valence", "v"), "phrases")
    met = toks.join(parts, toks.token == parts.part).groupBy(*keys, (F.col("pos") - F.col("i")).alias("pos"), "entry", "words", "v").agg(
        F.size(F.collect_set("i")).alias("there"), F.bool_and("caps").alias("caps"))
    best = met.filter(F.col("there") == F.col("words")).groupBy(*keys, "pos").agg(F.max(F.struct("words", "v", "caps")).alias("b"))
    return best.select(*keys, "pos", "b.words", F.col("b.v").alias("valence"), "b.caps")


def _rule_words(lexicon: DataFrame, modifiers: DataFrame) -> list[str] | None:
    """All words that matter to the rules, single or in an entry of several; None if they are more than ``LISTED``."""
    words = lexicon.select(F.explode(F.split("word", " +")).alias("word")).union(modifiers.select("word")).where("word IS NOT NULL").distinct()
    rows = words.limit(LISTED + 1).collect()
    return None if len(rows) > LISTED else sorted({r["word"] for r in rows} | {"but"})


def _rules(reviews: DataFrame, lexicon: DataFrame, modifiers: DataFrame, keys: list[str], out: str) -> DataFrame:
    listed = _rule_words(lexicon, modifiers)
    if listed is None:
        toks = text.explode_items(reviews, text.rule_tokens("content"), "raw", keep=keys, with_pos=True)
    else:
        # Tokens that no table has leave inside the row.
        found = F.expr(f"filter(transform(_tokens, (t, i) -> struct(i AS pos, t AS raw)), x -> lower(x.raw) IN ({_listed(listed)}))")
        rows = reviews.withColumn("_tokens", text.rule_tokens("content"))
        toks = text.explode_items(rows, found, "_it", keep=keys).select(*keys, "_it.pos", "_it.raw")
    toks = toks.withColumn("token", F.lower("raw")).withColumn("caps", (F.col("raw") == F.upper("raw")) & (F.col("raw") != F.lower("raw")))
    entries = unique_words(lexicon)
    several = F.col("word").contains(" ")
    lex = bounded_broadcast(entries.filter(~several), "lexicon")
    mods = bounded_broadcast(_unique_modifiers(modifiers), "modifiers")
    phrases = entries.filter(several)
    with_phrases = not phrases.isEmpty()
    tag = ["pos", "caps", "token", "valence", "kind", "weight"]
    single = F.col("valence").isNotNull() | F.col("kind").isNotNull() | (F.col("token") == "but")
    tagged = toks.join(lex, toks.token == lex.word, "left").join(mods, toks.token == mods.mword, "left")
    if with_phrases:
        parts = bounded_broadcast(phrases.select(F.explode(F.split("word", " +")).alias("part")).distinct().withColumn("in_phrase", F.lit(True)), "parts")
        tagged = tagged.join(parts, tagged.token == parts.part, "left").filter(single | F.col("in_phrase"))
    else:
        tagged = tagged.filter(single)
    # Equal rows give each place once.
    tagged = tagged.groupBy(*keys).agg(F.collect_set(F.struct(*tag)).alias("tags")).select(*keys, F.inline("tags"))
    if with_phrases:
        # The tokens that matter, some of all, are read for the phrases and for what is left beside them.
        tagged = materialize(tagged, "tagged-tokens")
        found = materialize(phrase_hits(tagged, phrases, keys), "phrases")
        inside = found.select(*keys, F.explode(F.sequence("pos", F.col("pos") + F.col("words") - 1)).alias("pos")).distinct()
        tagged = tagged.filter(single).join(inside, [*keys, "pos"], "left_anti").select(*keys, *tag).unionByName(
            found.select(*keys, "pos", "caps", F.lit("").alias("token"), "valence", F.lit(None).cast("string").alias("kind"), F.lit(None).cast("double").alias("weight")))
    w = Window.partitionBy(*keys).orderBy("pos")
    per_review = Window.partitionBy(*keys)
    cols = {"but_pos": F.min(F.when(F.col("token") == "but", F.col("pos"))).over(per_review)}
    for d in (1, 2, 3):
        cols[f"p{d}"] = F.lag("pos", d).over(w)
        cols[f"k{d}"] = F.lag("kind", d).over(w)
        cols[f"w{d}"] = F.lag("weight", d).over(w)
    lagged = tagged.withColumns(cols).filter(F.col("valence").isNotNull())

    scale = {1: 1.0, 2: 0.95, 3: 0.9}
    boost = F.lit(0.0)
    n_neg = F.lit(0)
    for d in (1, 2, 3):
        dist = F.col("pos") - F.col(f"p{d}")
        near = dist.between(1, 3)
        factor = F.when(dist == 1, scale[1]).when(dist == 2, scale[2]).otherwise(scale[3])
        boost = boost + F.when(near & (F.col(f"k{d}") == "booster"), F.col(f"w{d}") * factor).otherwise(0.0)
        n_neg = n_neg + F.when(near & (F.col(f"k{d}") == "negation"), 1).otherwise(0)
    v = F.col("valence")
    sign = F.signum(v)
    neg = F.pow(F.lit(ref.NEGATION_SCALAR), n_neg.cast("double"))
    but_pos = F.col("but_pos")
    contrast = (F.when(but_pos.isNull(), 1.0).when(F.col("pos") < but_pos, ref.BUT_BEFORE)
                 .when(F.col("pos") > but_pos, ref.BUT_AFTER).otherwise(1.0))
    caps = F.when(F.col("caps"), sign * ref.CAPS_INCR).otherwise(0.0)
    # The capitals bonus is summed apart: it applies only when the whole
    # text is not in capitals, which is known on the review row.
    sums = lagged.groupBy(*keys).agg(
        F.sum((v + sign * boost) * neg * contrast).alias("_s_plain"),
        F.sum(caps * neg * contrast).alias("_s_caps"))

    base = reviews.join(sums, keys, "left")
    content = F.coalesce(F.col("content"), F.lit(""))
    all_caps = (F.col("content") == F.upper("content")) & (F.col("content") != F.lower("content"))
    s = (F.coalesce(F.col("_s_plain"), F.lit(0.0))
         + F.when(all_caps, 0.0).otherwise(F.coalesce(F.col("_s_caps"), F.lit(0.0))))
    n_excl = F.least(F.size(F.split(content, "!", -1)) - 1, F.lit(ref.EXCLAIM_MAX))
    n_q = F.size(F.split(content, r"\?", -1)) - 1
    q_amp = F.when(n_q > 3, ref.QUESTION_MAX_BONUS).when(n_q > 1, n_q * ref.QUESTION_INCR).otherwise(0.0)
    emph = n_excl * ref.EXCLAIM_INCR + q_amp
    s_final = F.when(s > 0, s + emph).when(s < 0, s - emph).otherwise(s)
    return (base.withColumn(out, F.when(F.col("content").isNull(), None).otherwise(compound(s_final)))
                .drop("_s_plain", "_s_caps"))
