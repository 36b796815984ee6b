"""Small lookup tables passed into the text and sentiment operators.

All of them are *inputs*: a caller with the full published sentiment
lexicon loads it with ``read_lexicon`` and passes that DataFrame instead
of the seed subset below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlake import schemas

# ---- fixed values -------------------------------------------------------
# Seed lexicon: a small labelled SUBSET of word valences on the -4..+4
# scale of the rule-based scorer, enough for the test phrases.  It is not
# the full lexicon, so published correlations are not reproduced with it.
SEED_LEXICON = [
    ("great", 3.1), ("love", 3.2), ("helpful", 1.8), ("good", 1.9),
    ("useful", 1.9), ("easy", 1.9), ("best", 3.2), ("awesome", 3.1),
    ("bad", -2.5), ("wrong", -2.1), ("problem", -1.7), ("terrible", -2.1),
    # Further words with valences of our own judgement.
    ("accurate", 1.5), ("amazing", 2.8), ("annoying", -1.8), ("appreciate", 1.9), ("awful", -2.4), ("beautiful", 2.6),
    ("better", 1.7), ("boring", -1.4), ("bored", -1.2), ("brilliant", 2.7), ("broken", -1.9),
    ("clean", 1.4), ("clever", 1.9), ("clown", -1.3), ("complaint", -1.4), ("confusing", -1.5), ("cool", 1.4),
    ("crap", -2.0), ("crash", -1.9), ("crashes", -1.9), ("creative", 1.8), ("cute", 1.8), ("damage", -2.0),
    ("delight", 2.7), ("delightful", 2.6), ("difficult", -1.4), ("disappointed", -2.0), ("disappointing", -2.1), ("disgusting", -2.7),
    ("dislike", -1.6), ("dumb", -2.2), ("enjoy", 2.1), ("enjoyable", 2.0), ("error", -1.6), ("errors", -1.6),
    ("excellent", 2.8), ("excited", 1.8), ("fail", -2.2), ("failed", -2.1), ("fails", -2.0), ("fake", -1.9),
    ("fantastic", 2.7), ("fast", 1.1), ("favorite", 2.0), ("fraud", -2.7), ("friendly", 2.0), ("frustrating", -1.9),
    ("fun", 2.2), ("funny", 1.8), ("garbage", -2.2), ("glad", 2.0), ("happy", 2.6), ("hate", -2.6),
    ("hated", -2.6), ("horrible", -2.4), ("idiot", -2.3), ("impressed", 2.0), ("impressive", 2.2), ("inaccurate", -1.6),
    ("incredible", 2.5), ("issue", -1.1), ("issues", -1.2), ("joke", -0.9), ("joy", 2.7), ("lag", -1.3),
    ("like", 1.4), ("loser", -2.2), ("loved", 2.8), ("lovely", 2.6), ("mad", -2.0), ("moron", -2.3),
    ("nice", 1.8), ("outstanding", 2.9), ("pathetic", -2.5), ("perfect", 2.8), ("pleased", 1.9), ("poor", -2.0),
    ("pretty", 1.6), ("recommend", 1.6), ("reliable", 1.7), ("ridiculous", -1.6), ("sad", -2.0), ("satisfied", 1.8),
    ("scam", -2.7), ("scum", -2.6), ("silly", -0.8), ("smart", 1.8), ("smooth", 1.2), ("spam", -1.7),
    ("stupid", -2.4), ("superb", 3.0), ("support", 1.5), ("thank", 1.6), ("thanks", 1.8), ("trash", -2.0),
    ("trust", 2.1), ("ugly", -2.2), ("unfair", -2.0), ("unhappy", -1.9), ("useless", -1.9), ("waste", -1.8),
    ("weak", -1.6), ("wonderful", 2.7), ("worse", -2.1), ("worst", -3.0), ("worthless", -2.3), ("wow", 2.6),
]

# Entries of several words and emoticons, for the rule-based scorer; valences of our own judgement.
SEED_PHRASES = [
    ("easy to use", 2.2), ("free version", 0.8), ("not bad", 1.2), ("waste of time", -2.3), ("worth it", 1.9), ("no problem", 1.3),
    ("does not work", -2.2), ("useful and easy to use", 2.6), ("really useful", 2.2), ("slow", -1.2), ("bad update", -2.4),
]
SEED_EMOTICONS = [(":)", 2.0), (":-)", 1.8), (":(", -1.9), (":-(", -1.7), (":d", 2.3), (";)", 1.4), ("<3", 2.2), (":/", -1.2), (":'(", -2.1)]

# Extra stop words the word-frequency analysis adds to the base list
# (fixed values, in the order the analysis lists them).
CUSTOM_STOPWORDS = [
    "app", "chatgpt", "chat", "gpt", "chat gpt", "ai", "bot",
    "nice", "good", "use", "really", "thing", "much", "best", "lot", "even",
    "its", "you", "that", "one", "and", "the", "this", "for", "very", "now",
    "please", "thank", "thanks", "application", "apps",
]

# Rule-based scorer constants (published method: lexicon valence adjusted by
# negation, boosters, contrast, capitals and punctuation; compound =
# s / sqrt(s^2 + alpha)).
COMPOUND_ALPHA = 15.0
NEGATION_SCALAR = -0.74
BOOSTER_INCR = 0.293
CAPS_INCR = 0.733
EXCLAIM_INCR = 0.292
EXCLAIM_MAX = 4
QUESTION_INCR = 0.18
QUESTION_MAX_BONUS = 0.96
BUT_BEFORE = 0.5
BUT_AFTER = 1.5
# Negation and booster words of the seed modifier table (small subset).
SEED_NEGATIONS = ["not", "no", "never", "isn't", "don't", "doesn't", "can't",
                  "won't", "wasn't", "didn't", "nothing", "without"]
SEED_BOOSTERS = [("very", 1.0), ("really", 1.0), ("extremely", 1.0),
                 ("so", 1.0), ("totally", 1.0), ("barely", -1.0),
                 ("slightly", -1.0), ("somewhat", -1.0)]
# -------------------------------------------------------------------------


_SESSION_TABLES: dict[tuple, DataFrame] = {}


def _per_session(spark: SparkSession, name: str, build) -> DataFrame:
    """One DataFrame per session for a fixed lookup table, so its broadcast
    size check runs once rather than for every query that uses it."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _SESSION_TABLES:
        _SESSION_TABLES[key] = build()
    return _SESSION_TABLES[key]


def seed_lexicon(spark: SparkSession) -> DataFrame:
    return _per_session(spark, "lexicon", lambda: spark.createDataFrame(SEED_LEXICON, schemas.LEXICON))


def rule_lexicon(spark: SparkSession) -> DataFrame:
    """The seed lexicon with its phrases and emoticons."""
    return _per_session(spark, "rule-lexicon", lambda: spark.createDataFrame(SEED_LEXICON + SEED_PHRASES + SEED_EMOTICONS, schemas.LEXICON))


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated lexicon file: word, mean valence, [std, ratings...]; of a word's several valences the greatest."""
    raw = spark.read.option("sep", "\t").option("quote", "\u0000").csv(path)
    return (raw.select(F.col("_c0").alias("word"), F.col("_c1").cast("double").alias("valence"))
               .filter(F.col("word").isNotNull() & F.col("valence").isNotNull())
               .groupBy("word").agg(F.max("valence").alias("valence")))


def base_stopwords(language: str = "english") -> list[str]:
    """Spark ML's built-in stop list (181 English words).

    Read from the list Spark ships inside its ML jar, so no running JVM is
    needed; falls back to ``StopWordsRemover.loadDefaultStopWords``.
    """
    import glob
    import os
    import zipfile

    import pyspark
    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    for jar in jars:
        with zipfile.ZipFile(jar) as z:
            name = f"org/apache/spark/ml/feature/stopwords/{language}.txt"
            if name in z.namelist():
                return [w for w in z.read(name).decode("utf-8").split() if w]
    from pyspark.ml.feature import StopWordsRemover
    return list(StopWordsRemover.loadDefaultStopWords(language))


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """A stop list of one's own, a word in each line, in lower case; blank lines are none."""
    word = F.lower(F.trim("value"))
    return spark.read.text(path).select(word.alias("word")).filter(F.col("word") != "").distinct()


def stopword_list(spark: SparkSession | None = None, custom: bool = True) -> list[str]:
    words = base_stopwords()
    if custom:
        words = words + CUSTOM_STOPWORDS
    return sorted(set(words))


def stopwords(spark: SparkSession, custom: bool = True) -> DataFrame:
    return _per_session(spark, f"stopwords-{custom}", lambda: spark.createDataFrame(
        [(w,) for w in stopword_list(spark, custom)], schemas.STOPWORDS))


def modifier_rows() -> list[tuple[str, str, float]]:
    rows = [(w, "negation", NEGATION_SCALAR) for w in SEED_NEGATIONS]
    rows += [(w, "booster", s * BOOSTER_INCR) for w, s in SEED_BOOSTERS]
    return rows


def modifiers(spark: SparkSession) -> DataFrame:
    return _per_session(spark, "modifiers", lambda: spark.createDataFrame(
        modifier_rows(), "word string, kind string, weight double"))
