"""Text column expressions (JVM-side, whole-stage codegen friendly).

Every pattern here is written so that Java regex (Spark) and RE2 (the
DuckDB oracle) read it the same way; the oracle SQL reuses these strings.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Whitespace as Python's str.split()/str.isspace() sees it: ASCII blanks,
# the Unicode separators (Zs, Zl, Zp) and the C0/C1 separators.
WS = r"\t\n\x{0B}\f\r \p{Z}\x{1C}-\x{1F}\x{85}"
# A maximal run of non-blank characters (one "word" of str.split()).
WORD_RUN = f"[^{WS}]+"
# URL-like runs removed before cleaning: http... or www... up to a blank.
URL_RUN = f"(?:http|www)[^{WS}]+"
# Characters dropped by cleaning: everything but a-z and blanks.
NON_ALPHA = f"[^a-z{WS}]"
BLANK_RUN = f"[{WS}]+"
# Vectoriser tokens: two or more letter/digit/underscore characters.
NGRAM_TOKEN = r"[\p{L}\p{N}_]{2,}"
# Lexicon tokens: letters/digits with inner apostrophes kept (don't).
LEXICON_TOKEN = r"[\p{L}\p{N}]+(?:'[\p{L}\p{N}]+)*"
# Emoticons stand between blanks, are short, begin with a sign and have no two letters or digits side by side.
BLANKS = r"[ \t\n\r\f\x0B]+"
EMOTICON = r"^[^\p{L}\p{N}](?:[\p{L}\p{N}]?[^\p{L}\p{N}])*[\p{L}\p{N}]?$"
EMOTICON_LENGTH = 8


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_count(c) -> Column:
    """Number of blank-separated words; null text stays null."""
    return F.array_size(F.regexp_extract_all(_c(c), F.lit(WORD_RUN), 0))


def char_length(c) -> Column:
    return F.char_length(_c(c))


def clean_text(c) -> Column:
    """lower -> drop URLs -> keep a-z and blanks -> collapse blanks -> trim."""
    t = F.lower(_c(c))
    # One pass removes URL runs and non a-z characters: a URL run starts
    # with a letter, so the alternation deletes exactly what removing URLs
    # first and then the other characters would delete.
    t = F.regexp_replace(t, f"{URL_RUN}|{NON_ALPHA}", "")
    t = F.regexp_replace(t, BLANK_RUN, " ")
    return F.trim(t)


def clean_words(c, min_len: int = 3) -> Column:
    """Words of cleaned text with at least ``min_len`` characters."""
    return F.filter(F.split(_c(c), " "), lambda w: F.char_length(w) >= min_len)


def ngram_tokens(c) -> Column:
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(NGRAM_TOKEN), 0)


def lexicon_tokens(c) -> Column:
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(LEXICON_TOKEN), 0)


def rule_tokens(c) -> Column:
    """Words as they are written, and emoticons, in the order of the text."""
    def of(chunk: Column) -> Column:
        sign = (F.length(chunk) <= EMOTICON_LENGTH) & chunk.rlike(EMOTICON)
        return F.when(sign, F.array(chunk)).otherwise(F.regexp_extract_all(chunk, F.lit(LEXICON_TOKEN), 0))
    return F.flatten(F.transform(F.split(_c(c), BLANKS, -1), of))


def ngrams(tokens, n: int) -> Column:
    """All contiguous n-grams of an array column, joined by one blank."""
    toks = grams = _c(tokens)
    for i in range(1, n):
        # Longer by the token that follows; beyond the last one there is none.
        grams = F.zip_with(grams, F.slice(toks, i + 1, F.greatest(F.array_size(toks) - i, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.slice(grams, 1, F.greatest(F.array_size(toks) - (n - 1), F.lit(0)))


def explode_items(df, array_col: Column, name: str, keep=(), with_pos: bool = False):
    """Rows of ``keep`` columns plus one per array element (null/empty arrays
    give no row).

    Written as ``explode_outer`` + a null filter on purpose: a plain
    ``explode`` lets the optimizer infer ``size(array) > 0`` and push it
    below the projection that computes the array, so the tokenising
    expression would be evaluated again inside that filter.
    """
    keep = list(keep)
    if with_pos:
        out = df.select(*keep, F.posexplode_outer(array_col).alias("pos", name))
    else:
        out = df.select(*keep, F.explode_outer(array_col).alias(name))
    return out.filter(F.col(name).isNotNull())


def is_blank(c) -> Column:
    """Null or only spaces (TRIM semantics of the warehouse check)."""
    col = _c(c)
    return col.isNull() | (F.trim(col) == "")


def truncate_with_suffix(c, limit: int = 800, suffix: str = " ...") -> Column:
    col = _c(c)
    return F.when(F.char_length(col) > limit,
                  F.concat(F.substring(col, 1, limit), F.lit(suffix))).otherwise(col)
