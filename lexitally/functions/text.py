"""Text columns: entity decoding, cleaning, tokens, bigrams, relevance."""

import pandas as pd
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexitally import constants as K


def _as_col(c):
    return F.col(c) if isinstance(c, str) else c


def _decoder():
    @F.pandas_udf(T.StringType())
    def decode(texts: pd.Series) -> pd.Series:
        import html

        return texts.map(html.unescape, na_action="ignore")

    return decode


def unescape_html(c):
    """Decode HTML entities, the whole HTML5 set.

    Only rows that hold an ampersand cross into Python; the others are sent as
    nulls and keep their JVM value.
    """
    c = _as_col(c)
    return F.coalesce(_decoder()(F.when(c.contains("&"), c)), c)


def clean_text(c, decoded=False):
    """Corpus cleaner: decode, lower, drop URLs, keep ASCII letters and digits.

    Markup is not stripped, so tag names stay in the text as words. Pass
    `decoded=True` when the column went through `unescape_html` already.
    """
    c = _as_col(c)
    t = F.lower(c if decoded else unescape_html(c))
    t = F.regexp_replace(t, r"(?U)http\S+|www\S+", " ")
    return F.trim(F.regexp_replace(t, r"[^a-z0-9]+", " "))


def clean_post(c):
    """Collector cleaner: strip tags, decode, drop mentions and URLs, keep case."""
    t = F.regexp_replace(_as_col(c), r"<[^>]+>", " ")
    t = unescape_html(t)
    t = F.regexp_replace(t, r"(?U)@\w+", "")
    t = F.regexp_replace(t, r"(?U)#(\w+)", "$1")
    t = F.regexp_replace(t, r"(?U)http\S+", "")
    t = F.regexp_replace(t, r"(?U)www\.\S+", "")
    t = F.regexp_replace(t, r"(?U)[^a-zA-Z0-9\s'\-]", " ")
    t = F.regexp_replace(t, r"(?U)\s['\-]\s", " ")
    t = F.btrim(t, F.lit("'- "))
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def preview(c):
    """Readable text for raters: decoded, whitespace collapsed, trimmed."""
    return F.trim(F.regexp_replace(unescape_html(c), r"(?U)\s+", " "))


def words(c):
    """Whitespace tokens of any text."""
    return F.filter(F.split(_as_col(c), r"(?U)\s+"), lambda x: x != "")


def word_count(c):
    return F.size(words(c))


def tokens(c):
    """Tokens of a cleaned text (single spaces only)."""
    return F.filter(F.split(_as_col(c), " "), lambda x: x != "")


def vectoriser_tokens(c):
    """Words of two or more word characters, the usual vectoriser default."""
    return F.regexp_extract_all(_as_col(c), F.lit(r"\b\w\w+\b"), F.lit(0))


def alphabetic_tokens(c):
    """Words made of two or more lower-case letters."""
    return F.regexp_extract_all(_as_col(c), F.lit(r"\b[a-z][a-z]+\b"), F.lit(0))


def drop_tokens(token_array, unwanted):
    """Array without the listed tokens, order kept."""
    unwanted = list(unwanted)
    return F.filter(_as_col(token_array), lambda x: ~x.isin(unwanted))


def content_tokens(c, stop_words=K.TOPIC_STOP_WORDS):
    """Tokens of a cleaned text without stop words."""
    unwanted = list(stop_words)
    return F.filter(F.split(_as_col(c), " "), lambda x: (x != "") & ~x.isin(unwanted))


def long_tokens(token_array, min_chars=2):
    """Tokens the vectoriser would keep, given whitespace tokens of cleaned ASCII text."""
    return F.filter(_as_col(token_array), lambda x: F.length(x) >= min_chars)


def bigrams(token_array):
    """Consecutive pairs joined by a space; empty for fewer than two tokens."""
    t = _as_col(token_array)
    pairs = F.greatest(F.size(t) - 1, F.lit(0))
    return F.zip_with(
        F.slice(t, F.lit(1), pairs), F.slice(t, F.lit(2), pairs), lambda a, b: F.concat_ws(" ", a, b)
    )


def ngrams(token_array, ngram_range=(1, 1)):
    """Unigrams, bigrams or both, as one array."""
    parts = {(1, 1): lambda t: t, (2, 2): bigrams, (1, 2): lambda t: F.concat(t, bigrams(t))}
    return parts[tuple(ngram_range)](_as_col(token_array))


def strip(c):
    """Without white space of any kind at both ends."""
    return F.regexp_replace(_as_col(c), r"(?U)^\s+|\s+\z", "")


def is_informative_bigram(c, noise=K.BIGRAM_NOISE_TOKENS, exact=K.BIGRAM_NOISE_EXACT):
    """True for a pair fit for a report table: no noise token, no one-letter token."""
    normal = F.lower(strip(c))
    parts = tokens(normal)
    return (
        (F.size(parts) == 2)
        & ~normal.isin(list(exact))
        & F.forall(parts, lambda x: ~x.isin(list(noise)) & (F.length(x) > 1))
    )


def slug(c):
    """Column-name-safe form of a topic name."""
    return F.btrim(F.regexp_replace(F.lower(_as_col(c)), "[^a-z0-9]+", "_"), F.lit("_"))


def keyword_hits(c, keywords, whole_words=K.WHOLE_WORD_KEYWORDS):
    """Keyword occurrences in a text: whole-word for the short ones, else non-overlapping substrings."""
    text = F.lower(_as_col(c))
    hits = F.lit(0)
    for keyword in keywords:
        if keyword in whole_words:
            hits = hits + F.regexp_count(text, F.lit(rf"\b{re.escape(keyword)}\b"))
        else:
            gone = F.length(F.replace(text, F.lit(keyword), F.lit("")))
            hits = hits + ((F.length(text) - gone) / F.lit(len(keyword))).cast("int")
    return hits


def relevant_topics(df, text, keywords=None, whole_words=K.WHOLE_WORD_KEYWORDS, min_hits=K.MIN_KEYWORD_HITS):
    """One row per (post, topic) the post is relevant to.

    The keyword table is configuration, so it becomes an array built in the
    same projection as the scan: no join and no shuffle.
    """
    keywords = K.TOPIC_KEYWORDS if keywords is None else keywords
    scored = F.array(
        *[
            F.struct(F.lit(topic).alias("topic"), keyword_hits(text, terms, whole_words).alias("keyword_hits"))
            for topic, terms in keywords.items()
        ]
    )
    kept = [c for c in df.columns if c not in ("topic", "keyword_hits")]
    return df.select(*kept, F.inline(F.filter(scored, lambda s: s["keyword_hits"] >= min_hits)))


def not_blank(*cols):
    """Predicate: every column holds something other than whitespace."""
    test = F.lit(True)
    for c in cols:
        test = test & _as_col(c).isNotNull() & (strip(c) != "")
    return test
