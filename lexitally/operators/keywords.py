"""Terms that set classes apart, by Naive Bayes log probabilities."""

from functools import reduce
from operator import add

from pyspark.sql import functions as F

from lexitally import constants as K
from lexitally.functions.text import alphabetic_tokens, drop_tokens, ngrams
from lexitally.operators.models import balanced_weights, class_sizes, smoothed_log_probs
from lexitally.operators.terms import ID, TERM, term_counts, top_n, top_n_overall
from lexitally.session import stored


def keyword_counts(docs, text, keys, ngram_range, stop_words=K.KEYWORD_STOP_WORDS):
    """Counts of alphabetic n-grams, paired after stop words are gone."""
    kept = docs.select(*keys, drop_tokens(alphabetic_tokens(text), stop_words).alias("_words"))
    return term_counts(kept.withColumn("_ngrams", ngrams("_words", ngram_range)), "_ngrams", keys)


def class_log_probs(docs, text, label, ngram_range=(1, 1), min_df=K.UNIGRAM_KEYWORD_MIN_DF, classes=K.LABELS, stop_words=K.KEYWORD_STOP_WORDS, id_col=ID):
    """Per term: log probability in every class under balanced weights, and its total count.

    Documents, class sums and total of a term come out of one aggregate, which map
    tasks reduce: a term that most documents hold is one row a task.
    """
    texts = docs.where(F.col(text).isNotNull())
    counts = keyword_counts(texts, text, (id_col, label), ngram_range, stop_words)
    weights = balanced_weights(class_sizes(texts, label, classes))
    sums = counts.groupBy(TERM).agg(
        F.count(F.lit(1)).alias("_df"), F.sum(F.col("tf").cast("double")).alias("total_count"),
        *[(F.lit(w) * F.sum(F.when(F.col(label) == c, F.col("tf")).otherwise(0))).alias(f"_s{k}") for k, (c, w) in enumerate(zip(classes, weights))],
    )
    kept = stored(sums.where(F.col("_df") >= min_df).drop("_df"), "keyword-sums")
    return smoothed_log_probs(kept, len(classes), ["total_count"])


def discriminative_terms(log_probs, classes=K.LABELS, n=K.TOP_KEYWORDS):
    """Best n terms per class by log probability minus the mean of the other classes."""
    lp = [F.col(f"_lp{k}") for k in range(len(classes))]
    others = reduce(add, lp)
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("class"), lp[k].alias("lp"), (lp[k] - (others - lp[k]) / (len(classes) - 1)).alias("d"))
            for k, c in enumerate(classes)
        ]
    )
    long = log_probs.select(TERM, F.inline(rows)).withColumn("_score", F.round("d", 9))
    best = top_n(long, n, "_score", ("class",))
    return best.select(
        "class", TERM, F.round("lp", 4).alias("log_prob"), F.round("d", 4).alias("discrimination_score"), "rank"
    )


def frequent_vs_discriminative(log_probs, classes=K.LABELS, n=K.TOP_KEYWORDS, threshold=K.SPREAD_THRESHOLD):
    """The most frequent terms and how far their class probabilities spread."""
    lp = [F.col(f"_lp{k}") for k in range(len(classes))]
    spread = F.greatest(*lp) - F.least(*lp)
    best = top_n_overall(log_probs.withColumn("_spread", spread), n, "total_count")
    return best.select(
        TERM,
        "total_count",
        F.round("_spread", 4).alias("log_prob_spread"),
        F.when(F.col("_spread") > threshold, K.DISCRIMINATIVE).otherwise(K.MERELY_FREQUENT).alias("interpretation"),
    )
