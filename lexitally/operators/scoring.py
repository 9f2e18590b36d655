"""Custom term, bigram and document scores per topic."""

from functools import reduce
from operator import add

from pyspark.sql import functions as F

from lexitally import constants as K
from lexitally.functions.numbers import settled
from lexitally.functions.text import bigrams, slug
from lexitally.operators.terms import ID, TERM, TOPIC, min_max_within, term_counts, topic_term_stats, topic_terms, topic_vs_rest_tfidf
from lexitally.session import stored


def positional_scores(docs, token_array="tokens", topic=TOPIC, terms=None):
    """Mean of 1/(position+1) over every occurrence of a term in a topic; `terms` is a table of `topic_terms`."""
    terms = topic_terms(docs, token_array, topic) if terms is None else terms
    return terms.select(topic, TERM, (F.col("early") / F.col("tf")).alias("positional_score"))


def label_gap(docs, terms, label="final_sentiment", topic=TOPIC, labels=K.LABELS):
    """`terms` with the largest gap between a term's label mix and its topic's, by documents."""
    per_topic = docs.groupBy(topic).agg(
        *[(F.count_if(F.col(label) == x) / F.count(label)).alias(f"_p_{x}") for x in labels]
    )
    gaps = [F.abs(F.col(f"n_{x}") / F.col("df") - F.col(f"_p_{x}")) for x in labels]
    return terms.join(F.broadcast(per_topic), topic).withColumn("sentiment_association_score", F.greatest(*gaps))


def sentiment_association(docs, label="final_sentiment", token_array="tokens", topic=TOPIC, labels=K.LABELS):
    """Largest gap between a term's label mix and its topic's, by documents."""
    terms = topic_terms(docs, token_array, topic, label, labels)
    return label_gap(docs, terms, label, topic, labels).select(topic, TERM, "sentiment_association_score")


def bigram_scores(bigram_tfidf, topic=TOPIC):
    """Bigram score from TF-IDF and distinctiveness, both scaled within the topic."""
    ratio = F.col("topic_distinctiveness_ratio")
    parts = bigram_tfidf.select(
        topic,
        F.col(TERM).alias("bigram"),
        F.col("mean_tfidf_in_topic").alias("bigram_tfidf_score"),
        F.when(ratio == float("inf"), F.col("topic_doc_count").cast("double")).otherwise(ratio).alias("bigram_distinctiveness"),
        "topic_doc_count",
    )
    scaled = min_max_within(parts, list(K.BIGRAM_WEIGHTS), topic)
    score = reduce(add, [w * F.col(f"{c}_norm") for c, w in K.BIGRAM_WEIGHTS.items()])
    return scaled.withColumn("custom_bigram_score", settled(score, 6))


def bigram_boost(scored_bigrams, topic=TOPIC):
    """Best score among the bigrams that contain a term."""
    parts = scored_bigrams.select(topic, F.explode(F.split("bigram", " ")).alias(TERM), "custom_bigram_score")
    return parts.groupBy(topic, TERM).agg(F.max("custom_bigram_score").alias("bigram_boost_score"))


def term_scores(docs, terms, tfidf_stats, scored_bigrams, label="final_sentiment", topic=TOPIC, min_count=K.MIN_TERM_COUNT, store=stored):
    """Weighted term score from six components, each scaled within its topic.

    `terms` is a table of `topic_terms` with labels: frequency, lift, position and
    label mix are columns of it, so only TF-IDF and the bigrams are joined.
    """
    key = [topic, TERM]
    stats = topic_term_stats(docs, topic=topic, terms=terms).select(
        *key, F.col("topic_term_freq").alias("freq_score"), F.col("topic_specific_ratio").alias("topic_specific_score")
    )
    frequent = label_gap(docs, terms.where(F.col("tf") >= min_count), label, topic)
    # Sums of fractions differ in the last bits between runs; settle them before scaling.
    base = frequent.select(
        *key, F.col("tf").alias("topic_term_count"), F.round(F.coalesce("sentiment_association_score", F.lit(0.0)), 12).alias("sentiment_association_score"),
        F.round(F.col("early") / F.col("tf"), 12).alias("positional_score"),
    )
    joined = (
        base.join(stats, key)
        .join(tfidf_stats.select(*key, F.col("mean_tfidf_in_topic").alias("tfidf_score")), key, "left")
        .join(bigram_boost(scored_bigrams, topic), key, "left")
        .na.fill(0.0, ["tfidf_score", "bigram_boost_score"])
    )
    scaled = min_max_within(joined, list(K.TERM_WEIGHTS), topic, store=store)
    score = reduce(add, [w * F.col(f"{c}_norm") for c, w in K.TERM_WEIGHTS.items()])
    return scaled.withColumn("custom_term_score", settled(score, 6))


def fit_scores(docs, label="final_sentiment", token_array="tokens", topic=TOPIC, id_col=ID, store=stored):
    """Term and bigram score tables fitted on the given documents.

    The documents are stored first: their tokens are read for each of the three
    statistics, but what made them runs once. The bigram table feeds the term table and both feed the document scores, so
    each is written once (a table in the shared folder) and read back.
    """
    docs = store(docs.select(id_col, topic, label, token_array), "scored-documents")
    scored_bigrams = store(bigram_scores(topic_vs_rest_tfidf(docs, (2, 2), token_array, topic, id_col), topic), "bigram-scores")
    terms = topic_terms(docs, token_array, topic, label, store=store)
    tfidf_stats = topic_vs_rest_tfidf(docs, (1, 1), token_array, topic, id_col)
    scored_terms = term_scores(docs, terms, tfidf_stats, scored_bigrams, label, topic, store=store)
    return store(scored_terms, "term-scores"), scored_bigrams


def _document_sums(docs, scored_terms, scored_bigrams, token_array, topic, id_col, own_topic_only):
    """Per (document, scored topic): sums and counts of the matched scores.

    Tables are reduced to one row per term, holding its topics' scores as a
    short array, so a document term meets the lookup once whatever the number
    of topics. Documents are shuffled by id as arrays, so counting their terms needs
    no other shuffle, and what they matched returns to them as one row a term: the
    array becomes rows only there. Zero rows for every (document, topic) join the same
    aggregate, which keeps documents without any match.
    """
    lookup = scored_terms.groupBy(TERM).agg(
        F.collect_list(F.struct(F.col(topic).alias("t"), F.col("custom_term_score").alias("s"), F.col("positional_score_norm").alias("p"))).alias("_scores")
    )
    pair_lookup = scored_bigrams.groupBy(F.col("bigram").alias(TERM)).agg(
        F.collect_list(F.struct(F.col(topic).alias("t"), F.col("custom_bigram_score").alias("s"), F.lit(0.0).alias("p"))).alias("_scores")
    )
    together = docs.select(id_col, topic, token_array).repartition(id_col)
    placed = (
        together.select(id_col, topic, F.posexplode(token_array).alias("_pos", TERM))
        .groupBy(id_col, topic, TERM)
        .agg(F.count(F.lit(1)).alias("tf"), F.sum(1 / (F.col("_pos") + 1)).alias("early"))
    )
    pairs = term_counts(together.withColumn("_bigrams", bigrams(token_array)), "_bigrams", (id_col, topic))
    zero, none = F.lit(0.0), F.lit(0).cast("long")

    def matched(rows, table, values):
        met = rows.join(table, TERM)
        if own_topic_only:
            met = met.withColumn("_scores", F.filter("_scores", lambda x: x["t"] == F.col(topic)))
        return met.select(id_col, *values, "_scores")

    from_terms = matched(placed, lookup, [F.col("tf").alias("u_n"), "early", none.alias("b_n")])
    from_pairs = matched(pairs, pair_lookup, [none.alias("u_n"), zero.alias("early"), F.col("tf").alias("b_n")])
    unscored = lambda t: F.struct(t.alias("t"), zero.alias("s"), zero.alias("p"))
    if own_topic_only:
        candidates = F.array(unscored(F.col(topic)))
    else:
        candidates = docs.agg(F.transform(F.array_sort(F.collect_set(topic)), unscored)).scalar()
    blank = docs.select(id_col, none.alias("u_n"), zero.alias("early"), none.alias("b_n"), candidates.alias("_scores"))
    scored = from_terms.unionByName(from_pairs).unionByName(blank).where(F.size("_scores") > 0).repartition(id_col)
    return (
        scored.select(id_col, "u_n", "early", "b_n", F.inline("_scores").alias("scored_topic", "s", "p"))
        .groupBy(id_col, "scored_topic")
        .agg(
            F.sum(F.col("u_n") * F.col("s")).alias("u"), F.sum("u_n").alias("u_n"), F.sum(F.col("early") * F.col("p")).alias("p"),
            F.sum(F.col("b_n") * F.col("s")).alias("b"), F.sum("b_n").alias("b_n"),
        )
    )


def _document_scores(sums):
    def mean(total, count):
        return F.when(F.col(count) > 0, F.col(total) / F.greatest(F.col(count), F.lit(1))).otherwise(F.lit(0.0))

    parts = {"unigram_score": mean("u", "u_n"), "bigram_score": mean("b", "b_n"), "positional_score": mean("p", "u_n")}
    scored = sums.withColumns(parts)
    total = reduce(add, [w * F.col(c) for c, w in K.DOCUMENT_WEIGHTS.items()])
    return scored.withColumn("custom_score", total).withColumns(
        {"matched_unigram_count": F.col("u_n"), "matched_bigram_count": F.col("b_n")}
    )


SCORES = ["unigram_score", "bigram_score", "positional_score", "custom_score"]
MATCHES = ["matched_unigram_count", "matched_bigram_count"]


def _document_columns():
    return [settled(c, 6).alias(f"document_{c}") for c in SCORES] + [F.col(c) for c in MATCHES]


def own_topic_scores(docs, scored_terms, scored_bigrams, token_array="tokens", topic=TOPIC, id_col=ID):
    """Each document against its own topic's tables: for description, not for classifiers."""
    sums = _document_sums(docs, scored_terms, scored_bigrams, token_array, topic, id_col, True)
    return _document_scores(sums).select(id_col, F.col("scored_topic").alias(topic), *_document_columns())


def best_topic_scores(docs, scored_terms, scored_bigrams, token_array="tokens", topic=TOPIC, id_col=ID):
    """Each document against every topic, keeping the best; the first topic wins ties.

    The document's own topic plays no part, so the scores may feed a classifier.
    """
    scored = _document_scores(_document_sums(docs, scored_terms, scored_bigrams, token_array, topic, id_col, False))
    order = F.struct(-F.round("custom_score", 9), F.col("scored_topic"))
    kept = [*SCORES, *MATCHES]
    best = scored.groupBy(id_col).agg(F.min_by(F.struct(*kept), order).alias("_best"))
    return best.select(id_col, "_best.*").select(id_col, *_document_columns())


def all_topic_scores(docs, scored_terms, scored_bigrams, topics, token_array="tokens", topic=TOPIC, id_col=ID):
    """Each document against every topic, one group of six columns per topic slug."""
    scored = _document_scores(_document_sums(docs, scored_terms, scored_bigrams, token_array, topic, id_col, False))
    slugs = sorted({_python_slug(t) for t in topics})
    wide = scored.withColumn("_slug", slug("scored_topic")).groupBy(id_col).pivot("_slug", slugs)
    return wide.agg(
        *[settled(F.first(c), 6).alias(c) for c in SCORES], *[F.first(c).alias(c) for c in MATCHES]
    )


def _python_slug(name):
    return "_".join("".join(ch if ch.isascii() and ch.isalnum() else " " for ch in name.lower()).split())


def score_summary(scored, topic=TOPIC, id_col=ID):
    """Mean and best document scores per topic."""
    return scored.groupBy(topic).agg(
        F.count(id_col).alias("document_count"),
        settled(F.avg("document_custom_score"), 6).alias("mean_document_custom_score"),
        settled(F.max("document_custom_score"), 6).alias("max_document_custom_score"),
        settled(F.avg("document_unigram_score"), 6).alias("mean_document_unigram_score"),
        settled(F.avg("document_bigram_score"), 6).alias("mean_document_bigram_score"),
        settled(F.avg("document_positional_score"), 6).alias("mean_document_positional_score"),
    )


def split_score_summary(scored, split="split", id_col=ID):
    """Mean scores and matches per split, and the share of documents without a match."""
    return scored.groupBy(split).agg(
        F.count(id_col).alias("document_count"),
        settled(F.avg("document_custom_score"), 4).alias("mean_document_custom_score"),
        settled(F.avg("matched_unigram_count"), 4).alias("mean_matched_unigram_count"),
        settled(F.avg("matched_bigram_count"), 4).alias("mean_matched_bigram_count"),
        F.round(F.avg((F.col("matched_unigram_count") == 0).cast("int")) * 100, 2).alias("pct_zero_unigram_match"),
    )
