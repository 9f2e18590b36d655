"""Term and bigram statistics on the long form (document, term, count).

A document-term matrix is a table here. `prepare` keeps each document's tokens
as an array, `term_counts` explodes it once, and every statistic is an
aggregate of that table, reduced in the map tasks before it shuffles. A term or
topic that holds a third of all rows therefore costs one row per task, and the
lookups by term leave hot terms to AQE's skew-join splitting. The vocabulary
grows with the data, so it is never marked for broadcast: Spark broadcasts it
only when its measured size allows. Tables of one row a topic are always
broadcast: a shuffle by topic would sort all terms of a topic in one task.
"""


from pyspark.sql import Window
from pyspark.sql import functions as F

from lexitally import constants as K
from lexitally.functions.guards import row_count
from lexitally.functions.numbers import settled
from lexitally.functions.text import content_tokens, long_tokens, ngrams, not_blank
from lexitally.session import stored

ID, TOPIC, TERM = "post_id", "topic", "term"


def prepare(df, text="text_clean", stop_words=K.TOPIC_STOP_WORDS):
    """Add the stop-word-free text and its word count; the source text stays."""
    kept = df.withColumn("_tokens", content_tokens(text, stop_words))
    return kept.withColumns(
        {
            "text_no_stopwords": F.array_join("_tokens", " "),
            "word_count_no_stopwords": F.size("_tokens"),
        }
    ).drop("_tokens")


def with_tokens(df, text="text_no_stopwords", topic=TOPIC, name="tokens"):
    """Drop blank rows and split the prepared text."""
    return df.where(not_blank(text, topic)).withColumn(name, F.split(text, " "))


def term_counts(docs, token_array="tokens", keys=(ID, TOPIC)):
    """(keys, term, tf): one row per document and distinct term."""
    return (
        docs.select(*keys, F.explode(token_array).alias(TERM))
        .groupBy(*keys, TERM)
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def ngram_counts(docs, ngram_range=(1, 1), token_array="tokens", keys=(ID, TOPIC)):
    """Counts of vectoriser n-grams: tokens of two or more characters, paired after that filter.

    Documents are shuffled by the first key, their id, as arrays, one row each. Counting their
    n-grams then needs no other shuffle, and all readers of the counts in one job share this one.
    """
    together = docs.select(*keys, F.col(token_array).alias("_tokens")).repartition(keys[0])
    return term_counts(together.withColumn("_ngrams", ngrams(long_tokens("_tokens"), ngram_range)), "_ngrams", keys)


# --- frequencies ---------------------------------------------------------------


def grouped_terms(docs, token_array="tokens", keys=(TOPIC,), **amounts):
    """Per (keys, term): occurrences `tf`, documents `df` and the given sums, from one scan and one shuffle.

    A document's tokens are followed by its distinct ones in one array, so a row is
    either an occurrence (`_pos` is its place) or, at `_pos >= _n`, a document.
    `amounts` are aggregates over these rows.
    """
    rows = docs.select("*", F.size(token_array).alias("_n"), F.posexplode(F.concat(token_array, F.array_distinct(token_array))).alias("_pos", TERM))
    here = F.col("_pos") < F.col("_n")
    return rows.groupBy(*keys, TERM).agg(F.count_if(here).alias("tf"), F.count_if(~here).alias("df"), *[a.alias(name) for name, a in amounts.items()])


def corpus_frequency(docs, token_array="tokens"):
    """Count and relative frequency of every token."""
    counts = docs.select(F.explode(token_array).alias(TERM)).groupBy(TERM).agg(
        F.count(F.lit(1)).alias("corpus_term_count")
    )
    total = docs.agg(F.sum(F.size(token_array))).scalar()
    return counts.withColumn("corpus_term_freq", F.round(F.col("corpus_term_count") / total, 6))


def every_topic(docs, topic=TOPIC):
    """All topics with their documents as one sorted array, for results that have a row per topic and term."""
    sizes = docs.groupBy(topic).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.array_sort(F.collect_list(F.struct(F.col(topic).alias("t"), "n")))).scalar()


def for_every_topic(sums, topics, key, topic=TOPIC, shared=()):
    """Rows (topic, key, sums) with rows of zeros for the topics a key lacks, and `topic_doc_count`; `shared` columns are a key's own.

    In the order of topics every row brings the topics between it and the row before;
    the last one brings those after it as well. Nothing is joined or grouped.
    """
    amounts = [c for c in sums.columns if c not in (topic, key)]
    inside = Window.partitionBy(key).orderBy(topic)
    placed = sums.withColumn("_every", topics).withColumn("_at", F.array_position(F.transform("_every", lambda x: x["t"]), F.col(topic)))
    first = F.coalesce(F.lag("_at").over(inside), F.lit(0)) + 1
    last = F.when(F.lead("_at").over(inside).isNull(), F.size("_every")).otherwise(F.col("_at"))
    rows = placed.withColumns({"_first": first, "_last": last}).select(
        "*", F.explode(F.slice("_every", F.col("_first").cast("int"), (F.col("_last") - F.col("_first") + 1).cast("int"))).alias("_x")
    )
    own = F.col("_x.t") == F.col(topic)
    return rows.select(
        F.col("_x.t").alias(topic), key, F.col("_x.n").alias("topic_doc_count"),
        *shared, *[F.when(own, F.col(c)).otherwise(F.lit(0).cast(dict(sums.dtypes)[c])).alias(c) for c in amounts if c not in shared],
    )


def topic_terms(docs, token_array="tokens", topic=TOPIC, label=None, labels=K.LABELS, store=stored):
    """Everything that is counted per topic and term, as one stored table.

    (topic, term, tf, df, early, n_<label>): occurrences, documents, the sum of
    1/(position+1) and, with `label`, documents per label. One scan of the tokens.
    """
    here, early = F.col("_pos") < F.col("_n"), 1 / (F.col("_pos") + 1)
    by_label = {f"n_{x}": F.count_if((F.col("_pos") >= F.col("_n")) & (F.col(label) == x)) for x in labels} if label else {}
    columns = docs.select(topic, token_array, *([label] if label else []))
    return store(grouped_terms(columns, token_array, (topic,), early=F.sum(F.when(here, early)), **by_label), "topic-terms")


def topic_term_stats(docs, token_array="tokens", topic=TOPIC, terms=None, store=stored):
    """Counts, frequencies and lift of every token in every topic it occurs in; `terms` is a table of `topic_terms`."""
    terms = topic_terms(docs, token_array, topic, store=store) if terms is None else terms
    sums = terms.groupBy(topic).agg(F.sum("tf").alias("_tokens"))
    sizes = docs.groupBy(topic).agg(F.count(F.lit(1)).alias("topic_doc_count"))
    total = terms.agg(F.sum("tf")).scalar()
    counts = terms.select(topic, TERM, F.col("tf").alias("topic_term_count"), F.sum("tf").over(Window.partitionBy(TERM)).alias("corpus_term_count"))
    share, overall = F.col("topic_term_count") / F.col("_tokens"), F.col("corpus_term_count") / total
    return counts.join(F.broadcast(sizes.join(sums, topic)), topic).select(
        topic, TERM, "topic_term_count", "corpus_term_count", "topic_doc_count",
        F.round(share, 6).alias("topic_term_freq"), F.round(overall, 6).alias("corpus_term_freq"),
        F.round(share / overall, 4).alias("topic_specific_ratio"),
    )


# --- ranking -------------------------------------------------------------------


def top_n(df, n, score, by=(TOPIC,), tie=TERM, rank="rank"):
    """Best n rows per group, ties alphabetical; limited per map task before it shuffles."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), tie)
    return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= n)


def top_n_overall(df, n, score, tie=TERM, rank="rank"):
    """Best n rows of the table with their rank; only n rows reach the last task."""
    best = df.orderBy(F.desc(score), tie).limit(n)
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc(score), tie)
    return best.withColumn(rank, F.row_number().over(order))


def rerank(df, score, by=(), tie=TERM, rank="rank"):
    """New ranks for what is left of an already short table."""
    order = Window.partitionBy(*(by or [F.lit(1)])).orderBy(F.desc(score), tie)
    return df.drop(rank).withColumn(rank, F.row_number().over(order))


def min_max_within(df, columns, by=TOPIC, digits=6, store=stored):
    """Scale columns to [0, 1] within a group as `<column>_norm`; a constant group gives 0.

    Extremes come from an aggregate, a row a group, broadcast back and not from a window,
    so a large group never has to fit one task. The input is stored first, as it is read twice.
    """
    df = store(df, "unscaled")
    extremes = df.groupBy(by).agg(
        *[F.min(c).alias(f"_lo_{c}") for c in columns], *[F.max(c).alias(f"_hi_{c}") for c in columns]
    )
    joined = df.join(F.broadcast(extremes), by)
    scaled = {}
    for c in columns:
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        scaled[f"{c}_norm"] = F.when(hi == lo, F.lit(0.0)).otherwise(settled((F.col(c) - lo) / (hi - lo), digits))
    return joined.withColumns(scaled).drop(*[f"_{side}_{c}" for side in ("lo", "hi") for c in columns])


# --- vocabulary and TF-IDF -----------------------------------------------------


def vocabulary(pairs, docs, min_df=K.MIN_DF, max_df=K.MAX_DF, by=()):
    """Terms with min_df <= df <= max_df * documents, with df and the document count n.

    `by` fits one vocabulary per group, whose document counts are joined; without
    groups the count is a scalar.
    """
    df_ = pairs.groupBy(*by, TERM).agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_df)
    if by:
        df_ = df_.join(F.broadcast(docs.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))), list(by))
    else:
        df_ = df_.withColumn("n", row_count(docs))
    return df_ if max_df is None else df_.where(F.col("df") <= F.col("n") * max_df)


def bag_of_words(pairs, vocab, by=()):
    """Raw counts of the terms in the vocabulary, as `value`."""
    return pairs.join(vocab.select(*by, TERM), [*by, TERM]).withColumnRenamed("tf", "value")


def tfidf(pairs, vocab, by=(), id_col=ID):
    """tf * (ln((1+n)/(1+df)) + 1) over the vocabulary, each document scaled to length 1."""
    idf = F.ln((1 + F.col("n")) / (1 + F.col("df"))) + 1
    raw = pairs.join(vocab.select(*by, TERM, idf.alias("idf")), [*by, TERM]).withColumn(
        "value", F.col("tf") * F.col("idf")
    )
    length = F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy(id_col)))
    return raw.withColumn("value", F.col("value") / length).drop("tf", "idf")


def l2_normalise(features, id_col=ID):
    """Scale each row's values to length 1; rows of zeros stay zero."""
    length = F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy(id_col)))
    return features.withColumn("value", F.when(length > 0, F.col("value") / length).otherwise(F.lit(0.0)))


def corpus_vocabulary(docs, ngram_range=(1, 1), token_array="tokens", min_df=K.MIN_DF, max_df=K.MAX_DF):
    """(term, df, n) of a whole corpus: documents are counted by their distinct terms, without counting terms inside them."""
    present = docs.select(F.explode(F.array_distinct(ngrams(long_tokens(token_array), ngram_range))).alias(TERM))
    df_ = present.groupBy(TERM).agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_df).withColumn("n", row_count(docs))
    return df_ if max_df is None else df_.where(F.col("df") <= F.col("n") * max_df)


def topic_vs_rest_tfidf(docs, ngram_range=(1, 1), token_array="tokens", topic=TOPIC, id_col=ID, min_df=K.MIN_DF, max_df=K.MAX_DF):
    """Mean TF-IDF of every vocabulary term in a topic and in all others, and their ratio.

    Means run over all documents, those without the term included, and every
    term has a row for every topic. A term found in one topic only has ratio
    infinity there. Occurrences meet the vocabulary before they are counted, so terms
    outside it are never shuffled.
    """
    topics = every_topic(docs, topic)
    vocab = corpus_vocabulary(docs, ngram_range, token_array, min_df, max_df)
    idf = F.ln((1 + F.col("n")) / (1 + F.col("df"))) + 1
    met = docs.select(id_col, topic, F.explode(ngrams(long_tokens(token_array), ngram_range)).alias(TERM)).join(vocab.select(TERM, idf.alias("idf")), TERM)
    # Rows of one document lie together from here on: counts and lengths share one shuffle.
    counted = met.repartition(id_col).groupBy(id_col, topic, TERM).agg((F.count(F.lit(1)) * F.first("idf")).alias("value"))
    length = F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy(id_col)))
    sums = counted.select(topic, TERM, (F.col("value") / length).alias("value")).groupBy(topic, TERM).agg(F.sum("value").alias("w"))
    of_term = Window.partitionBy(TERM).orderBy(topic).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # one sort with for_every_topic
    whole = sums.withColumns({"_all": F.sum("w").over(of_term), "_topics": F.count_if(F.col("w") > 0).over(of_term)})
    # A row of zeros needs its term's totals: they are the same in every row, so zeros take them from the row that brings them.
    rows = for_every_topic(whole.withColumn("_term", F.struct("_all", "_topics")).drop("_all", "_topics"), topics, TERM, topic, shared=("_term",))
    n = row_count(docs)
    others = n - F.col("topic_doc_count")
    here, total, held = F.col("w"), F.col("_term._all"), F.col("_term._topics")
    rest = F.when(held == (here > 0).cast("int"), F.lit(0.0)).otherwise((total - here) / F.greatest(others, F.lit(1)))
    rows = rows.select(topic, TERM, (here / F.col("topic_doc_count")).alias("_here"), rest.alias("_rest"), "topic_doc_count", others.alias("other_doc_count"))
    here, rest = F.col("_here"), F.col("_rest")
    ratio = (
        F.when(rest > 0, F.round(here / F.when(rest > 0, rest), 4))
        .when(here > 0, F.lit(float("inf")))
        .otherwise(F.lit(0.0))
    )
    return rows.select(
        topic,
        TERM,
        F.round(here, 6).alias("mean_tfidf_in_topic"),
        F.round(rest, 6).alias("mean_tfidf_in_other"),
        ratio.alias("topic_distinctiveness_ratio"),
        F.col("topic_doc_count").cast("long").alias("topic_doc_count"),
        F.col("other_doc_count").cast("long").alias("other_doc_count"),
    )


def local_tfidf(docs, ngram_range=(1, 1), token_array="tokens", topic=TOPIC, id_col=ID, min_df=K.MIN_DF, max_df=K.MAX_DF):
    """Mean TF-IDF with vocabulary, df and idf fitted inside each topic."""
    pairs = ngram_counts(docs, ngram_range, token_array, (id_col, topic))
    weights = tfidf(pairs, vocabulary(pairs, docs, min_df, max_df, by=(topic,)), by=(topic,), id_col=id_col)
    sums = weights.groupBy(topic, TERM).agg(F.sum("value").alias("w"))
    sizes = docs.groupBy(topic).agg(F.count(F.lit(1)).alias("topic_doc_count"))
    return sums.join(F.broadcast(sizes), topic).select(
        topic, TERM, F.round(F.col("w") / F.col("topic_doc_count"), 6).alias("mean_tfidf_local"), "topic_doc_count"
    )


# --- bigrams -------------------------------------------------------------------


def long_ngrams(docs, ngram_range=(2, 2), token_array="tokens", keys=(TOPIC,)):
    """Documents as (keys, _ngrams): vectoriser n-grams of tokens of two or more characters."""
    return docs.select(*keys, ngrams(long_tokens(token_array), ngram_range).alias("_ngrams"))


def bigram_frequency(docs, token_array="tokens", topic=TOPIC, min_df=K.MIN_DF, max_df=K.MAX_DF, store=stored):
    """Counts, shares and document ratios of every retained bigram in every topic, zeros included."""
    counts = grouped_terms(long_ngrams(docs, (2, 2), token_array, (topic,)), "_ngrams", (topic,)).withColumnRenamed(TERM, "bigram")
    held = counts.withColumn("_held", F.sum("df").over(Window.partitionBy("bigram")))  # a row a topic
    kept = store(held.where((F.col("_held") >= min_df) & (F.col("_held") <= row_count(docs) * max_df)).drop("_held"), "bigram-counts")
    totals = kept.groupBy(topic).agg(F.sum("tf").alias("_total"))
    rows = for_every_topic(kept, every_topic(docs, topic), "bigram", topic).join(F.broadcast(totals), topic, "left")
    share = F.when(F.col("_total") > 0, F.col("tf") / F.greatest("_total", F.lit(1))).otherwise(F.lit(0.0))
    return rows.select(
        topic, "bigram", F.col("tf").alias("bigram_count"), F.round(share, 6).alias("bigram_freq"), F.col("df").alias("bigram_doc_freq"),
        F.round(F.col("df") / F.col("topic_doc_count"), 6).alias("bigram_doc_ratio"), "topic_doc_count",
    )


def bigram_coverage(docs, token_array="tokens", topic=TOPIC, id_col=ID, min_df=K.MIN_DF, max_df=K.MAX_DF):
    """Documents per topic with at least one retained bigram."""
    pairs = ngram_counts(docs, (2, 2), token_array, (id_col, topic))
    vocab = vocabulary(pairs, docs, min_df, max_df).select(TERM)
    covered = pairs.join(vocab, TERM, "left_semi").groupBy(topic, id_col).agg(F.lit(1).alias("_one"))
    per_topic = covered.groupBy(topic).agg(F.count(F.lit(1)).alias("docs_with_bigram"))
    sizes = docs.groupBy(topic).agg(F.count(F.lit(1)).alias("topic_doc_count"))
    hit = F.coalesce(F.col("docs_with_bigram"), F.lit(0))
    return sizes.join(per_topic, topic, "left").select(
        topic,
        "topic_doc_count",
        hit.alias("docs_with_bigram"),
        F.round(100 * hit / F.col("topic_doc_count"), 2).alias("bigram_doc_coverage_pct"),
        F.coalesce(row_count(vocab), F.lit(0)).alias("retained_bigram_count"),
    )


def frequent_bigrams(docs, token_array="tokens", min_df=K.MIN_DF, n=K.TOP_BIGRAMS):
    """Most frequent bigrams overall, found in at least min_df documents."""
    counts = grouped_terms(long_ngrams(docs, (2, 2), token_array, ()), "_ngrams", ())
    kept = counts.where(F.col("df") >= min_df).select(F.col(TERM).alias("bigram"), F.col("tf").alias("frequency"))
    return top_n_overall(kept, n, "frequency", "bigram")


def frequent_bigrams_by_class(docs, label, token_array="tokens", min_df=K.MIN_DF, n=K.TOP_BIGRAMS_PER_CLASS):
    """Most frequent bigrams per class, each class with its own vocabulary."""
    counts = grouped_terms(long_ngrams(docs, (2, 2), token_array, (label,)), "_ngrams", (label,))
    kept = counts.where(F.col("df") >= min_df).select(label, F.col(TERM).alias("bigram"), F.col("tf").alias("frequency"))
    return top_n(kept, n, "frequency", (label,), "bigram")


def rank_comparison(by_tfidf, by_count, n=K.TOP_TERMS, topic=TOPIC):
    """TF-IDF rank against frequency rank for the top terms; a term outside the other list has rank 0."""
    left = top_n(by_tfidf, n, "mean_tfidf_in_topic", (topic,), rank="tfidf_rank")
    right = top_n(by_count, n, "topic_term_count", (topic,), rank="frequency_rank")
    ranks = right.select(topic, TERM, "topic_term_count", "frequency_rank")
    joined = left.select(topic, TERM, "mean_tfidf_in_topic", "tfidf_rank").join(ranks, [topic, TERM], "left")
    filled = joined.withColumn("frequency_rank", F.coalesce("frequency_rank", F.lit(0)))
    return filled.withColumn("rank_difference", F.col("frequency_rank") - F.col("tfidf_rank"))
