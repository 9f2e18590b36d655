"""Term, bigram and TF-IDF statistics and custom scores over documents by language."""

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.relational import sql_split
from catalog.tables import LANGS, SQL_CORPUS, SQL_LABELS, corpus, features, labelled, scored_posts, sql_list, sql_with
from lexitally import constants as K
from lexitally.functions.text import is_informative_bigram
from lexitally.operators import scoring as S
from lexitally.operators import terms as T
from lexitally.operators.split import stratified_split
from lexitally.operators.terms import with_tokens
from lexitally.plans.modeling import topic_features

TOPIC_ARRAY = "tops AS (SELECT topic, count(*) AS topic_doc_count FROM {src} GROUP BY topic)"


def sql_stats(src="kept", p=""):
    """CTE {p}stats: term counts and lift per topic."""
    return f"""
{p}tk AS (SELECT topic, unnest(toks) AS term FROM {src}),
{p}tc AS (SELECT topic, term, count(*) AS c FROM {p}tk GROUP BY ALL),
{p}tt AS (SELECT topic, count(*) AS topic_doc_count, sum(len(toks)) AS total FROM {src} GROUP BY topic),
{p}ct AS (SELECT term, sum(c) AS cc FROM {p}tc GROUP BY term),
{p}ca AS (SELECT sum(total) AS total FROM {p}tt),
{p}stats AS (SELECT tc.topic, tc.term, c AS topic_term_count, cc::BIGINT AS corpus_term_count, topic_doc_count,
  round(c / tt.total::DOUBLE, 6) AS topic_term_freq, round(cc / ca.total::DOUBLE, 6) AS corpus_term_freq,
  round((c / tt.total::DOUBLE) / (cc / ca.total::DOUBLE), 4) AS topic_specific_ratio
  FROM {p}tc tc JOIN {p}tt tt USING (topic) JOIN {p}ct USING (term) CROSS JOIN {p}ca ca)"""


GRAMS = {1: "vt", 2: "list_transform(range(1, len(vt)), lambda i: vt[i] || ' ' || vt[i + 1])"}


def sql_weights(n=1, src="kept", p="", local=False):
    """CTEs {p}pairs, {p}vocab and {p}w: n-gram counts, pruned vocabulary, unit-length TF-IDF."""
    by = "topic, " if local else ""
    on = "(topic, term)" if local else "(term)"
    size = f"(SELECT topic, count(*) AS n FROM {src} GROUP BY topic)" if local else f"(SELECT count(*) AS n FROM {src})"
    join = "JOIN {0} z USING (topic)".format(size) if local else f"CROSS JOIN {size} z"
    return f"""
{p}pairs AS (SELECT post_id, topic, term, count(*) AS tf FROM (SELECT post_id, topic, unnest({GRAMS[n]}) AS term FROM {src}) GROUP BY ALL),
{p}df AS (SELECT {by}term, count(*) AS df FROM {p}pairs GROUP BY ALL),
{p}vocab AS (SELECT {by}term, df, n FROM {p}df {join} WHERE df >= 2 AND df <= 0.9e0 * n),
{p}raw AS (SELECT post_id, topic, term, tf, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS v FROM {p}pairs JOIN {p}vocab USING {on}),
{p}w AS (SELECT post_id, topic, term, tf, v / sqrt(sum(v * v) OVER (PARTITION BY post_id)) AS value FROM {p}raw)"""


def sql_vs_rest(n=1, src="kept", p=""):
    """CTE {p}tv: topic-vs-rest means with the ratio, zeros filled in."""
    return sql_weights(n, src, p) + f""",
{p}tops AS (SELECT topic, count(*) AS d FROM {src} GROUP BY topic),
{p}tall AS (SELECT sum(d) AS n FROM {p}tops),
{p}s AS (SELECT topic, term, sum(value) AS w FROM {p}w GROUP BY ALL),
{p}g AS (SELECT t.topic, t.d, v.term, coalesce(s.w, 0) AS w FROM {p}tops t CROSS JOIN {p}vocab v LEFT JOIN {p}s s ON s.topic = t.topic AND s.term = v.term),
{p}m AS (SELECT a.topic, a.term, a.d, n - a.d AS o, a.w / a.d AS here, (SELECT coalesce(sum(b.w), 0) FROM {p}s b WHERE b.term = a.term AND b.topic <> a.topic) / (n - a.d) AS rest FROM {p}g a CROSS JOIN {p}tall),
{p}tv AS (SELECT topic, term, round(here, 6) AS mean_tfidf_in_topic, round(rest, 6) AS mean_tfidf_in_other,
  CASE WHEN rest > 0 THEN round(here / rest, 4) WHEN here > 0 THEN 'inf'::DOUBLE ELSE 0 END AS topic_distinctiveness_ratio, d AS topic_doc_count, o::BIGINT AS other_doc_count FROM {p}m)"""


def top(df, n, score, by, tie, rank="rank"):
    return T.top_n(df, n, score, by, tie, rank).withColumn(rank, F.col(rank).cast("long"))


# --- frequencies ----------------------------------------------------------------------------


@query("G1_corpus_term_frequency", sql_with(SQL_CORPUS, "SELECT term, count(*) AS corpus_term_count, round(count(*) / (SELECT count(*) FROM tok)::DOUBLE, 6) AS corpus_term_freq FROM tok GROUP BY term"))
def corpus_frequency(spark, sf):
    return T.corpus_frequency(corpus(spark, sf))


@query("G2_topic_term_stats", sql_with(SQL_CORPUS, sql_stats(), "SELECT * FROM stats"))
def topic_term_stats(spark, sf):
    return T.topic_term_stats(corpus(spark, sf))


@query("F1_top_terms_per_topic", sql_with(SQL_CORPUS, sql_stats(), "SELECT topic, term, topic_term_count, row_number() OVER (PARTITION BY topic ORDER BY topic_term_count DESC, term) AS rank FROM stats QUALIFY rank <= 20"))
def top_terms(spark, sf):
    return top(T.topic_term_stats(corpus(spark, sf)), 20, "topic_term_count", ("topic",), "term").select("topic", "term", "topic_term_count", "rank")


@query(
    "F6_min_max_within_topic",
    sql_with(SQL_CORPUS, sql_stats(), "x AS (SELECT topic, term, topic_term_freq, min(topic_term_freq) OVER (PARTITION BY topic) AS lo, max(topic_term_freq) OVER (PARTITION BY topic) AS hi FROM stats)", "SELECT topic, term, CASE WHEN lo = hi THEN 0 ELSE round((topic_term_freq - lo) / (hi - lo), 6) END AS topic_term_freq_norm FROM x"),
)
def min_max(spark, sf):
    return T.min_max_within(T.topic_term_stats(corpus(spark, sf)), ["topic_term_freq"]).select("topic", "term", "topic_term_freq_norm")


# --- vocabulary, TF-IDF -----------------------------------------------------------------------


@query("G3_vocabulary", sql_with(SQL_CORPUS, sql_weights(), "SELECT term, df, n FROM vocab"))
def vocabulary(spark, sf):
    docs = corpus(spark, sf)
    return T.vocabulary(T.ngram_counts(docs), docs)


@query(
    "G4_bag_of_words",
    sql_with(
        SQL_CORPUS, sql_split("kept", "topic"), "fit AS (SELECT * FROM parted WHERE split = 'train')", sql_weights(1, "fit"),
        "SELECT post_id, split, term, count(*) AS value FROM (SELECT post_id, split, unnest(vt) AS term FROM parted) SEMI JOIN vocab USING (term) GROUP BY ALL",
    ),
)
def bag_of_words(spark, sf):
    docs = stratified_split(corpus(spark, sf), "post_id", "topic")
    pairs = T.ngram_counts(docs, keys=("post_id", "split"))
    in_train = F.col("split") == "train"
    return T.bag_of_words(pairs, T.vocabulary(pairs.where(in_train), docs.where(in_train)))


@query("G5_tfidf", sql_with(SQL_CORPUS, sql_weights(), "SELECT post_id, topic, term, round(value, 9) AS value FROM w"))
def tfidf(spark, sf):
    docs = corpus(spark, sf)
    pairs = T.ngram_counts(docs)
    return T.tfidf(pairs, T.vocabulary(pairs, docs)).select("post_id", "topic", "term", F.round("value", 9).alias("value"))


@query("G6_topic_vs_rest_tfidf", sql_with(SQL_CORPUS, sql_vs_rest(), "SELECT * FROM tv"))
def vs_rest(spark, sf):
    return T.topic_vs_rest_tfidf(corpus(spark, sf))


def _sql_local(n):
    return sql_with(SQL_CORPUS, sql_weights(n, local=True), TOPIC_ARRAY.format(src="kept"), "SELECT topic, term, round(sum(value) / topic_doc_count, 6) AS mean_tfidf_local, topic_doc_count FROM w JOIN tops USING (topic) GROUP BY topic, term, topic_doc_count")


@query("G7_local_tfidf", _sql_local(1))
def local(spark, sf):
    return T.local_tfidf(corpus(spark, sf))


@query("G10_bigram_local_tfidf", _sql_local(2))
def bigram_local(spark, sf):
    return T.local_tfidf(corpus(spark, sf), (2, 2))


@query("G9_bigram_topic_vs_rest_tfidf", sql_with(SQL_CORPUS, sql_vs_rest(2), "SELECT * FROM tv"))
def bigram_vs_rest(spark, sf):
    return T.topic_vs_rest_tfidf(corpus(spark, sf), (2, 2))


@query(
    "G8_bigram_frequency",
    sql_with(
        SQL_CORPUS, sql_weights(2), TOPIC_ARRAY.format(src="kept"),
        "s AS (SELECT topic, term, sum(tf) AS c, count(*) AS d FROM pairs JOIN vocab USING (term) GROUP BY ALL)",
        "tt AS (SELECT topic, sum(c) AS total FROM s GROUP BY topic)",
        "g AS (SELECT t.topic, t.topic_doc_count, v.term, coalesce(c, 0) AS c, coalesce(d, 0) AS d FROM tops t CROSS JOIN vocab v LEFT JOIN s ON s.topic = t.topic AND s.term = v.term)",
        "SELECT topic, term AS bigram, c::BIGINT AS bigram_count, coalesce(round(c / total::DOUBLE, 6), 0) AS bigram_freq, d AS bigram_doc_freq, round(d / topic_doc_count, 6) AS bigram_doc_ratio, topic_doc_count FROM g LEFT JOIN tt USING (topic)",
    ),
)
def bigram_frequency(spark, sf):
    return T.bigram_frequency(corpus(spark, sf))


@query(
    "G11_bigram_coverage",
    sql_with(
        SQL_CORPUS, sql_weights(2), TOPIC_ARRAY.format(src="kept"),
        "h AS (SELECT topic, count(DISTINCT post_id) AS k FROM pairs JOIN vocab USING (term) GROUP BY topic)",
        "SELECT topic, topic_doc_count, coalesce(k, 0) AS docs_with_bigram, round(100 * coalesce(k, 0) / topic_doc_count, 2) AS bigram_doc_coverage_pct, (SELECT count(*) FROM vocab) AS retained_bigram_count FROM tops LEFT JOIN h USING (topic)",
    ),
)
def coverage(spark, sf):
    return T.bigram_coverage(corpus(spark, sf))


@query(
    "G12_D4_rank_comparison",
    sql_with(
        SQL_CORPUS, sql_stats(), sql_vs_rest(),
        "a AS (SELECT topic, term, mean_tfidf_in_topic, row_number() OVER (PARTITION BY topic ORDER BY mean_tfidf_in_topic DESC, term) AS tfidf_rank FROM tv QUALIFY tfidf_rank <= 20)",
        "b AS (SELECT topic, term, topic_term_count, row_number() OVER (PARTITION BY topic ORDER BY topic_term_count DESC, term) AS frequency_rank FROM stats QUALIFY frequency_rank <= 20)",
        "SELECT topic, term, mean_tfidf_in_topic, tfidf_rank::INTEGER AS tfidf_rank, topic_term_count, coalesce(frequency_rank, 0)::INTEGER AS frequency_rank, (coalesce(frequency_rank, 0) - tfidf_rank)::INTEGER AS rank_difference FROM a LEFT JOIN b USING (topic, term)",
    ),
)
def ranks(spark, sf):
    docs = corpus(spark, sf)
    return T.rank_comparison(T.topic_vs_rest_tfidf(docs), T.topic_term_stats(docs))


# --- frequent bigrams --------------------------------------------------------------------------

BIGRAM_COUNTS = "bc AS (SELECT term AS bigram, sum(tf)::BIGINT AS frequency FROM pairs GROUP BY term HAVING count(*) >= 2)"
CLASS_COUNTS = "bc AS (SELECT topic, term AS bigram, sum(tf)::BIGINT AS frequency FROM pairs GROUP BY topic, term HAVING count(*) >= 2)"


@query("G13_frequent_bigrams", sql_with(SQL_CORPUS, sql_weights(2), BIGRAM_COUNTS, "SELECT bigram, frequency, row_number() OVER (ORDER BY frequency DESC, bigram)::INTEGER AS rank FROM bc QUALIFY rank <= 30"))
def frequent_bigrams(spark, sf):
    return T.frequent_bigrams(corpus(spark, sf))


@query("G13_frequent_bigrams_by_class", sql_with(SQL_CORPUS, sql_weights(2), CLASS_COUNTS, "SELECT topic, bigram, frequency, row_number() OVER (PARTITION BY topic ORDER BY frequency DESC, bigram)::INTEGER AS rank FROM bc QUALIFY rank <= 15"))
def frequent_by_class(spark, sf):
    return T.frequent_bigrams_by_class(corpus(spark, sf), "topic")


# The filter has something to drop only where stop words are still in the text.
SQL_FULL = SQL_CORPUS + ",\nfull_text AS (SELECT post_id, topic, list_filter(string_split(text_clean, ' '), lambda x: length(x) >= 2) AS vt FROM kept)"


def full_text(spark, sf):
    return with_tokens(features(spark, sf)).withColumn("tokens", F.array_remove(F.split("text_clean", " "), "")).select("post_id", "topic", "tokens")


INFORMATIVE = f"bigram NOT IN ({sql_list(K.BIGRAM_NOISE_EXACT)}) AND split_part(bigram, ' ', 1) NOT IN ({sql_list(K.BIGRAM_NOISE_TOKENS)}) AND split_part(bigram, ' ', 2) NOT IN ({sql_list(K.BIGRAM_NOISE_TOKENS)})"


@query("F5_filtered_bigrams", sql_with(SQL_FULL, sql_weights(2, "full_text"), BIGRAM_COUNTS, "t AS (SELECT * FROM bc ORDER BY frequency DESC, bigram LIMIT 30)", f"SELECT bigram, frequency, row_number() OVER (ORDER BY frequency DESC, bigram)::INTEGER AS rank FROM t WHERE {INFORMATIVE}"))
def filtered(spark, sf):
    return T.rerank(T.frequent_bigrams(full_text(spark, sf)).where(is_informative_bigram("bigram")), "frequency", (), "bigram")


@query("F5_filtered_bigrams_by_class", sql_with(SQL_FULL, sql_weights(2, "full_text"), CLASS_COUNTS, "t AS (SELECT * FROM bc QUALIFY row_number() OVER (PARTITION BY topic ORDER BY frequency DESC, bigram) <= 15)", f"SELECT topic, bigram, frequency, row_number() OVER (PARTITION BY topic ORDER BY frequency DESC, bigram)::INTEGER AS rank FROM t WHERE {INFORMATIVE}"))
def filtered_by_class(spark, sf):
    kept = T.frequent_bigrams_by_class(full_text(spark, sf), "topic").where(is_informative_bigram("bigram"))
    return T.rerank(kept, "frequency", ("topic",), "bigram")


# --- custom scores -------------------------------------------------------------------------------

SQL_LABELLED = SQL_CORPUS + "," + SQL_LABELS + ",\nld AS (SELECT kept.*, final_sentiment FROM kept JOIN lab USING (post_id))"


def sql_parts(src, p=""):
    """CTEs {p}pos and {p}sent: positional scores and sentiment association."""
    rates = ", ".join(f"count(*) FILTER (final_sentiment = '{x}') / count(*) AS p_{x}" for x in K.LABELS)
    gaps = ", ".join(f"abs(t_{x} - p_{x})" for x in K.LABELS)
    term_rates = ", ".join(f"count(*) FILTER (final_sentiment = '{x}') / count(*) AS t_{x}" for x in K.LABELS)
    return f"""
{p}pos AS (SELECT topic, term, avg(1e0 / (pos + 1)) AS positional_score FROM (SELECT topic, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM {src}) GROUP BY ALL),
{p}base AS (SELECT topic, {rates} FROM {src} GROUP BY topic),
{p}seen AS (SELECT topic, term, {term_rates} FROM (SELECT DISTINCT post_id, topic, final_sentiment, unnest(toks) AS term FROM {src}) GROUP BY topic, term),
{p}sent AS (SELECT topic, term, greatest({gaps}) AS sentiment_association_score FROM {p}seen JOIN {p}base USING (topic))"""


def rounded(x, digits):
    """Half up in decimals, after settling at nine digits."""
    return f"round(round({x}, 9)::DECIMAL(28, 9), {digits})::DOUBLE"


def _norm(c):
    scaled = rounded(f"({c} - min({c}) OVER t) / (max({c}) OVER t - min({c}) OVER t)", 6)
    return f"CASE WHEN max({c}) OVER t = min({c}) OVER t THEN 0e0 ELSE {scaled} END AS {c}_norm"


def sql_bigram_scores(src, p=""):
    return sql_vs_rest(2, src, p + "big_") + f""",
{p}b1 AS (SELECT topic, term AS bigram, mean_tfidf_in_topic AS bigram_tfidf_score, CASE WHEN isinf(topic_distinctiveness_ratio) THEN topic_doc_count ELSE topic_distinctiveness_ratio END AS bigram_distinctiveness FROM {p}big_tv),
{p}b2 AS (SELECT *, {_norm('bigram_tfidf_score')}, {_norm('bigram_distinctiveness')} FROM {p}b1 WINDOW t AS (PARTITION BY topic)),
{p}bs AS (SELECT *, {rounded("0.7e0 * bigram_tfidf_score_norm + 0.3e0 * bigram_distinctiveness_norm", 6)} AS custom_bigram_score FROM {p}b2),
{p}boost AS (SELECT topic, term, max(custom_bigram_score) AS bigram_boost_score FROM (SELECT topic, unnest(string_split(bigram, ' ')) AS term, custom_bigram_score FROM {p}bs) GROUP BY ALL)"""


def sql_term_scores(src, p=""):
    weights = " + ".join(f"{w}e0 * {c}_norm" for c, w in K.TERM_WEIGHTS.items())
    return ",".join([sql_bigram_scores(src, p), sql_stats(src, p), sql_vs_rest(1, src, p), sql_parts(src, p)]) + f""",
{p}j AS (SELECT st.topic, st.term, topic_term_count, topic_term_freq AS freq_score, topic_specific_ratio AS topic_specific_score, coalesce(mean_tfidf_in_topic, 0) AS tfidf_score,
  round(coalesce(sentiment_association_score, 0), 12) AS sentiment_association_score, round(coalesce(positional_score, 0), 12) AS positional_score, coalesce(bigram_boost_score, 0) AS bigram_boost_score
  FROM (SELECT * FROM {p}stats WHERE topic_term_count >= 2) st LEFT JOIN {p}tv USING (topic, term) LEFT JOIN {p}sent USING (topic, term) LEFT JOIN {p}pos USING (topic, term) LEFT JOIN {p}boost USING (topic, term)),
{p}n AS (SELECT *, {', '.join(_norm(c) for c in K.TERM_WEIGHTS)} FROM {p}j WINDOW t AS (PARTITION BY topic)),
{p}ts AS (SELECT *, {rounded(weights, 6)} AS custom_term_score FROM {p}n)"""


@query("G14_positional_scores", sql_with(SQL_LABELLED, sql_parts("ld"), "SELECT topic, term, round(positional_score, 9) AS positional_score FROM pos"))
def positional(spark, sf):
    return S.positional_scores(labelled(spark, sf)).withColumn("positional_score", F.round("positional_score", 9))


@query("G15_sentiment_association", sql_with(SQL_LABELLED, sql_parts("ld"), "SELECT topic, term, round(sentiment_association_score, 9) AS sentiment_association_score FROM sent"))
def association(spark, sf):
    return S.sentiment_association(labelled(spark, sf)).withColumn("sentiment_association_score", F.round("sentiment_association_score", 9))


@query("G17_bigram_scores", sql_with(SQL_LABELLED, sql_bigram_scores("ld"), "SELECT topic, bigram, bigram_tfidf_score_norm, bigram_distinctiveness_norm, custom_bigram_score FROM bs"))
def bigram_scores(spark, sf):
    scored = S.bigram_scores(T.topic_vs_rest_tfidf(labelled(spark, sf), (2, 2)))
    return scored.select("topic", "bigram", "bigram_tfidf_score_norm", "bigram_distinctiveness_norm", "custom_bigram_score")


@query("G16_bigram_boost", sql_with(SQL_LABELLED, sql_bigram_scores("ld"), "SELECT * FROM boost"))
def boost(spark, sf):
    return S.bigram_boost(S.bigram_scores(T.topic_vs_rest_tfidf(labelled(spark, sf), (2, 2))))


TERM_COLUMNS = ["topic", "term", "topic_term_count", *[f"{c}_norm" for c in K.TERM_WEIGHTS], "custom_term_score"]


@query("G18_D5_term_scores", sql_with(SQL_LABELLED, sql_term_scores("ld"), f"SELECT {', '.join(TERM_COLUMNS)} FROM ts"))
def term_scores(spark, sf):
    return S.fit_scores(labelled(spark, sf))[0].select(*TERM_COLUMNS)


@query("F1_top_custom_terms", sql_with(SQL_LABELLED, sql_term_scores("ld"), "SELECT topic, term, custom_term_score, row_number() OVER (PARTITION BY topic ORDER BY custom_term_score DESC, term) AS rank FROM ts QUALIFY rank <= 15"))
def top_custom(spark, sf):
    return top(S.fit_scores(labelled(spark, sf))[0], 15, "custom_term_score", ("topic",), "term").select("topic", "term", "custom_term_score", "rank")


def sql_scored(fit, docs):
    """CTE sc: scores and match counts of every (document, scored topic)."""
    return sql_term_scores(fit) + f""",
u AS (SELECT d.post_id, ts.topic AS st, avg(custom_term_score) AS us, avg(positional_score_norm / (pos + 1)) AS ps, count(*) AS un FROM (SELECT post_id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM {docs}) d JOIN ts USING (term) GROUP BY ALL),
bg AS (SELECT d.post_id, bs.topic AS st, avg(custom_bigram_score) AS bsc, count(*) AS bn FROM (SELECT post_id, unnest(list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1])) AS bigram FROM {docs}) d JOIN bs USING (bigram) GROUP BY ALL),
al AS (SELECT d.post_id, d.topic, x.st FROM {docs} d CROSS JOIN (SELECT DISTINCT topic AS st FROM {docs}) x),
sc AS (SELECT al.*, coalesce(us, 0) AS unigram_score, coalesce(bsc, 0) AS bigram_score, coalesce(ps, 0) AS positional_score, 0.55e0 * coalesce(us, 0) + 0.3e0 * coalesce(bsc, 0) + 0.15e0 * coalesce(ps, 0) AS custom_score,
  coalesce(un, 0) AS matched_unigram_count, coalesce(bn, 0) AS matched_bigram_count FROM al LEFT JOIN u USING (post_id, st) LEFT JOIN bg USING (post_id, st))"""


DOC_COLUMNS = ", ".join(f"{rounded(c, 6)} AS document_{c}" for c in S.SCORES) + ", " + ", ".join(S.MATCHES)


@query("G19_D6_own_topic_scores", sql_with(SQL_LABELLED, sql_scored("ld", "ld"), f"SELECT post_id, topic, {DOC_COLUMNS} FROM sc WHERE topic = st"))
def own_topic(spark, sf):
    docs = labelled(spark, sf)
    return S.own_topic_scores(docs, *S.fit_scores(docs))


@query("E19_document_score_summary", sql_with(SQL_LABELLED, sql_scored("ld", "ld"), f"o AS (SELECT post_id, topic, {DOC_COLUMNS} FROM sc WHERE topic = st)", "SELECT topic, count(post_id) AS document_count, " + rounded("avg(document_custom_score)", 6) + " AS mean_document_custom_score, " + rounded("max(document_custom_score)", 6) + " AS max_document_custom_score, " + rounded("avg(document_unigram_score)", 6) + " AS mean_document_unigram_score, " + rounded("avg(document_bigram_score)", 6) + " AS mean_document_bigram_score, " + rounded("avg(document_positional_score)", 6) + " AS mean_document_positional_score FROM o GROUP BY topic"))
def score_summary(spark, sf):
    return S.score_summary(own_topic(spark, sf))


SQL_BEST = f"best AS (SELECT post_id, {DOC_COLUMNS} FROM sc QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY round(custom_score, 9) DESC, st) = 1)"


@query("G20_D7_best_topic_scores", sql_with(SQL_LABELLED, sql_scored("ld", "ld"), SQL_BEST, "SELECT * FROM best"))
def best_topic(spark, sf):
    docs = labelled(spark, sf)
    return S.best_topic_scores(docs, *S.fit_scores(docs))


@query(
    "G21_all_topic_scores",
    sql_with(
        SQL_LABELLED, sql_scored("ld", "ld"),
        "SELECT post_id, " + ", ".join([f"max({rounded(c, 6)}) FILTER (st = '{t}') AS {t}_{c}" for t in LANGS for c in S.SCORES] + [f"max({c}) FILTER (st = '{t}') AS {t}_{c}" for t in LANGS for c in S.MATCHES]) + " FROM sc GROUP BY post_id",
    ),
)
def all_topics(spark, sf):
    docs = labelled(spark, sf)
    return S.all_topic_scores(docs, *S.fit_scores(docs), LANGS)


SQL_SAFE = sql_with(SQL_LABELLED, sql_split("ld", "topic"), "fit AS (SELECT * FROM parted WHERE split = 'train')", sql_scored("fit", "parted"), SQL_BEST, "{final}")


@query("G23_leakage_safe_features", SQL_SAFE.replace("{final}", "SELECT p.topic, p.final_sentiment, p.split, best.* FROM best JOIN parted p USING (post_id)"))
def safe_features(spark, sf):
    scored = topic_features(scored_posts(spark, sf))
    return scored.select("post_id", "topic", "final_sentiment", "split", *[f"document_{c}" for c in S.SCORES], *S.MATCHES)


@query("E18_split_feature_summary", SQL_SAFE.replace("{final}", "SELECT split, count(best.post_id) AS document_count, " + rounded("avg(document_custom_score)", 4) + " AS mean_document_custom_score, " + rounded("avg(matched_unigram_count)", 4) + " AS mean_matched_unigram_count, " + rounded("avg(matched_bigram_count)", 4) + " AS mean_matched_bigram_count, round(avg((matched_unigram_count = 0)::INTEGER) * 100, 2) AS pct_zero_unigram_match FROM best JOIN parted USING (post_id) GROUP BY split"))
def split_feature_summary(spark, sf):
    return S.split_score_summary(topic_features(scored_posts(spark, sf)))
