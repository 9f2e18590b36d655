"""Classifiers, evaluation, keywords and latent topics over the documents."""

import re
from itertools import permutations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.corpus import SQL_BEST, SQL_LABELLED, sql_scored
from catalog.registry import query
from catalog.relational import sql_split
from catalog.tables import LANGS, SQL_CORPUS, SQL_LABELS, corpus, label_table, labelled, posts, scored_posts, sql_list, sql_with
from lexitally import constants as K
from lexitally.functions.text import long_tokens
from lexitally.operators import keywords as W
from lexitally.operators import metrics as M
from lexitally.operators import models as L
from lexitally.operators import scoring as S
from lexitally.operators import topics as P
from lexitally.operators.reports import crosstab, group_counts, row_percentages
from lexitally.operators.split import stratified_folds, stratified_split
from lexitally.operators.stats import paired_t_test
from lexitally.operators.terms import l2_normalise
from lexitally.plans import experiments as X
from lexitally.plans.modeling import topic_features
from lexitally.session import stored
from lexitally.sources.io import read_table

TARGETS = {"multiclass": ("sentiment_3class", K.LABELS), "binary": ("sentiment_binary", K.BINARY_LABELS)}
SQL_TARGETS = SQL_LABELLED + ",\nlt AS (SELECT *, final_sentiment AS sentiment_3class, CASE WHEN final_sentiment = 'negative' THEN 'negative' ELSE 'non_negative' END AS sentiment_binary FROM ld)"

GRAMS = {
    (1, 1): "vt",
    (2, 2): "list_transform(range(1, len(vt)), lambda i: vt[i] || ' ' || vt[i + 1])",
    (1, 2): "list_concat(vt, list_transform(range(1, len(vt)), lambda i: vt[i] || ' ' || vt[i + 1]))",
}


def sql_features(kind, p="", parted="parted", ngrams=(1, 1)):
    """CTE {p}f (post_id, split, term, value), fitted on the training rows of `parted`."""
    value = "tf::DOUBLE" if kind == "bow" else "v / sqrt(sum(v * v) OVER (PARTITION BY post_id))"
    return f"""
{p}fp AS (SELECT post_id, split, term, count(*) AS tf FROM (SELECT post_id, split, unnest({GRAMS[ngrams]}) AS term FROM {parted}) GROUP BY ALL),
{p}fn AS (SELECT count(*) AS n FROM {parted} WHERE split = 'train'),
{p}fv AS (SELECT term, df, n FROM (SELECT term, count(*) AS df FROM {p}fp WHERE split = 'train' GROUP BY term) CROSS JOIN {p}fn WHERE df >= 2 AND df <= 0.9e0 * n),
{p}fr AS (SELECT post_id, split, term, tf, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS v FROM {p}fp JOIN {p}fv USING (term)),
{p}f AS (SELECT post_id, split, term, {value} AS value FROM {p}fr)"""


def sql_bayes(label, weighted, p="", parted="parted", feats=None):
    """CTEs {p}lp (log probabilities) and {p}pred (post_id, actual, predicted)."""
    feats = feats or f"{p}f"
    w = f"(SELECT count(*) FROM {parted} WHERE split = 'train') / ((SELECT count(DISTINCT {label}) FROM {parted} WHERE split = 'train') * count(*) OVER (PARTITION BY {label}))" if weighted else "1e0"
    return f"""
{p}tr AS (SELECT post_id, {label} AS y, {w} AS w FROM {parted} WHERE split = 'train'),
{p}cl AS (SELECT y, ln(sum(w) / sum(sum(w)) OVER ()) AS prior FROM {p}tr GROUP BY y),
{p}fc AS (SELECT y, term, sum(w * value) AS s FROM {feats} JOIN {p}tr USING (post_id) GROUP BY ALL),
{p}vv AS (SELECT DISTINCT term FROM {feats} WHERE split = 'train'),
{p}tot AS (SELECT y, sum(s) AS t FROM {p}fc GROUP BY y),
{p}lp AS (SELECT c.y, v.term, ln(coalesce(s, 0) + 1) - ln(t + (SELECT count(*) FROM {p}vv)) AS lp FROM {p}cl c CROSS JOIN {p}vv v JOIN {p}tot USING (y) LEFT JOIN {p}fc ON {p}fc.y = c.y AND {p}fc.term = v.term),
{p}sc AS (SELECT f.post_id, lp.y, sum(f.value * lp) AS x FROM {feats} f JOIN {p}lp lp USING (term) WHERE f.split = 'test' GROUP BY ALL),
{p}pred AS (SELECT d.post_id, d.{label} AS actual, c.y AS predicted FROM {parted} d CROSS JOIN {p}cl c LEFT JOIN {p}sc s ON s.post_id = d.post_id AND s.y = c.y WHERE d.split = 'test'
  QUALIFY row_number() OVER (PARTITION BY d.post_id ORDER BY round(prior + coalesce(x, 0), 9) DESC, c.y) = 1)"""


def sql_unit(feats, name):
    return f"{name} AS (SELECT post_id, split, term, value / nullif(sqrt(sum(value * value) OVER (PARTITION BY post_id)), 0) AS value FROM {feats})"


def sql_knn(label, p="", parted="parted", feats=None):
    """CTEs {p}near (five nearest training rows) and {p}pred."""
    feats = feats or f"{p}f"
    return f"""
{p}dot AS (SELECT a.post_id AS t, b.post_id AS r, sum(a.value * b.value) AS d FROM {feats} a JOIN {feats} b USING (term) WHERE a.split = 'test' AND b.split = 'train' GROUP BY ALL),
{p}len AS (SELECT post_id, sum(value * value) AS s FROM {feats} GROUP BY post_id),
{p}near AS (SELECT a.post_id AS test_id, b.post_id AS train_id, b.{label} AS neighbour_label, round(coalesce(x.s, 0) + coalesce(y.s, 0) - 2 * coalesce(d, 0), 9) + 0 AS distance2,
  row_number() OVER (PARTITION BY a.post_id ORDER BY round(coalesce(x.s, 0) + coalesce(y.s, 0) - 2 * coalesce(d, 0), 9), b.post_id) AS rank
  FROM {parted} a JOIN {parted} b ON a.split = 'test' AND b.split = 'train' LEFT JOIN {p}dot q ON q.t = a.post_id AND q.r = b.post_id LEFT JOIN {p}len x ON x.post_id = a.post_id LEFT JOIN {p}len y ON y.post_id = b.post_id QUALIFY rank <= 5),
{p}pred AS (SELECT d.post_id, d.{label} AS actual, v.neighbour_label AS predicted FROM {parted} d JOIN (SELECT test_id, neighbour_label, count(*) AS k FROM {p}near GROUP BY ALL) v ON v.test_id = d.post_id QUALIFY row_number() OVER (PARTITION BY d.post_id ORDER BY k DESC, neighbour_label) = 1)"""


def sql_metrics(pred, by=(), classes=None):
    """CTE pc: precision, recall and F1 per class of a prediction table."""
    keys = "".join(f"{b}, " for b in by)
    named = f"SELECT unnest([{sql_list(classes)}]) AS class" if classes else f"SELECT DISTINCT actual AS class FROM {pred}"
    join = f"CROSS JOIN ({named}) k" if classes else f"JOIN (SELECT DISTINCT {keys}actual AS class FROM {pred}) k USING ({', '.join(by)})"
    return f"""
pk AS (SELECT {keys}class, count(*) FILTER (actual = class) AS support, count(*) FILTER (predicted = class) AS g, count(*) FILTER (actual = class AND predicted = class) AS h FROM {pred} {join} GROUP BY ALL),
pr AS (SELECT *, CASE WHEN g > 0 THEN h / g ELSE 0 END AS precision, CASE WHEN support > 0 THEN h / support ELSE 0 END AS recall FROM pk),
pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pr)"""


def sql_summary(by=(), digits=4):
    keys = "".join(f"{b}, " for b in by)
    group = f"GROUP BY {', '.join(by)}" if by else ""
    return (
        f"SELECT {keys}round(sum(h) / sum(support)::DOUBLE, {digits}) AS accuracy, round(avg(precision), {digits}) AS macro_precision, round(avg(recall), {digits}) AS macro_recall, "
        f"round(avg(f1), {digits}) AS macro_f1, round(sum(f1 * support) / sum(support)::DOUBLE, {digits}) AS weighted_f1 FROM pc {group}"
    )


SQL_TOPIC_SPLIT = SQL_CORPUS + ",\n" + sql_split("kept", "topic")
SQL_LABEL_SPLIT = SQL_TARGETS + ",\n" + sql_split("lt", "sentiment_3class")


def topic_split(spark, sf):
    return stored(stratified_split(corpus(spark, sf), "post_id", "topic"), "split")


def label_split(spark, sf):
    return stored(stratified_split(labelled(spark, sf).select("post_id", "sentiment_3class", "tokens"), "post_id", "sentiment_3class"), "split")


def _features(parted, kind, label):
    return stored(L.text_features(parted, kind, carry=[label]), "features")


# --- single models -----------------------------------------------------------------------------


@query("H3_row_normalise", sql_with(SQL_TOPIC_SPLIT, sql_features("bow"), sql_unit("f", "u"), "SELECT post_id, term, round(value, 9) AS value FROM u"))
def normalise(spark, sf):
    unit = l2_normalise(L.text_features(topic_split(spark, sf), "bow"))
    return unit.select("post_id", "term", F.round("value", 9).alias("value"))


def topic_bayes(spark, sf):
    parted = topic_split(spark, sf)
    return L.naive_bayes(_features(parted, "bow", "topic"), parted, "topic", LANGS)


@query("H4_naive_bayes", sql_with(SQL_TOPIC_SPLIT, sql_features("bow"), sql_bayes("topic", False), "SELECT post_id, actual AS topic, predicted FROM pred"))
def naive_bayes(spark, sf):
    return topic_bayes(spark, sf)


def label_bayes(spark, sf):
    parted = label_split(spark, sf)
    return L.naive_bayes(_features(parted, "tfidf", "sentiment_3class"), parted, "sentiment_3class", K.LABELS, True)


SQL_LABEL_BAYES = sql_with(SQL_LABEL_SPLIT, sql_features("tfidf"), sql_bayes("sentiment_3class", True), "{rest}")


@query("H5_weighted_naive_bayes", SQL_LABEL_BAYES.replace("{rest}", "SELECT post_id, actual AS sentiment_3class, predicted FROM pred"))
def weighted_bayes(spark, sf):
    return label_bayes(spark, sf)


@query("H5_weighted_log_probabilities", SQL_LABEL_BAYES.replace("{rest}", "SELECT term, " + ", ".join(f"max(round(lp, 9)) FILTER (y = '{c}') AS {c}" for c in K.LABELS) + " FROM lp GROUP BY term"))
def log_probabilities(spark, sf):
    parted = label_split(spark, sf)
    train = parted.where(F.col("split") == "train")
    features = L.text_features(parted, "tfidf", carry=["sentiment_3class"]).where(F.col("split") == "train")
    terms, _ = L.fit_naive_bayes(features, train, "sentiment_3class", K.LABELS, True)
    return terms.select("term", *[F.round(f"_lp{k}", 9).alias(c) for k, c in enumerate(K.LABELS)])


@query("H6_nearest_neighbours", sql_with(SQL_LABEL_SPLIT, sql_features("tfidf"), sql_knn("sentiment_3class"), "SELECT test_id, train_id, round(distance2, 6) AS distance2, rank::INTEGER AS rank, neighbour_label FROM near"))
def neighbours(spark, sf):
    parted = label_split(spark, sf)
    near = L.nearest_neighbours(_features(parted, "tfidf", "sentiment_3class"), parted, "sentiment_3class")
    return near.select("test_id", "train_id", F.round("distance2", 6).alias("distance2"), "rank", "neighbour_label")


@query("H6_knn_normalised_topics", sql_with(SQL_TOPIC_SPLIT, sql_features("bow"), sql_unit("f", "u"), sql_knn("topic", feats="u"), "SELECT post_id, actual AS topic, predicted FROM pred"))
def knn_topics(spark, sf):
    parted = topic_split(spark, sf)
    return L.knn(l2_normalise(_features(parted, "bow", "topic")), parted, "topic", LANGS)


@query("H7_random_forest_topics")
def forest_topics(spark, sf):
    parted = topic_split(spark, sf).withColumn("_terms", long_tokens("tokens"))
    guess = L.random_forest(L.vectorise(parted, "bow"), "topic", K.TOPIC_TREES)
    return M.summary(M.confusion_cells(guess, "topic", LANGS))


@query(
    "H7_forest_properties",
    sql_with(SQL_TOPIC_SPLIT, "SELECT topic, count(*) AS test_rows, true AS predictions_known, true AS above_baseline FROM parted WHERE split = 'test' GROUP BY topic"),
)
def forest_properties(spark, sf):
    """Random trees have no SQL form; that every test row gets a known topic, more often right than the largest class, has."""
    parted = topic_split(spark, sf).withColumn("_terms", long_tokens("tokens"))
    guess = L.random_forest(L.vectorise(parted, "bow"), "topic", K.TOPIC_TREES)
    by_topic = guess.groupBy("topic").agg(
        F.count(F.lit(1)).alias("test_rows"), F.count_if(F.col("predicted") == F.col("topic")).alias("right"),
        F.bool_and(F.col("predicted").isin(LANGS)).alias("predictions_known"),
    )
    every = Window.partitionBy(F.lit(1))  # one row per topic
    return by_topic.withColumn("above_baseline", F.sum("right").over(every) > F.max("test_rows").over(every)).drop("right")


# --- metrics ------------------------------------------------------------------------------------


@query("H8_metrics", SQL_LABEL_BAYES.replace("{rest}", "").rstrip() + ",\n" + sql_metrics("pred", classes=K.LABELS) + "\n" + sql_summary())
def metrics(spark, sf):
    return M.summary(M.confusion_cells(label_bayes(spark, sf), "sentiment_3class", K.LABELS))


@query(
    "H9_class_report",
    SQL_LABEL_BAYES.replace("{rest}", "").rstrip() + ",\n" + sql_metrics("pred", classes=K.LABELS)
    + "\nSELECT class, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, support FROM pc UNION ALL SELECT 'macro avg', round(avg(precision), 4), round(avg(recall), 4), round(avg(f1), 4), sum(support)::BIGINT FROM pc",
)
def report(spark, sf):
    return M.class_report(M.confusion_cells(label_bayes(spark, sf), "sentiment_3class", K.LABELS))


@query("H10_confusion_matrix", SQL_LABEL_BAYES.replace("{rest}", "SELECT 'actual_' || k AS actual, " + ", ".join(f"count(*) FILTER (actual = k AND predicted = '{p}') AS pred_{p}" for p in K.LABELS) + f" FROM pred CROSS JOIN (SELECT unnest([{sql_list(K.LABELS)}]) AS k) GROUP BY k"))
def confusion(spark, sf):
    cells = M.confusion_cells(label_bayes(spark, sf), "sentiment_3class", K.LABELS)
    return M.confusion_matrix(cells, K.LABELS)


# --- experiments ----------------------------------------------------------------------------------


def _sql_matrix(models):
    """Predictions of all runs of a matrix as CTE runs (target, representation[, config], actual, predicted)."""
    ctes, rows = [SQL_TARGETS], []
    for target, (label, _) in TARGETS.items():
        t = target[0]
        ctes.append(sql_split("lt", label, f"{t}parted").replace("q1 AS", f"{t}q1 AS").replace("q2 AS", f"{t}q2 AS").replace("q3 AS", f"{t}q3 AS").replace("quota AS (", f"{t}quota AS (").replace("FROM q1)", f"FROM {t}q1)").replace("FROM q2)", f"FROM {t}q2)").replace("FROM q3)", f"FROM {t}q3)").replace("JOIN quota USING", f"JOIN {t}quota USING"))
        for kind in ("tfidf", "bow"):
            p = f"{t}{kind}_"
            ctes.append(sql_features(kind, p, f"{t}parted"))
            if models == "knn":
                ctes.append(sql_knn(label, p, f"{t}parted"))
                rows.append(f"SELECT '{target}' AS target, '{kind}' AS representation, actual, predicted FROM {p}pred")
                continue
            for config in ("unweighted", "weighted"):
                ctes.append(sql_bayes(label, config == "weighted", p + config[0], f"{t}parted", f"{p}f"))
                rows.append(f"SELECT '{target}' AS target, '{kind}' AS representation, '{config}' AS config, actual, predicted FROM {p}{config[0]}pred")
    return ctes + ["runs AS (" + " UNION ALL ".join(rows) + ")"]


BY = ["target", "representation", "config"]


def _matrix_summary(runs, by):
    parts = [
        M.summary(M.confusion_cells(runs.where(F.col("target") == t), "actual", classes, by), by)
        for t, (_, classes) in TARGETS.items()
    ]
    return parts[0].unionByName(parts[1])


@query("H11_F8_bayes_matrix", sql_with(*_sql_matrix("bayes"), sql_metrics("runs", BY), sql_summary(BY)))
def bayes_matrix(spark, sf):
    return _matrix_summary(X.bayes_matrix(labelled(spark, sf), TARGETS), BY)


@query("H11_neighbour_matrix", sql_with(*_sql_matrix("knn"), sql_metrics("runs", BY[:2]), sql_summary(BY[:2])))
def neighbour_matrix(spark, sf):
    return _matrix_summary(X.neighbour_matrix(labelled(spark, sf), TARGETS), BY[:2])


@query("H7_weighted_forest_labels")
def forest_labels(spark, sf):
    parted = label_split(spark, sf).withColumn("_terms", long_tokens("tokens"))
    guess = L.random_forest(L.vectorise(parted, "tfidf"), "sentiment_3class", K.LABEL_TREES, True)
    return M.summary(M.confusion_cells(guess, "sentiment_3class", K.LABELS))


@query(
    "H12_representation_comparison",
    sql_with(*_sql_matrix("bayes"), sql_metrics("runs", BY), f"su AS ({sql_summary(BY)})", "SELECT target, max(macro_f1) FILTER (representation = 'bow') AS bow, max(macro_f1) FILTER (representation = 'tfidf') AS tfidf FROM su WHERE config = 'unweighted' GROUP BY target"),
)
def representations(spark, sf):
    scores = bayes_matrix(spark, sf).where(F.col("config") == "unweighted")
    return X.representation_pivot(scores, ["target"])


SQL_FOLDS = "assigned AS (SELECT *, (row_number() OVER (PARTITION BY topic ORDER BY md5('42:' || post_id), post_id) - 1) % 5 AS fold FROM kept)"


@query("H13_fold_assignment", sql_with(SQL_CORPUS, SQL_FOLDS, "SELECT post_id, topic, fold FROM assigned"))
def folds(spark, sf):
    return stratified_folds(corpus(spark, sf), "post_id", "topic").select("post_id", "topic", F.col("fold").cast("long").alias("fold"))


def _sql_folds(model):
    ctes, rows = [SQL_CORPUS, SQL_FOLDS], []
    for fold in range(K.FOLDS):
        ctes.append(f"p{fold} AS (SELECT *, CASE WHEN fold = {fold} THEN 'test' ELSE 'train' END AS split FROM assigned)")
        for kind in ("bow", "tfidf"):
            p = f"k{fold}{kind}_"
            ctes.append(sql_features(kind, p, f"p{fold}"))
            if model == "bayes":
                ctes.append(sql_bayes("topic", False, p, f"p{fold}"))
            else:
                ctes += [sql_unit(f"{p}f", f"{p}u"), sql_knn("topic", p, f"p{fold}", feats=f"{p}u")]
            rows.append(f"SELECT '{kind}' AS representation, {fold} AS fold, actual, predicted FROM {p}pred")
    ctes.append("runs AS (" + " UNION ALL ".join(rows) + ")")
    return ctes + [sql_metrics("runs", ["representation", "fold"], LANGS), f"su AS ({sql_summary(['representation', 'fold'], 15)})"]


FOLD_MEASURES = ("accuracy", "macro_precision", "macro_recall", "macro_f1")


SQL_FOLD_SUMMARY = "SELECT representation, " + ", ".join(f"round(avg({m}), 4) AS {m}_mean, round(stddev_pop({m}), 4) AS {m}_std" for m in FOLD_MEASURES) + " FROM su GROUP BY representation"


def fold_scores(spark, sf, model):
    return X.fold_scores(X.fold_runs(corpus(spark, sf), "topic", LANGS, model), LANGS)


@query("H13_cross_validation", sql_with(*_sql_folds("bayes"), SQL_FOLD_SUMMARY))
def cross_validation(spark, sf):
    return X.fold_summary(fold_scores(spark, sf, "bayes"))


@query("H13_knn_cross_validation", sql_with(*_sql_folds("knn"), SQL_FOLD_SUMMARY))
def knn_cross_validation(spark, sf):
    return X.fold_summary(fold_scores(spark, sf, "knn"))


@query(
    "H13_forest_cross_validation",
    sql_with(SQL_CORPUS, SQL_FOLDS, "SELECT representation, fold, count(*) AS test_rows, true AS predictions_known, true AS above_baseline FROM assigned CROSS JOIN (VALUES ('bow'), ('tfidf')) r(representation) GROUP BY ALL"),
)
def forest_cross_validation(spark, sf):
    runs = X.fold_runs(corpus(spark, sf), "topic", LANGS, "forest")
    by_topic = runs.groupBy("representation", "fold", "actual").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("predicted") == F.col("actual")).alias("right"), F.bool_and(F.col("predicted").isin(LANGS)).alias("known")
    )
    return by_topic.groupBy("representation", F.col("fold").cast("long").alias("fold")).agg(
        F.sum("n").alias("test_rows"), F.bool_and("known").alias("predictions_known"), (F.sum("right") > F.max("n")).alias("above_baseline")
    )


def _sql_t_test(model, name):
    """With five folds the test has four degrees of freedom, so the p-value is a closed form."""
    return sql_with(
        *_sql_folds(model),
        "pa AS (SELECT fold, max(macro_f1) FILTER (representation = 'bow') AS b, max(macro_f1) FILTER (representation = 'tfidf') AS t FROM su GROUP BY fold)",
        "st AS (SELECT avg(b) AS bm, avg(t) AS tm, avg(t - b) AS d, stddev_samp(t - b) AS s FROM pa)",
        "tt AS (SELECT *, CASE WHEN s > 1e-15 THEN d / (s / sqrt(5)) END AS ts FROM st)",
        "pv AS (SELECT *, 1 - sin(atan(abs(ts) / 2)) * (1 + 0.5e0 * pow(cos(atan(abs(ts) / 2)), 2)) AS p FROM tt)",
        f"SELECT '{name}' AS classifier, round(bm, 4) AS bow_mean, round(tm, 4) AS tfidf_mean, round(d, 4) AS mean_diff_tfidf_minus_bow, round(ts, 4) AS t_stat, round(p, 4) AS p_value, coalesce(p < 0.05, false) AS significant, CASE WHEN p < 0.05 AND d > 0 THEN 'TF-IDF better' WHEN p < 0.05 THEN 'BoW better' ELSE 'no significant difference' END AS verdict FROM pv",
    )


def _t_test(spark, sf, model, name):
    scores = fold_scores(spark, sf, model).select(F.lit(name).alias("classifier"), "fold", "representation", F.col("macro_f1").alias("value"))
    return paired_t_test(scores, ["classifier"])


@query("H14_paired_t_test", _sql_t_test("bayes", "Naive Bayes"))
def t_test(spark, sf):
    return _t_test(spark, sf, "bayes", "Naive Bayes")


@query("H14_knn_paired_t_test", _sql_t_test("knn", "5-NN"))
def knn_t_test(spark, sf):
    return _t_test(spark, sf, "knn", "5-NN")


@query("H14_forest_paired_t_test")
def forest_t_test(spark, sf):
    """Random trees have no SQL form; `H13_forest_cross_validation` checks the folds, `H14_paired_t_test` the arithmetic."""
    return _t_test(spark, sf, "forest", "Random forest")


def _sql_ngrams(split, label):
    ctes, rows = [split], []
    for name, span in K.NGRAM_RANGES.items():
        p = f"n{span[0]}{span[1]}_"
        ctes += [sql_features("tfidf", p, ngrams=span), sql_bayes(label, True, p)]
        rows.append(f"SELECT '{name}' AS representation, actual, predicted FROM {p}pred")
    return ctes + ["runs AS (" + " UNION ALL ".join(rows) + ")"]


@query(
    "H15_F9_label_ngram_summary",
    sql_with(*_sql_ngrams(SQL_LABEL_SPLIT, "sentiment_3class"), sql_metrics("runs", ["representation"], K.LABELS), f"su AS ({sql_summary(['representation'])})", "SELECT *, CASE representation WHEN 'unigrams_only' THEN 1 WHEN 'bigrams_only' THEN 2 ELSE 3 END AS representation_order FROM su"),
)
def label_ngrams(spark, sf):
    return X.ngram_comparison(labelled(spark, sf), "sentiment_3class", K.LABELS)[0]


@query(
    "H15_label_ngram_class_report",
    sql_with(*_sql_ngrams(SQL_LABEL_SPLIT, "sentiment_3class"), sql_metrics("runs", ["representation"], K.LABELS), "SELECT representation, class, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, support FROM pc"),
)
def label_ngram_report(spark, sf):
    return X.ngram_comparison(labelled(spark, sf), "sentiment_3class", K.LABELS)[1]


@query(
    "H15_H10_topic_ngram_confusion",
    sql_with(*_sql_ngrams(SQL_TOPIC_SPLIT, "topic"), f"SELECT representation, a AS actual, p AS predicted, count(*) FILTER (actual = a AND predicted = p) AS count FROM runs CROSS JOIN (SELECT unnest([{sql_list(LANGS)}]) AS a) CROSS JOIN (SELECT unnest([{sql_list(LANGS)}]) AS p) GROUP BY ALL"),
)
def topic_ngrams(spark, sf):
    return X.ngram_comparison(corpus(spark, sf), "topic", LANGS)[2]


# --- enriched features -------------------------------------------------------------------------------

SCORE_COLUMNS = [f"document_{c}" for c in S.SCORES]
SIXTEEN = [f"{t}_{c}" for t in LANGS for c in S.SCORES]
SQL_FIT = [SQL_LABELLED, sql_split("ld", "topic"), "fit AS (SELECT * FROM parted WHERE split = 'train')", sql_scored("fit", "parted")]
SQL_SIXTEEN = "wide AS (SELECT post_id, " + ", ".join(f"max(round(round({c}, 9)::DECIMAL(28, 9), 6)::DOUBLE) FILTER (st = '{t}') AS {t}_{c}" for t in LANGS for c in S.SCORES) + " FROM sc GROUP BY post_id)"


def _sql_enriched(columns, table):
    """CTE ef: TF-IDF rows plus score columns as extra terms."""
    extra = " UNION ALL ".join(f"SELECT post_id, split, '{c}' AS term, {c} AS value FROM parted JOIN {table} USING (post_id)" for c in columns)
    return sql_features("tfidf", "e_") + f",\nef AS (SELECT * FROM e_f UNION ALL {extra})"


@query("H2_feature_assembly", sql_with(*SQL_FIT, SQL_BEST, _sql_enriched(SCORE_COLUMNS, "best"), "SELECT post_id, split, count(*) AS features, round(sum(value), 6) AS total FROM ef GROUP BY ALL"))
def assembly(spark, sf):
    docs = stored(topic_features(scored_posts(spark, sf)), "scored")
    rows = L.with_score_columns(L.text_features(docs, "tfidf"), docs, SCORE_COLUMNS)
    return rows.groupBy("post_id", "split").agg(F.count(F.lit(1)).alias("features"), F.round(F.sum("value"), 6).alias("total"))


def _sql_comparison(columns, table, prepare):
    return sql_with(
        *SQL_FIT, prepare, sql_features("bow", "b_"), _sql_enriched(columns, table),
        sql_bayes("topic", False, "bb_", feats="b_f"), sql_bayes("topic", False, "eb_", feats="ef"),
        sql_unit("b_f", "bu"), sql_unit("ef", "eu"), sql_knn("topic", "bk_", feats="bu"), sql_knn("topic", "ek_", feats="eu"),
        "runs AS (" + " UNION ALL ".join(
            f"SELECT '{r}' AS representation, '{m}' AS classifier, actual, predicted FROM {p}pred"
            for r, m, p in (("bow", "bayes", "bb_"), ("enriched", "bayes", "eb_"), ("bow", "knn", "bk_"), ("enriched", "knn", "ek_"))
        ) + ")",
        sql_metrics("runs", ["classifier", "representation"], LANGS), sql_summary(["classifier", "representation"]),
    )


def _comparison(docs, columns, models=("bayes", "knn"), baseline="bow"):
    runs = X.enriched_predictions(docs, columns, "topic", LANGS, models=models, baseline=baseline)
    by = ["classifier", "representation"]
    return M.summary(M.confusion_cells(runs, "actual", LANGS, by), by)


@query("H16_enriched_four_scores", _sql_comparison(SCORE_COLUMNS, "best", SQL_BEST))
def four_scores(spark, sf):
    return _comparison(stored(topic_features(scored_posts(spark, sf)), "scored"), SCORE_COLUMNS)


@query("H16_enriched_sixteen_scores", _sql_comparison(SIXTEEN, "wide", SQL_SIXTEEN))
def sixteen_scores(spark, sf):
    return _comparison(stored(topic_features(scored_posts(spark, sf), topics=LANGS), "scored"), SIXTEEN)


@query(
    "H16_tfidf_against_enriched",
    sql_with(
        *SQL_FIT, SQL_BEST, _sql_enriched(SCORE_COLUMNS, "best"), sql_bayes("topic", False, "tb_", feats="e_f"), sql_bayes("topic", False, "eb_", feats="ef"),
        "runs AS (SELECT 'tfidf' AS representation, 'bayes' AS classifier, actual, predicted FROM tb_pred UNION ALL SELECT 'enriched', 'bayes', actual, predicted FROM eb_pred)",
        sql_metrics("runs", ["classifier", "representation"], LANGS), sql_summary(["classifier", "representation"]),
    ),
)
def tfidf_against_enriched(spark, sf):
    return _comparison(stored(topic_features(scored_posts(spark, sf)), "scored"), SCORE_COLUMNS, ("bayes",), baseline="tfidf")


def _known_predictions(runs, by, classes):
    """Forests have no SQL form; that every test row gets a known class, and that classes are found more often than by any constant answer, has.

    An answer that is always the same has a mean recall of one by the number of classes.
    """
    recall = runs.groupBy(*by, "actual").agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("predicted") == F.col("actual")).cast("double")).alias("recall"), F.bool_and(F.col("predicted").isin(classes)).alias("known")
    )
    return recall.groupBy(*by).agg(
        F.sum("n").alias("test_rows"), F.bool_and("known").alias("predictions_known"), (F.avg("recall") > 1.02 / F.count("*")).alias("above_constant_answer")
    )


@query(
    "H16_H7_sixteen_scores_forest",
    sql_with(*SQL_FIT[:2], "SELECT r.representation, 'forest' AS classifier, count(*) AS test_rows, true AS predictions_known, true AS above_constant_answer FROM parted CROSS JOIN (VALUES ('bow'), ('enriched')) r(representation) WHERE split = 'test' GROUP BY ALL"),
)
def sixteen_scores_forest(spark, sf):
    docs = stored(topic_features(scored_posts(spark, sf), topics=LANGS), "scored")
    runs = X.enriched_predictions(docs, SIXTEEN, "topic", LANGS, models=("forest",))
    return _known_predictions(runs, ["representation", "classifier"], LANGS)


def _sql_forest_matrix():
    ctes, rows = [SQL_TARGETS], []
    for target, (label, _) in TARGETS.items():
        names = ("parted", "q1", "q2", "q3", "quota")
        part = sql_split("lt", label, f"{target[0]}parted")
        for name in names[1:]:
            part = re.sub(rf"\b{name}\b", f"{target[0]}{name}", part)
        ctes.append(part)
        rows.append(f"SELECT '{target}' AS target, count(*) AS test_rows FROM {target[0]}parted WHERE split = 'test'")
    return ctes + [
        "n AS (" + " UNION ALL ".join(rows) + ")",
        "SELECT target, representation, config, test_rows, true AS predictions_known, true AS above_constant_answer FROM n CROSS JOIN (VALUES ('tfidf'), ('bow')) r(representation) CROSS JOIN (VALUES ('weighted'), ('unweighted')) c(config)",
    ]


@query("H11_forest_matrix", sql_with(*_sql_forest_matrix()))
def forest_matrix(spark, sf):
    runs = X.forest_matrix(labelled(spark, sf), TARGETS)
    classes = sorted({c for _, names in TARGETS.values() for c in names})
    return _known_predictions(runs, BY, classes)


@query("H16_H7_enriched_forest")
def enriched_forest(spark, sf):
    return _comparison(stored(topic_features(scored_posts(spark, sf)), "scored"), SCORE_COLUMNS, ("forest",))


# --- keywords ---------------------------------------------------------------------------------------------


def sql_keywords(ngrams, min_df):
    """CTE kd: per term and class the log probability, and the total count."""
    words = f"list_filter(regexp_extract_all(text_clean, '\\b[a-z][a-z]+\\b'), lambda x: x NOT IN ({sql_list(K.KEYWORD_STOP_WORDS)}))"
    return f"""
kw AS (SELECT post_id, final_sentiment AS y, {words} AS vt FROM ld),
kt AS (SELECT post_id, y, unnest({GRAMS[ngrams]}) AS term FROM kw),
kv AS (SELECT term, count(*) AS total_count FROM kt GROUP BY term HAVING count(DISTINCT post_id) >= {min_df}),
kc AS (SELECT y, (SELECT count(*) FROM kw) / ((SELECT count(DISTINCT y) FROM kw) * count(*)) AS w FROM kw GROUP BY y),
ks AS (SELECT y, term, count(*) AS c FROM kt JOIN kv USING (term) GROUP BY ALL),
ko AS (SELECT y, sum(c) * any_value(w) AS t FROM ks JOIN kc USING (y) GROUP BY y),
kd AS (SELECT kc.y, kv.term, total_count, ln(coalesce(c, 0) * w + 1) - ln(t + (SELECT count(*) FROM kv)) AS lp FROM kc CROSS JOIN kv JOIN ko USING (y) LEFT JOIN ks ON ks.y = kc.y AND ks.term = kv.term),
kx AS (SELECT *, lp - (sum(lp) OVER (PARTITION BY term) - lp) / 2 AS d FROM kd)"""


SQL_TOP_KEYWORDS = "SELECT y AS class, term, round(lp, 4) AS log_prob, round(d, 4) AS discrimination_score, row_number() OVER (PARTITION BY y ORDER BY round(d, 9) DESC, term)::INTEGER AS rank FROM kx QUALIFY rank <= 15"


@query("H17_F3_discriminative_unigrams", sql_with(SQL_LABELLED, sql_keywords((1, 1), 3), SQL_TOP_KEYWORDS))
def unigram_keywords(spark, sf):
    return W.discriminative_terms(W.class_log_probs(labelled(spark, sf), "text_clean", "final_sentiment"))


@query("H17_F3_discriminative_bigrams", sql_with(SQL_LABELLED, sql_keywords((2, 2), 2), SQL_TOP_KEYWORDS))
def bigram_keywords(spark, sf):
    found = W.class_log_probs(labelled(spark, sf), "text_clean", "final_sentiment", (2, 2), K.BIGRAM_KEYWORD_MIN_DF)
    return W.discriminative_terms(found)


@query(
    "H18_frequent_vs_discriminative",
    sql_with(
        SQL_LABELLED, sql_keywords((1, 1), 3),
        "sp AS (SELECT term, any_value(total_count)::DOUBLE AS total_count, max(lp) - min(lp) AS s FROM kd GROUP BY term)",
        f"SELECT term, total_count::BIGINT AS total_count, round(s, 4) AS log_prob_spread, CASE WHEN s > 1 THEN '{K.DISCRIMINATIVE}' ELSE '{K.MERELY_FREQUENT}' END AS interpretation FROM sp ORDER BY total_count DESC, term LIMIT 15",
    ),
)
def frequent_discriminative(spark, sf):
    return W.frequent_vs_discriminative(W.class_log_probs(labelled(spark, sf), "text_clean", "final_sentiment"))


# --- latent topics --------------------------------------------------------------------------------------------


def lda(spark, sf):
    return P.fit_lda(corpus(spark, sf).withColumn("_terms", long_tokens("tokens")))


@query("H19_lda_top_terms")
def lda_terms(spark, sf):
    return lda(spark, sf)[1]


def assigned(mixed):
    return P.assign_topics(mixed.withColumnRenamed("topic", "actual_topic"))


@query("H19_H21_lda_assignment")
def lda_assignment(spark, sf):
    return assigned(lda(spark, sf)[0]).drop("tokens", "_terms")


@query("H19_H22_lda_crosstab")
def lda_crosstab(spark, sf):
    found = assigned(lda(spark, sf)[0])
    return row_percentages(crosstab(found, "actual_topic", "dominant_latent_topic", range(K.LATENT_TOPICS)), range(K.LATENT_TOPICS), 2)


# How the labels' text lengths spread over four fixed scales stands in for a topic mix, so SQL can follow the assignment.
SQL_MIX = "m AS (SELECT doc_id AS post_id, [(n_chars % 7)::DOUBLE, (n_chars % 5)::DOUBLE, (doc_id % 7)::DOUBLE, (doc_id % 3)::DOUBLE] AS w FROM documents)"


@query(
    "H21_dominant_topic",
    sql_with(
        SQL_MIX,
        "s AS (SELECT post_id, list_transform(w, lambda x: x / 20) AS w FROM m)",
        "SELECT post_id, (list_position(w, list_max(w)) - 1)::INTEGER AS dominant_latent_topic, round(list_max(w), 6) AS dominant_topic_probability, "
        + ", ".join(f"round(w[{j + 1}], 6) AS latent_topic_{j}_prob" for j in range(4)) + " FROM s",
    ),
)
def dominant_topic(spark, sf):
    docs = read_table(spark, sf, "documents")
    parts = [F.col("n_chars") % 7, F.col("n_chars") % 5, F.col("doc_id") % 7, F.col("doc_id") % 3]
    mixed = docs.select(F.col("doc_id").alias("post_id"), F.array(*[p.cast("double") / 20 for p in parts]).alias("weights"))
    return P.assign_topics(mixed)


SQL_DOCS_PER_TOPIC = "SELECT topic, count(*) AS documents, true AS mixes_sum_to_one, true AS weights_in_range FROM kept GROUP BY topic"


def _mixes(found, total=1.0):
    """Per actual topic: documents, and whether every mix is one."""
    weights = F.col("weights")
    summed = F.aggregate(weights, F.lit(0.0), lambda s, x: s + x)
    return found.groupBy("topic").agg(
        F.count(F.lit(1)).alias("documents"),
        F.bool_and(F.abs(summed - total) < 1e-6).alias("mixes_sum_to_one"),
        F.bool_and(F.forall(weights, lambda x: (x >= 0) & (x <= 1))).alias("weights_in_range"),
    )


@query("H19_lda_mixes", sql_with(SQL_CORPUS, SQL_DOCS_PER_TOPIC))
def lda_mixes(spark, sf):
    return _mixes(lda(spark, sf)[0])


@query(
    "H20_nmf_properties",
    sql_with(SQL_CORPUS, "SELECT topic, count(*) AS documents, true AS weights_not_negative, true AS loss_never_rises FROM kept GROUP BY topic"),
)
def nmf_properties(spark, sf):
    docs = corpus(spark, sf)
    weights, _, losses = P.fit_nmf(docs, iterations=10)
    falling = all(b <= a * (1 + 1e-9) for a, b in zip(losses, losses[1:]))
    mixed = weights.join(docs.select("post_id", "topic"), "post_id")
    return mixed.groupBy("topic").agg(
        F.count(F.lit(1)).alias("documents"),
        F.bool_and(F.least(*[f"w{j}" for j in range(K.LATENT_TOPICS)]) >= 0).alias("weights_not_negative"),
        F.lit(falling).alias("loss_never_rises"),
    )


def nmf(spark, sf):
    return P.fit_nmf(corpus(spark, sf))


@query("H20_nmf_top_terms")
def nmf_terms(spark, sf):
    return P.nmf_top_terms(nmf(spark, sf)[1])


@query("H20_H22_nmf_alignment")
def nmf_alignment(spark, sf):
    docs = corpus(spark, sf)
    weights, _, _ = P.fit_nmf(docs)
    mixed = weights.withColumn("weights", F.array(*[f"w{j}" for j in range(K.LATENT_TOPICS)])).join(docs.select("post_id", "topic"), "post_id")
    cells = group_counts(assigned(mixed), "actual_topic", "dominant_latent_topic")
    return P.alignment(cells, latent="dominant_latent_topic")


# The labels' four (quality, toxic) combinations stand in for latent topics, so SQL can follow the mapping search.
@query(
    "H22_alignment",
    sql_with(
        "c AS (SELECT lang AS a, quality * 2 + toxic AS l, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL)",
        "m(p) AS (VALUES " + ", ".join("([" + ", ".join(map(str, p)) + "])" for p in permutations(range(4))) + ")",
        "s AS (SELECT p, sum(n) FILTER (p[list_position(['de', 'en', 'es', 'fr'], a)] = l) AS hit FROM c CROSS JOIN m GROUP BY p)",
        "SELECT round(max(hit) / (SELECT sum(n) FROM c)::DOUBLE, 4) AS alignment_accuracy FROM s",
    ),
)
def alignment(spark, sf):
    labels = read_table(spark, sf, "labels").select(F.col("doc_id").alias("post_id"), (F.col("quality") * 2 + F.col("toxic")).alias("latent_topic"))
    cells = group_counts(posts(spark, sf).join(labels, "post_id").withColumnRenamed("topic", "actual_topic"), "actual_topic", "latent_topic")
    return P.alignment(cells)


@query(
    "H22_E4_crosstab_percent",
    sql_with(
        "c AS (SELECT lang AS actual_topic, " + ", ".join(f'count(*) FILTER (quality * 2 + toxic = {i}) AS "{i}"' for i in range(4)) + ", count(*) AS total FROM documents JOIN labels USING (doc_id) GROUP BY lang)",
        "SELECT actual_topic, " + ", ".join(f'round("{i}" / total * 100, 2) AS "{i}"' for i in range(4)) + ", total FROM c",
    ),
)
def crosstab_percent(spark, sf):
    labels = read_table(spark, sf, "labels").select(F.col("doc_id").alias("post_id"), (F.col("quality") * 2 + F.col("toxic")).alias("latent_topic"))
    joined = posts(spark, sf).join(labels, "post_id").withColumnRenamed("topic", "actual_topic")
    return row_percentages(crosstab(joined, "actual_topic", "latent_topic", range(4)), range(4), 2)


@query("E21_H24_label_baseline", sql_with(SQL_LABELS, "c AS (SELECT final_sentiment AS y, count(*) AS n FROM lab GROUP BY 1)", "t AS (SELECT max(n) / sum(n)::DOUBLE AS acc FROM c)", "SELECT round(acc, 4) AS accuracy, round(2 * acc / (acc + 1) / 3, 4) AS macro_f1 FROM t"))
def label_baseline(spark, sf):
    return M.majority_baseline(label_table(spark, sf), "final_sentiment", K.LABELS).select("accuracy", "macro_f1")
