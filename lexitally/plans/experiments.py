"""Comparisons of representations, weightings and models over one split or over folds."""

from functools import reduce

from pyspark.sql import functions as F

from lexitally import constants as K
from lexitally.functions.text import long_tokens
from lexitally.operators.metrics import class_report, confusion_cells, summary
from lexitally.operators.models import (
    knn, naive_bayes, ngram_features, random_forest, text_features, vectorise, with_score_columns,
)
from lexitally.operators.split import stratified_folds, stratified_split
from lexitally.operators.terms import ID, l2_normalise
from lexitally.plans.folds import bayes_folds
from lexitally.session import stored


def _tag(df, **values):
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def _stack(parts):
    return reduce(lambda a, b: a.unionByName(b), parts)


def bayes_matrix(docs, targets, id_col=ID, token_array="tokens"):
    """Naive Bayes predictions for targets x representations x weightings.

    `targets` maps a name to (label column, classes). One split per target
    serves all its runs. Returns rows (target, representation, config, id,
    actual, predicted).
    """
    runs = []
    for target, (label, classes) in targets.items():
        parted = stored(stratified_split(docs.select(id_col, label, token_array), id_col, label), "split")
        for representation in ("tfidf", "bow"):
            features = stored(text_features(parted, representation, token_array=token_array, carry=[label], id_col=id_col), "features")
            for weighted in (False, True):
                guess = naive_bayes(features, parted, label, classes, weighted, id_col)
                runs.append(
                    _tag(
                        guess.withColumnRenamed(label, "actual"),
                        target=target, representation=representation, config="weighted" if weighted else "unweighted",
                    )
                )
    return _stack(runs)


def neighbour_matrix(docs, targets, id_col=ID, token_array="tokens", normalise=False):
    """Nearest-neighbour predictions for targets x representations; class weights do not apply to it."""
    runs = []
    for target, (label, classes) in targets.items():
        parted = stored(stratified_split(docs.select(id_col, label, token_array), id_col, label), "split")
        for representation in ("tfidf", "bow"):
            features = stored(text_features(parted, representation, token_array=token_array, carry=[label], id_col=id_col), "features")
            features = l2_normalise(features, id_col) if normalise else features
            guess = knn(features, parted, label, classes, id_col=id_col)
            runs.append(_tag(guess.withColumnRenamed(label, "actual"), target=target, representation=representation))
    return _stack(runs)


def forest_matrix(docs, targets, id_col=ID, token_array="tokens", trees=K.LABEL_TREES):
    """Random-forest predictions for targets x representations x weightings."""
    runs = []
    for target, (label, classes) in targets.items():
        parted = stored(stratified_split(docs.select(id_col, label, token_array), id_col, label), "split").withColumn("_terms", long_tokens(token_array))
        for representation in ("tfidf", "bow"):
            vectors = vectorise(parted, representation)
            for weighted in (False, True):
                guess = random_forest(vectors, label, trees, weighted, id_col)
                runs.append(
                    _tag(
                        guess.withColumnRenamed(label, "actual"),
                        target=target, representation=representation, config="weighted" if weighted else "unweighted",
                    )
                )
    return _stack(runs)


def representation_pivot(scores, by, measure="macro_f1", representations=("bow", "tfidf")):
    """One column per representation for a measure."""
    return scores.groupBy(*by).pivot("representation", list(representations)).agg(F.first(measure))


def ngram_predictions(docs, label, classes, ranges=None, id_col=ID, token_array="tokens"):
    """Weighted Naive Bayes on TF-IDF unigrams, bigrams and both, from one table of features."""
    parted = stored(stratified_split(docs.select(id_col, label, token_array), id_col, label), "split")
    ranges = {name: tuple(span) for name, span in (ranges or K.NGRAM_RANGES).items()}
    features = ngram_features(parted, set(ranges.values()), token_array, [label], id_col)
    runs = []
    for name, span in ranges.items():
        guess = naive_bayes(features[span], parted, label, classes, True, id_col)
        runs.append(_tag(guess.withColumnRenamed(label, "actual"), representation=name))
    return _stack(runs)


def in_listed_order(df, column, order):
    """Sort by a fixed list of values, kept as an ordinal column."""
    rank = F.coalesce(*[F.when(F.col(column) == v, i) for i, v in enumerate(order, start=1)])
    return df.withColumn(f"{column}_order", rank).orderBy(f"{column}_order")


def ngram_comparison(docs, label, classes, id_col=ID, token_array="tokens"):
    """Summary, per-class report and confusion cells by n-gram range."""
    cells = confusion_cells(
        ngram_predictions(docs, label, classes, None, id_col, token_array), "actual", classes, ["representation"]
    )
    scores = in_listed_order(summary(cells, ["representation"]), "representation", list(K.NGRAM_RANGES))
    return scores, class_report(cells, ["representation"], macro=False), cells


def fold_runs(docs, label, classes, model="bayes", folds=K.FOLDS, id_col=ID, token_array="tokens", trees=K.TOPIC_TREES):
    """Predictions per fold and representation: (representation, fold, id, actual, predicted).

    `model` is bayes, knn (rows scaled to length 1) or forest. Vocabulary and idf are
    refitted on each fold's training rows. Naive Bayes makes its sums once for all
    folds; the other models are independent jobs over one assignment to folds.
    """
    assigned = stored(stratified_folds(docs, id_col, label, folds).withColumn("_terms", long_tokens(token_array)), "folds")
    if model == "bayes":
        return bayes_folds(assigned, label, classes, folds, id_col)
    runs = []
    for fold in range(folds):
        parted = assigned.withColumn("split", F.when(F.col("fold") == fold, "test").otherwise("train"))
        for representation in ("bow", "tfidf"):
            if model == "forest":
                guess = random_forest(vectorise(parted, representation), label, trees, False, id_col)
            else:
                features = stored(text_features(parted, representation, token_array=token_array, carry=[label], id_col=id_col), "features")
                guess = knn(l2_normalise(features, id_col), parted, label, classes, id_col=id_col)
            runs.append(_tag(guess.withColumnRenamed(label, "actual"), representation=representation, fold=fold))
    return _stack(runs)


def fold_scores(runs, classes):
    """Metrics per fold and representation."""
    cells = confusion_cells(runs, "actual", classes, ["representation", "fold"])
    return summary(cells, ["representation", "fold"], digits=15)


def fold_summary(scores, by=("representation",), measures=("accuracy", "macro_precision", "macro_recall", "macro_f1")):
    """Mean and population deviation over folds."""
    return scores.groupBy(*by).agg(
        *[F.round(F.avg(m), 4).alias(f"{m}_mean") for m in measures],
        *[F.round(F.stddev_pop(m), 4).alias(f"{m}_std") for m in measures],
    )


def enriched_predictions(parted, scored_columns, label, classes, id_col=ID, token_array="tokens", models=("bayes", "knn"), trees=K.TOPIC_TREES, baseline="bow"):
    """Bag of words (or what `baseline` names) against TF-IDF plus score columns, per model.

    `parted` holds documents with a split, tokens and the score columns. Nearest
    neighbours compare rows scaled to length 1, so that vector length does not
    decide between representations.
    """
    runs = []
    representations = {baseline: (baseline, []), "enriched": ("tfidf", list(scored_columns))}
    for name, (kind, columns) in representations.items():
        if set(models) - {"forest"}:  # forests read vectors
            features = stored(text_features(parted, kind, token_array=token_array, carry=[label], id_col=id_col), "features")
            if columns:
                features = with_score_columns(features, parted, columns)
        for model in models:
            if model == "bayes":
                guess = naive_bayes(features, parted, label, classes, False, id_col)
            elif model == "knn":
                guess = knn(l2_normalise(features, id_col), parted, label, classes, id_col=id_col)
            else:
                vectors = vectorise(parted.withColumn("_terms", long_tokens(token_array)), kind, extra=columns)
                guess = random_forest(vectors, label, trees, False, id_col)
            runs.append(_tag(guess.withColumnRenamed(label, "actual"), representation=name, classifier=model))
    return _stack(runs)
