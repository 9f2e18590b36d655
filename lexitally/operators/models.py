"""Classifiers on long-form features: Naive Bayes, nearest neighbours, random forest.

Long-form features are rows (id, term, value); documents are rows (id, label,
split). Class lists are closed and given by the caller.
"""


from math import log

import numpy as np
import pandas as pd
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexitally import constants as K
from lexitally.functions.guards import row_count
from lexitally.functions.text import long_tokens
from lexitally.operators.blocks import weighted_terms
from lexitally.operators.forest import forest_votes
from lexitally.operators.terms import ID, TERM, bag_of_words, ngram_counts, tfidf
from lexitally.session import stored


# --- features ------------------------------------------------------------------


def text_features(docs, representation="tfidf", ngram_range=(1, 1), token_array="tokens", carry=(), id_col=ID, split="split", min_df=K.MIN_DF, max_df=K.MAX_DF):
    """Bag-of-words or TF-IDF rows for all documents, vocabulary and idf from training rows only.

    `carry` names document columns (labels) to keep on every row, so that
    fitting needs no join back to the documents.
    """
    pairs = ngram_counts(docs, ngram_range, token_array, (id_col, split, *carry))
    vocab = training_vocabulary(pairs, docs, split, min_df, max_df)
    weigh = {"bow": bag_of_words, "tfidf": lambda p, v: tfidf(p, v, id_col=id_col)}[representation]
    return weigh(pairs, vocab).select(id_col, split, *carry, TERM, F.col("value").cast("double").alias("value"))


def training_vocabulary(pairs, docs, split="split", min_df=K.MIN_DF, max_df=K.MAX_DF):
    """`vocabulary` of the training rows. They are counted inside the pairs of all rows: a filter below would keep the two from sharing a shuffle."""
    trained = F.col(split) == "train"
    df_ = pairs.groupBy(TERM).agg(F.count_if(trained).alias("df")).where(F.col("df") >= max(min_df, 1)).withColumn("n", row_count(docs.where(trained)))
    return df_ if max_df is None else df_.where(F.col("df") <= F.col("n") * max_df)


def ngram_features(docs, ranges, token_array="tokens", carry=(), id_col=ID, split="split", min_df=K.MIN_DF, max_df=K.MAX_DF, store=stored):
    """TF-IDF rows of several n-gram ranges from one count of words and pairs: {range: `text_features` of it}.

    Whether a term is in the vocabulary, and its idf, do not depend on the range; only the
    length of a document's row does.
    """
    held = docs.withColumn("_long", long_tokens(token_array))
    rows = weighted_terms(held, (id_col, split, *carry), "_long", [tuple(span) for span in ranges], False, min_df, max_df, split)
    rows = store(rows.select(id_col, split, *carry, TERM, *[F.col(f"v{a}{b}").alias(f"_v{a}{b}") for a, b in ranges]), "ngram-features")
    return {
        (a, b): rows.where(F.col(f"_v{a}{b}").isNotNull()).select(id_col, split, *carry, TERM, F.col(f"_v{a}{b}").alias("value"))
        for a, b in ranges
    }


def with_score_columns(features, docs, columns):
    """Add dense score columns to text features as extra terms named after the columns.

    Vocabulary terms hold only letters and digits, so a name with an underscore
    cannot collide with one.
    """
    extra = F.array(*[F.struct(F.lit(c).alias(TERM), F.col(c).cast("double").alias("value")) for c in columns])
    keys = [c for c in features.columns if c not in (TERM, "value")]
    return features.unionByName(docs.select(*keys, F.inline(extra)))


# --- Naive Bayes ---------------------------------------------------------------


def class_sizes(docs, label, classes):
    """Rows per class, in the order of `classes`: a few numbers on the driver."""
    return list(docs.agg(*[F.count_if(F.col(label) == c) for c in classes]).first())


def balanced_weights(sizes):
    """Balanced weight of each class: rows / (classes present x class size)."""
    present = sum(1 for n in sizes if n)
    return [sum(sizes) / (present * n) if n else 0.0 for n in sizes]


def fit_naive_bayes(features, train, label, classes, weighted=False, store=stored):
    """Multinomial Naive Bayes with smoothing 1 and an unsmoothed class prior.

    `features` are training rows that carry the label. Balanced weights are the
    same for all rows of a class, so they scale the class sums after the
    aggregation. The fitted sums are written as a table, one row per term; only
    a few numbers per class reach the driver. Returns the terms with a log
    probability per class (`_lp0`, `_lp1`, ...) and the list of log priors.
    """
    sizes = class_sizes(train, label, classes)
    weights = balanced_weights(sizes) if weighted else [1.0] * len(classes)
    sums = features.groupBy(TERM).agg(
        *[
            (F.lit(w) * F.sum(F.when(F.col(label) == c, F.col("value")).otherwise(F.lit(0.0)))).alias(f"_s{k}")
            for k, (c, w) in enumerate(zip(classes, weights))
        ]
    )
    terms = smoothed_log_probs(store(sums, "bayes-terms"), len(classes))
    mass = [w * n for w, n in zip(weights, sizes)]
    return terms, [log(m / sum(mass)) if m else float("-inf") for m in mass]


def smoothed_log_probs(sums, n_classes, carry=()):
    """Log probability of every term per class, from the class sums `_s0`, `_s1`, ... of a written table."""
    *totals, n_features = sums.agg(*[F.sum(f"_s{k}") for k in range(n_classes)], F.count(F.lit(1))).first()
    return sums.select(
        TERM, *carry,
        *[(F.ln(F.col(f"_s{k}") + 1) - F.lit(log((t or 0.0) + n_features) if n_features else 0.0)).alias(f"_lp{k}") for k, t in enumerate(totals)],
    )


def predict_naive_bayes(terms, priors, features, docs, label, classes, id_col=ID):
    """Most probable class per document: (id, label, predicted).

    Every document adds a row of zeros to the sums, which keeps documents
    without a known term and brings their label along without a join.
    """
    ks = range(len(classes))
    scored = features.join(terms, TERM).select(
        id_col, F.lit(None).cast("string").alias(label), *[(F.col("value") * F.col(f"_lp{k}")).alias(f"_x{k}") for k in ks]
    )
    none = docs.select(id_col, label, *[F.lit(0.0).alias(f"_x{k}") for k in ks])
    summed = scored.unionByName(none).groupBy(id_col).agg(
        F.max(label).alias(label), *[F.sum(f"_x{k}").alias(f"_x{k}") for k in ks]
    )
    joint = [F.round(F.col(f"_x{k}") + F.lit(priors[k]), 9) for k in ks]
    return summed.select(id_col, label, _first_best(joint, classes).alias("predicted"))


def _first_best(scores, classes):
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return F.coalesce(*[F.when(s == top, F.lit(c)) for s, c in zip(scores, classes)])


def naive_bayes(features, docs, label, classes, weighted=False, id_col=ID, split="split"):
    """Fit on the training split, predict the test split: (id, label, predicted)."""
    train, test = docs.where(F.col(split) == "train"), docs.where(F.col(split) == "test")
    terms, priors = fit_naive_bayes(features.where(F.col(split) == "train"), train, label, classes, weighted)
    return predict_naive_bayes(terms, priors, features.where(F.col(split) == "test"), test, label, classes, id_col)


# --- nearest neighbours --------------------------------------------------------


def nearest_neighbours(features, docs, label, k=K.NEIGHBOURS, id_col=ID, split="split", block_tokens=4_000_000):
    """The k nearest training rows of every test row by Euclidean distance, exact.

    A document is one row with an array of (term hash, value). Both sides are hashed
    into blocks of about `block_tokens` terms (fewer in small tables, to use all cores) and
    every test block meets every train block in its own task, which keeps only its k best per
    test row before anything is shuffled again; no pair of documents is ever a row. Rows are
    sent once per block of the other side, so what is shuffled falls with the size of a
    block; the arithmetic grows with test rows x train rows, as in any exact search; the
    data held by one task does not.
    """
    arrays = features.groupBy(id_col).agg(F.collect_list(F.struct(F.xxhash64(TERM).alias("code"), F.col("value").cast("double").alias("value"))).alias("_x"))
    rows = docs.select(id_col, split).join(arrays, id_col, "left").select(
        id_col, split, F.coalesce(F.transform("_x", lambda x: x["code"]), F.array().cast("array<bigint>")).alias("codes"),
        F.coalesce(F.transform("_x", lambda x: x["value"]), F.array().cast("array<double>")).alias("values"),
    )
    rows = stored(rows, "document-arrays")
    block = F.xxhash64(id_col)

    def terms(part):
        return part.agg(F.coalesce(F.sum(F.size("codes") + 1), F.lit(1))).scalar()

    def blocks(side):
        most = F.least(F.lit(block_tokens), F.greatest(F.lit(1_000_000), terms(rows) / 8))
        return F.ceil(terms(rows.where(F.col(split) == side)) / most).cast("int")

    def dealt(side, own, other):
        return (
            rows.where(F.col(split) == side).drop(split).withColumn(own, F.pmod(block, blocks(side)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), blocks("train" if side == "test" else "test") - 1)))
        )

    left, right = dealt("test", "_tb", "_rb"), dealt("train", "_rb", "_tb")
    id_type = dict(docs.dtypes)[id_col]
    found = (
        # Both sides come from one table; fresh column identities keep them apart.
        left.toDF(*left.columns).groupBy("_tb", "_rb").cogroup(right.toDF(*right.columns).groupBy("_tb", "_rb"))
        .applyInPandas(_block_neighbours(id_col, k), f"test_id {id_type}, train_id {id_type}, distance2 double")
    )
    order = Window.partitionBy("test_id").orderBy("distance2", "train_id")
    nearest = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    labels = docs.where(F.col(split) == "train").select(F.col(id_col).alias("train_id"), F.col(label).alias("neighbour_label"))
    return nearest.join(labels, "train_id")


def _block_neighbours(id_col, k, cells=4_000_000, common=0.004):
    """Distances of two blocks: terms that at least `common` of all pairs share go through one matrix product, others through lists of the rows that hold them."""

    def flat(frame):
        sizes = np.array([len(c) for c in frame["codes"]])
        codes = np.concatenate([np.asarray(c, np.int64) for c in frame["codes"]])
        values = np.concatenate([np.asarray(v, np.float64) for v in frame["values"]])
        owner = np.repeat(np.arange(len(frame)), sizes)
        return codes, values, owner, np.bincount(owner, weights=values**2, minlength=len(frame))

    def nearest(test: pd.DataFrame, train: pd.DataFrame) -> pd.DataFrame:
        if test.empty or train.empty:
            return pd.DataFrame({"test_id": [], "train_id": [], "distance2": []})
        codes, values, owner, length2 = flat(test)
        train_codes, train_values, train_owner, train_length2 = flat(train)
        ids, width = train[id_col].to_numpy(), len(train)
        # Only terms that a test document has add to a product; of a term given twice, the last one counts.
        vocab, place = np.unique(codes, return_inverse=True)
        key = owner * len(vocab) + place
        _, back = np.unique(key[::-1], return_index=True)
        last = len(key) - 1 - back
        owner, place, values = owner[last], place[last], values[last]
        at = np.minimum(np.searchsorted(vocab, train_codes), max(len(vocab) - 1, 0))
        met = vocab[at] == train_codes if len(vocab) else np.zeros(len(train_codes), bool)
        at, weight, holder = at[met], train_values[met], train_owner[met]
        order = np.argsort(at, kind="stable")
        at, weight, holder = at[order], weight[order], holder[order]
        held = np.bincount(at, minlength=len(vocab))
        begin = np.cumsum(held) - held
        dense = np.bincount(place, minlength=len(vocab)) * held > common * len(test) * width
        column = np.cumsum(dense) - 1
        table = np.zeros((width, int(dense.sum())))
        often = dense[at]
        np.add.at(table, (holder[often], column[at[often]]), weight[often])
        rare = ~dense[place]
        row_cost = np.bincount(owner[rare], weights=held[place[rare]], minlength=len(test))
        reach = np.cumsum(np.maximum(row_cost, width))
        out, first = [], 0
        while first < len(test):  # as many test rows at a time as fit `cells`
            after = max(first + 1, int(np.searchsorted(reach, (reach[first - 1] if first else 0) + cells, "right")))
            lo, hi = np.searchsorted(owner, [first, after])
            mine, word, value = owner[lo:hi] - first, place[lo:hi], values[lo:hi]
            full = dense[word]
            left = np.zeros((after - first, table.shape[1]))
            left[mine[full], column[word[full]]] = value[full]
            dot = left @ table.T
            mine, word, value = mine[~full], word[~full], value[~full]
            many = held[word]
            source = np.repeat(np.arange(len(word)), many)
            entry = np.arange(len(source)) + np.repeat(begin[word] - (np.cumsum(many) - many), many)
            dot += np.bincount(mine[source] * width + holder[entry], weights=value[source] * weight[entry], minlength=dot.size).reshape(dot.shape)
            out.append((test[id_col].to_numpy()[first:after], *_least(length2[first:after, None] + train_length2 - 2 * dot, ids, min(k, width))))
            first = after
        return pd.DataFrame({
            "test_id": np.concatenate([mine[row] for mine, row, _, _ in out]),
            "train_id": np.concatenate([near for _, _, near, _ in out]), "distance2": np.concatenate([d for _, _, _, d in out]),
        })

    return nearest


def _least(distances, ids, keep, digits=9):
    """(row, id, distance) of the `keep` smallest distances of every row, to nine digits, ties to the smaller id."""
    edge = np.partition(distances, keep - 1, axis=1)[:, keep - 1 : keep]
    row, at = np.nonzero(distances <= edge + 2 * 10.0**-digits)
    near = np.round(distances[row, at], digits) + 0.0
    order = np.lexsort((ids[at], near, row))
    row, at, near = row[order], at[order], near[order]
    best = np.arange(len(row)) - np.searchsorted(row, row) < keep
    return row[best], ids[at[best]], near[best]


def knn(features, docs, label, classes, k=K.NEIGHBOURS, id_col=ID, split="split", **blocks):
    """Majority label of the k nearest training rows, smallest label on ties: (id, label, predicted)."""
    near = nearest_neighbours(features, docs, label, k, id_col, split, **blocks)
    votes = near.groupBy(F.col("test_id").alias(id_col)).agg(
        *[F.count_if(F.col("neighbour_label") == c).alias(f"_v{i}") for i, c in enumerate(classes)]
    )
    guess = votes.select(id_col, _first_best([F.col(f"_v{i}") for i in range(len(classes))], classes).alias("predicted"))
    return docs.where(F.col(split) == "test").select(id_col, label).join(guess, id_col)


# --- random forest -------------------------------------------------------------


def vectorise(docs, representation="tfidf", token_array="_terms", split="split", min_df=K.MIN_DF, max_df=K.MAX_DF, extra=(), max_vocabulary=1 << 24):
    """Add an ML `features` vector, vocabulary and idf from training rows only.

    `max_vocabulary` is the width the ML library can hold, not a selection: a
    training vocabulary that reaches it fails rather than losing terms.
    """
    train = docs.where(F.col(split) == "train")
    counter = CountVectorizer(
        inputCol=token_array, outputCol="_counts", minDF=float(min_df), maxDF=float(max_df), vocabSize=max_vocabulary
    ).fit(train)
    if len(counter.vocabulary) >= max_vocabulary:
        raise ValueError(f"the vocabulary exceeds {max_vocabulary} terms")
    out, column = counter.transform(docs), "_counts"
    if representation == "tfidf":
        idf = IDF(inputCol="_counts", outputCol="_idf").fit(counter.transform(train))
        scale = ElementwiseProduct(
            scalingVec=Vectors.dense(np.asarray(idf.idf.toArray()) + 1.0), inputCol="_counts", outputCol="_scaled"
        )
        out = Normalizer(p=2.0, inputCol="_scaled", outputCol="_tfidf").transform(scale.transform(out))
        column = "_tfidf"
    return VectorAssembler(inputCols=[column, *extra], outputCol="features").transform(out)


def random_forest(vectors, label, trees=K.TOPIC_TREES, weighted=False, id_col=ID, split="split", seed=K.SEED, max_depth=30):
    """Distributed random forest: square-root feature subsets, deep trees, optional balanced weights."""
    train = vectors.where(F.col(split) == "train")
    found = train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()  # one row a class
    sizes = {row[label]: row["n"] for row in found}
    if not sizes or None in sizes:
        raise ValueError("a forest needs training rows, and a label on each")
    classes = sorted(sizes)
    weights = balanced_weights([sizes[c] for c in classes]) if weighted else [1.0] * len(classes)
    vector = F.unwrap_udt("features")
    width = vectors.select(F.coalesce(vector["size"], F.size(vector["values"])).alias("width")).first()["width"]
    dense = F.sequence(F.lit(0), F.size(vector["values"]) - 1)
    number = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
    rows = vectors.where(F.col(split).isin("train", "test")).select(
        F.col(id_col).alias("id"), F.col(label).alias("label"), F.when(F.col(split) == "train", number).otherwise(-1).cast("int").alias("y"),
        F.xxhash64(id_col).alias("code"), F.coalesce(vector["indices"], dense).alias("index"), vector["values"].alias("value"),
    )
    votes = forest_votes(rows, width, len(classes), np.array(weights), trees, seed, max_depth)
    best = F.array_position("votes", F.array_max("votes")).cast("int")
    return votes.select(F.col("id").alias(id_col), F.col("label").alias(label), F.element_at(F.array(*[F.lit(c) for c in classes]), best).alias("predicted"))
