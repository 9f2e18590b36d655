"""Brown class-based bigram language model: exchange clustering, smoothed scores of whole texts.

p(word | word before) = p(class | class before) * p(unit | class) * p(word | unit).

Units are what is clustered: each of the `CLUSTERED` most frequent words by itself,
and for all other words one of `SUFFIXES` units by a hash of the word's end. So
every word of the training texts has a class, its own count, and its share of its
unit; the two numbers bound the model, not the text that it is fitted on. The end of
a text is a unit and a class of its own, and the context of a first word.

Fitting counts everything in Spark: words by partial sums; then, for every pass of
the exchange algorithm, how often each unit follows and precedes each class. Those
sums, at most units x classes numbers, come to the driver, which moves units one by
one to the class that raises the likelihood most, with class counts kept up to date.

Scoring reads a text once. Words of a dictionary of bounded size (the `KNOWN` most
frequent, broadcast) are scored on the spot, so no frequent word is a join key; the
others go as (row, word, count) to a join with the word counts, whatever their number.

Smoothing: classes back off to their frequency (`BACKOFF` pseudo counts), units of a
class get half a count more, words of a suffix unit one, and there is one unseen word
in every unit.

Defined results: a null or empty text is the end token alone; a null id counts as
training; rows that repeat are scored each, and count each in training; without
training texts every probability is that of an empty count; an empty table gives no
rows.
"""

import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lexitally.llm.resampling import kth_largest
from lexitally.llm.text import word_bytes
from lexitally.session import delete_path, scratch_path, stored

KNOWN = 1 << 16
CLUSTERED = 1 << 13
SUFFIXES = 1 << 10
CLASSES = 64
PASSES = 3
BACKOFF = 50.0
FLUSH = 200_000
END = b""


# --- counting words --------------------------------------------------------------------


def word_counts(texts, flush=FLUSH):
    """(word, n) over a one-column table of texts; the end of a text is the empty word. A task holds about `flush` words."""

    def counted(batches):
        counts = Counter()

        def batch_of(counts):
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(word_bytes(text or ""))
                counts[END] += 1
                if len(counts) > flush:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)

    return texts.mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Dictionary:
    """The most frequent words with their counts, and the unit of every word.

    Units: 0 the end, then the clustered words, then the suffix units.
    """

    def __init__(self, counts, known=KNOWN, clustered=CLUSTERED, suffixes=SUFFIXES):
        self.suffixes = suffixes
        least = kth_largest(counts, "n", known) if counts.count() > known else 0
        frequent = counts.where((F.col("n") > least) & (F.col("word") != END)).toArrow()  # at most `known` rows
        frequent = sorted(zip(frequent["n"].to_pylist(), frequent["word"].to_pylist()), key=lambda x: (-x[0], x[1]))
        self.index = {word: i for i, (_, word) in enumerate(frequent)}
        self.count = np.array([n for n, _ in frequent], np.int64)
        own = min(clustered, len(frequent))
        self.first_suffix = 1 + own
        self.units = self.first_suffix + suffixes
        self.unit = np.array([1 + i if i < own else self._suffix_unit(w) for i, (_, w) in enumerate(frequent)], np.int32)
        totals = counts.agg(F.sum("n"), F.count("*"), F.sum(F.when(F.col("word") == END, F.col("n")))).first()
        self.tokens, self.words, self.ends = (int(x or 0) for x in totals)
        # Suffix units: tokens and different words, less those of the clustered words.
        suffix = F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(suffixes))
        by_suffix = counts.where(F.col("word") != END).groupBy(suffix.alias("s")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
        self.unit_count, self.unit_words = np.zeros(self.units), np.ones(self.units)
        self.unit_count[0] = self.ends
        self.unit_count[1 : 1 + own] = self.count[:own]
        self.unit_words[self.first_suffix :] = 0
        for row in by_suffix:
            self.unit_count[self.first_suffix + row["s"]] = row["n"]
            self.unit_words[self.first_suffix + row["s"]] = row["v"]
        for n, word in frequent[:own]:
            self.unit_count[self._suffix_unit(word)] -= n
            self.unit_words[self._suffix_unit(word)] -= 1

    def _suffix_unit(self, word):
        return self.first_suffix + zlib.crc32(word[-3:]) % self.suffixes

    def look_up(self, words):
        """(place in the dictionary or -1, unit) of every word."""
        place = np.fromiter(map(self.index.get, words, repeat(-1)), np.int32, len(words))
        unit = self.unit[place] if len(self.unit) else np.zeros(len(words), np.int32)
        for i in np.flatnonzero(place < 0):
            unit[i] = self._suffix_unit(words[i])
        return place, unit


# --- exchange clustering ------------------------------------------------------------------


def unit_stream(texts, shared):
    """One row a batch: the units of its texts as packed 32-bit integers, each text closed by the end unit."""

    def streamed(batches):
        for batch in batches:
            parts = []
            for text in batch.column(0).to_pylist():
                parts += [shared.value.look_up(word_bytes(text or ""))[1], np.zeros(1, np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(parts).astype(np.int32).tobytes()], pa.binary())], ["units"])

    return texts.mapInArrow(streamed, "units binary")


def neighbour_classes(stream, classes, units, n_classes):
    """Two matrices units x classes: how often a unit follows, and precedes, a word of a class."""

    def counted(batches):
        after, before = np.zeros(units * n_classes, np.int64), np.zeros(units * n_classes, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                unit = np.frombuffer(packed, np.int32).astype(np.int64)
                left = np.concatenate([[0], unit[:-1]])
                after += np.bincount(unit * n_classes + classes[left], minlength=len(after))
                before += np.bincount(left * n_classes + classes[unit], minlength=len(before))
        seen = np.flatnonzero(after + before)
        columns = [pa.array(seen), pa.array(after[seen]), pa.array(before[seen])]
        yield pa.RecordBatch.from_arrays(columns, ["cell", "after", "before"])

    cells = stream.mapInArrow(counted, "cell long, after long, before long").groupBy("cell").agg(F.sum("after").alias("a"), F.sum("before").alias("b")).toArrow()
    after, before = np.zeros(units * n_classes), np.zeros(units * n_classes)
    at = cells["cell"].to_numpy()
    after[at], before[at] = cells["a"].to_numpy(), cells["b"].to_numpy()
    return after.reshape(units, n_classes), before.reshape(units, n_classes)


def class_bigrams(after, classes):
    """Matrix (class before, class) of counts."""
    table = np.zeros((after.shape[1], after.shape[1]))
    np.add.at(table.T, classes, after)
    return table


def _entropy(x):
    return x * np.log(np.maximum(x, 1.0))


def exchange(after, before, classes):
    """One pass: every unit but the end, most frequent first, moves to the class with the highest likelihood.

    The likelihood is that of the class bigrams, counts kept up to date with every move.
    """
    classes = classes.copy()
    table = class_bigrams(after, classes)
    total = after.sum(axis=1)
    weight = table.sum(axis=0)
    terms, totals = _entropy(table), _entropy(weight)
    for u in sorted(range(1, len(classes)), key=lambda u: (-total[u], u)):
        if not total[u]:
            break
        own = classes[u]
        came, went = after[u], before[u]
        table[:, own] -= came
        table[own, :] -= went
        weight[own] -= total[u]
        np.maximum(table, 0, out=table)
        terms[:, own], terms[own, :], totals[own] = _entropy(table[:, own]), _entropy(table[own, :]), _entropy(weight[own])
        come, go = np.flatnonzero(came), np.flatnonzero(went)
        gain = (_entropy(table[come] + came[come, None]) - terms[come]).sum(axis=0)
        gain += (_entropy(table[:, go] + went[go]) - terms[:, go]).sum(axis=1)
        gain -= 2 * (_entropy(weight + total[u]) - totals)
        gain[0] = -np.inf  # the end's class
        best = int(np.argmax(gain))
        classes[u] = best
        table[:, best] += came
        table[best, :] += went
        weight[best] += total[u]
        terms[:, best], terms[best, :], totals[best] = _entropy(table[:, best]), _entropy(table[best, :]), _entropy(weight[best])
    return classes


class BrownModel:
    """Log10 probabilities: `transition` (class before, class), `emission` of units, `base` and `share` parts of words."""

    def __init__(self, dictionary, classes, table):
        d = self.dictionary = dictionary
        self.classes = classes
        n = table.sum(axis=0)
        back = (n + 1) / (n + 1).sum()
        self.transition = np.log10((table + BACKOFF * back) / (table.sum(axis=1, keepdims=True) + BACKOFF))
        size = np.bincount(classes, weights=d.unit_count + 0.5, minlength=len(n))
        self.emission = np.log10((d.unit_count + 0.5) / size[classes])
        self.share_total = np.zeros(d.units)  # of a word in its unit: log10(count + 1) less this, for suffix units
        self.share_total[d.first_suffix :] = np.log10(d.unit_count[d.first_suffix :] + d.unit_words[d.first_suffix :] + 1)
        self.base_total = np.log10(d.tokens + d.words + 1)
        self.log_count = np.log10(d.count + 1.0)

    def score(self, text):
        """(tokens, known ones, base score, model score, {word: count}) of a text; the words outside the dictionary
        still lack log10(their count + 1) in both scores and their place among the known."""
        d = self.dictionary
        words = word_bytes(text)
        place, unit = d.look_up(words)
        seen = place >= 0
        logs = self.log_count[place[seen]]
        n = len(words) + 1
        base = logs.sum() + np.log10(d.ends + 1) - n * self.base_total
        unit = np.append(unit, 0)
        cls = self.classes[unit]
        model = self.transition[np.concatenate([[0], cls[:-1]]), cls].sum() + self.emission[unit].sum() - self.share_total[unit].sum()
        shared = unit[:-1][seen] >= d.first_suffix
        model += logs[shared].sum()
        others = Counter(words[i] for i in np.flatnonzero(~seen))
        return n, int(seen.sum()) + (d.ends > 0), float(base), float(model), others


def fit(texts, counts, n_classes=CLASSES, passes=PASSES, **sizes):
    """The model of a one-column table of training texts with their word counts."""
    spark = texts.sparkSession
    dictionary = Dictionary(counts, **sizes)
    shared = spark.sparkContext.broadcast(dictionary)
    path = scratch_path(spark, "unit-stream")
    unit_stream(texts, shared).write.parquet(path)
    stream = spark.read.parquet(path)
    classes = 1 + np.arange(dictionary.units) % (n_classes - 1)
    classes[0] = 0
    for _ in range(passes):
        classes = exchange(*neighbour_classes(stream, classes, dictionary.units, n_classes), classes)
    table = class_bigrams(neighbour_classes(stream, classes, dictionary.units, n_classes)[0], classes)
    delete_path(spark, path)
    return BrownModel(dictionary, classes, table)


# --- scoring --------------------------------------------------------------------------


def score_documents(docs, train, id_col="doc_id", text="text", **options):
    """Per row: id, train (boolean), n_tokens, n_known, train_tokens, base_score, score.

    `train` is a condition on the rows that says which texts the model learns from;
    options are those of `fit` and `Dictionary`.
    """
    spark = docs.sparkSession
    flagged = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(train, F.lit(True)).alias("train"), F.col(f"`{text}`").alias("text"))
    texts = flagged.where("train").select("text")
    counts = stored(word_counts(texts), "word-counts")
    model = fit(texts, counts, **options)
    shared = spark.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)[id_col]
    pair = pa.list_(pa.struct([("word", pa.binary()), ("tf", pa.int64())]))

    def scored(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, known, base, score, others = zip(*[shared.value.score(t or "") for t in part.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(score),
                     pa.array([[{"word": w, "tf": c} for w, c in o.items()] for o in others], pair)],
                    ["id", "train", "n_tokens", "known", "base", "model", "others"],
                )

    schema = f"id {kind}, train boolean, n_tokens long, known long, base double, model double, others array<struct<word:binary,tf:bigint>>"
    partial = stored(flagged.mapInArrow(scored, schema).withColumn("row", F.monotonically_increasing_id()), "partial-scores")
    others = partial.select("row", F.explode("others").alias("o")).select("row", "o.word", "o.tf")
    rest = others.join(counts, "word").groupBy("row").agg(F.sum("tf").alias("_known"), F.sum(F.col("tf") * F.log10(F.col("n") + 1)).alias("_logs"))
    logs = F.coalesce("_logs", F.lit(0.0))
    return partial.drop("others").join(rest, "row", "left").select(
        F.col("id").alias(id_col), "train", "n_tokens", (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(model.dictionary.tokens).cast("long").alias("train_tokens"), (F.col("base") + logs).alias("base_score"), (F.col("model") + logs).alias("score"),
    )
