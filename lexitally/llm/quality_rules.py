"""Rule-based quality filter: one threshold table compiled into one Spark projection.

Every rule bounds one measure of the text. Measures are array and string
functions of the row alone, so the whole filter is a projection over the scan:
no shuffle, no user function, and a text of any length stays in its row.

Defined results: a null text counts as a text without words; an empty text has
all counts 0 and fails the word-count rule; ratios with a zero denominator are
0; equal rows give equal rows; an empty table gives an empty result. The columns
that `with_measures` adds replace input columns of the same name.
"""

from pyspark.sql import functions as F

from lexitally.llm.text import NOT_SPACE, only, words

#: The symbols counted as such.
SYMBOLS = "#*$%&|<>"

#: Function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it on with as are be by this was from or an at have not "
    "der die das und zu den mit von ist ein eine einer nicht sich auf dem des er sie "
    "le la les de des et un une en du que qui dans pour par sur est pas au aux avec elle il "
    "el los las del y se por con para una su al lo como es no de la en que un"
).split()

#: Threshold table: (rule, measure, smallest and largest value that passes; None: no bound).
RULES = (
    ("enough_words", "n_words", 10, None),
    ("few_repeated_windows", "repeat_word_ratio", None, 0.2),
    ("word_length", "mean_word_chars", 2.5, 12.0),
    ("few_symbols", "symbol_word_ratio", None, 0.1),
    ("few_duplicate_lines", "dup_line_ratio", None, 0.4),
    ("few_upper_case", "upper_char_ratio", None, 0.35),
    ("mostly_letters", "alpha_word_ratio", 0.7, None),
    ("some_stop_words", "stop_word_ratio", 0.01, None),
)


def _length_sum(array):
    return F.length(F.array_join(array, ""))


def _repeat_words(w, size):
    """Words inside `size`-word windows that occur twice or more in the row, first ones included.

    Windows become (64-bit hash, position) pairs; sorted, equal windows are
    neighbours. The positions of repeated windows, sorted, cover `size` words
    each, less the overlap with the next one. Two different windows of one text
    share a hash with a chance below 2^-64 per pair of windows.
    """
    n = F.size(w) - (size - 1)
    window = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)])
    keyed = F.when(n > 0, F.array_sort(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(window(i).alias("h"), i.alias("i")))))

    def covered(s):
        same = lambda a, b: F.get(s, a)["h"].eqNullSafe(F.get(s, b)["h"])
        marks = F.transform(s, lambda x, k: F.when(((k > 0) & same(k, k - 1)) | same(k, k + 1), x["i"]))
        return _let(F.array_sort(F.array_compact(marks)), lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(size)), F.lit(size))),
            F.lit(0).cast("long"), lambda total, x: total + x,
        ))

    return F.coalesce(_let(keyed, covered), F.lit(0).cast("long"))


def _let(value, body):
    """body(value), with the value computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_measures(docs, text="text", window=5):
    """Add the counts and ratios that rules refer to."""
    t = F.coalesce(F.col(text), F.lit(""))
    staged = docs.withColumn("_w", words(t))
    w = F.col("_w")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_SPACE))
    symbols = F.length(t) - F.length(F.regexp_replace(t, "[" + SYMBOLS + "]+", ""))
    letters = r"\p{L}"
    stop = F.array(*[F.lit(x) for x in sorted(set(STOP_WORDS))])
    long = lambda c: c.cast("long")
    counted = staged.withColumns({
        "n_words": long(F.size(w)),
        "word_chars": long(_length_sum(w)),
        "n_symbols": long(symbols),
        "_lines": lines,
        "n_repeat_words": _repeat_words(w, window),
        "_upper": long(F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))),
        "_alpha": long(F.size(F.filter(w, lambda x: x.rlike(letters)))),
        "_stop": long(F.size(F.filter(w, lambda x: F.array_contains(stop, F.lower(x))))),
    }).withColumns({
        "n_lines": long(F.size("_lines")),
        "n_dup_lines": long(F.size("_lines") - F.size(F.array_distinct("_lines"))),
    })
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return counted.withColumns({
        "mean_word_chars": ratio("word_chars", "n_words"),
        "symbol_word_ratio": ratio("n_symbols", "n_words"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "repeat_word_ratio": ratio("n_repeat_words", "n_words"),
        "upper_char_ratio": ratio("_upper", "word_chars"),
        "alpha_word_ratio": ratio("_alpha", "n_words"),
        "stop_word_ratio": ratio("_stop", "n_words"),
    }).drop("_w", "_lines", "_upper", "_alpha", "_stop")


def failed(rules=RULES, names=None):
    """Array column: the rules of the table that a row of measures breaks, in table order."""
    checks = []
    for rule, measure, low, high in rules:
        if names is not None and rule not in names:
            continue
        broken = F.lit(False)
        if low is not None:
            broken = broken | (F.col(measure) < low)
        if high is not None:
            broken = broken | (F.col(measure) > high)
        checks.append(F.when(broken, F.lit(rule)))
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def quality_report(docs, text="text", rules=RULES):
    """Every row (its columns as a struct `row`) with its measures, the rules it breaks (`failed_rules`) and `kept`."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("_text"))
    judged = with_measures(rows, "_text").drop("_text").withColumn("failed_rules", failed(rules))
    return judged.withColumn("kept", F.size("failed_rules") == 0)


def keep_good(docs, text="text", rules=RULES):
    """The rows that break no rule, with their own columns only."""
    return only(quality_report(docs, text, rules), F.col("kept")).select("row.*")
