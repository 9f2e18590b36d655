"""Rows met with tables of keywords and of time windows."""

import unicodedata

import pandas as pd
from pyspark.sql import functions as F

from lexitally import constants as K
from lexitally.functions.text import _as_col
from lexitally.operators.ordering import running_total
from lexitally.session import stored


def _counter(rows):
    """A function from a text to its hits per topic, for keywords (topic, keyword, whole_word)."""
    import ahocorasick

    uses = {}
    for topic, keyword, whole in rows:
        uses.setdefault(keyword, []).append((topic, whole))
    automaton = ahocorasick.Automaton()
    for keyword, topics in uses.items():
        automaton.add_word(keyword, (keyword, topics))
    automaton.make_automaton()

    def is_word(text, at):
        if not 0 <= at < len(text):
            return False
        if text[at] == "_":
            return True
        while at and unicodedata.category(text[at]) == "Mn":  # a mark belongs to the letter before it
            at -= 1
        return text[at].isalpha() or text[at].isdecimal()

    def hits(text):
        reached, found = {}, {}
        for end, (keyword, topics) in automaton.iter(text):
            start = end + 1 - len(keyword)
            alone = is_word(text, start - 1) != is_word(text, start) and is_word(text, end) != is_word(text, end + 1)
            for topic, whole in topics:
                key = keyword, topic, whole
                if (alone or not whole) and start > reached.get(key, -1):  # a keyword's hits do not overlap
                    reached[key] = end
                    found[topic] = found.get(topic, 0) + 1
        return found

    return hits


def relevant_by_table(df, text, keywords, min_hits=K.MIN_KEYWORD_HITS, most=1_000_000):
    """One row per (post, topic) the post is relevant to, for a table of keywords (topic, keyword, whole_word).

    Counts as `relevant_topics` does, for any number of keywords in one pass over the
    text: an automaton finds all of them at once, in Arrow batches. The table is sent to
    every task, so its size is checked; a larger one than `most` rows fails. Null and
    empty keywords and texts have no hits.
    """
    usable = keywords.where("topic IS NOT NULL AND keyword <> ''").select("topic", "keyword", F.coalesce("whole_word", F.lit(False))).distinct()
    rows = [tuple(r) for r in usable.limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"more than {most} keywords")
    kept = [c for c in df.columns if c not in ("topic", "keyword_hits")]
    if not rows:
        return df.select(*kept, F.lit("").alias("topic"), F.lit(0).alias("keyword_hits")).where(F.lit(False))

    @F.pandas_udf("array<struct<topic:string,keyword_hits:int>>")
    def counted(texts: pd.Series) -> pd.Series:
        hits = _counter(rows)
        return texts.map(lambda t: [{"topic": topic, "keyword_hits": n} for topic, n in sorted(hits(t).items()) if n >= min_hits] if t else [])

    return df.select(*kept, F.inline(counted(F.lower(_as_col(text)))))


def in_windows(df, ts, windows, name="window_name"):
    """A row per window that holds the timestamp, for a table of windows (name, start, end) in epoch seconds, both ends exclusive.

    Windows may overlap and differ in length by any factor. A window of n seconds lies in
    two buckets, at most, of the power of two above n; a timestamp has one bucket for
    each power in use. So the join is on equal buckets, and the range is tested inside.
    Windows that hold no instant, and null timestamps, give no rows.
    """
    usable = windows.where(F.col("end") > F.col("start")).select(F.col(name).alias("_name"), F.col("start").cast("long").alias("_start"), F.col("end").cast("long").alias("_end"))
    level = F.length(F.bin(F.col("_end") - F.col("_start")))
    leveled = usable.withColumn("_level", level)
    levels = leveled.agg(F.array_sort(F.collect_set("_level"))).scalar()  # at most 64
    right = leveled.withColumn("_bucket", F.explode(F.expr("sequence(shiftright(_start, _level), shiftright(_end, _level))")))
    at = F.col(ts).cast("timestamp")
    left = df.withColumns({"_micros": F.unix_micros(at), "_seconds": F.unix_seconds(at)}).where("_micros IS NOT NULL").withColumn("_levels", levels)
    left = left.withColumn("_level", F.explode("_levels")).withColumn("_bucket", F.expr("shiftright(_seconds, _level)"))
    met = left.join(right, ["_level", "_bucket"]).where("_micros > _start * 1000000 AND _micros < _end * 1000000")
    return met.select(*[c for c in df.columns if c != name], F.col("_name").alias(name))


def count_in_windows(df, ts, windows, name="window_name", store=stored):
    """Rows per window whose timestamp it holds, for a table of windows as in `in_windows`: (name, count), counts above 0.

    A row and a window never meet: a window's count is the rows before its end less those
    up to its start, both read from one running total over the distinct instants. So the
    work grows with rows plus windows, not with the matches. Windows of one name are summed.
    """
    usable = windows.where(F.col("end") > F.col("start")).select(
        F.col(name).alias("_name"), (F.col("start").cast("long") * 1_000_000 + 1).alias("_from"), (F.col("end").cast("long") * 1_000_000).alias("_to")
    )
    edges = F.inline(F.array(F.struct(F.col("_from").alias("_at"), F.lit(-1).alias("_sign")), F.struct(F.col("_to").alias("_at"), F.lit(1).alias("_sign"))))
    bounds = usable.select("_name", edges)
    micros = F.unix_micros(F.col(ts).cast("timestamp")).alias("_at")
    instants = df.select(micros, F.lit(1).cast("long").alias("_n")).where("_at IS NOT NULL").unionByName(bounds.select("_at", F.lit(0).cast("long").alias("_n")))
    before = running_total(store(instants.groupBy("_at").agg(F.sum("_n").alias("_n")), "instants"), "_at", "_n", "_before")
    counted = bounds.join(before.select("_at", "_before"), "_at").groupBy(F.col("_name").alias(name)).agg(F.sum(F.col("_sign") * F.col("_before")).alias("count"))
    return counted.where(F.col("count") > 0)
