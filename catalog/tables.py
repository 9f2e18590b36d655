"""How the given tables stand in for posts, labels and raters.

documents: posts, with lang as the topic. labels: toxic -> negative, else
quality 1 -> positive, else neutral. orders: a three-class label (status) by
group (priority) over time. events: search hits, with days as windows.
"""

from pyspark.sql import functions as F

from lexitally import constants as K
from lexitally.functions.labels import label_targets
from lexitally.functions.text import clean_text, word_count
from lexitally.operators.terms import prepare, with_tokens
from lexitally.session import spread, stored
from lexitally.sources.io import read_table

STATUS = ["F", "O", "P"]
LANGS = ["de", "en", "es", "fr"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

_STAGES = {}


def _stage(spark, sf, name, build):
    """A stage table, written once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STAGES:
        _STAGES[key] = stored(build(), name)
    return _STAGES[key]


def posts(spark, sf):
    docs = spread(read_table(spark, sf, "documents"))
    return docs.select(F.col("doc_id").alias("post_id"), F.col("lang").alias("topic"), "text", "source")


def clean(spark, sf):
    """Posts with cleaned text and the word count of the raw text."""
    docs = posts(spark, sf)
    return docs.withColumns({"text_clean": clean_text("text"), "word_count": word_count("text")})


def features(spark, sf):
    """Stage table: posts with cleaned and stop-word-free text."""

    def build():
        return prepare(clean(spark, sf)).drop("text")

    return _stage(spark, sf, "topic_features", build)


def corpus(spark, sf):
    """Stage table split into tokens, blank rows dropped."""
    return with_tokens(features(spark, sf)).select("post_id", "topic", "tokens")


def label_table(spark, sf):
    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    labels = read_table(spark, sf, "labels")
    return labels.select(F.col("doc_id").alias("post_id"), label.alias("final_sentiment"))


def labelled(spark, sf):
    """Posts that have a label, with tokens and both targets."""
    docs = with_tokens(features(spark, sf)).join(label_table(spark, sf), "post_id")
    return label_targets(docs).drop("text_no_stopwords", "source")


def scored_posts(spark, sf):
    """The columns of `labelled` that document scores read."""
    return labelled(spark, sf).select("post_id", "topic", "tokens", "final_sentiment")


def order_posts(spark, sf):
    orders = read_table(spark, sf, "orders")
    return orders.select(
        F.col("o_orderkey").alias("post_id"), F.col("o_orderpriority").alias("topic"),
        F.col("o_orderstatus").alias("label"), F.col("o_orderdate").alias("created_at"), "o_totalprice",
    )


def _drawn_label(key):
    """One of three labels, blank or unknown, drawn by a hex digit of the id's hash."""
    digit = F.substring(F.md5(F.concat_ws(":", F.col("post_id").cast("string"), F.lit(key))), 1, 1)
    return (
        F.when(digit < "5", "negative").when(digit == "5", "\t Neutral \n").when(digit == "6", "neutral\n").when(digit < "a", "neutral")
        .when(digit < "e", "positive").when(digit == "e", F.lit(None).cast("string")).otherwise("unsure")
    )


def rater_sheet(spark, sf):
    """Every labelled post with four raters' labels."""
    sheet = label_table(spark, sf).select("post_id")
    return sheet.withColumns({r: _drawn_label(r) for r in K.RATERS})


def adjudications(spark, sf):
    return label_table(spark, sf).select("post_id", _drawn_label("adjudicated").alias("adjudicated_sentiment"))


# --- the same in SQL -------------------------------------------------------------


def sql_list(values):
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def sql_unescape(c):
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·")):
        c = f"replace({c}, '{entity}', '{char}')"
    return f"regexp_replace({c}, '&amp;?', '&', 'g')"


def sql_clean(c):
    return (
        f"trim(regexp_replace(regexp_replace(lower({sql_unescape(c)}), 'http\\S+|www\\S+', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"
    )


def sql_with(*parts):
    """Join CTE fragments and the final select."""
    *ctes, final = parts
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes) + "\n" + final


SQL_CLEAN = f"""
docs AS (SELECT doc_id AS post_id, lang AS topic, source, text, {sql_clean('text')} AS text_clean FROM documents),
prep AS (SELECT *, list_filter(string_split(text_clean, ' '), lambda x: x <> '' AND x NOT IN ({sql_list(K.TOPIC_STOP_WORDS)})) AS toks FROM docs)"""
SQL_CORPUS = SQL_CLEAN + """,
kept AS (SELECT post_id, topic, text_clean, toks, list_filter(toks, lambda x: length(x) >= 2) AS vt FROM prep WHERE len(toks) > 0),
tok AS (SELECT post_id, topic, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM kept)"""
SQL_LABELS = """
lab AS (SELECT doc_id AS post_id, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS final_sentiment FROM labels)"""
SQL_ORDERS = """
posts AS (SELECT o_orderkey AS post_id, o_orderpriority AS topic, o_orderstatus AS label, o_orderdate AS created_at, o_totalprice FROM orders)"""


def sql_drawn(key):
    d = f"substr(md5(post_id || ':{key}'), 1, 1)"
    return (
        f"CASE WHEN {d} < '5' THEN 'negative' WHEN {d} = '5' THEN chr(9) || ' Neutral ' || chr(10) WHEN {d} = '6' THEN 'neutral' || chr(10) WHEN {d} < 'a' THEN 'neutral' "
        f"WHEN {d} < 'e' THEN 'positive' WHEN {d} = 'e' THEN NULL ELSE 'unsure' END"
    )


def sql_strip(c):
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def sql_norm(c, unknown="'invalid'"):
    return (
        f"CASE WHEN lower({sql_strip(c)}) IN ({sql_list(K.LABELS)}) THEN lower({sql_strip(c)}) "
        f"WHEN {sql_strip(c)} <> '' THEN {unknown} END"
    )
