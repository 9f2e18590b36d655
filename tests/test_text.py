"""Text columns against plain Python on small inputs."""

import html
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexitally import constants as K
from lexitally.functions import labels as B
from lexitally.functions import periods as D
from lexitally.functions import text as X

TEXTS = [
    "A &amp;amp; B&#x27;s <p>tag</p> http://x.y/z?a=1 www.site.org Done",
    "@é mention #Größe café&nbsp;au&eacute; x - y 'quoted'",
    "", "   ", "one", "ünïcödé ONLY", "https://only.url", "a\tb\nc  d", "tail http", "&lt;b&gt;",
]


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")


def one(spark, texts, column):
    return [r[0] for r in frame(spark, texts).orderBy("id").select(column).collect()]


def corpus_clean(t):
    t = re.sub(r"http\S+|www\S+", " ", html.unescape(t).lower())
    return " ".join(re.sub(r"[^a-z0-9]", " ", t).split())


def post_clean(t):
    t = html.unescape(re.sub(r"<[^>]+>", " ", t))
    for pattern, to in ((r"@\w+", ""), (r"#(\w+)", r"\1"), (r"http\S+", ""), (r"www\.\S+", ""), (r"[^a-zA-Z0-9\s'\-]", " "), (r"\s['\-]\s", " ")):
        t = re.sub(pattern, to, t)
    return " ".join(t.strip("'- ").split())


def test_cleaners(spark):
    assert one(spark, TEXTS, X.clean_text("t")) == [corpus_clean(t) for t in TEXTS]
    assert one(spark, TEXTS, X.clean_post("t")) == [post_clean(t) for t in TEXTS]
    assert one(spark, TEXTS, X.unescape_html("t")) == [html.unescape(t) for t in TEXTS]
    assert one(spark, TEXTS, X.word_count("t")) == [len(t.split()) for t in TEXTS]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aZé9 &;#<>'-@.\n", max_size=40), min_size=5, max_size=20))
def test_cleaners_on_random_text(spark, texts):
    assert one(spark, texts, X.clean_text("t")) == [corpus_clean(t) for t in texts]
    assert one(spark, texts, X.clean_post("t")) == [post_clean(t) for t in texts]


def test_tokens_and_bigrams(spark):
    texts = ["", "one", "one two", "the a bb ccc gpt4 dd"]
    assert one(spark, texts, X.bigrams(X.tokens("t"))) == [[], [], ["one two"], ["the a", "a bb", "bb ccc", "ccc gpt4", "gpt4 dd"]]
    assert one(spark, texts, X.vectoriser_tokens("t"))[3] == ["the", "bb", "ccc", "gpt4", "dd"]
    assert one(spark, texts, X.alphabetic_tokens("t"))[3] == ["the", "bb", "ccc", "dd"]
    assert one(spark, texts, X.content_tokens("t"))[3] == ["bb", "ccc", "gpt4", "dd"]
    assert one(spark, texts, X.ngrams(X.tokens("t"), (1, 2)))[2] == ["one", "two", "one two"]


def test_informative_bigrams(spark):
    texts = ["machine learning", "of the", "Is It", "x ray", "three word phrase", "climate change", "solo"]
    assert one(spark, texts, X.is_informative_bigram("t")) == [True, False, False, False, False, True, False]


def test_keyword_relevance(spark):
    texts = ["AI and ai, email", "weather eth ethereum", "nothing", "data breach, exploit exploit", None]
    rows = X.relevant_topics(frame(spark, texts), "t").collect()
    assert {(r.id, r.topic, r.keyword_hits) for r in rows} == {
        (0, "Artificial Intelligence", 2), (1, "Cryptocurrency", 2), (3, "Cybersecurity", 3),
    }


def test_labels(spark):
    texts = [" Positive ", "NEUTRAL", "bad", "", "  ", None]
    assert one(spark, texts, B.normalise_label("t")) == ["positive", "neutral", "invalid", None, None, None]
    assert one(spark, texts, B.normalise_label("t", unknown=None)) == ["positive", "neutral", None, None, None, None]
    assert one(spark, ["negative", "x"], B.display_name("t", K.LABEL_DISPLAY)) == ["Αρνητικό", "x"]
    assert one(spark, [" A-b  C!"], X.slug("t")) == ["a_b_c"]


def test_periods_and_windows(spark):
    texts = ["2024-02-03T04:05:06Z", "no date", None, "2023-12-31T23:59:59Z"]
    rows = D.with_periods(frame(spark, texts), "t").orderBy("id").collect()
    assert [(r.id, r.month, r.quarter) for r in rows] == [(0, "2024-02", "Ιαν–Μαρ 2024"), (3, "2023-12", "Οκτ–Δεκ 2023")]
    edge = spark.createDataFrame([(1704067200,), (1704067201,), (0,)], "s long").select(F.timestamp_seconds("s").alias("ts"))
    assert [r[0] for r in edge.select(D.window_name("ts")).collect()] == [None, "Q1-2024", None]
