"""Votes, adjudication, agreement and the modelling join."""

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.tables import (
    SQL_CORPUS, SQL_LABELS, adjudications, features, label_table, posts, rater_sheet, sql_drawn, sql_list, sql_norm, sql_with,
)
from lexitally import constants as K
from lexitally.functions.labels import normalise_label
from lexitally.operators import raters as A
from lexitally.operators.reports import group_counts
from lexitally.operators.terms import with_tokens
from lexitally.plans.modeling import attach_text, modeling_table, rows_without_text

SQL_SHEET = SQL_LABELS + ",\nsheet AS (SELECT post_id, " + ", ".join(f"{sql_drawn(r)} AS {r}" for r in K.RATERS) + " FROM lab)"
SQL_NORMAL = SQL_SHEET + ",\nnorm AS (SELECT post_id, " + ", ".join(f"{sql_norm(r)} AS {r}" for r in K.RATERS) + " FROM sheet)"


def _n(label):
    return " + ".join(f"(coalesce({r}, '') = '{label}')::INTEGER" for r in K.RATERS)


SQL_VOTE = SQL_NORMAL + f""",
tally AS (SELECT *, {_n('negative')} AS n1, {_n('neutral')} AS n2, {_n('positive')} AS n3, {_n('invalid')} AS invalid_annotation_count FROM norm),
top AS (SELECT *, n1 + n2 + n3 AS valid_annotation_count, greatest(n1, n2, n3) AS m FROM tally),
voted AS (SELECT post_id, {', '.join(K.RATERS)}, valid_annotation_count, invalid_annotation_count,
  CASE WHEN invalid_annotation_count > 0 THEN 'invalid_label' WHEN valid_annotation_count < 3 THEN 'needs_review'
       WHEN (n1 = m)::INTEGER + (n2 = m)::INTEGER + (n3 = m)::INTEGER > 1 THEN 'manual_review'
       WHEN n1 = m THEN 'negative' WHEN n2 = m THEN 'neutral' ELSE 'positive' END AS final_sentiment FROM top)"""
SQL_RESOLVED = SQL_VOTE + f""",
adj AS (SELECT post_id, {sql_norm(sql_drawn('adjudicated'), 'NULL')} AS adjudicated_sentiment FROM lab),
resolved AS (SELECT voted.* REPLACE (CASE WHEN final_sentiment = 'manual_review' AND adjudicated_sentiment IS NOT NULL THEN adjudicated_sentiment ELSE final_sentiment END AS final_sentiment), adjudicated_sentiment
  FROM voted LEFT JOIN adj USING (post_id))"""


def voted(spark, sf):
    return A.vote(rater_sheet(spark, sf))


def resolved(spark, sf):
    return A.adjudicate(voted(spark, sf), adjudications(spark, sf))


@query("B8_label_normalise", sql_with(SQL_SHEET, f"SELECT post_id, {sql_norm('annotator_1')} AS for_vote, {sql_norm('annotator_1', 'NULL')} AS for_adjudication FROM sheet"))
def normalise(spark, sf):
    return rater_sheet(spark, sf).select(
        "post_id", normalise_label("annotator_1").alias("for_vote"), normalise_label("annotator_1", unknown=None).alias("for_adjudication")
    )


@query("E13_rater_counts", sql_with(SQL_VOTE, "SELECT post_id, valid_annotation_count, invalid_annotation_count FROM voted"))
def rater_counts(spark, sf):
    return voted(spark, sf).select("post_id", "valid_annotation_count", "invalid_annotation_count")


@query("E14_plurality_vote", sql_with(SQL_VOTE, "SELECT * FROM voted"))
def vote(spark, sf):
    return voted(spark, sf)


@query("E15_review_queue", sql_with(SQL_VOTE, f"SELECT post_id, final_sentiment FROM voted WHERE final_sentiment IN ({sql_list(K.REVIEW_STATES)})"))
def review_queue(spark, sf):
    return A.review_queue(voted(spark, sf)).select("post_id", "final_sentiment")


@query(
    "E9_vote_quality",
    sql_with(
        SQL_VOTE,
        f"""r AS (SELECT count(*) AS total_records, count(*) FILTER (final_sentiment IN ({sql_list(K.LABELS)})) AS records_with_final_label,
        count(*) FILTER (final_sentiment IN ({sql_list(K.REVIEW_STATES)})) AS records_needing_review, count(*) FILTER (final_sentiment = 'needs_review') AS needs_review_missing_annotations,
        count(*) FILTER (final_sentiment = 'manual_review') AS manual_review_ties, count(*) FILTER (final_sentiment = 'invalid_label') AS invalid_label_records FROM voted)""",
        "SELECT metric, value FROM (UNPIVOT r ON COLUMNS(*) INTO NAME metric VALUE value)",
    ),
)
def vote_quality(spark, sf):
    return A.vote_quality(voted(spark, sf))


@query("D2_adjudication", sql_with(SQL_RESOLVED, "SELECT post_id, final_sentiment, adjudicated_sentiment FROM resolved"))
def adjudication(spark, sf):
    return resolved(spark, sf).select("post_id", "final_sentiment", "adjudicated_sentiment")


@query("D2_unresolved", sql_with(SQL_RESOLVED, f"SELECT post_id, final_sentiment FROM resolved WHERE final_sentiment NOT IN ({sql_list(K.LABELS)})"))
def unresolved(spark, sf):
    return A.unresolved(resolved(spark, sf)).select("post_id", "final_sentiment")


@query(
    "E9_resolution_quality",
    sql_with(
        SQL_RESOLVED,
        f"""r AS (SELECT count(*) AS total_records, count(*) FILTER (final_sentiment IN ({sql_list(K.LABELS)})) AS resolved_final_records,
        count(*) FILTER (final_sentiment NOT IN ({sql_list(K.LABELS)})) AS remaining_unresolved_records, """
        + ", ".join(f"count(*) FILTER (final_sentiment = '{x}') AS {x}_records" for x in K.LABELS) + " FROM resolved)",
        "SELECT metric, value FROM (UNPIVOT r ON COLUMNS(*) INTO NAME metric VALUE value)",
    ),
)
def resolution_quality(spark, sf):
    return A.resolution_quality(resolved(spark, sf))


PAIRS = [(a, b) for i, a in enumerate(K.RATERS) for b in K.RATERS[i + 1:]]


@query(
    "E16_cohen_kappa",
    sql_with(
        SQL_NORMAL,
        "p AS (" + " UNION ALL ".join(f"SELECT '{a}' AS rater_a, '{b}' AS rater_b, {a} AS a, {b} AS b FROM norm" for a, b in PAIRS) + ")",
        f"v AS (SELECT * FROM p WHERE a IN ({sql_list(K.LABELS)}) AND b IN ({sql_list(K.LABELS)}))",
        "s AS (SELECT rater_a, rater_b, count(*) AS n, count(*) FILTER (a = b) / count(*) AS po, ("
        + " + ".join(f"count(*) FILTER (a = '{x}') * count(*) FILTER (b = '{x}')" for x in K.LABELS) + ") / (count(*) * count(*)) AS pe FROM v GROUP BY ALL)",
        "SELECT rater_a, rater_b, n AS n_posts, round(CASE WHEN pe = 1 THEN 1 ELSE (po - pe) / (1 - pe) END, 6) AS kappa FROM s",
    ),
)
def cohen(spark, sf):
    return A.cohen_kappa(rater_sheet(spark, sf))


@query(
    "E16_fleiss_kappa",
    sql_with(
        SQL_VOTE,
        "f AS (SELECT n1, n2, n3 FROM tally WHERE n1 + n2 + n3 = 4)",
        "s AS (SELECT count(*) AS n, avg((n1 * n1 + n2 * n2 + n3 * n3 - 4) / 12) AS po, pow(sum(n1) / (4 * count(*)), 2) + pow(sum(n2) / (4 * count(*)), 2) + pow(sum(n3) / (4 * count(*)), 2) AS pe FROM f)",
        "SELECT n AS n_posts, round((po - pe) / (1 - pe), 6) AS kappa FROM s",
    ),
)
def fleiss(spark, sf):
    return A.fleiss_kappa(rater_sheet(spark, sf))


@query("D1_label_join", sql_with(SQL_CORPUS, SQL_RESOLVED, f"SELECT topic, final_sentiment, count(*) AS count, sum(len(toks))::BIGINT AS words FROM prep JOIN resolved USING (post_id) WHERE final_sentiment IN ({sql_list(K.LABELS)}) GROUP BY ALL"))
def label_join(spark, sf):
    table = modeling_table(features(spark, sf), resolved(spark, sf))
    return table.groupBy("topic", "final_sentiment").agg(
        F.count(F.lit(1)).alias("count"), F.sum("word_count_no_stopwords").alias("words")
    )


@query("E1_topic_by_label", sql_with(SQL_CORPUS, SQL_RESOLVED, "SELECT topic, final_sentiment, count(*) AS count FROM kept JOIN resolved USING (post_id) GROUP BY ALL"))
def topic_by_label(spark, sf):
    return group_counts(with_tokens(features(spark, sf)).join(resolved(spark, sf), "post_id"), "topic", "final_sentiment")


# All documents against the texts of those that have a label: most find no text.
def labelled_texts(spark, sf):
    return features(spark, sf).join(label_table(spark, sf).select("post_id"), "post_id", "left_semi")


@query("D3_feature_text_join", sql_with(SQL_CORPUS, SQL_LABELS, "SELECT post_id, topic, array_to_string(toks, ' ') AS text_no_stopwords FROM prep WHERE post_id IN (SELECT post_id FROM lab)"))
def feature_text(spark, sf):
    return attach_text(posts(spark, sf).select("post_id", "topic"), labelled_texts(spark, sf))


@query("D3_rows_without_text", sql_with(SQL_CORPUS, SQL_LABELS, "SELECT count(*) AS missing_text FROM docs WHERE post_id NOT IN (SELECT post_id FROM lab)"))
def without_text(spark, sf):
    return rows_without_text(posts(spark, sf), labelled_texts(spark, sf))
