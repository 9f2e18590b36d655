"""Label counts, shares, trends, weights and tests over orders; contracts and files."""

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.tables import (
    PRIORITIES, SQL_CLEAN, SQL_LABELS, SQL_ORDERS, STATUS, clean, features, label_table, order_posts, posts, sql_with,
)
from lexitally import constants as K
from lexitally.functions.labels import is_valid_label
from lexitally.functions.periods import with_periods
from lexitally.functions.text import word_count
from lexitally.operators import reports as R
from lexitally.operators.metrics import majority_baseline
from lexitally.operators.split import split_feasibility, stratified_split
from lexitally.operators.stats import chi_square, expected_counts
from lexitally.operators.terms import rerank, top_n, top_n_overall
from lexitally.session import scratch_path
from lexitally.sources.contracts import contract_report, enforce_contract
from lexitally.sources.io import read_csv, read_table, write_csv

Q = "CASE quarter(created_at) WHEN 1 THEN 'Ιαν–Μαρ' WHEN 2 THEN 'Απρ–Ιουν' WHEN 3 THEN 'Ιουλ–Σεπ' ELSE 'Οκτ–Δεκ' END || ' ' || year(created_at)"
PERIODS = SQL_ORDERS + f""",
per AS (SELECT *, strftime(created_at, '%Y-%m') AS month, date_trunc('quarter', created_at)::DATE AS quarter_start, {Q} AS quarter FROM posts)"""


def _cells(by):
    return f"{by}, " + ", ".join(f"count(*) FILTER (label = '{s}') AS \"{s}\"" for s in STATUS) + ", count(*) AS total"


def _pct(digits=1, suffix=""):
    return ", ".join(f"round(\"{s}\" / total * 100, {digits}) AS \"{s}{suffix}\"" for s in STATUS)


def dated(spark, sf):
    return with_periods(order_posts(spark, sf))


# --- files and contracts -----------------------------------------------------------


@query(
    "A1_A2_csv_round_trip",
    "SELECT lang, count(*) AS n, sum(length(text))::BIGINT AS chars, sum(length(text) - length(replace(text, chr(10), '')))::BIGINT AS line_breaks, min(md5(text)) AS first_hash, max(md5(text)) AS last_hash FROM documents GROUP BY lang",
)
def csv_round_trip(spark, sf):
    path = scratch_path(spark, "documents-csv")
    write_csv(read_table(spark, sf, "documents").select("doc_id", "lang", "text"), path)
    back = read_csv(spark, path, "doc_id LONG, lang STRING, text STRING")
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return back.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"), F.sum(breaks).alias("line_breaks"),
        F.min(F.md5("text")).alias("first_hash"), F.max(F.md5("text")).alias("last_hash"),
    )


@query(
    "A4_contract_report",
    """SELECT count(*) AS rows, count(*) FILTER (label IS NULL OR label NOT IN ('F', 'O')) AS invalid_label,
       count(*) FILTER (topic IS NULL) AS null_text, count(*) - count(DISTINCT post_id) AS duplicate_key
       FROM (SELECT o_custkey AS post_id, o_orderstatus AS label, o_orderpriority AS topic FROM orders)""",
)
def contract(spark, sf):
    orders = read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("post_id"), F.col("o_orderstatus").alias("label"), F.col("o_orderpriority").alias("topic")
    )
    return contract_report(orders, "post_id", "topic", "label", ["F", "O"])


@query("A4_contract_gate", sql_with(SQL_ORDERS, "SELECT label, count(*) AS count FROM posts GROUP BY label"))
def contract_gate(spark, sf):
    checked = enforce_contract(order_posts(spark, sf), key="post_id", text="topic", label="label", valid=STATUS)
    return R.group_counts(checked, "label")


# --- counts and shares ---------------------------------------------------------------


@query("B19_valid_label_filter", sql_with(SQL_ORDERS, "SELECT topic, count(*) AS count FROM posts WHERE lower(trim(label)) IN ('f', 'o') GROUP BY topic"))
def valid_labels(spark, sf):
    return R.group_counts(order_posts(spark, sf).where(is_valid_label("label", ["f", "o"])), "topic")


@query(
    "B16_periods",
    sql_with(PERIODS, "SELECT month, quarter_start, quarter, count(*) AS count FROM per GROUP BY ALL"),
)
def periods(spark, sf):
    return R.group_counts(dated(spark, sf), "month", "quarter_start", "quarter")


@query(
    "B16_timestamp_coercion",
    "SELECT quarter(ts) AS q, count(*) AS count FROM (SELECT try_cast(CASE WHEN o_orderstatus = 'P' THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS ts FROM orders) WHERE ts IS NOT NULL GROUP BY q",
)
def coercion(spark, sf):
    text = F.when(F.col("label") == "P", "not a date").otherwise(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    parsed = with_periods(order_posts(spark, sf).withColumn("created_at", text))
    return R.group_counts(parsed.withColumn("q", F.quarter("quarter_start").cast("long")), "q")


@query("E1_group_count", sql_with(SQL_ORDERS, "SELECT topic, label, count(*) AS count FROM posts GROUP BY topic, label"))
def group_count(spark, sf):
    return R.group_counts(order_posts(spark, sf), "topic", "label")


NAMES = {"en": "English", "de": "Deutsch", "fr": "Français"}


@query(
    "E2_B17_topic_distribution",
    "SELECT lang AS topic, count(*) AS count, CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'Deutsch' WHEN 'fr' THEN 'Français' ELSE lang END AS topic_display FROM documents GROUP BY lang",
)
def topic_distribution(spark, sf):
    return R.topic_distribution(posts(spark, sf), "topic", NAMES)


@query("E3_crosstab", sql_with(SQL_ORDERS, f"SELECT {_cells('topic')} FROM posts GROUP BY topic"))
def crosstab(spark, sf):
    return R.crosstab(order_posts(spark, sf), "topic", "label", STATUS)


@query("E4_row_percentages", sql_with(SQL_ORDERS, f"c AS (SELECT {_cells('topic')} FROM posts GROUP BY topic)", f"SELECT topic, {_pct()}, total FROM c"))
def row_percentages(spark, sf):
    return R.row_percentages(crosstab(spark, sf), STATUS)


def _share(period):
    return sql_with(
        PERIODS,
        f"c AS (SELECT topic, {period}, label, count(*) AS count FROM per GROUP BY ALL)",
        f"SELECT topic, {period}, label, count, round(count / sum(count) OVER (PARTITION BY topic, {period}) * 100, 1) AS percentage FROM c",
    )


@query("E5_F7_quarterly_share_of_topic", _share("quarter"))
def quarterly_share(spark, sf):
    return R.share_of_group(dated(spark, sf), ["topic", "quarter"], "label")


@query("E6_monthly_share_of_topic", _share("month"))
def monthly_share(spark, sf):
    return R.share_of_group(dated(spark, sf), ["topic", "month"], "label")


def _trend(period):
    both = ", ".join(f"\"{s}\"" for s in STATUS)
    return sql_with(PERIODS, f"c AS (SELECT {_cells(period)} FROM per GROUP BY {period})", f"SELECT {period}, {both}, total, {_pct(1, '_pct')} FROM c")


@query("E7_monthly_trend", _trend("month"))
def monthly_trend(spark, sf):
    return R.label_trend(dated(spark, sf), "month", "label", STATUS)


@query("E7_quarterly_trend", _trend("quarter_start"))
def quarterly_trend(spark, sf):
    return R.label_trend(dated(spark, sf), "quarter_start", "label", STATUS)


@query(
    "E8_label_share_matrix",
    sql_with(
        PERIODS,
        "c AS (SELECT topic, quarter_start, label, count(*) AS n FROM per GROUP BY ALL)",
        "s AS (SELECT *, round(n / sum(n) OVER (PARTITION BY topic, quarter_start) * 100, 1) AS p FROM c)",
        "SELECT quarter_start, " + ", ".join(f"max(p) FILTER (label = 'F' AND topic = '{t}') AS \"{t}\"" for t in PRIORITIES) + " FROM s GROUP BY quarter_start",
    ),
)
def share_matrix(spark, sf):
    return R.label_share_matrix(dated(spark, sf), "quarter_start", "topic", "label", "F", PRIORITIES)


@query(
    "E9_quality_summary",
    sql_with(
        SQL_CLEAN, SQL_LABELS,
        "m AS (SELECT d.post_id, d.text_clean, len(list_filter(regexp_split_to_array(d.text, '\\s+'), lambda x: x <> '')) AS wc, l.final_sentiment FROM docs d JOIN lab l USING (post_id))",
        "r AS (SELECT count(*) AS total_records, count(*) FILTER (text_clean IS NULL) AS missing_text, count(*) FILTER (final_sentiment IS NULL) AS missing_label, count(*) - count(DISTINCT post_id) AS duplicate_key, min(wc)::BIGINT AS min_word_count, max(wc)::BIGINT AS max_word_count, "
        + ", ".join(f"count(*) FILTER (final_sentiment = '{x}') AS {x}_records" for x in K.LABELS) + " FROM m)",
        "SELECT metric, value FROM (UNPIVOT r ON COLUMNS(*) INTO NAME metric VALUE value)",
    ),
)
def quality(spark, sf):
    return R.quality_summary(clean(spark, sf).join(label_table(spark, sf), "post_id"))


@query(
    "E9_preparation_summary",
    sql_with(
        SQL_CLEAN,
        "r AS (SELECT count(*)::DOUBLE AS total_records, count(*) FILTER (text_clean IS NULL)::DOUBLE AS missing_text_clean, 0::DOUBLE AS missing_text_no_stopwords, count(*) FILTER (len(toks) = 0)::DOUBLE AS empty_text_no_stopwords, (count(*) - count(DISTINCT post_id))::DOUBLE AS duplicate_post_id, min(len(toks))::DOUBLE AS word_count_no_stopwords_min, max(len(toks))::DOUBLE AS word_count_no_stopwords_max, round(avg(len(toks)), 2) AS word_count_no_stopwords_mean FROM prep)",
        "SELECT metric, value FROM (UNPIVOT r ON COLUMNS(*) INTO NAME metric VALUE value)",
    ),
)
def preparation(spark, sf):
    return R.preparation_summary(features(spark, sf))


@query(
    "E10_topic_profile",
    sql_with(SQL_ORDERS, "SELECT topic, count(post_id) AS posts, min(created_at) AS date_from, max(created_at) AS date_to, round(avg(o_totalprice), 1) AS avg_words, max(o_totalprice) AS max_words FROM posts GROUP BY topic"),
)
def profile(spark, sf):
    return R.topic_profile(order_posts(spark, sf), n_words="o_totalprice")


@query(
    "E11_describe",
    "WITH w AS (SELECT len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS n FROM documents) SELECT count(n) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std, min(n)::DOUBLE AS min, quantile_cont(n, 0.25) AS p25, quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.75) AS p75, max(n)::DOUBLE AS max FROM w",
)
def describe(spark, sf):
    return R.describe(posts(spark, sf).select(word_count("text").alias("n")), "n")


@query("E12_temporal_coverage", sql_with(SQL_ORDERS, 'SELECT min(created_at) AS start, max(created_at) AS "end", count(DISTINCT date_trunc(\'month\', created_at)) AS months, count(DISTINCT date_trunc(\'quarter\', created_at)) AS quarters FROM posts'))
def coverage(spark, sf):
    return R.temporal_coverage(order_posts(spark, sf))


# --- classes, weights, quotas ----------------------------------------------------------


@query("E20_class_distribution", sql_with(SQL_ORDERS, 'SELECT label AS class, count(*) AS count, round(count(*) / sum(count(*)) OVER () * 100, 2) AS percentage FROM posts GROUP BY label'))
def class_distribution(spark, sf):
    return R.class_distribution(order_posts(spark, sf), "label")


def _sql_profile(source, by="", label="label"):
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"SELECT {lead}sum(n)::BIGINT AS records, count(*) AS n_classes, max(n) / min(n) AS imbalance_ratio, max(n) / sum(n)::DOUBLE AS baseline_accuracy, min_by({label}, (n, {label})) AS minority_class, min(n) AS minority_count, round_even(min(n) * 0.2e0, 0)::BIGINT AS minority_in_test FROM (SELECT {lead}{label}, count(*) AS n FROM {source} GROUP BY ALL) {group}"


@query(
    "E21_imbalance_profile",
    sql_with(SQL_LABELS, f"p AS ({_sql_profile('lab', label='final_sentiment')})", "SELECT * REPLACE (round(imbalance_ratio, 6) AS imbalance_ratio, round(baseline_accuracy, 6) AS baseline_accuracy) FROM p"),
)
def imbalance(spark, sf):
    found = R.imbalance_profile(label_table(spark, sf), "final_sentiment")
    return found.withColumns({c: F.round(c, 6) for c in ("imbalance_ratio", "baseline_accuracy")})


@query(
    "E22_B15_target_options",
    sql_with(
        SQL_LABELS,
        """o AS (SELECT 'A_multiclass_3_classes' AS option, final_sentiment AS target FROM lab
            UNION ALL SELECT 'B_binary_drop_neutral', final_sentiment FROM lab WHERE final_sentiment <> 'neutral'
            UNION ALL SELECT 'C_binary_negative_vs_rest', CASE WHEN final_sentiment = 'negative' THEN 'negative' ELSE 'non_negative' END FROM lab
            UNION ALL SELECT 'D_binary_positive_vs_rest', CASE WHEN final_sentiment = 'positive' THEN 'positive' ELSE 'non_positive' END FROM lab)""",
        f"p AS ({_sql_profile('o', 'option', 'target')})",
        "SELECT option, records AS records_kept, round(records / (SELECT count(*) FROM lab) * 100, 1) AS records_kept_pct, n_classes, round(imbalance_ratio, 2) AS imbalance_ratio, round(baseline_accuracy * 100, 1) AS baseline_accuracy_pct, minority_class, minority_count, minority_in_test AS minority_in_test_set FROM p",
    ),
)
def target_options(spark, sf):
    return R.target_options(label_table(spark, sf))


@query(
    "E23_class_weights",
    sql_with(SQL_LABELS, "c AS (SELECT final_sentiment, count(*) AS n FROM lab GROUP BY 1)", "SELECT post_id, final_sentiment, round((SELECT sum(n) / (count(*) * 1e0) FROM c) / n, 6) AS weight FROM lab JOIN c USING (final_sentiment)"),
)
def weights(spark, sf):
    return R.with_class_weights(label_table(spark, sf), "final_sentiment").withColumn("weight", F.round("weight", 6))


def sql_quota(source, label, keep=""):
    """CTEs q1..quota over a source table: test rows per class."""
    return f"""q1 AS (SELECT {label}, count(*) AS n FROM {source} GROUP BY 1),
q2 AS (SELECT *, sum(n) OVER () AS total, ceil(sum(n) OVER () * 0.2e0)::BIGINT AS want FROM q1),
q3 AS (SELECT *, (n * want) // total AS fl, (n * want) % total AS rest FROM q2),
quota AS (SELECT {label}, n, (fl + CASE WHEN row_number() OVER (ORDER BY rest DESC, {label}) <= want - sum(fl) OVER () THEN 1 ELSE 0 END)::BIGINT AS quota FROM q3)"""


def sql_split(source, label, name="parted"):
    return sql_quota(source, label) + f""",
{name} AS (SELECT s.*, CASE WHEN row_number() OVER (PARTITION BY s.{label} ORDER BY md5('42:' || s.post_id), s.post_id) <= quota THEN 'test' ELSE 'train' END AS split
  FROM {source} s JOIN quota USING ({label}))"""


@query("E24_split_feasibility", sql_with(SQL_ORDERS, sql_quota("posts", "label"), "SELECT label, n AS records, quota AS test_records, min(quota) OVER () < 10 AS few_test_records FROM quota"))
def feasibility(spark, sf):
    return split_feasibility(order_posts(spark, sf), "label")


@query("H1_stratified_split", sql_with(SQL_ORDERS, sql_split("posts", "label"), "SELECT post_id, label, split FROM parted"))
def split(spark, sf):
    return stratified_split(order_posts(spark, sf).select("post_id", "label"), "post_id", "label")


@query(
    "E17_split_summary",
    sql_with(SQL_ORDERS, sql_split("posts", "topic"), "SELECT topic, count(*) FILTER (split = 'test') AS test, count(*) FILTER (split = 'train') AS train, count(*) AS total FROM parted GROUP BY topic"),
)
def split_summary(spark, sf):
    parted = stratified_split(order_posts(spark, sf).select("post_id", "topic"), "post_id", "topic")
    return R.crosstab(parted, "topic", "split", ["test", "train"])


@query(
    "H24_majority_baseline",
    sql_with(
        SQL_ORDERS,
        "c AS (SELECT label, count(*) AS n FROM posts GROUP BY 1)",
        "t AS (SELECT max(n) / sum(n)::DOUBLE AS acc, sum(n) AS total, max(n) AS top FROM c)",
        "SELECT round(acc, 4) AS accuracy, round(acc / 3, 4) AS macro_precision, round(1e0 / 3, 4) AS macro_recall, round(2 * acc / (acc + 1) / 3, 4) AS macro_f1, round(2 * acc / (acc + 1) * top / total, 4) AS weighted_f1 FROM t",
    ),
)
def baseline(spark, sf):
    return majority_baseline(order_posts(spark, sf), "label", STATUS)


# --- ranking, stacking, ordering ---------------------------------------------------------


@query(
    "F2_top_orders_per_group",
    sql_with(SQL_ORDERS, "SELECT topic, post_id, o_totalprice, row_number() OVER (PARTITION BY topic ORDER BY o_totalprice DESC, post_id) AS rank FROM posts QUALIFY rank <= 20"),
)
def top_orders(spark, sf):
    best = top_n(order_posts(spark, sf).select("topic", "post_id", "o_totalprice"), 20, "o_totalprice", ("topic",), "post_id")
    return best.withColumn("rank", F.col("rank").cast("long"))


@query(
    "F4_F5_top_overall_then_filtered",
    sql_with(SQL_ORDERS, "t AS (SELECT post_id, label, o_totalprice FROM posts ORDER BY o_totalprice DESC, post_id LIMIT 30)", "SELECT post_id, label, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, post_id) AS rank FROM t WHERE label <> 'P'"),
)
def top_filtered(spark, sf):
    best = top_n_overall(order_posts(spark, sf).select("post_id", "label", "o_totalprice"), 30, "o_totalprice", "post_id")
    left = rerank(best.where(F.col("label") != "P"), "o_totalprice", (), "post_id")
    return left.withColumn("rank", F.col("rank").cast("long"))


# --- chi-square -----------------------------------------------------------------------------


def sql_chi(source, row, col):
    return f"""
cell AS (SELECT {row} AS r, {col} AS c, count(*) AS o FROM {source} GROUP BY ALL),
rm AS (SELECT r, sum(o) AS rn FROM cell GROUP BY r),
cm AS (SELECT c, sum(o) AS cn FROM cell GROUP BY c),
tot AS (SELECT sum(o)::DOUBLE AS n FROM cell),
ex AS (SELECT rm.r, cm.c, coalesce(o, 0) AS o, rn * cn / n AS e, n FROM rm CROSS JOIN cm CROSS JOIN tot LEFT JOIN cell ON cell.r = rm.r AND cell.c = cm.c),
chi AS (SELECT sum((o - e) * (o - e) / e) AS x, max(n) AS n, (count(DISTINCT r) - 1) * (count(DISTINCT c) - 1) AS dof, least(count(DISTINCT r), count(DISTINCT c)) - 1 AS side FROM ex)"""


@query("H23_expected_counts", sql_with(SQL_ORDERS, sql_chi("posts", "topic", "label"), 'SELECT r AS topic, c AS label, o::BIGINT AS count, round(e, 6) AS expected FROM ex'))
def expected(spark, sf):
    found = expected_counts(order_posts(spark, sf), "topic", "label", STATUS)
    return found.select("topic", "label", "count", F.round("expected", 6).alias("expected"))


# With five groups and three labels the degrees of freedom are 8, so the p-value is a finite sum.
@query(
    "H23_chi_square",
    sql_with(
        SQL_ORDERS, sql_chi("posts", "topic", "label"),
        "SELECT round(x, 8) AS chi2_statistic, round(exp(-x / 2) * (1 + x / 2 + pow(x / 2, 2) / 2 + pow(x / 2, 3) / 6), 8) AS p_value, dof::BIGINT AS degrees_of_freedom, n::BIGINT AS total_records, round(sqrt(x / (n * side)), 8) AS cramers_v FROM chi",
    ),
)
def chi(spark, sf):
    return chi_square(order_posts(spark, sf), "topic", "label", STATUS, digits=8)
