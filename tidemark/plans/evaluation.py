"""Descriptive statistics, splits and classification metrics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import shard
from tidemark.operators import describe as D
from tidemark.operators import metrics as M
from tidemark.operators import sampling as S
from tidemark.operators.indexing import index_interactions
from tidemark.operators.running import Ranges, dense_index, exact_quantiles
from tidemark.plans.registry import query
from tidemark.plans.sources_yield import rounded
from tidemark.plans.temporal import INTERACTIONS_SQL
from tidemark.sources.tables import interactions, table

NARROW = Ranges(rows_per_range=40)  # many ranges even on the small tables

# ---- labelled documents: quality is the label, a score from the length -----------------

SCORED_SQL = """
    SELECT doc_id, n_chars, quality AS label, toxic,
           1.0 / (1.0 + exp(-(n_chars - 800.0) / 400.0)) AS score, least(n_chars, 1000) / 1000.0 AS coarse
    FROM documents JOIN labels USING (doc_id)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id")
        .selectExpr(
            "doc_id",
            "n_chars",
            "quality AS label",
            "toxic",
            "1D / (1D + exp(-(n_chars - 800D) / 400D)) AS score",
            "least(n_chars, 1000) / 1000D AS coarse",
        )
    )


GROUPS_SQL = f"""
    s AS ({SCORED_SQL}),
    g AS (SELECT coarse AS score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM s GROUP BY coarse),
    c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
                 sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM g)"""
AUC_SQL = """(SELECT round(sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END
              * a.pos * b.neg) / (sum(a.pos * b.neg)), 9) FROM g a, g b)"""


def auc_oracle() -> str:
    return f"""
WITH {GROUPS_SQL}
SELECT {AUC_SQL} AS roc_auc, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives FROM g"""


@query("roc_auc", auc_oracle())
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.roc_auc(scored(spark, sf_dir), "coarse", "label"))


@query("roc_auc_ranged", auc_oracle())
def roc_auc_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the score axis cut into many ranges."""
    return rounded(M.roc_auc(scored(spark, sf_dir), "coarse", "label", NARROW))


@query(
    "roc_points",
    f"""
WITH {GROUPS_SQL}
SELECT score AS threshold, round(fp / n, 9) AS fpr, round(tp / p, 9) AS tpr FROM c
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""",
)
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.roc_points(scored(spark, sf_dir), "coarse", "label", NARROW))


@query(
    "pr_points",
    f"WITH {GROUPS_SQL} SELECT score AS threshold, round(tp / (tp + fp), 9) AS precision, round(tp / p, 9) AS recall FROM c",
)
def pr_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.pr_points(scored(spark, sf_dir), "coarse", "label"))


AP_SQL = "(SELECT round(sum(pos / p * tp / (tp + fp)), 9) FROM c)"


@query("avg_precision", f"WITH {GROUPS_SQL} SELECT {AP_SQL} AS average_precision")
def avg_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.average_precision(scored(spark, sf_dir), "coarse", "label"))


@query(
    "calibration",
    f"""
WITH s AS ({SCORED_SQL})
SELECT CAST(least(floor(score * 10), 9) AS BIGINT) AS bin, round(avg(score), 9) AS mean_score,
       round(avg(label), 9) AS positive_share, count(*) AS count
FROM s GROUP BY 1""",
)
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.calibration(scored(spark, sf_dir), "score", "label"))


@query(
    "f1_sweep",
    f"""
WITH s AS ({SCORED_SQL}), t AS (SELECT i / 20.0 AS threshold FROM range(20) r(i)),
m AS (
    SELECT CAST(threshold AS DOUBLE) AS threshold, count_if(score >= threshold) AS predicted,
           count_if(score >= threshold AND label = 1) AS tp, count_if(label = 1) AS p
    FROM s, t GROUP BY threshold
)
SELECT threshold, round(CASE WHEN predicted + p = 0 THEN 0 ELSE 2.0 * tp / (predicted + p) END, 9) AS f1 FROM m""",
)
def f1_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.f1_sweep(scored(spark, sf_dir), "score", "label"))


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).selectExpr("*", "CAST(score >= 0.5 AS INT) AS prediction", "doc_id % 4 = 0 AS test")


PREDICTED_SQL = (
    f"p AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction, doc_id % 4 = 0 AS test FROM ({SCORED_SQL}))"
)


@query("confusion", f"WITH {PREDICTED_SQL} SELECT label, prediction, count(*) AS count FROM p GROUP BY ALL")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.confusion(predicted(spark, sf_dir), "prediction", "label")


@query(
    "classification_report",
    f"""
WITH {PREDICTED_SQL}, k AS (SELECT unnest([0, 1]) AS class),
c AS (
    SELECT class, count_if(label = class) AS support, count_if(prediction = class) AS predicted,
           count_if(label = class AND prediction = class) AS hits
    FROM p, k GROUP BY class
),
r AS (SELECT support, coalesce(hits / nullif(predicted, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS r,
             coalesce(2.0 * hits / nullif(predicted + support, 0), 0) AS f FROM c)
SELECT round(sum(p * support) / sum(support), 9) AS precision, round(sum(r * support) / sum(support), 9) AS recall,
       round(sum(f * support) / sum(support), 9) AS f1, CAST(sum(support) AS BIGINT) AS support FROM r""",
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.weighted_report(predicted(spark, sf_dir), "prediction", "label"))


@query(
    "binary_report",
    f"""
WITH {PREDICTED_SQL}, c AS (
    SELECT test, avg(CAST(prediction = label AS INTEGER)) AS accuracy, count_if(prediction = 1 AND label = 1) AS tp,
           count_if(prediction = 1) AS predicted, count_if(label = 1) AS actual
    FROM p GROUP BY test
)
SELECT test, round(accuracy, 9) AS accuracy, round(coalesce(tp / nullif(predicted, 0), 0), 9) AS precision,
       round(coalesce(tp / nullif(actual, 0), 0), 9) AS recall,
       round(coalesce(2.0 * tp / nullif(predicted + actual, 0), 0), 9) AS f1 FROM c""",
)
def binary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.binary_report(predicted(spark, sf_dir), "prediction", "label", by="test"))


@query(
    "bce_report",
    f"""
WITH {GROUPS_SQL}, l AS (SELECT *, least(greatest(coarse, 1e-7), 1 - 1e-7) AS q FROM s)
SELECT round(avg(-(label * ln(q) + (1 - label) * ln(1 - q))), 9) AS label_crossentropy,
       round(avg((coarse - label) * (coarse - label)), 9) AS mse,
       round(avg(CAST((coarse > 0.5) = (label = 1) AS INTEGER)), 9) AS accuracy,
       round(avg(coarse), 9) AS prediction_mean, round(avg(label), 9) AS label_mean,
       {AUC_SQL} AS roc_auc, {AP_SQL} AS average_precision
FROM l""",
)
def bce_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.training_report(scored(spark, sf_dir), "coarse", "label"))


# ---- descriptive statistics -----------------------------------------------------------

CUSTOMER_SQL = """
    SELECT c_custkey, CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS label, c_acctbal, c_nationkey FROM customer"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "CAST(c_mktsegment = 'BUILDING' AS INT) AS label", "c_acctbal", "c_nationkey"
    )


def describe_oracle(condition: str, label: str = "label") -> str:
    return f"""
WITH c AS (SELECT * REPLACE ({label} AS label) FROM ({CUSTOMER_SQL}) WHERE {condition}), u AS (
    SELECT label, 'c_acctbal' AS column, c_acctbal AS value FROM c
    UNION ALL SELECT label, 'c_nationkey', CAST(c_nationkey AS DOUBLE) FROM c
)
SELECT label, "column", count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.25), 6) AS p25,
       round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75
FROM u GROUP BY ALL"""


@query("label_describe", describe_oracle("TRUE"))
def label_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(D.describe_by(customers(spark, sf_dir), "label", ["c_acctbal", "c_nationkey"], NARROW), 6)


SOME_LABELS = "CASE WHEN c_nationkey % 5 <> 0 THEN label END"


@query("label_describe_null", describe_oracle("TRUE", SOME_LABELS))
def label_describe_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null label is summarised like any other."""
    rows = customers(spark, sf_dir).withColumn("label", F.expr(SOME_LABELS))
    return rounded(D.describe_by(rows, "label", ["c_acctbal", "c_nationkey"]), 6)


@query("label_describe_clipped", describe_oracle("c_acctbal <= 5000 AND c_nationkey <= 20"))
def label_describe_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = D.clip(customers(spark, sf_dir), {"c_acctbal": 5000, "c_nationkey": 20})
    return rounded(D.describe_by(kept, "label", ["c_acctbal", "c_nationkey"]), 6)


@query(
    "quantiles_ranged",
    """
SELECT round(quantile_cont(l_extendedprice, 0.01), 6) AS q0, round(quantile_cont(l_extendedprice, 0.5), 6) AS q1,
       round(quantile_cont(l_extendedprice, 0.99), 6) AS q2 FROM lineitem""",
)
def quantiles_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles over thousands of value ranges."""
    ranges = Ranges(rows_per_range=20)
    return rounded(
        exact_quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", [0.01, 0.5, 0.99], ranges=ranges), 6
    )


@query(
    "label_balance",
    """
WITH c AS (SELECT count(*) FILTER (quality = 1) AS positives, count(*) FILTER (quality = 0) AS negatives FROM labels)
SELECT positives, negatives, negatives // nullif(positives, 0) AS negatives_per_positive FROM c""",
)
def label_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.label_balance(table(spark, sf_dir, "labels"), "quality")


@query("label_counts", "SELECT quality, toxic, count(*) AS count FROM labels GROUP BY ALL")
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").groupBy("quality", "toxic").count()


@query(
    "histogram_fixed",
    "SELECT CAST(floor(o_totalprice / 5000) * 5000 AS DOUBLE) AS bin, count(*) AS count FROM orders GROUP BY 1",
)
def histogram_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.histogram_fixed(table(spark, sf_dir, "orders"), "o_totalprice", 5000.0)


@query(
    "histogram_equal",
    """
WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT CAST(least(floor((o_totalprice - lo) * 10 / (hi - lo)) + 1, 10) AS BIGINT) AS bin, count(*) AS count
FROM orders, e GROUP BY 1""",
)
def histogram_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.histogram_equal(table(spark, sf_dir, "orders"), "o_totalprice")


@query(
    "score_cut_means",
    """
SELECT round(avg(CAST(quality IS NOT NULL AS INTEGER)), 6) AS positive_rate,
       round(avg(CAST(quality IS NOT NULL AS INTEGER)) FILTER (n_chars > 2000), 6) AS positive_rate_long,
       round(avg(n_chars), 6) AS mean_chars, round(avg(n_chars) FILTER (quality = 1), 6) AS mean_chars_good,
       round(avg(n_chars) FILTER (quality < 1), 6) AS mean_chars_bad
FROM documents LEFT JOIN labels USING (doc_id)""",
)
def score_cut_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    positive = "quality IS NOT NULL"
    return rounded(
        D.conditional_means(
            rows,
            {
                "positive_rate": (positive, "true"),
                "positive_rate_long": (positive, "n_chars > 2000"),
                "mean_chars": ("n_chars", "true"),
                "mean_chars_good": ("n_chars", "quality = 1"),
                "mean_chars_bad": ("n_chars", "quality < 1"),
            },
        ),
        6,
    )


@query(
    "coverage",
    """
SELECT round(avg(CASE WHEN quality IS NULL OR quality <> 0 THEN 1.0 ELSE 0.0 END), 9) AS nonzero,
       round(avg(CASE WHEN quality > 0 THEN 1.0 ELSE 0.0 END), 9) AS above_zero,
       round(avg(CASE WHEN quality IS NULL OR quality <> 0 THEN 1.0 ELSE 0.0 END) FILTER (lang = 'en'), 9) AS nonzero_en
FROM documents LEFT JOIN labels USING (doc_id)""",
)
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rounded(
        D.coverage(
            rows,
            {
                "nonzero": ("quality <> 0", "true"),
                "above_zero": ("coalesce(quality > 0, false)", "true"),
                "nonzero_en": ("quality <> 0", "lang = 'en'"),
            },
        )
    )


@query(
    "argmax_row",
    "SELECT * FROM customer ORDER BY coalesce(c_acctbal, 0) DESC, c_custkey LIMIT 1",
)
def argmax_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.argmax_row(table(spark, sf_dir, "customer"), "c_acctbal", 0.0, "c_custkey")


# ---- splits, samples, indexes ---------------------------------------------------------


@query(
    "date_split",
    """
WITH s AS (
    SELECT CASE CAST(ts AS DATE) WHEN DATE '2024-01-20' THEN 'val' WHEN DATE '2024-01-19' THEN 'gap' ELSE 'train' END
               AS split, user_id, CASE WHEN value * 60 >= 60 THEN 1 ELSE 0 END AS label
    FROM events
)
SELECT split, count(*) AS rows, count(DISTINCT user_id) AS users, CAST(sum(label) AS BIGINT) AS positives
FROM s GROUP BY split""",
)
def date_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.date_split(table(spark, sf_dir, "events"), "ts", date(2024, 1, 20), date(2024, 1, 19))
    return (
        rows.withColumn("label", S.timespent_label(F.col("value")))
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.countDistinct("user_id").alias("users"),
            F.sum("label").alias("positives"),
        )
    )


@query(
    "temporal_split",
    """
SELECT CASE WHEN ts >= TIMESTAMP '2024-01-21' THEN 'eval' ELSE 'train' END AS split, count(*) AS rows,
       round(sum(value), 6) AS total FROM events GROUP BY 1""",
)
def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, evaluation = S.temporal_split(table(spark, sf_dir, "events"), "ts", "2024-01-21 00:00:00")
    tagged = train.withColumn("split", F.lit("train")).unionByName(evaluation.withColumn("split", F.lit("eval")))
    return tagged.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("value"), 6).alias("total"))


@query(
    "dense_index",
    f"""
WITH e AS ({INTERACTIONS_SQL}),
u AS (SELECT *, dense_rank() OVER (ORDER BY user_id) - 1 AS user_index FROM e),
c AS (SELECT * FROM u WHERE user_index <= 10000000)
SELECT event_id, user_id, k, user_index, dense_rank() OVER (ORDER BY k) - 1 AS creator_index FROM c""",
)
def dense_index_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = interactions(spark, sf_dir).select("event_id", "user_id", "k")
    return index_interactions(rows, "user_id", "k", ranges=Ranges(rows_per_range=10))


@query(
    "dense_index_text",
    "SELECT DISTINCT c_name, dense_rank() OVER (ORDER BY c_name) - 1 AS name_index FROM customer",
)
def dense_index_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_index(table(spark, sf_dir, "customer"), "c_name", "name_index", NARROW)


HASH_SQL = "CAST(('0x' || substr(md5('42:' || {0}), 1, 8)) AS BIGINT)"


@query(
    "random_split",
    f"""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {HASH_SQL.format('doc_id')}, doc_id) AS n,
                  count(*) OVER () AS total FROM documents)
SELECT doc_id, n <= ceil(total * 0.75) AS train FROM r""",
)
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.exact_sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", fraction=0.75, flag="train")


@query(
    "stratified_split",
    f"""
WITH r AS (SELECT doc_id, quality,
                  row_number() OVER (PARTITION BY quality ORDER BY {HASH_SQL.format('doc_id')}, doc_id) AS n,
                  count(*) OVER (PARTITION BY quality) AS total FROM labels)
SELECT doc_id, quality, n <= ceil(total * 0.2) AS test FROM r""",
)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return S.exact_sample(rows, "doc_id", fraction=0.2, by="quality", flag="test")


NEGATIVES_SQL = f"""
    SELECT event_id, 0 AS label FROM events WHERE event_type <> 'purchase'
    ORDER BY {HASH_SQL.format('event_id')}, event_id LIMIT 1000"""


@query(
    "neg_downsample",
    f"SELECT event_id, 1 AS label FROM events WHERE event_type = 'purchase' UNION ALL SELECT * FROM ({NEGATIVES_SQL})",
)
def neg_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "CAST(event_type = 'purchase' AS INT) AS label")
    return S.shuffled(S.downsample_negatives(rows, "label", "event_id", 1000), "event_id")


@query(
    "class_weights",
    """
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality)
SELECT doc_id, quality, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 9) AS weight
FROM labels JOIN c USING (quality)""",
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.balanced_weights(table(spark, sf_dir, "labels").select("doc_id", "quality"), "quality"))


@query(
    "class_weights_null",
    """
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN quality END AS quality FROM labels),
c AS (SELECT quality, count(*) AS n FROM d WHERE quality IS NOT NULL GROUP BY quality)
SELECT doc_id, quality, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 9) AS weight
FROM d LEFT JOIN c USING (quality)""",
)
def class_weights_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a label stay, without a weight, and do not count."""
    rows = table(spark, sf_dir, "labels").selectExpr("doc_id", "CASE WHEN doc_id % 5 <> 0 THEN quality END AS quality")
    return rounded(S.balanced_weights(rows, "quality"))


@query(
    "hash_shard",
    """
WITH h AS (SELECT user_id, CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) AS h, value FROM events)
SELECT i AS shard, count(*) AS rows, count(DISTINCT user_id) AS users
FROM h, range(4) r(i) WHERE (h + i) % 4 = 0 GROUP BY i""",
)
def hash_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    number = F.coalesce(*[F.when(shard(F.col("user_id"), i, 4), F.lit(i).cast("bigint")) for i in range(4)])
    return (
        events.groupBy(number.alias("shard"))
        .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("user_id").alias("users"))
    )


@query("limit_rows", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 1000")
def limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: the thousand largest values."""
    return table(spark, sf_dir, "events").select("event_id", "value").orderBy(F.desc("value"), "event_id").limit(1000)
