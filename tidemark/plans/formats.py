"""Readers and writers over data that Spark renders from the tables, and write-then-read round trips."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions.times import parse_iso_seconds
from tidemark.operators.counters import decayed_counters, livestream_counters
from tidemark.operators.embeddings import embedding_export
from tidemark.operators.features import Config, read_input, read_vocabulary
from tidemark.operators.history import delayed_history
from tidemark.operators.metrics import f1_sweep, training_report
from tidemark.operators.ranks import yield_curve
from tidemark.operators.wordcount import count_words
from tidemark.plans import evaluation, preparation, sources_yield, words
from tidemark.plans.registry import ORACLES, query
from tidemark.plans.temporal import INTERACTIONS_SQL
from tidemark.session import scratch_path
from tidemark.sources import readers, writers
from tidemark.sources.tables import interactions, spread, table

# ---- the counter job from JSON lines to features --------------------------------------

NAMES_SQL = """CASE event_type WHEN 'view' THEN 'view_end' WHEN 'click' THEN 'like' WHEN 'signup' THEN 'gift'
               WHEN 'error' THEN 'share' ELSE 'timespent_target' END"""


def counter_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(interactions(spark, sf_dir)).selectExpr(
        "CAST(k AS STRING) AS hostId",
        "CAST(user_id AS STRING) AS memberId",
        "CASE WHEN value > 0 THEN CAST(segment AS STRING) END AS livestreamId",
        f"{NAMES_SQL} AS event_name",
        "CAST(unix_millis(CAST(ts AS TIMESTAMP)) AS STRING) AS event_time",
        "CAST(CAST(floor(value * 1000) AS BIGINT) AS STRING) AS duration_ms",
        "CAST(k AS STRING) AS like_counter",
        "CAST(k % 7 AS STRING) AS gift_cheers_value",
        "CAST(k % 5 AS STRING) AS gift_quantity",
    )
    return rows.select(writers.json_line().alias("value"))


@query(
    "json_events_parse",
    f"""
WITH e AS ({INTERACTIONS_SQL})
SELECT {NAMES_SQL} AS event_name, CAST(segment AS VARCHAR) AS "livestreamId", count(*) AS rows,
       CAST(sum(us // 1000) AS BIGINT) AS millis, CAST(sum(floor(value * 1000)) AS BIGINT) AS duration,
       CAST(sum((k % 7) * (k % 5)) AS BIGINT) AS gifts
FROM e WHERE value > 0 GROUP BY 1, 2""",
)
def json_events_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.counter_events(counter_lines(spark, sf_dir))
    return rows.groupBy("event_name", "livestreamId").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.unix_millis("event_time")).alias("millis"),
        F.sum("duration_ms").alias("duration"),
        F.sum(F.col("gift_cheers_value") * F.col("gift_quantity")).alias("gifts"),
    )


LIVE_SQL = f"""
    SELECT k, user_id, us // 1000 * 1000 AS us, event_type, floor(value * 1000) AS duration_ms
    FROM ({INTERACTIONS_SQL}) WHERE value > 0"""


@query(
    "counter_job",
    f"""
WITH e AS ({LIVE_SQL}), b AS (SELECT *, (SELECT min(us) FROM e) AS t0 FROM e),
f AS (
    SELECT *, sum(CASE WHEN event_type = 'view' THEN duration_ms * exp((us - t0) / 2592000000000.0) END) OVER w
                  * exp((t0 - max(CASE WHEN event_type = 'view' THEN us END) OVER w) / 2592000000000.0) AS timespent,
           sum(CASE WHEN event_type = 'signup' THEN (k % 7) * (k % 5) * exp((us - t0) / 2592000000000.0) END) OVER w
                  * exp((t0 - max(CASE WHEN event_type = 'signup' THEN us END) OVER w) / 2592000000000.0) AS gifts
    FROM b WINDOW w AS (PARTITION BY k ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND 3600000000 PRECEDING)
)
SELECT CAST(k AS VARCHAR) AS "hostId", count(*) AS targets, round(sum(coalesce(timespent, 0)), 1) AS timespent,
       round(sum(coalesce(gifts, 0)), 2) AS gifts
FROM f WHERE event_type = 'purchase' GROUP BY k""",
)
def counter_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines in, standard counters on, summed per host."""
    rows = readers.counter_events(counter_lines(spark, sf_dir))
    targets = rows.where("event_name = 'timespent_target'").withColumn(
        "row", F.concat_ws("|", "hostId", "memberId", F.unix_micros("event_time"))
    )
    out = decayed_counters(rows, targets, key_sets=[["hostId"]], counters=livestream_counters(), target_id="row")
    return out.groupBy("hostId").agg(
        F.count(F.lit(1)).alias("targets"),
        F.round(F.sum("feature_hostId_1h0m0s_timespent_decay_720h0m0s"), 1).alias("timespent"),
        F.round(F.sum("feature_hostId_1h0m0s_gift_value_720h0m0s"), 2).alias("gifts"),
    )


# ---- the history job from CSV lines to gzip lines -------------------------------------


@query(
    "history_job",
    f"""
WITH e AS (SELECT *, us // 1000000 AS s, value > 50 AS positive FROM ({INTERACTIONS_SQL})),
h AS (
    SELECT t.event_id, count(*) FILTER (o.positive) AS pos, count(*) FILTER (NOT o.positive) AS neg
    FROM e t LEFT JOIN e o ON t.user_id = o.user_id AND o.s + 3600 <= t.s
    WHERE t.s >= 1704240000 GROUP BY t.event_id
)
SELECT CAST(event_id AS VARCHAR) AS event, CASE WHEN pos <= 64 THEN pos ELSE 33 + (pos - 65) % 32 END AS positives,
       CASE WHEN neg <= 64 THEN neg ELSE 33 + (neg - 65) % 32 END AS negatives
FROM h""",
)
def history_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction lines to gzip lines with both histories, read back; counts the ids of each history."""
    lines = interactions(spark, sf_dir).selectExpr(
        "concat_ws(',', event_id, k, user_id, date_format(ts, 'yyyy-MM-dd'), value, "
        "unix_seconds(CAST(ts AS TIMESTAMP)), CAST(value > 50 AS INT), 'a,b') AS value"
    )
    rows = readers.interactions_csv(lines)
    out = delayed_history(
        rows,
        member="memberId",
        item="hostId",
        label="label",
        time="livestreamExitTime",
        row_id="livestreamId",
        start=datetime(2024, 1, 3),
    )
    path = scratch_path(spark, "histories")
    fields = [c for c in readers.INTERACTION if c != "evaluationFlag"]
    writers.text(out, writers.history_line(fields, ["positives_history", "negatives_history"]), path, gzip=True)
    parts = F.split("value", ",")

    def ids(index: int):
        return F.size(F.filter(F.split(parts[index], " "), lambda t: t != "")).cast("bigint")

    return readers.text_lines(spark, path).select(
        parts[0].alias("event"), ids(7).alias("positives"), ids(8).alias("negatives")
    )


# ---- word counts through every sink ---------------------------------------------------

_COUNTS_SQL = ORACLES["wordcount_regex"]


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_words(words.document_lines(spark, sf_dir), T.words(F.col("value")))


@query("sink_text", _COUNTS_SQL)
def sink_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "words")
    writers.text(counts(spark, sf_dir), writers.word_line(), path)
    parts = F.split("value", ": ")
    return readers.text_lines(spark, path).select(parts[0].alias("word"), parts[1].cast("bigint").alias("count"))


@query("sink_csv", _COUNTS_SQL)
def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "words")
    writers.csv(counts(spark, sf_dir), path)
    return readers.csv_table(spark, path, "word STRING, count BIGINT", header=False)


@query("sink_key_value", _COUNTS_SQL)
def sink_key_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "words")
    writers.text(counts(spark, sf_dir), writers.key_value_line("word", "count"), path, gzip=True)
    return readers.tsv_table(spark, path, "word STRING, count BIGINT")


@query("sink_table", _COUNTS_SQL)
def sink_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "words")
    counts(spark, sf_dir).write.mode("overwrite").parquet(path)
    return readers.parquet_table(spark, path, ["word", "count"])


@query(
    "sink_tsv_fixed",
    f"""
WITH {sources_yield.YIELD_SQL}, {sources_yield.CURVE_SQL}
SELECT cg_name, cg_rank, format('{{:.3f}}', per_slot) AS per_slot, CAST(cg_pool_cumsum AS BIGINT) AS cg_pool_cumsum FROM n""",
)
def sink_tsv_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "curve")
    curve = yield_curve(*sources_yield.yield_inputs(spark, sf_dir))
    picked = curve.selectExpr("cg_name", "cg_rank", "front_event_per_cg_slot AS per_slot", "cg_pool_cumsum")
    writers.tsv_fixed(picked, path)
    schema = "cg_name STRING, cg_rank INT, per_slot STRING, cg_pool_cumsum BIGINT"
    return readers.csv_table(spark, path, schema, header=True, sep="\t")


@query(
    "sink_scored_labels",
    f"""
WITH s AS ({evaluation.SCORED_SQL})
SELECT CASE WHEN coarse >= 0.1 THEN 'true' ELSE 'false' END AS label, format('{{:.4f}}', coarse) AS score, count(*) AS rows
FROM s GROUP BY 1, 2""",
)
def sink_scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "scored")
    writers.scored_labels(evaluation.scored(spark, sf_dir), "coarse", path)
    rows = readers.tsv_table(spark, path, "label STRING, score STRING")
    return rows.groupBy("label", "score").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "sink_predictions",
    f"""
WITH s AS ({evaluation.SCORED_SQL}), t AS (SELECT i / 20.0 AS threshold FROM range(20) r(i)),
m AS (
    SELECT CAST(threshold AS DOUBLE) AS threshold, count_if(coarse >= threshold) AS predicted,
           count_if(coarse >= threshold AND label = 1) AS tp, count_if(label = 1) AS p
    FROM s, t GROUP BY threshold
)
SELECT threshold, round(2.0 * tp / nullif(predicted + p, 0), 9) AS f1 FROM m""",
)
def sink_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores written as gzip CSV, read back, and matched with the labels by row id."""
    path = scratch_path(spark, "predictions")
    writers.csv(evaluation.scored(spark, sf_dir).select("doc_id", "coarse"), path, header=True, gzip=True)
    predictions = readers.csv_table(spark, path, "doc_id BIGINT, score DOUBLE")
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id", "quality AS label")
    return sources_yield.rounded(f1_sweep(predictions.join(labels, "doc_id"), "score", "label"))


@query(
    "sink_daily_append",
    """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS rows, count(DISTINCT user_id) AS users
FROM events GROUP BY 1""",
)
def sink_daily_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to one table partitioned by day."""
    path = scratch_path(spark, "daily")
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    for half in (0, 1):
        writers.append_daily(rows.where(F.col("event_id") % 2 == half), "ts", path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("user_id").alias("users")
    )


@query("sink_replaced_table", "SELECT event_id, user_id, value FROM events WHERE event_id % 2 = 1")
def sink_replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table of all events, replaced by those of odd number."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    path = scratch_path(spark, "replaced")
    name = f"replaced_{path.rpartition('-')[2]}"
    writers.replace_table(rows, name, path)
    writers.replace_table(rows.where("event_id % 2 = 1"), name, path)
    return spark.table(name)


@query(
    "iso_times",
    """
SELECT event_id, CAST(epoch_us(date_trunc('second', ts)) // 1000000 AS BIGINT) AS seconds,
       CAST(floor((epoch_us(TIMESTAMP '2024-03-01') - epoch_us(date_trunc('second', ts))) / 1e6) AS BIGINT) AS age
FROM events""",
)
def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as ISO text, parsed back, and their distance from a fixed instant."""
    texts = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("text"))
    seconds = F.unix_micros(parse_iso_seconds(F.col("text"))) / 1_000_000
    instant = F.unix_micros(parse_iso_seconds(F.lit("2024-03-01T00:00:00"))) / 1_000_000
    return texts.select("event_id", seconds.cast("bigint").alias("seconds"), (instant - seconds).cast("bigint").alias("age"))


@query(
    "sink_report",
    f"""
WITH {evaluation.GROUPS_SQL}
SELECT round(avg(coarse), 9) AS prediction_mean, {evaluation.AUC_SQL} AS roc_auc, 'run 1' AS arguments FROM s""",
)
def sink_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "report")
    metrics = training_report(evaluation.scored(spark, sf_dir), "coarse", "label")
    writers.report(metrics, path, arguments="run 1")
    schema = "prediction_mean DOUBLE, roc_auc DOUBLE, arguments STRING"
    return sources_yield.rounded(readers.json_lines(spark, path, schema))


@query(
    "sink_vectors",
    """
SELECT vec_id, 'bias-free' AS model_name, CAST(embedding[1] AS DOUBLE) AS first, 64 AS dim FROM embeddings""",
)
def sink_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "vectors")
    rows = table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", "'bias-free' AS model_name", "CAST(embedding AS ARRAY<DOUBLE>) AS vector"
    )
    writers.vectors_csv(rows, ["vec_id", "model_name"], "vector", path)
    schema = "vec_id BIGINT, model_name STRING, vector STRING"
    back = spark.read.schema(schema).csv(path, header=True, escape="\\")
    parsed = F.from_json("vector", "ARRAY<DOUBLE>")
    return back.select("vec_id", "model_name", parsed[0].alias("first"), F.size(parsed).alias("dim"))


@query(
    "sink_embedding_table",
    """
SELECT CAST(TIMESTAMP '2023-03-10 13:15:50' AS DATE)::VARCHAR AS date, count(*) AS rows,
       round(sum(CAST(embedding[1] AS DOUBLE)), 6) AS total FROM embeddings GROUP BY 1""",
)
def sink_embedding_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "export")
    wide = embedding_export(
        table(spark, sf_dir, "embeddings"),
        key="vec_id",
        vector="embedding",
        entity="user",
        dim=preparation.DIM,
        at=datetime(2023, 3, 10, 13, 15, 50),
    )
    writers.append_daily(wide, "timestamp", path)
    return spark.read.parquet(path).groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum(F.col("user_emb_0").cast("double")), 6).alias("total")
    )


# ---- further readers ------------------------------------------------------------------


@query(
    "csv_defaults",
    """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS event_type,
       CASE WHEN event_id % 5 = 0 THEN 0 ELSE user_id END AS user_id,
       CASE WHEN event_id % 7 = 0 THEN 0.0 ELSE CAST(CAST(value AS FLOAT) AS DOUBLE) END AS value
FROM events""",
)
def csv_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional CSV whose empty fields take the default of their type."""
    path = scratch_path(spark, "csv")
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 3 <> 0 THEN event_type END AS event_type",
        "CASE WHEN event_id % 5 <> 0 THEN user_id END AS user_id",
        "CASE WHEN event_id % 7 <> 0 THEN value END AS value",
    )
    writers.csv(rows, path)
    config = Config.parse(
        {
            "format": "csv",
            "label": "value",
            "dataset_features": {
                "event_id": {"type": "int"},
                "event_type": {"type": "str"},
                "user_id": {"type": "int"},
                "value": {"type": "float"},
            },
            "model": {"features": {}},
        }
    )
    return read_input(spark, config, path).withColumn("value", F.col("value").cast("double"))


@query("vocabulary_gzip", "SELECT DISTINCT l_partkey AS token, l_partkey * 2 AS index FROM lineitem")
def vocabulary_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "vocabulary")
    ids = table(spark, sf_dir, "lineitem").select("l_partkey").distinct()
    writers.csv(ids.selectExpr("l_partkey", "l_partkey * 2"), path, gzip=True)
    return read_vocabulary(spark, path)


@query(
    "json_rows_with_key",
    "SELECT doc_id, quality FROM documents JOIN labels USING (doc_id)",
)
def json_rows_with_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "prompts")
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    writers.text(rows.select("doc_id", "text", "quality"), writers.json_line(), path)
    return readers.json_lines_with(spark, path, "doc_id BIGINT, quality INT", "quality")


@query(
    "warehouse_scan",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def warehouse_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("tidemark_orders")
    return readers.warehouse(spark, "tidemark_orders", ["o_orderkey", "o_totalprice"], "o_orderstatus = 'F'")


@query(
    "tagged_union",
    """
SELECT CASE WHEN event_type = 'purchase' THEN 'DATASET' ELSE 'FEATURES' END AS input_type, count(*) AS rows,
       count(*) FILTER (event_type <> 'purchase') AS with_value
FROM events GROUP BY 1""",
)
def tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    both = readers.tagged_union(
        events.where("event_type = 'purchase'").select("event_id", "ts"),
        events.where("event_type <> 'purchase'").select("event_id", "ts", "value"),
    )
    return both.groupBy("input_type").agg(F.count(F.lit(1)).alias("rows"), F.count("value").alias("with_value"))


@query("text_generate")
def text_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated line per document, counted by word."""
    lines = readers.random_lines(table(spark, sf_dir, "documents"), "doc_id")
    return count_words(lines, T.space_tokens(T.csv_field(F.col("value"), 1)))
