"""Candidate-source rank counts, statistics and yield curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ranks
from tidemark.plans.registry import query
from tidemark.plans.temporal import INTERACTIONS_SQL
from tidemark.sources.tables import interactions, spread, table

# every event names two candidate sources with the position each gave the item
SOURCES_SQL = f"""
    WITH e AS ({INTERACTIONS_SQL})
    SELECT *, k AS pos, CASE WHEN segment % 3 = 0 THEN 'sharecone-weighted-' || event_type || '-s' || (segment % 7)
                             ELSE 's' || (segment % 7) END AS cg_rank_raw FROM e
    UNION ALL
    SELECT *, (k * 7) % 20 AS pos, 'latestMinView-' || event_type AS cg_rank_raw FROM e"""
COUNTS_SQL = f"""
    SELECT pos, CASE WHEN starts_with(cg_rank_raw, 'latest') THEN 'latestMinView'
                     ELSE regexp_replace(cg_rank_raw, '^(sharecone-weighted-)[^-]*-?', '\\1') END AS cg_rank,
           event_type = 'click' AS is_liked, k % 2 = 0 AS is_shared, k % 3 = 0 AS is_profile_opened,
           user_id % 5 = 0 AS is_downloaded, user_id % 7 = 0 AS is_followed, value > 50 AS vplay98,
           CAST(1 + event_id % 4 AS BIGINT) AS n
    FROM ({SOURCES_SQL})"""
RANK_COUNTS_SQL = f"""
    SELECT pos, cg_rank, is_liked, is_shared, is_profile_opened, is_downloaded, is_followed, vplay98,
           CAST(sum(n) AS BIGINT) AS cnt
    FROM ({COUNTS_SQL}) GROUP BY ALL"""


def client_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as the JSON lines a client logs."""
    kind = F.concat(F.lit("s"), F.col("segment") % 7)
    source = F.when(
        F.col("segment") % 3 == 0, F.concat(F.lit("sharecone-weighted-"), F.col("event_type"), F.lit("-"), kind)
    ).otherwise(kind)
    nested = F.to_json(
        F.create_map(
            source,
            F.col("k").cast("string"),
            F.concat(F.lit("latestMinView-"), F.col("event_type")),
            (F.col("k") * 7 % 20).cast("string"),
        )
    )
    line = F.struct(
        (1 + F.col("event_id") % 4).cast("string").alias("cnt"),
        nested.alias("cg_ranks"),
        F.when(F.col("event_type") == "click", "true").otherwise("false").alias("isLiked"),
        F.when(F.col("k") % 2 == 0, "1").otherwise("0").alias("isShared"),
        F.when(F.col("k") % 3 == 0, "True").otherwise("False").alias("isProfileOpened"),
        F.when(F.col("user_id") % 5 == 0, "t").otherwise("f").alias("isDownloaded"),
        F.when(F.col("user_id") % 7 == 0, "TRUE").otherwise("F").alias("isFollowed"),
        (F.col("value") > 50).alias("vplay98"),
    )
    return spread(interactions(spark, sf_dir)).select(F.to_json(line).alias("value"))


@query("cg_rank_counts", RANK_COUNTS_SQL)
def cg_rank_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.client_event_ranks(client_lines(spark, sf_dir))


@query(
    "cg_candidate_counts",
    f"SELECT pos, cg_rank, CAST(sum(n) AS BIGINT) AS cnt FROM ({COUNTS_SQL}) GROUP BY ALL",
)
def cg_candidate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.candidate_ranks(client_lines(spark, sf_dir))


def stats_oracle(condition: str) -> str:
    return f"""
WITH c AS (SELECT pos, cg_rank, sum(n) AS cnt FROM ({COUNTS_SQL}) WHERE {condition} GROUP BY ALL),
r AS (SELECT *, sum(cnt) OVER (PARTITION BY cg_rank ORDER BY pos) / (pos + 1) AS ratio FROM c)
SELECT cg_rank, max(pos) AS max_pos, CAST(sum(cnt) AS BIGINT) AS total_sum, max(ratio) AS max_cumsum_ratio,
       arg_max(ratio, pos) AS last_cumsum_ratio,
       round(arg_max(ratio, pos) / (SELECT sum(cnt) FROM c), 9) AS normalized_cumsum_ratio
FROM r GROUP BY cg_rank"""


def rank_stats(rows: DataFrame) -> DataFrame:
    share = F.round("normalized_cumsum_ratio", 9).alias("normalized_cumsum_ratio")
    stats = ranks.source_stats(rows)
    return stats.withColumn("normalized_cumsum_ratio", share).orderBy(F.desc("last_cumsum_ratio"))


@query("cg_rank_stats", stats_oracle("TRUE"))
def cg_rank_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_stats(cg_rank_counts(spark, sf_dir))


@query("cg_rank_stats_filtered", stats_oracle("vplay98"))
def cg_rank_stats_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_stats(cg_rank_counts(spark, sf_dir).where("vplay98"))


@query(
    "cg_source_totals",
    f"SELECT cg_rank, CAST(sum(n) AS BIGINT) AS cnt, max(pos) AS max_pos FROM ({COUNTS_SQL}) GROUP BY cg_rank",
)
def cg_source_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.source_totals(cg_candidate_counts(spark, sf_dir)).orderBy(F.desc("cnt"))


@query("cg_distinct_sources", f"SELECT DISTINCT cg_rank FROM ({COUNTS_SQL})")
def cg_distinct_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cg_candidate_counts(spark, sf_dir).select("cg_rank").distinct()


# Pool: every line item of a brand. Front events: the returned ones. Both for one variant.
SLOTS = ["Brand#3", "Brand#11"]
YIELD_SQL = """
    r AS (
        SELECT p_brand AS cg_name, l_linenumber - 1 AS cg_rank, CAST(l_quantity AS BIGINT) AS cnt, l_returnflag
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE l_linestatus = 'O' AND p_brand NOT IN ('Brand#3', 'Brand#11')
    ),
    pool AS (SELECT cg_name, cg_rank, cnt FROM r),
    front AS (SELECT cg_name, cg_rank, cnt FROM r WHERE l_returnflag = 'R')"""


def yield_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    items = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'")
    parts = ranks.without_slots(
        table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("cg_name")),
        "cg_name",
        SLOTS,
    )
    rows = items.join(parts, "l_partkey").selectExpr(
        "cg_name", "l_linenumber - 1 AS cg_rank", "CAST(l_quantity AS BIGINT) AS cnt", "l_returnflag"
    )
    return ranks.per_rank_pair(rows, "l_returnflag = 'R'")


OVERALL_SQL = """
    o AS (
        SELECT coalesce(f.cg_name, p.cg_name) AS cg_name, front_events_cnt, cg_pool_cnt,
               front_events_cnt / cg_pool_cnt AS per_slot
        FROM (SELECT cg_name, sum(cnt) AS front_events_cnt FROM front GROUP BY 1) f
        FULL JOIN (SELECT cg_name, sum(cnt) AS cg_pool_cnt FROM pool GROUP BY 1) p ON f.cg_name = p.cg_name
    )"""
CURVE_SQL = """
    c AS (
        SELECT f.cg_name, f.cg_rank, cg_pool_cnt, cg_pool_cumsum, front_events_cnt, front_events_cumsum,
               front_events_cumsum / cg_pool_cumsum AS per_slot
        FROM (SELECT *, sum(front_events_cnt) OVER (PARTITION BY cg_name ORDER BY cg_rank) AS front_events_cumsum
              FROM (SELECT cg_name, cg_rank, sum(cnt) AS front_events_cnt FROM front GROUP BY ALL)) f
        JOIN (SELECT *, sum(cg_pool_cnt) OVER (PARTITION BY cg_name ORDER BY cg_rank) AS cg_pool_cumsum
              FROM (SELECT cg_name, cg_rank, sum(cnt) AS cg_pool_cnt FROM pool GROUP BY ALL)) p
        ON f.cg_name = p.cg_name AND f.cg_rank = p.cg_rank
    ),
    n AS (SELECT *, per_slot / (SELECT max(per_slot) FROM c) AS normalized FROM c)"""


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query(
    "cg_yield_overall",
    f"""
WITH {YIELD_SQL}, {OVERALL_SQL}
SELECT cg_name, CAST(front_events_cnt AS BIGINT) AS front_events_cnt, CAST(cg_pool_cnt AS BIGINT) AS cg_pool_cnt,
       round(per_slot, 9) AS front_event_per_cg_slot,
       round(front_events_cnt / (SELECT sum(cnt) FROM front), 9) AS front_events_share,
       round(cg_pool_cnt / (SELECT sum(cnt) FROM pool), 9) AS cg_pool_share,
       round(per_slot / (SELECT max(per_slot) FROM o), 9) AS front_event_per_cg_slot_normalized
FROM o""",
)
def cg_yield_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranks.overall_yield(*yield_inputs(spark, sf_dir)))


@query(
    "cg_yield_curve",
    f"""
WITH {YIELD_SQL}, {CURVE_SQL}
SELECT cg_name, cg_rank, CAST(cg_pool_cnt AS BIGINT) AS cg_pool_cnt, CAST(cg_pool_cumsum AS BIGINT) AS cg_pool_cumsum,
       CAST(front_events_cnt AS BIGINT) AS front_events_cnt,
       CAST(front_events_cumsum AS BIGINT) AS front_events_cumsum, round(per_slot, 9) AS front_event_per_cg_slot,
       round(cg_pool_cumsum / (SELECT sum(cg_pool_cnt) FROM c), 9) AS cg_pool_cumshare,
       round(front_events_cumsum / (SELECT sum(front_events_cumsum) FROM c), 9) AS front_events_share,
       round(normalized, 9) AS front_event_per_cg_slot_normalized,
       round(cg_pool_cumsum / (cg_rank + 1), 9) AS cg_pool_cumsum_per_pos
FROM n""",
)
def cg_yield_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranks.yield_curve(*yield_inputs(spark, sf_dir)))


@query(
    "cg_yield_summary",
    f"""
WITH {YIELD_SQL}, {OVERALL_SQL}, {CURVE_SQL},
l AS (SELECT cg_name, arg_max(normalized, cg_rank) AS last_normalized FROM n GROUP BY cg_name),
j AS (SELECT o.*, last_normalized FROM o JOIN l ON o.cg_name = l.cg_name)
SELECT cg_name, CAST(front_events_cnt AS BIGINT) AS front_events_cnt, CAST(cg_pool_cnt AS BIGINT) AS cg_pool_cnt,
       round(per_slot, 9) AS front_event_per_cg_slot,
       round(front_events_cnt / (SELECT sum(cnt) FROM front), 9) AS front_events_share,
       round(cg_pool_cnt / (SELECT sum(cnt) FROM pool), 9) AS cg_pool_share,
       round(per_slot / (SELECT max(per_slot) FROM o), 9) AS front_event_per_cg_slot_normalized,
       round(last_normalized / (SELECT max(last_normalized) FROM j), 9) AS last_front_event_per_cg_slot_normalized
FROM j""",
)
def cg_yield_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranks.yield_summary(*yield_inputs(spark, sf_dir)))
