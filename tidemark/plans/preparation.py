"""Vocabulary lookups, sequences, the feature pipeline and embeddings."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import vectors as V
from tidemark.functions.sequences import padded_sequence
from tidemark.operators import embeddings as E
from tidemark.operators import factors as FA
from tidemark.operators.features import Config, read_input, store_vocabularies, transform_features
from tidemark.operators.running import dense_index
from tidemark.operators.small import hint_if_small
from tidemark.plans.registry import query
from tidemark.plans.sources_yield import rounded
from tidemark.plans.temporal import INTERACTIONS_SQL, history_oracle, run_history
from tidemark.session import materialise, scratch_path
from tidemark.sources.tables import interactions, spread, table

VOCAB_SIZE, OOV_BUCKETS, SEQ_LEN, DIM = 80, 3, 16, 64


def portable(value: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({value} AS VARCHAR)), 1, 8)) AS BIGINT)"


def host_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts (property k) below 80 are known; the rest are out of vocabulary."""
    known = interactions(spark, sf_dir).where(F.col("k") < VOCAB_SIZE)
    return known.selectExpr("CAST(k AS BIGINT) AS token").distinct().selectExpr("token", f"{VOCAB_SIZE - 1} - token AS index")


def index_sql(token: str) -> str:
    return f"CASE WHEN {token} < 80 THEN 79 - {token} ELSE 80 + {portable(token)} % 3 END"


def config(features: dict) -> Config:
    return Config.parse(
        {
            "format": "parquet",
            "label": "label",
            "dataset_features": {
                "event_id": {"type": "int", "keep": True},
                "host": {"type": "int"},
                "member": {"type": "int"},
                "label": {"type": "int"},
                "positives_history": {"type": "str"},
                "negatives_history": {"type": "str"},
            },
            "model": {"features": features},
        }
    )


HOST = {
    "vocab_path": "given",
    "vocab_size": VOCAB_SIZE,
    "num_oov_buckets": OOV_BUCKETS,
    "embedding_dim": 16,
    "belongs_to": "post",
}
HISTORY = {
    "split_by_space": True,
    "seq_len": SEQ_LEN,
    "convert_to_int_after_split": True,
    "reuse_vocab": "host",
    "reuse_embedding": "host",
    "belongs_to": "user",
}
MEMBER = {"convert_to_string": True, "hash": True, "vocab_size": 1000, "embedding_dim": 16, "belongs_to": "user"}


@query(
    "vocab_lookup_oov",
    f"WITH e AS ({INTERACTIONS_SQL}) SELECT event_id, {index_sql('k')} AS host, CAST(value > 50 AS INTEGER) AS label FROM e",
)
def vocab_lookup_oov(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = interactions(spark, sf_dir).selectExpr("event_id", "k AS host", "CAST(value > 50 AS INT) AS label")
    return transform_features(rows, config({"host": HOST}), {"host": host_vocabulary(spark, sf_dir)}, "event_id")


@query(
    "stored_vocabularies",
    f"""
WITH e AS ({INTERACTIONS_SQL})
SELECT event_id, {index_sql('k')} AS host, {index_sql('(event_id % 100)')} AS post, segment, CAST(value > 50 AS INTEGER) AS label
FROM e WHERE ({portable('user_id')} + 1) % 3 = 0""",
)
def stored_vocabularies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of three parts of a table, by its users; two vocabularies from the files that the config names; a kept column."""
    folder = scratch_path(spark, "config")
    host_vocabulary(spark, sf_dir).write.csv(f"{folder}/vocabulary", compression="gzip")
    rows = interactions(spark, sf_dir)
    rows.selectExpr("event_id", "k AS host", "event_id % 100 AS post", "user_id", "segment", "CAST(value > 50 AS INT) AS label").write.parquet(
        f"{folder}/rows"
    )
    listed = {"vocab_path": f"{folder}/vocabulary/*.gz"}
    own = Config.parse(
        {
            "format": "parquet",
            "label": "label",
            "dataset_features": {
                "event_id": {"type": "int"},
                "host": {"type": "int"},
                "post": {"type": "int"},
                "user_id": {"type": "int", "use_for_sampling": True},
                "segment": {"type": "int", "keep": True},
                "label": {"type": "int"},
            },
            "model": {"features": {"host": HOST | listed, "post": HOST | listed}},
        }
    )
    stored = store_vocabularies(spark, own, f"vocabularies_{folder.rpartition('-')[2]}", f"{folder}/stored")
    return transform_features(read_input(spark, own, f"{folder}/rows", part=(1, 3)), own, stored, "event_id")


SEQUENCE_SQL = f"""
    SELECT event_id, string_agg(CAST((k * n) % 100 AS VARCHAR), ' ' ORDER BY n) AS tokens
    FROM ({INTERACTIONS_SQL}), range(1, 24) r(n) WHERE n <= 1 + event_id % 23 GROUP BY event_id"""


def token_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with 1 to 23 host ids as text."""
    return spread(interactions(spark, sf_dir)).selectExpr(
        "event_id",
        "array_join(transform(sequence(1, 1 + CAST(event_id % 23 AS INT)), n -> CAST(k * n % 100 AS STRING)), ' ') AS tokens",
    )


@query(
    "sequence_pad",
    f"""
WITH s AS ({SEQUENCE_SQL}), l AS (SELECT event_id, string_split(tokens, ' ') AS t FROM s)
SELECT event_id, array_to_string((t || ['0','0','0','0','0','0','0','0','0','0','0','0','0','0','0','0'])[1:16], ' ') AS oldest,
       array_to_string((t[greatest(len(t) - 16, 0) + 1:]
           || ['0','0','0','0','0','0','0','0','0','0','0','0','0','0','0','0'])[1:16], ' ') AS newest
FROM l""",
)
def sequence_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_text(spark, sf_dir)
    return rows.select(
        "event_id",
        F.array_join(padded_sequence(F.col("tokens"), SEQ_LEN), " ").alias("oldest"),
        F.array_join(padded_sequence(F.col("tokens"), SEQ_LEN, keep="newest"), " ").alias("newest"),
    )


def _pipeline_oracle() -> str:
    zeros = ", ".join(["'0'"] * SEQ_LEN)

    def looked_up(text: str) -> str:
        tokens = f"(CASE WHEN {text} = '' THEN ['0'] ELSE string_split({text}, ' ') END || [{zeros}])[1:{SEQ_LEN}]"
        ids = f"list_transform({tokens}, lambda t: CAST(t AS BIGINT))"
        return f"array_to_string(list_transform({ids}, lambda t: {index_sql('t')}), ' ')"

    return f"""
WITH h AS ({history_oracle('user_id', 'sawtooth')}), e AS ({INTERACTIONS_SQL})
SELECT event_id, {index_sql('k')} AS host, {portable('user_id')} % 1000 AS member,
       {looked_up('positives_history')} AS positives_history, {looked_up('negatives_history')} AS negatives_history,
       CAST(value > 50 AS INTEGER) AS label
FROM e JOIN h USING (event_id)"""


@query("feature_pipeline", _pipeline_oracle())
def feature_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delayed histories, then the whole config-driven preparation on top."""
    rows = interactions(spark, sf_dir).selectExpr(
        "event_id", "k AS host", "user_id AS member", "CAST(value > 50 AS INT) AS label"
    )
    histories = run_history(spark, sf_dir, "user_id").drop("member")
    features = {"host": HOST, "member": MEMBER, "positives_history": HISTORY, "negatives_history": HISTORY}
    out = transform_features(
        rows.join(histories, "event_id"), config(features), {"host": host_vocabulary(spark, sf_dir)}, "event_id"
    )
    return out.select(
        "event_id",
        "host",
        "member",
        F.array_join(F.col("positives_history").cast("array<string>"), " ").alias("positives_history"),
        F.array_join(F.col("negatives_history").cast("array<string>"), " ").alias("negatives_history"),
        "label",
    )


# ---- embeddings -----------------------------------------------------------------------


def dot_sql(a: str, b: str) -> str:
    return f"coalesce(list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])), 0.0)"


@query(
    "embedding_join_dot",
    f"""
WITH e AS ({INTERACTIONS_SQL})
SELECT event_id, round({dot_sql('u.embedding', 'c.embedding')}, 8) AS dot
FROM e LEFT JOIN embeddings u ON user_id * 4 = u.vec_id LEFT JOIN embeddings c ON k = c.vec_id""",
)
def embedding_join_dot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = interactions(spark, sf_dir).selectExpr("event_id", "user_id * 4 AS user_key", "CAST(k AS BIGINT) AS host_key")
    vectors = E.latest_per_id(table(spark, sf_dir, "embeddings"), "vec_id", "label")
    common = {"key": "vec_id", "vector": "embedding", "dim": DIM}
    rows = E.join_embeddings(rows, vectors, row_key="user_key", name="user", **common)
    rows = E.join_embeddings(rows, vectors, row_key="host_key", name="host", **common)
    return rounded(E.dot_feature(rows, "user", "host", "dot").select("event_id", "dot"), 8)


@query(
    "embedding_json_parse",
    """
SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN 0.0 ELSE CAST(embedding[1] AS DOUBLE) END AS first,
       round(CASE WHEN vec_id % 10 = 0 THEN 0.0 ELSE list_sum(CAST(embedding AS DOUBLE[])) END, 9) AS total, 64 AS dim
FROM embeddings""",
)
def embedding_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("vec_id") % 10 == 0, "").otherwise(F.to_json(F.col("embedding").cast("array<double>")))
    vector = V.parse_vector(F.col("text"), DIM)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", text.alias("text")).select("vec_id", vector.alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        "vec_id", F.col("v")[0].alias("first"), F.round(total, 9).alias("total"), F.size("v").alias("dim")
    )


def elements(column: str, names: str, count: int = DIM) -> str:
    """SQL for every element of an array as a column of its own."""
    return ", ".join(f"{column.format(i + 1)} AS {names}{i}" for i in range(count))


@query(
    "embedding_pool",
    f"""
WITH s AS ({SEQUENCE_SQL}), t AS (SELECT event_id, CAST(unnest(string_split(tokens, ' ')) AS BIGINT) AS id FROM s)
SELECT event_id, {elements("round(sum(CAST(embedding[{0}] AS DOUBLE)), 7)", "p")}
FROM t JOIN embeddings ON id = vec_id GROUP BY event_id""",
)
def embedding_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_text(spark, sf_dir).select("event_id", F.split("tokens", " ").cast("array<bigint>").alias("ids"))
    pooled = E.pool_sequence(
        rows,
        table(spark, sf_dir, "embeddings"),
        row_id="event_id",
        sequence="ids",
        key="vec_id",
        vector="embedding",
        dim=DIM,
        name="pooled",
    )
    return pooled.select("event_id", *[F.round(F.col("pooled")[i], 7).alias(f"p{i}") for i in range(DIM)])


@query(
    "affinity_sigmoid",
    f"""
WITH e AS ({INTERACTIONS_SQL}), j AS (
    SELECT event_id, u.vec_id AS user_index, c.vec_id AS creator_index,
           list_dot_product(CAST(u.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS d,
           u.label / 10.0 AS user_bias, c.label / 10.0 AS creator_bias
    FROM e JOIN embeddings u ON user_id * 4 = u.vec_id JOIN embeddings c ON k = c.vec_id
)
SELECT event_id, user_index, creator_index, round(1 / (1 + exp(-(d + user_bias + creator_bias - 0.5))), 8) AS affinity,
       round(1 / (1 + exp(-(user_bias + creator_bias))), 8) AS bias_only
FROM j""",
)
def affinity_sigmoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pretrained factors of both sides: unseen ids drop out, indexes shift to start at 0."""
    rows = interactions(spark, sf_dir).selectExpr("event_id", "user_id * 4 AS user", "CAST(k AS BIGINT) AS creator")
    factors = table(spark, sf_dir, "embeddings")
    for side in ("user", "creator"):
        known = factors.selectExpr(
            f"vec_id AS {side}",
            f"vec_id + 1 AS {side}_index",
            f"embedding AS {side}_vector",
            f"label / 10D AS {side}_bias",
        )
        rows = E.pretrained_indexes(rows, known, side, f"{side}_index", keep=[f"{side}_vector", f"{side}_bias"])
    biases = F.col("user_bias") + F.col("creator_bias")
    return rows.select(
        "event_id",
        "user_index",
        "creator_index",
        F.round(V.affinity(F.col("user_vector"), F.col("creator_vector"), biases, F.lit(-0.5)), 8).alias("affinity"),
        F.round(V.sigmoid(biases), 8).alias("bias_only"),
    )


@query(
    "embedding_concat",
    """
SELECT vec_id, 130 AS width, CAST(embedding[64] AS DOUBLE) AS at_63, CAST(embedding[1] AS DOUBLE) AS at_64,
       CAST(label AS DOUBLE) AS at_128, CAST(vec_id AS DOUBLE) AS at_129 FROM embeddings""",
)
def embedding_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    out = E.concat_blocks(rows, ["embedding", "embedding"], ["label", "vec_id"], "input")
    return out.select(
        "vec_id", F.size("input").alias("width"), *[F.col("input")[i].alias(f"at_{i}") for i in (63, 64, 128, 129)]
    )


@query(
    "embedding_export",
    f"""
SELECT vec_id AS "userId", {", ".join(f"CAST(embedding[{i + 1}] AS FLOAT) AS user_emb_{i}" for i in range(64))},
       CAST(label AS DOUBLE) AS user_bias, CAST(TIMESTAMP '2023-03-10 13:15:50' AS VARCHAR) AS exported
FROM embeddings""",
)
def embedding_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    factors = table(spark, sf_dir, "embeddings").withColumn("bias", F.col("label").cast("double"))
    wide = E.embedding_export(
        factors,
        key="vec_id",
        vector="embedding",
        entity="user",
        dim=64,
        at=datetime(2023, 3, 10, 13, 15, 50),
        bias="bias",
    )
    return wide.withColumn("exported", F.col("timestamp").cast("string")).drop("timestamp")


@query(
    "factor_refresh",
    f"""
SELECT vec_id, {elements("CASE WHEN vec_id % 3 = 0 THEN -CAST(embedding[{0}] AS DOUBLE) ELSE CAST(embedding[{0}] AS DOUBLE) END", "f")}
FROM embeddings""",
)
def factor_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    pretrained = table(spark, sf_dir, "embeddings").selectExpr("vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS factors")
    refit = pretrained.where("vec_id % 3 = 0").selectExpr("vec_id", "transform(factors, x -> -x) AS factors")
    out = E.refresh_factors(pretrained, refit, "vec_id", "factors")
    return out.select("vec_id", *V.to_wide("factors", "f", DIM))


STRENGTHS_SQL = f"""
WITH e AS ({INTERACTIONS_SQL}), p AS (SELECT user_id, k, sum(value) / 100 AS s FROM e GROUP BY ALL)"""


def strengths(spark: SparkSession, sf_dir: str) -> FA.Strengths:
    rows = interactions(spark, sf_dir).selectExpr("user_id", "CAST(k AS BIGINT) AS k", "value / 100 AS s")
    return FA.Strengths(rows, "user_id", "k", "s", alpha=0.5, reg=0.1)


@query(
    "factor_refit",
    f"""{STRENGTHS_SQL}
SELECT p.user_id, {elements("round(sum(CASE WHEN s > 0 THEN 1 + 0.5 * s ELSE 0 END * CAST(embedding[{0}] AS DOUBLE)), 5)", "b")}
FROM p JOIN embeddings ON p.k = vec_id GROUP BY p.user_id""",
)
def factor_refit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A half-step for the users from pretrained creators: factors put into their equations give the right-hand sides.

    The left-hand sides are summed anew, by joins and vector functions, from the factors that the half-step returns.
    """
    given = strengths(spark, sf_dir)
    pairs = materialise(given.pairs("user_id", "k"), "pairs")
    given = replace(given, rows=pairs, user="own", item="other", strength="s")
    creators = table(spark, sf_dir, "embeddings").selectExpr("vec_id AS id", "CAST(embedding AS ARRAY<DOUBLE>) AS features")
    users = materialise(FA.half_step(given, "own", "other", creators), "users").withColumnsRenamed({"id": "own", "features": "x"})

    def weighted(vector: str) -> list[Column]:
        return [F.sum(F.col("c") * F.col(vector)[i]).alias(f"b{i}") for i in range(DIM)]

    # a left-hand side is a sum of weighted vectors: of the rows of G + reg, and of the creators met
    axes = creators.select(F.posexplode("features").alias("at", "c"), "features").groupBy("at").agg(*weighted("features"))
    ridge = [F.col(f"b{i}") + F.when(F.col("at") == i, given.reg).otherwise(0.0) for i in range(DIM)]
    axes = F.broadcast(axes.select("at", F.array(*ridge).alias("v")))  # one row a dimension
    whole = users.select("own", F.posexplode("x").alias("at", "c")).join(axes, "at").select("own", "c", "v")
    named = hint_if_small(creators.join(pairs.select("other").distinct(), F.col("id") == F.col("other"), "leftsemi"), "named")
    met = pairs.join(users, "own").join(named, F.col("other") == named["id"])
    weight = given.alpha * F.abs("s") * V.dot(F.col("x"), F.col("features"))
    left = whole.unionByName(met.select("own", weight.alias("c"), F.col("features").alias("v"))).groupBy("own").agg(*weighted("v"))
    return left.select(F.col("own").alias("user_id"), *[F.round(f"b{i}", 5).alias(f"b{i}") for i in range(DIM)])


@query(
    "factor_export",
    f"""
SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS position, {elements("CAST(embedding[{0}] AS DOUBLE)", "f")} FROM embeddings""",
)
def factor_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factors written in the order of their dense index and read back by place."""
    rows = table(spark, sf_dir, "embeddings").selectExpr("vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS features")
    numbered = rows.join(dense_index(rows, "vec_id", "index"), "vec_id")
    path = scratch_path(spark, "factors")
    FA.export_in_order(numbered, "index", path, rows_per_file=100)
    back = FA.read_in_order(spark, path, "vec_id BIGINT, features ARRAY<DOUBLE>")
    return back.select("vec_id", "position", *V.to_wide("features", "f", DIM))


@query("embedding_wide", "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS ue0, CAST(embedding[64] AS DOUBLE) AS ue63 FROM embeddings")
def embedding_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector to wide columns and back."""
    wide = table(spark, sf_dir, "embeddings").select("vec_id", *V.to_wide("embedding", "ue", DIM))
    back = wide.select("vec_id", V.from_wide("ue", DIM).alias("vector"))
    return back.select("vec_id", F.col("vector")[0].alias("ue0"), F.col("vector")[63].alias("ue63"))


@query(
    "first_per_user",
    "SELECT user_id, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY user_id",
)
def first_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates dropped by id, the first row kept."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return E.first_per_id(rows, "user_id", "event_id")


@query(
    "rename_and_cast",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS "entityId", CAST(o_custkey AS INTEGER) AS "distinctId",
       CAST(trunc(o_totalprice) AS INTEGER) AS amount FROM orders""",
)
def rename_and_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns renamed, cast and dropped."""
    rows = table(spark, sf_dir, "orders").withColumnsRenamed(
        {"o_orderkey": "entityId", "o_custkey": "distinctId", "o_totalprice": "amount"}
    )
    casts = {
        "entityId": F.col("entityId").cast("string"),
        "distinctId": F.col("distinctId").cast("int"),
        "amount": F.col("amount").cast("int"),
    }
    return rows.withColumns(casts).drop("o_orderstatus", "o_orderdate", "o_orderpriority")
