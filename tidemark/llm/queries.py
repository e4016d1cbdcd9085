"""Each operator applied to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, decontaminate, hard_negatives, lm, near_dups, neighbours, prefix_trie, sentencepiece, sharding, token_counts, token_files, toxicity, warc
from tidemark.llm.registry import ORACLES, QUERIES, query
from tidemark.session import materialise, scratch_path
from tidemark.sources.tables import table

__all__ = ["ORACLES", "QUERIES"]

SHARDS, SEED = 40, 20240601


@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shuffled shards, read back from the written files."""
    docs, path = table(spark, sf_dir, "documents"), scratch_path(spark, "shards")
    rows = sharding.with_slots(sharding.write_shards(docs, path, SHARDS, "doc_id", "text", SEED))
    doc_id, text = F.col("record.doc_id"), F.col("record.text")
    return rows.select(
        doc_id.alias("doc_id"),
        sharding.record_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        sharding.shard_of(doc_id, SHARDS + 1, SEED).cast("int").alias("grown_shard"),
    )


@query(
    "op3_warc",
    """
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
        CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN page_id > first THEN first END AS refers_to
    FROM (
        SELECT *, CASE WHEN strlen(html) >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first
        FROM pages
    )
    """,
)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per page, written to ZIP packages and read back by ranges."""
    pages = table(spark, sf_dir, "pages")
    manifest = materialise(warc.write_packages(pages, scratch_path(spark, "packages")), "packages")
    return warc.read_packages(manifest, with_payload=False).drop("url")


@query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of all documents in range-coded files, read back."""
    docs = table(spark, sf_dir, "documents")
    written = token_files.write_ids(docs, scratch_path(spark, "ids"), public_tokenizers.path("byte_bpe_50k.json"))
    manifest = materialise(written, "ids")
    return token_files.read_ids(manifest, with_ids=False).withColumnRenamed("key", "doc_id")


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents, as the word model counts them."""
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), ["doc_id"])


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)


@query(
    "op9_decontaminate",
    f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n,
            array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
        FROM b, unnest(range(1, greatest(len(w) - 8, 2))) AS r(i) WHERE len(w) > 0
    ),
    sizes AS (SELECT DISTINCT n FROM windows),
    places AS (
        SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
        FROM d, sizes, unnest(range(1, greatest(len(w) - n + 2, 1))) AS r(i)
    ),
    hits AS (SELECT p.doc_id, p.i, p.n, x.item_id FROM places p JOIN windows x ON x.n = p.n AND x.s = p.s),
    hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hits, unnest(range(i, i + n)) AS r(k) GROUP BY doc_id),
    items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
        CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that lie in ten-word windows of benchmark items."""
    found = decontaminate.find_windows(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"], width=10
    )
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        F.size("found.hit_words").cast("long").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("found.hit_words") > 0).alias("contaminated"),
    )


def _remainder(divisor: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learnt from labels outside the held-out quarter."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train_model(docs, labels, _remainder(4) != 2)
    scored = toxicity.add_scores(docs, model, ["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op6_near_dups")
def op6_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its near duplicates."""
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), least=0.8)


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents: their number, a checksum of the ids, and whether they decode to the text."""
    return sentencepiece.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op4_neighbours")
def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@query("op7_lm")
def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents under a bigram model of nine tenths of them."""
    docs = table(spark, sf_dir, "documents")
    model = lm.learn(docs.where(~lm.held_out("doc_id")))
    scored = lm.add_scores(docs, model).withColumn("held_out", lm.held_out("doc_id"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query(
    "op13_chat",
    r"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL
        SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(
            length(text) + len(regexp_extract_all(text, '[<\[]\\*(?:/?s>|/?INST\]|/?SYS\]|TURN|/TURN\])'))
            + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13 WHEN 'assistant' THEN 7 ELSE 16 + length(role) END
        ) AS BIGINT) AS formatted_chars
    FROM t GROUP BY conv_id
    """,
)
def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that says control strings, formatted, written and read back."""
    turns = table(spark, sf_dir, "conversations")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    whole = turns.select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.read_back(materialise(chat.format_conversations(whole), "chat"))


_CRC32 = """
    xor(list_reduce(
        [CAST(4294967295 AS BIGINT)] || flatten(list_transform(
            string_split(CAST({0} AS VARCHAR), ''), lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]
        )),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END
    ), 4294967295)
"""


@query(
    "op11_prefix_trie",
    f"""
    WITH own AS (
        SELECT conv_id, md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS id,
            length(coalesce(text, '')) AS chars, turn
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id, chars) AS p FROM own),
    heads AS (SELECT DISTINCT conv_id, {_CRC32.format("conv_id")} % 6 AS h FROM own),
    rebuilt AS (
        SELECT c.conv_id, t.p, t.id, t.chars FROM heads c JOIN placed t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.p <= c.h
        UNION ALL
        SELECT c.conv_id, t.p + least(c.h, coalesce(b.n, 0)) - c.h, t.id, t.chars
        FROM heads c JOIN placed t ON t.conv_id = c.conv_id AND t.p > c.h
        LEFT JOIN (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id) b ON b.conv_id = c.conv_id - c.conv_id % 100
    ),
    prefixes AS (
        SELECT conv_id, p AS depth, chars, string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY p) AS path FROM rebuilt
        UNION ALL SELECT conv_id, 0, 0, '' FROM heads
    ),
    ends AS (
        SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
        FROM (SELECT conv_id, max_by(path, depth) AS path FROM prefixes GROUP BY conv_id) GROUP BY path
    ),
    nodes AS (
        SELECT path, depth, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
            CASE WHEN depth > 0 THEN left(path, (depth - 1) * 32) END AS parent
        FROM prefixes GROUP BY path, depth
    ),
    kids AS (SELECT parent, count(*) AS n FROM nodes GROUP BY parent),
    below AS (
        SELECT left(x.path, r.d * 32) AS path, CAST(sum((x.n_convs - 1) * x.chars) AS BIGINT) AS saved,
            count(*) FILTER (k.n IS NULL) AS leaves
        FROM nodes x LEFT JOIN kids k ON k.parent = x.path, unnest(range(0, x.depth + 1)) AS r(d) GROUP BY ALL
    )
    SELECT x.conv_id, x.depth, u.conv_id AS parent_conv_id, x.n_convs, coalesce(k.n, 0) AS n_children, b.leaves AS n_leaves,
        b.saved AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
    FROM nodes x JOIN below b ON b.path = x.path LEFT JOIN nodes u ON u.path = x.parent
    LEFT JOIN kids k ON k.parent = x.path LEFT JOIN ends e ON e.path = x.path
    """,
)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each with the first turns of its hundred's first one in place of its own."""
    convs = materialise(prefix_trie.conversations(table(spark, sf_dir, "conversations")), "conversations")
    first = convs.where("conv_id % 100 = 0").select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("base_turns"), F.slice("chars", 1, 5).alias("base_chars")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    joined = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100).join(first, "base", "left")

    def rebuilt(column: str, kind: str):
        own = F.slice(column, h + 1, F.greatest(F.size(column) - h, F.lit(0)))
        return F.concat(F.coalesce(F.slice(f"base_{column}", F.lit(1), h), F.array().cast(kind)), own).alias(column)

    return prefix_trie.trie(joined.select("conv_id", rebuilt("turns", "array<string>"), rebuilt("chars", "array<int>")))


@query(
    "op12_hard_negatives",
    """
    WITH r AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
            AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))
    ),
    scored AS (
        SELECT a.vec_id AS anchor_id, o.vec_id AS id, a.label = o.label AS same,
            CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(o.v AS DOUBLE[])) AS BIGINT) AS score
        FROM r a JOIN r o ON a.vec_id <> o.vec_id AND len(a.v) = len(o.v) WHERE a.vec_id % 100 = 0
    ),
    positives AS (
        SELECT anchor_id, id, score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT p.anchor_id, p.id AS positive_id,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
        n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
        AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
    QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= 5
    """,
)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hard negatives of each of the five positives of every hundredth vector, among all vectors."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(vectors, F.col("id") % 100 == 0)
