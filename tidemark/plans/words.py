"""Word counts, job metrics, name and label rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators.wordcount import count_words, line_metrics
from tidemark.plans.registry import query
from tidemark.sources.tables import spread, table

LINES_SQL = "SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents"


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document, as a text reader would deliver them."""
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return documents.select("doc_id", F.explode(F.split("text", "\n")).alias("value"))


def words_oracle(tokens: str, source: str = LINES_SQL) -> str:
    return f"""
WITH l AS ({source}), t AS (SELECT unnest({tokens}) AS word FROM l)
SELECT word, count(*) AS count FROM t GROUP BY word"""


def word_query(name: str, tokens: Callable[[], Column], oracle: str, **options) -> None:
    query(name, oracle)(lambda spark, sf_dir: count_words(document_lines(spark, sf_dir), tokens(), **options))


def line() -> Column:
    return F.col("value")


def csv_text() -> Column:
    """The second field of the line ``id,text``: all that follows the first comma."""
    return F.element_at(F.split(F.concat_ws(",", "doc_id", "value"), ",", 2), 2)


_FIELD = "substr(doc_id || ',' || value, strpos(doc_id || ',' || value, ',') + 1)"
_SPACE = f"string_split({_FIELD}, ' ')"
_NON_WORD = r"list_transform(string_split_regex(value, '\W+'), lambda w: lower(w))"

word_query(
    "wordcount_regex",
    lambda: T.words(line()),
    words_oracle("list_transform(regexp_extract_all(value, '[a-zA-Z]+(''[a-z])?'), lambda w: lower(w))"),
)
word_query("wordcount_space", lambda: T.space_tokens(csv_text()), words_oracle(_SPACE))
word_query(
    "wordcount_space_jvm",
    lambda: T.space_tokens(csv_text(), keep_trailing_empty=False),
    words_oracle(
        f"CASE WHEN {_FIELD} = '' THEN [''] WHEN rtrim({_FIELD}, ' ') = '' THEN [] "
        f"ELSE string_split(rtrim({_FIELD}, ' '), ' ') END"
    ),
)
word_query("wordcount_nonword", lambda: T.non_word_tokens(line()), words_oracle(_NON_WORD))
word_query("wordcount_nonword_parts", lambda: T.non_word_tokens(line()), words_oracle(_NON_WORD), partitions=4)
word_query(
    "wordcount_whitespace",
    lambda: T.whitespace_tokens(line()),
    words_oracle(r"string_split_regex(value, '[ \t\n\x0B\f\r]')"),
)


@query("wordcount_table", words_oracle("string_split(text, ' ')", "SELECT text FROM documents"))
def wordcount_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("text"))
    return count_words(documents, T.space_tokens(F.col("text")))


@query(
    "wordcount_job_metrics",
    rf"""
WITH l AS ({LINES_SQL})
SELECT count(*) FILTER (regexp_matches(value, '^[\s\x{{0B}}\x{{85}}\p{{Z}}]*$')) AS empty_lines,
       CAST(sum(len(list_filter(regexp_extract_all(value, '[a-zA-Z]+(''[a-z])?'), lambda w: len(w) < 9))) AS BIGINT)
           AS small_words,
       count(value) AS lines, CAST(sum(strlen(value)) AS BIGINT) AS line_length_sum,
       min(strlen(value)) AS line_length_min, max(strlen(value)) AS line_length_max
FROM l""",
)
def wordcount_job_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_metrics(document_lines(spark, sf_dir))


SOURCE_NAMES_SQL = """
    SELECT doc_id, CASE doc_id % 5
        WHEN 0 THEN 'sharecone-weighted-' || lang || '-' || source || '-[1]'
        WHEN 1 THEN 'sharecone-weightedlag-' || lang || '-latestMinView-' || source
        WHEN 2 THEN source || '-latestMinView-' || lang
        WHEN 3 THEN 'sharecone-weighted-' || source
        ELSE lang || '-' || source END AS name
    FROM documents"""


def source_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang, source = F.col("lang"), F.col("source")
    kind = F.col("doc_id") % 5
    name = (
        F.when(kind == 0, F.concat(F.lit("sharecone-weighted-"), lang, F.lit("-"), source, F.lit("-[1]")))
        .when(kind == 1, F.concat(F.lit("sharecone-weightedlag-"), lang, F.lit("-latestMinView-"), source))
        .when(kind == 2, F.concat(source, F.lit("-latestMinView-"), lang))
        .when(kind == 3, F.concat(F.lit("sharecone-weighted-"), source))
        .otherwise(F.concat(lang, F.lit("-"), source))
    )
    return table(spark, sf_dir, "documents").select("doc_id", name.alias("name"))


_SIMPLE = r"regexp_replace(name, '^(sharecone-weighted(lag)?-)[^-]*-?', '\1')"


@query(
    "cg_name_simplify",
    f"""
WITH n AS ({SOURCE_NAMES_SQL})
SELECT doc_id, name, {_SIMPLE} AS plain,
       CASE WHEN NOT regexp_matches(name, '^sharecone-weighted(lag)?-') AND contains(name, 'latestMinView')
            THEN 'latestMinView' ELSE {_SIMPLE} END AS merged
FROM n""",
)
def cg_name_simplify(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("name")
    return source_names(spark, sf_dir).select(
        "doc_id",
        "name",
        T.simplify_source(name, merge_latest_view=False).alias("plain"),
        T.simplify_source(name).alias("merged"),
    )


@query(
    "label_remap",
    """
WITH l AS (SELECT doc_id, quality * 3 + doc_id % 3 AS votes, 1 + (doc_id + toxic) % 5 AS grade, quality, toxic FROM labels),
m AS (
    SELECT doc_id, CASE WHEN votes >= 3 THEN 1 WHEN votes <= 1 THEN 0 ELSE 2 END AS vote_label,
           CASE WHEN grade >= 4 THEN 1 WHEN grade <= 2 THEN 0 ELSE 2 END AS grade_label,
           CASE WHEN toxic = 1 THEN 2 ELSE quality END AS truth
    FROM l
)
SELECT doc_id, vote_label, grade_label, truth AS truth_label FROM m WHERE vote_label <> 2 AND truth <> 2""",
)
def label_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels rendered as the texts annotators deliver, then read back."""
    rows = table(spark, sf_dir, "labels").select(
        "doc_id",
        F.format_string("(%d, %d)", F.col("quality") * 3 + F.col("doc_id") % 3, F.lit(2)).alias("votes"),
        (1 + (F.col("doc_id") + F.col("toxic")) % 5).cast("string").alias("grade"),
        F.when(F.col("toxic") == 1, "other").when(F.col("quality") == 1, "true").otherwise("false").alias("truth"),
    )
    out = rows.select(
        "doc_id",
        T.vote_label(F.col("votes")).alias("vote_label"),
        T.grade_label(F.col("grade")).alias("grade_label"),
        T.truth_label(F.col("truth")).alias("truth_label"),
    )
    return out.where((F.col("vote_label") != 2) & (F.col("truth_label") != 2))
