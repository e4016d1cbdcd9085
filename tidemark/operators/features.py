"""Config-driven feature preparation: cast, split, pad, to int, hash, vocabulary lookup, in that order."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import hash_bucket, shard
from tidemark.functions.sequences import PAD, pad, sequence_tokens

# Column types of a config and what a missing CSV field becomes
TYPES = {"str": "string", "int": "bigint", "float": "float"}
DEFAULTS = {"str": "", "int": 0, "float": 0.0}
FORMATS = ("csv", "parquet", "table")


@dataclass(frozen=True)
class InputColumn:
    name: str
    type: str
    keep: bool = False
    use_for_sampling: bool = False

    def __post_init__(self):
        if self.type not in TYPES:
            raise ValueError(f"column {self.name}: unknown type {self.type}")


@dataclass(frozen=True)
class Feature:
    name: str
    belongs_to: str
    type: str = "embedding_lookup"
    convert_to_string: bool = False
    split_by_space: bool = False
    seq_len: int | None = None
    convert_to_int_after_split: bool = False
    hash: bool = False
    vocab_size: int | None = None
    vocab_path: str | None = None
    num_oov_buckets: int | None = None
    reuse_vocab: str | None = None
    reuse_embedding: str | None = None
    embedding_dim: int | None = None
    combine_mode: str = "sum"

    def __post_init__(self):
        problems = {
            "type must be embedding_lookup or dense": self.type not in ("embedding_lookup", "dense"),
            "embedding_lookup needs embedding_dim or reuse_embedding": self.type == "embedding_lookup"
            and not (self.embedding_dim or self.reuse_embedding),
            "hash needs vocab_size": self.hash and not self.vocab_size,
            "vocab_path needs vocab_size and num_oov_buckets": bool(self.vocab_path)
            and not (self.vocab_size and self.num_oov_buckets),
            "split_by_space needs seq_len": self.split_by_space and not self.seq_len,
        }
        for problem, found in problems.items():
            if found:
                raise ValueError(f"feature {self.name}: {problem}")

    @property
    def vocabulary(self) -> str:
        return self.reuse_vocab or self.name


@dataclass(frozen=True)
class Config:
    format: str
    label: str
    columns: tuple[InputColumn, ...]
    features: tuple[Feature, ...]
    settings: Mapping[str, Any] = field(default_factory=dict)

    @staticmethod
    def parse(doc: Mapping[str, Any]) -> Config:
        if doc["format"] not in FORMATS:
            raise ValueError(f"format must be one of {FORMATS}, not {doc['format']}")
        known = set(Feature.__dataclass_fields__)
        features = tuple(
            Feature(name, **{k: v for k, v in spec.items() if k in known})
            for name, spec in doc["model"]["features"].items()
        )
        columns = tuple(InputColumn(name, **spec) for name, spec in doc["dataset_features"].items())
        rest = {k: v for k, v in doc.items() if k not in ("format", "label", "dataset_features")}
        return Config(doc["format"], doc["label"], columns, features, rest)

    @staticmethod
    def load(path: str) -> Config:
        import yaml

        with open(path) as text:
            return Config.parse(yaml.safe_load(text))

    @property
    def sampling_column(self) -> str:
        """The one column whose hash deals rows to parts."""
        marked = [c.name for c in self.columns if c.use_for_sampling]
        if len(marked) != 1:
            raise ValueError(f"one column must be marked use_for_sampling, not {len(marked)}")
        return marked[0]

    @property
    def schema(self) -> str:
        return ", ".join(f"`{c.name}` {TYPES[c.type]}" for c in self.columns)


def read_input(
    spark: SparkSession, config: Config, path: str, where: str | None = None, part: tuple[int, int] | None = None
) -> DataFrame:
    """The configured columns; CSV is positional and its missing fields get the type's default.

    With ``part`` (index, parts) only rows whose value in the column marked ``use_for_sampling`` hashes to that part; the
    parts share out the rows.
    """
    if config.format == "csv":
        rows = spark.read.schema(config.schema).option("mode", "FAILFAST").csv(path)
        rows = rows.select(*[F.coalesce(c.name, F.lit(DEFAULTS[c.type])).alias(c.name) for c in config.columns])
    else:
        rows = spark.read.parquet(path) if config.format == "parquet" else spark.table(path)
        if where:
            rows = rows.where(where)
        rows = rows.select(*[F.col(c.name).cast(TYPES[c.type]).alias(c.name) for c in config.columns])
    return rows.where(shard(F.col(config.sampling_column), *part)) if part else rows


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(token, index) from headless CSV files, gzip included."""
    return spark.read.schema("token BIGINT, index BIGINT").option("mode", "FAILFAST").csv(path)


@dataclass(frozen=True)
class StoredVocabularies:
    """Vocabularies in one table (voc, token, index), bucketed and sorted by voc and token; voc numbers ``names``."""

    names: tuple[str, ...]
    table: DataFrame


def store_vocabularies(spark: SparkSession, config: Config, table: str, path: str, buckets: int | None = None) -> StoredVocabularies:
    """The files that the features' ``vocab_path`` name, as one catalog table below ``path``, for any number of jobs.

    A token that a vocabulary holds more than once has its smallest index. A join to the table shuffles only the
    tokens looked up, if ``buckets`` is not below the session's shuffle partitions, which it is set to by default.
    """
    paths = {f.name: f.vocab_path for f in config.features if f.vocab_path}
    names = tuple(sorted(paths))
    rows = spark.createDataFrame([], "voc INT, token BIGINT, index BIGINT")
    for number, name in enumerate(names):
        part = read_vocabulary(spark, paths[name]).dropna(subset=["token"])
        rows = rows.unionByName(part.select(F.lit(number).alias("voc"), "token", "index"))
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = rows.groupBy("voc", "token").agg(F.min("index").alias("index")).repartition(count, "voc", "token")
    written = least.write.mode("overwrite").format("parquet").option("path", path).bucketBy(count, "voc", "token")
    written.sortBy("voc", "token").saveAsTable(table)
    return StoredVocabularies(names, spark.table(table))


def _prepared(feature: Feature, keep: str) -> tuple[Column, bool]:
    """The feature before padding and lookup, and whether it is a sequence."""
    value = F.col(feature.name)
    if feature.convert_to_string:
        value = value.cast("string")
    steps = []
    if feature.convert_to_int_after_split:
        steps.append(lambda t: t.cast("bigint"))
    if feature.hash:
        steps.append(lambda t: hash_bucket(t, feature.vocab_size))
    if not feature.split_by_space:
        for step in steps:
            value = step(value)
        return value, False
    tokens = sequence_tokens(value, feature.seq_len, keep)
    for step in steps:
        tokens = F.transform(tokens, step)
    return tokens, True


def _filler(feature: Feature) -> Column:
    value = F.lit(PAD)
    if feature.convert_to_int_after_split:
        value = value.cast("bigint")
    return hash_bucket(value, feature.vocab_size) if feature.hash else value


def out_of_vocabulary(token: Column, vocab_size: int, buckets: int) -> Column:
    """Index of an unknown token: one of ``buckets`` numbers behind the vocabulary."""
    return F.lit(vocab_size).cast("bigint") + hash_bucket(token, buckets)


def _united(vocabularies: Mapping[str, DataFrame]) -> StoredVocabularies:
    """Vocabularies at hand in the shape of stored ones."""
    names, united = tuple(sorted(vocabularies)), None
    for v, name in enumerate(names):
        part = vocabularies[name].select(F.lit(v).alias("voc"), F.col("token").cast("bigint").alias("token"), "index")
        part = part.groupBy("voc", "token").agg(F.min("index").alias("index"))
        united = part if united is None else united.unionByName(part)
    return StoredVocabularies(names, united)


def transform_features(
    rows: DataFrame,
    config: Config,
    vocabularies: Mapping[str, DataFrame] | StoredVocabularies,
    row_id: str,
    keep: str = "oldest",
) -> DataFrame:
    """(row_id, features, kept columns, label) as the config asks.

    All vocabulary lookups, scalar and sequence alike, share one join and one
    regrouping by row. Padding is looked up once per vocabulary, not per row, so
    the filler token does not become a hot join key. The join carries no broadcast
    hint: a vocabulary can hold millions of ids. A null sequence is all padding; a token
    that a vocabulary holds more than once has its smallest index.
    """
    sizes = {f.name: (f.vocab_size, f.num_oov_buckets) for f in config.features}
    known = vocabularies.names if isinstance(vocabularies, StoredVocabularies) else tuple(vocabularies)
    looked_up = [f for f in config.features if f.vocabulary in known]
    if not isinstance(vocabularies, StoredVocabularies):
        vocabularies = _united({f.vocabulary: vocabularies[f.vocabulary] for f in looked_up})
    used = vocabularies.names
    taken = {row_id, *(f.name for f in config.features)}
    kept = [c.name for c in config.columns if c.keep and c.name not in taken]

    columns, sequences = [], set()
    for f in config.features:
        value, is_sequence = _prepared(f, keep)
        if is_sequence:
            sequences.add(f.name)
            value = value if f in looked_up else pad(value, f.seq_len, _filler(f))
        columns.append(value.alias(f.name))
    base = rows.select(row_id, *columns, *kept, F.col(config.label).alias("label"))
    if not looked_up:
        return base

    # a row travels as its tokens plus one entry that carries everything else, so it is computed once
    rest = [c for c in base.columns if c != row_id and c not in {f.name for f in looked_up}]
    payload = f"struct({', '.join(f'`{c}`' for c in rest)})"
    blank = f"IF(true, NULL, {payload})"
    entries = [
        f"array(struct(-1 AS feature, -1 AS voc, -1 AS pos, xxhash64(`{row_id}`) AS token, {payload} AS rest))"
    ]
    for i, f in enumerate(looked_up):
        voc = used.index(f.vocabulary)
        col = f"`{f.name}`" if f.name in sequences else f"array(`{f.name}`)"
        entry = f"struct({i} AS feature, {voc} AS voc, p AS pos, CAST(t AS BIGINT) AS token, {blank} AS rest)"
        entries.append(f"coalesce(transform({col}, (t, p) -> {entry}), array())")
    long = base.selectExpr(f"`{row_id}`", f"inline(concat({', '.join(entries)}))")
    def unknown(token: Column, voc: Column) -> Column:
        out = F.lit(None).cast("bigint")
        for v, name in enumerate(used):
            if name in sizes and all(sizes[name]):
                out = F.when(voc == v, out_of_vocabulary(token, *sizes[name])).otherwise(out)
        return out

    indexed = long.join(vocabularies.table, ["voc", "token"], "left").select(
        row_id, "feature", "pos", "rest", F.coalesce("index", unknown(F.col("token"), F.col("voc"))).alias("index")
    )
    cells = [F.first("rest", ignorenulls=True).alias("_rest")]
    for i, f in enumerate(looked_up):
        if f.name in sequences:
            cell = f"sort_array(collect_list(CASE WHEN feature = {i} THEN struct(pos, index) END)).index"
        else:
            cell = f"max(CASE WHEN feature = {i} THEN index END)"
        cells.append(F.expr(f"{cell} AS `{f.name}`"))
    found = indexed.groupBy(row_id).agg(*cells)
    for f in looked_up:
        if f.name in sequences:
            filler = _filler(f).cast("bigint")
            held = vocabularies.table.where((F.col("voc") == used.index(f.vocabulary)) & (F.col("token") == filler))
            padding = F.coalesce(held.agg(F.min("index")).scalar(), out_of_vocabulary(filler, *sizes[f.vocabulary]))
            found = found.withColumn(f.name, pad(F.col(f.name), f.seq_len, padding))
    return found.select("*", "_rest.*").select(row_id, *[f.name for f in config.features], *kept, "label")
