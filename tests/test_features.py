"""The config, the feature pipeline and embeddings."""

from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import vectors as V
from tidemark.operators import embeddings as E
from tidemark.operators.features import Config, Feature, read_input, transform_features
from tidemark.sources import writers

DOC = """
format: csv
label: label
epochs: 5
dataset_features:
    pp: {type: str}
    host: {type: int}
    member: {type: int, keep: true}
    label: {type: int}
    history: {type: str}
model:
    learning_rate: 0.001
    features:
        host: {type: embedding_lookup, vocab_size: 3, num_oov_buckets: 1, embedding_dim: 16, belongs_to: post, vocab_path: "x"}
        history: {seq_len: 4, split_by_space: true, convert_to_int_after_split: true, belongs_to: user,
                  reuse_vocab: host, reuse_embedding: host}
"""


def config() -> Config:
    import yaml

    return Config.parse(yaml.safe_load(DOC))


def test_config_from_file(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text(DOC)
    got = Config.load(str(path))
    assert got.schema == "`pp` string, `host` bigint, `member` bigint, `label` bigint, `history` string"
    assert got.features[1].vocabulary == "host"
    assert got.settings["epochs"] == 5


@pytest.mark.parametrize(
    "spec",
    [
        {"type": "sparse"},
        {"type": "embedding_lookup"},
        {"embedding_dim": 4, "hash": True},
        {"embedding_dim": 4, "vocab_path": "x"},
        {"embedding_dim": 4, "split_by_space": True},
    ],
)
def test_config_errors(spec):
    with pytest.raises(ValueError):
        Feature("f", "user", **spec)


def test_unknown_format():
    with pytest.raises(ValueError):
        Config.parse({"format": "xml", "label": "y", "dataset_features": {}, "model": {"features": {}}})


def test_pipeline(spark):
    rows = spark.createDataFrame(
        [("p", 10, 1, 1, "20 99 10"), ("p", 55, 2, 0, ""), ("p", 30, 3, 1, "10 20 30 10 20")],
        "pp STRING, host BIGINT, member BIGINT, label BIGINT, history STRING",
    ).withColumn("row", F.col("member"))
    vocabulary = spark.createDataFrame([(10, 0), (20, 1), (30, 2)], "token BIGINT, index BIGINT")
    out = transform_features(rows, config(), {"host": vocabulary}, "row")
    assert out.columns == ["row", "host", "history", "member", "label"]
    got = {r["row"]: (r["host"], r["history"], r["member"], r["label"]) for r in out.collect()}
    assert got == {
        1: (0, [1, 3, 0, 3], 1, 1),  # 99 and the filler 0 are unknown: the one bucket behind the vocabulary
        2: (3, [3, 3, 3, 3], 2, 0),
        3: (2, [0, 1, 2, 0], 3, 1),
    }
    newest = transform_features(rows, config(), {"host": vocabulary}, "row", keep="newest")
    assert newest.where("row = 3").first()["history"] == [1, 2, 0, 1]


def test_known_filler(spark):
    rows = spark.createDataFrame([("p", 0, 1, 1, "0")], "pp STRING, host BIGINT, member BIGINT, label BIGINT, history STRING")
    vocabulary = spark.createDataFrame([(0, 7)], "token BIGINT, index BIGINT")
    got = transform_features(rows, config(), {"host": vocabulary}, "member").first()
    assert (got["host"], got["history"]) == (7, [7, 7, 7, 7])


def test_without_vocabulary_tokens_stay(spark):
    rows = spark.createDataFrame([("p", 5, 1, 1, "8 9")], "pp STRING, host BIGINT, member BIGINT, label BIGINT, history STRING")
    got = transform_features(rows, config(), {}, "member").first()
    assert (got["host"], got["history"]) == (5, [8, 9, 0, 0])


def test_csv_defaults(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = spark.createDataFrame([("a", None, 1, None, None)], "pp STRING, host INT, member INT, label INT, history STRING")
    writers.csv(rows, path)
    assert tuple(read_input(spark, config(), path).first()) == ("a", 0, 1, 0, "")


def test_vectors(spark):
    nan = float("nan")
    rows = spark.createDataFrame(
        [("[1.0, 2.0]", [1.0, nan]), ("", [3.0, 4.0]), (None, None)], "text STRING, v ARRAY<DOUBLE>"
    )
    got = [
        (r["p"], r["z"])
        for r in rows.select(V.parse_vector(F.col("text"), 2).alias("p"), V.or_zeros(F.col("v"), 2).alias("z")).collect()
    ]
    assert got == [([1.0, 2.0], [0.0, 0.0]), ([0.0, 0.0], [3.0, 4.0]), ([0.0, 0.0], [0.0, 0.0])]
    two = spark.createDataFrame([([1.0, 2.0], [3.0, 0.5])], "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>")
    assert two.select(V.dot(F.col("a"), F.col("b"))).first()[0] == 4.0
    affinity = two.select(V.affinity(F.col("a"), F.col("b"), F.lit(-3.0), F.lit(0.5))).first()[0]
    assert affinity == pytest.approx(1 / (1 + math.exp(-1.5)))


def test_join_embeddings_does_not_multiply_rows(spark):
    rows = spark.createDataFrame([(1, 5), (2, 6), (3, 5)], "id INT, user INT")
    table = spark.createDataFrame([(5, [1.0], 1), (5, [2.0], 2)], "uid INT, v ARRAY<DOUBLE>, version INT")
    latest = E.latest_per_id(table, "uid", "version")
    out = E.join_embeddings(rows, latest, row_key="user", key="uid", vector="v", dim=1, name="u")
    assert {r["id"]: r["u"] for r in out.collect()} == {1: [2.0], 2: [0.0], 3: [2.0]}


def test_pooling_and_refresh(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0]), (2, [10.0, 20.0])], "k INT, v ARRAY<DOUBLE>")
    rows = spark.createDataFrame([("a", [1, 1, 2, 9]), ("b", [])], "id STRING, seq ARRAY<INT>")
    pooled = E.pool_sequence(rows, table, row_id="id", sequence="seq", key="k", vector="v", dim=2, name="p")
    assert {r["id"]: r["p"] for r in pooled.collect()} == {"a": [12.0, 24.0], "b": [0.0, 0.0]}
    new = spark.createDataFrame([(2, [5.0, 5.0]), (3, [7.0, 7.0])], "k INT, v ARRAY<DOUBLE>")
    got = {r["k"]: r["v"] for r in E.refresh_factors(table, new, "k", "v").collect()}
    assert got == {1: [1.0, 2.0], 2: [5.0, 5.0], 3: [7.0, 7.0]}


def test_pooling_in_parts(spark, monkeypatch):
    """A frequent id, a frequent row id, and no row id at all: no shuffle of sums but of crowded row ids, more parts for more rows."""
    held = {i: [float(i), i / 8] for i in range(40)}
    table = [(i, v) for i, v in held.items()] + [(7, [0.5, None]), (8, None), (None, [9.0, 9.0])]
    embeddings = spark.createDataFrame(table, "k INT, v ARRAY<FLOAT>")
    held[7] = [7.5, 7 / 8]
    rows = [(i, [0, *(j % 50 for j in range(i, i + i % 5)), 0, 7]) for i in range(400)] + [(5, None), (6, []), (None, [3]), (None, [3, None])]
    crowd = [(1, [j % 50] * 3) for j in range(3000)] + [(None, [1, 2])] * 2000
    schema = "id INT, seq ARRAY<INT>"
    for found, size in ((rows, 64), (rows + crowd, 64), (rows + crowd, 10**6)):
        monkeypatch.setattr(E, "ITEMS_PER_PART", size)
        want = {}
        for r, seq in found:
            total = want.setdefault(r, [0.0, 0.0])
            for x in seq or []:
                total[:] = [a + b for a, b in zip(total, held.get(x, [0.0, 0.0]))]
        frame = spark.createDataFrame(found, schema).repartition(3)
        pooled = E.pool_sequence(frame, embeddings, row_id="id", sequence="seq", key="k", vector="v", dim=2, name="p")
        got = pooled.collect()
        assert pooled.columns == ["id", "p"] and len(got) == len(want)
        assert {r["id"]: r["p"] for r in got} == {r: pytest.approx(v) for r, v in want.items()}
        plan = pooled._jdf.queryExecution().executedPlan().toString().splitlines()
        sums = [line for line in plan if "hashpartitioning(_row" in line and "ENSURE_REQUIREMENTS" in line]
        assert bool(sums) == (len(found) > len(rows) and size == 64)
        parts = [int(n) for n in re.findall(r"hashpartitioning\(_row\S* (\d+)\), REPARTITION_BY_NUM", "\n".join(plan))]
        assert parts and (size > 64 or max(parts) > 8)


def test_stored_vocabularies_are_joined_without_a_shuffle_of_them(spark, tmp_path):
    from tidemark.operators.features import store_vocabularies

    spark.range(50).selectExpr("id AS token", "49 - id AS index").write.csv(str(tmp_path / "v"), compression="gzip")
    spark.range(50).selectExpr("id AS token", "100 + id AS index").write.csv(str(tmp_path / "v"), compression="gzip", mode="append")
    feature = {"vocab_path": str(tmp_path / "v"), "vocab_size": 50, "num_oov_buckets": 2, "embedding_dim": 4, "belongs_to": "x"}
    own = Config.parse(
        {
            "format": "parquet",
            "label": "label",
            "dataset_features": {"id": {"type": "int"}, "a": {"type": "int"}, "label": {"type": "int"}},
            "model": {"features": {"a": feature}},
        }
    )
    stored = store_vocabularies(spark, own, "stored_vocabulary", str(tmp_path / "stored"))
    rows = spark.range(100).selectExpr("id", "id % 60 AS a", "1 AS label")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = transform_features(rows, own, stored, "id")
        got = {r["id"]: r["a"] for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all(got[i] == 49 - i % 60 if i % 60 < 50 else got[i] >= 50 for i in got) and len(got) == 100
    lines = plan.splitlines()
    indent = [len(line) - len(line.lstrip(" :+-*")) for line in lines]

    def above(i):
        """The operators over line ``i`` up to the next join."""
        found, depth = [], indent[i]
        for j in range(i - 1, -1, -1):
            if indent[j] < depth:
                found.append(lines[j])
                depth = indent[j]
                if "Join" in lines[j]:
                    break
        return found

    scans = [above(i) for i, line in enumerate(lines) if "stored_vocabulary" in line]
    joined = [chain for chain in scans if chain and "Join" in chain[-1]]
    assert joined and not any("Exchange" in line for chain in joined for line in chain)
    spark.sql("DROP TABLE stored_vocabulary")


def test_parts_share_out_the_rows(spark, tmp_path):
    spark.range(300).selectExpr("id", "id % 40 AS u", "1 AS label").write.parquet(str(tmp_path / "rows"))
    doc = {
        "format": "parquet",
        "label": "label",
        "dataset_features": {"id": {"type": "int"}, "u": {"type": "int", "use_for_sampling": True}, "label": {"type": "int"}},
        "model": {"features": {}},
    }
    parts = [{tuple(r)[:2] for r in read_input(spark, Config.parse(doc), str(tmp_path / "rows"), part=(i, 3)).collect()} for i in range(3)]
    assert sum(map(len, parts)) == len(set.union(*parts)) == 300
    assert not {u for _, u in parts[0]} & {u for _, u in parts[1]}
    doc["dataset_features"]["id"]["use_for_sampling"] = True
    with pytest.raises(ValueError, match="use_for_sampling"):
        read_input(spark, Config.parse(doc), str(tmp_path / "rows"), part=(0, 3))
