"""Writers. Every path is a folder of part files, one per task."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def text(rows: DataFrame, line: Column, path: str, gzip: bool = False) -> None:
    rows.select(line.alias("value")).write.text(path, compression="gzip" if gzip else "none")


def csv(rows: DataFrame, path: str, header: bool = False, gzip: bool = False, sep: str = ",") -> None:
    rows.write.csv(path, header=header, sep=sep, compression="gzip" if gzip else "none", emptyValue="")


def key_value_line(key: str, value: str | None = None) -> Column:
    """``key<TAB>value``; the key alone where there is no value."""
    return F.concat_ws("\t", F.col(key).cast("string"), *([F.col(value).cast("string")] if value else []))


def word_line(word: str = "word", count: str = "count") -> Column:
    """``word: count``."""
    return F.format_string("%s: %d", F.col(word), F.col(count))


def tab_line(columns: Sequence[str]) -> Column:
    return F.concat_ws("\t", *[F.col(c).cast("string") for c in columns])


def tsv_fixed(rows: DataFrame, path: str, digits: int = 3) -> None:
    """Tab-separated with a header; floating-point columns with a fixed number of digits."""
    out = [
        F.format_string(f"%.{digits}f", F.col(c)).alias(c) if t in ("double", "float") else F.col(c)
        for c, t in rows.dtypes
    ]
    csv(rows.select(*out), path, header=True, sep="\t")


def scored_labels(rows: DataFrame, score: str, path: str, threshold: float = 0.1) -> None:
    """``true|false<TAB>score`` lines, the score with four digits."""
    label = F.when(F.col(score) >= threshold, "true").otherwise("false")
    text(rows, F.format_string("%s\t%.4f", label, F.col(score)), path)


def history_line(columns: Sequence[str], histories: Sequence[str]) -> Column:
    """Comma-separated row; each history is one field of space-joined ids."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.concat_ws(",", *fields, *[F.array_join(F.col(h).cast("array<string>"), " ") for h in histories])


def json_line() -> Column:
    """The whole row as one JSON object."""
    return F.to_json(F.struct("*"))


def append_daily(rows: DataFrame, time: str, path: str) -> None:
    """Append to a table partitioned by day; one task writes each day's slice of its rows."""
    rows.withColumn("date", F.to_date(time)).write.partitionBy("date").mode("append").parquet(path)


def replace_table(rows: DataFrame, name: str, path: str | None = None) -> None:
    """Replace all rows of the catalog table ``name``, which is made if there is none, in folders below ``path``.

    The rows are written to a fresh folder first; then one change of the catalog points the table there. Readers see the old
    rows or the new ones, never a part; a write that fails leaves the table as it was. The folder that is replaced
    stays until the next replacement, for readers that began before. Columns must be those of the table. Without ``path``
    the folders lie beside the table's, or where the catalog puts a table of that name.
    """
    spark = rows.sparkSession
    known = spark.catalog.tableExists(name)
    if known:
        old, new = spark.table(name).schema, rows.schema
        if [(f.name, f.dataType) for f in old] != [(f.name, f.dataType) for f in new]:
            raise ValueError(f"table {name} has the columns {old.simpleString()}, not {new.simpleString()}")
    described = _location(spark, name) if known else None
    root = path or (described.rsplit("/", 1)[0] if described and VERSION in described else f"{described or _default(spark, name)}-versions")
    fresh = f"{root}/{VERSION}{uuid.uuid4().hex}"
    rows.write.mode("errorifexists").parquet(fresh)
    quoted = "`.`".join(name.split("."))
    if known:
        spark.sql(f"ALTER TABLE `{quoted}` SET LOCATION '{fresh}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, fresh, "parquet", rows.schema)
    _keep(spark, root, {fresh, described})


VERSION = "version-"


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{'`.`'.join(name.split('.'))}`")
    return rows.where("col_name = 'Location'").first()["data_type"]


def _default(spark: SparkSession, name: str) -> str:
    database, _, table = name.rpartition(".")
    rows = spark.sql(f"DESCRIBE DATABASE `{database or spark.catalog.currentDatabase()}`").where("info_name = 'Location'")
    return f"{rows.first()['info_value']}/{table}"


def _keep(spark: SparkSession, root: str, folders: set[str | None]) -> None:
    """Delete the versions below ``root`` other than ``folders``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{VERSION}*")
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    kept = {folder.rsplit("/", 1)[-1] for folder in folders if folder}
    for status in system.globStatus(place) or []:
        if status.getPath().getName() not in kept:
            system.delete(status.getPath(), True)


def report(metrics: DataFrame, path: str, **context: str) -> None:
    """A one-row metrics frame with the run's arguments and config as JSON."""
    metrics.withColumns({k: F.lit(v) for k, v in context.items()}).write.json(path)


def vectors_csv(rows: DataFrame, columns: Sequence[str], vector: str, path: str) -> None:
    """CSV with a header; the vector as a JSON list."""
    csv(rows.select(*columns, F.to_json(vector).alias(vector)), path, header=True)
