"""Replacement that readers never see half done.

A dataset is a folder with `data/<version>` folders and a `current` log. Replacing writes a new version
beside the old ones, reads it back, checks it, and only then adds one entry to the log: one small
file that Spark's own commit makes visible at once. Readers take the last entry, so they see the old
rows or the new ones; a job that fails on the way leaves the old rows, and a dataset may be
computed from itself. One writer at a time."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG = "seq long, version string, fmt string, row_count long, fields string"


class RefusedVersion(ValueError):
    """A written version failed its checks; the dataset still is what it was."""


def _fields(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The log of a dataset: (seq, version, fmt, row_count, fields)."""
    try:
        return spark.read.schema(_LOG).json(f"{path}/current")
    except AnalysisException:  # nothing has been published
        return spark.createDataFrame([], _LOG)


def _last(spark: SparkSession, path: str):
    return versions(spark, path).orderBy(F.desc("seq")).first()


def _write_checked(df: DataFrame, folder: str, fmt: str, min_rows: int, fields: str | None,
                   partition_by: Sequence[str] | None) -> tuple[int, str]:
    """Write `df` to a new folder and check what can be read back: as many rows as went in, at least
    `min_rows`, and the wanted names and types."""
    seen = Observation()
    w = df.observe(seen, F.count(F.lit(1)).alias("n")).write.format(fmt)
    (w.partitionBy(*partition_by) if partition_by else w).save(folder)
    spark = df.sparkSession
    back = spark.read.format(fmt).schema(df.schema).load(folder)
    rows, sent, have = back.count(), seen.get["n"], _fields(df.schema)
    if rows != sent:
        raise RefusedVersion(f"{rows} rows read back of {sent} written")
    if rows < min_rows:
        raise RefusedVersion(f"{rows} rows, at least {min_rows} wanted")
    if fields is not None and have != fields:
        raise RefusedVersion(f"columns are ({have}), wanted ({fields})")
    return rows, have


def publish(df: DataFrame, path: str, fmt: str = "parquet", min_rows: int = 1, same_fields: bool = True,
            partition_by: Sequence[str] | None = None) -> int:
    """Replace the dataset at `path` by `df`; returns the new version's number. With `same_fields` the
    columns must be those of the version before (the first one may have any)."""
    spark = df.sparkSession
    last = _last(spark, path)
    version = uuid.uuid4().hex
    rows, fields = _write_checked(df, f"{path}/data/{version}", fmt, min_rows,
                                  last["fields"] if last and same_fields else None, partition_by)
    seq = (last["seq"] if last else 0) + 1
    spark.createDataFrame([(seq, version, fmt, rows, fields)], _LOG).coalesce(1).write.mode("append").json(f"{path}/current")
    return seq


def current(spark: SparkSession, path: str, seq: int | None = None) -> DataFrame:
    """The published dataset: its last version, or the version `seq`."""
    log = versions(spark, path)
    entry = (log.where(F.col("seq") == seq) if seq is not None else log).orderBy(F.desc("seq")).first()
    if entry is None:
        raise FileNotFoundError(f"no published version at {path}")
    return spark.read.format(entry["fmt"]).schema(entry["fields"]).load(f"{path}/data/{entry['version']}")


def publish_table(df: DataFrame, name: str, fmt: str = "parquet", min_rows: int = 1, same_fields: bool = True) -> None:
    """Replace a catalog table (B3): the new rows are written and checked in a folder of their own, then
    the table is pointed at it, one entry of the catalog. `df` may read the table it replaces."""
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    folder = f"{root}/_versions/{name.replace('.', '/')}/{uuid.uuid4().hex}"
    _write_checked(df, folder, fmt, min_rows, _fields(spark.table(name).schema) if exists and same_fields else None, None)
    if exists and _fields(spark.table(name).schema) == _fields(df.schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} LOCATION '{folder}'")
