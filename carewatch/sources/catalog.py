"""One catalog of dataset name -> path and format (trap T31: a dataset is always read
with the format it was written in)."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


@dataclass(frozen=True)
class Dataset:
    name: str
    path: str
    fmt: str = "parquet"


class Catalog:
    def __init__(self, root: str, entries: dict[str, Dataset] | None = None):
        self.root = root
        self.entries = dict(entries or {})

    def register(self, name: str, rel_path: str, fmt: str = "parquet") -> Dataset:
        d = Dataset(name, os.path.join(self.root, rel_path), fmt)
        self.entries[name] = d
        return d

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        d = self.entries[name]
        if d.fmt == "csv":
            from .readers import read_text_table
            return read_text_table(spark, d.path)
        return spark.read.format(d.fmt).load(d.path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver test table (`{sf_dir}/{name}.parquet`)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def test_catalog(sf_dir: str) -> Catalog:
    c = Catalog(sf_dir)
    for t in TEST_TABLES:
        c.register(t, f"{t}.parquet")
    return c
