"""Set logic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .contracts import align, rename_map


def union_sources(sources: Sequence[tuple[DataFrame, str]], schema: Sequence[tuple[str, str]],
                  renames: Mapping[str, Mapping] | None = None, label_col: str = "source") -> DataFrame:
    """Union-all of differently shaped sources into one declared schema, labelled.
    Each source is renamed (C2), aligned (C4) and stamped; `unionByName` adds no shuffle."""
    out = None
    for df, label in sources:
        d = rename_map(df, (renames or {}).get(label, {}))
        d = align(d, schema).withColumn(label_col, F.lit(label))
        out = d if out is None else out.unionByName(d)
    return out


def union_keys(dfs: Sequence[DataFrame], key: str) -> DataFrame:
    """Distinct union of key sets."""
    u = dfs[0].select(key)
    for d in dfs[1:]:
        u = u.unionByName(d.select(key))
    return u.distinct()


def except_keys(a: DataFrame, b: DataFrame, key) -> DataFrame:
    """Rows of `a` whose key is absent from `b`."""
    keys = [key] if isinstance(key, str) else list(key)
    return a.join(b.select(*keys).distinct(), keys, "left_anti")


def except_names(a: Sequence[str], b: Sequence[str]) -> list[str]:
    """Set difference of two name lists, order kept (I3 on field sets)."""
    bs = set(b)
    return [x for x in a if x not in bs]


def required_members(df: DataFrame, col: str, values: Sequence, value_type: str = "string") -> DataFrame:
    """For each required value: is it present in `col`? Rows (value, present) (I4).
    The membership filter is pushed to the scan and at most len(values) keys survive it."""
    spark = df.sparkSession
    req = spark.createDataFrame([(v,) for v in values], f"value {value_type}")
    seen = (df.where(F.col(col).isin(list(values))).select(F.col(col).cast(value_type).alias("value"))
            .distinct().withColumn("_p", F.lit(True)))
    return (req.join(F.broadcast(seen), "value", "left")
            .select("value", F.coalesce(F.col("_p"), F.lit(False)).alias("present")))
