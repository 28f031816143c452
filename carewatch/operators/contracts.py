"""Declared column contracts and schema conformance.

Name resolution happens at plan-construction time on `df.columns` (metadata only); the
result is one `select`, so every column not in the contract is pruned from the scan.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import num


@dataclass
class Field:
    """One contract column. `candidates` are either exact names or, with `match="substr"`,
    lists of case-insensitive substrings that must all appear in the source name
    (first matching source column in order wins); `exclude` substrings disqualify.
    `parse` = "text" | "number" | "int" | "bool_yn" | "date"."""
    out: str
    candidates: Sequence = field(default_factory=list)
    match: str = "exact"
    exclude: Sequence[str] = field(default_factory=list)
    required: bool = False
    parse: str = "text"
    sentinels: Sequence[str] | None = None


def _matches(name: str, cand, match: str, exclude: Sequence[str]) -> bool:
    low = name.lower()
    if any(e.lower() in low for e in exclude):
        return False
    if match == "exact":
        return name == cand
    if match == "ci":
        return low == str(cand).lower()
    subs = [cand] if isinstance(cand, str) else list(cand)
    return all(s.lower() in low for s in subs)


def find_column(columns: Sequence[str], f: Field) -> str | None:
    """Resolve one field against the source columns; candidates are tried in order."""
    for cand in f.candidates:
        for c in columns:
            if _matches(c, cand, f.match, f.exclude):
                return c
    return None


def _parsed(col: Column, f: Field) -> Column:
    if f.parse == "number":
        return num(col, **({"sentinels": f.sentinels} if f.sentinels is not None else {}))
    if f.parse == "int":
        return num(col, **({"sentinels": f.sentinels} if f.sentinels is not None else {})).cast("long")
    if f.parse == "bool_yn":
        s = F.upper(F.trim(col.cast("string")))
        return F.when(s.isin("Y", "YES", "TRUE", "1"), True).when(s.isin("N", "NO", "FALSE", "0"), False)
    if f.parse == "date":
        s = F.trim(col.cast("string"))
        return F.when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"),
                      F.try_to_timestamp(F.substring(s, 1, 10), F.lit("yyyy-MM-dd")).cast("date"))
    s = F.regexp_replace(col.cast("string"), r"^\s+|\s+$", "")
    if f.sentinels is not None:
        s = F.when(s.isin(list(f.sentinels)), F.lit(None).cast("string")).otherwise(s)
    return s


_TYPES = {"text": T.StringType(), "number": T.DoubleType(), "int": T.LongType(),
          "bool_yn": T.BooleanType(), "date": T.DateType()}


def resolve_columns(df: DataFrame, contract: Sequence[Field]) -> tuple[DataFrame, DataFrame]:
    """Apply a contract (C1): returns the conformed DataFrame and a mapping report
    `(field, source_column, status)` with status bound / missing_optional. A missing
    required field raises. Missing optional fields become typed NULL columns."""
    cols, report = [], []
    for f in contract:
        src = find_column(df.columns, f)
        if src is None:
            if f.required:
                raise KeyError(f"required field {f.out!r} not found; candidates {list(f.candidates)}")
            cols.append(F.lit(None).cast(_TYPES[f.parse]).alias(f.out))
            report.append((f.out, None, "missing_optional"))
        else:
            cols.append(_parsed(F.col(f"`{src}`"), f).alias(f.out))
            report.append((f.out, src, "bound"))
    schema = "field string, source_column string, status string"
    return df.select(*cols), df.sparkSession.createDataFrame(report, schema)


def rename_map(df: DataFrame, mapping: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """Rename by map (C2). A value may list several source spellings of one output; the
    first present spelling wins."""
    out = df
    for dst, srcs in ((d, s) for d, s in _invert(mapping).items()):
        present = [s for s in srcs if s in out.columns]
        if not present:
            continue
        if len(present) == 1:
            out = out.withColumnRenamed(present[0], dst)
        else:
            out = out.withColumn(dst, F.coalesce(*[F.col(f"`{p}`") for p in present])).drop(
                *[p for p in present if p != dst])
    return out


def _invert(mapping: Mapping[str, str | Sequence[str]]) -> dict[str, list[str]]:
    inv: dict[str, list[str]] = {}
    for src, dst in mapping.items():
        if isinstance(dst, str):
            inv.setdefault(dst, []).append(src)
        else:  # {dst: [spellings]} form
            inv.setdefault(src, []).extend(dst)
    return inv


def present_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The listed columns that exist, in the listed order."""
    return [c for c in cols if c in df.columns]


def select_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    return df.select(*[F.col(f"`{c}`") for c in cols if c in df.columns])


def align(df: DataFrame, schema: Sequence[tuple[str, str]]) -> DataFrame:
    """Pad missing columns with typed NULLs and order them as declared (C4)."""
    return df.select(*[(F.col(f"`{n}`").cast(t) if n in df.columns else F.lit(None).cast(t)).alias(n)
                       for n, t in schema])


def drop_helpers(df: DataFrame, prefix: str = "_") -> DataFrame:
    """Drop helper columns."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def normalize_name(name: str) -> str:
    s = name.strip().strip("\"'").strip().lower()
    s = re.sub(r"[^0-9a-z]+", "_", s)
    return s.strip("_")


def normalize_headers(df: DataFrame) -> DataFrame:
    """Lower-case, underscore, quote-free column names."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def schema_diff(df: DataFrame, expected: Sequence[str], computed: Sequence[str] = ()) -> DataFrame:
    """Expected-vs-actual column report (C7): rows (field, status) with status
    present / missing / unexpected; `computed` fields are never 'unexpected'."""
    actual = list(df.columns)
    rows = [(c, "present") for c in expected if c in actual]
    rows += [(c, "missing") for c in expected if c not in actual]
    rows += [(c, "unexpected") for c in actual if c not in expected and c not in computed]
    return df.sparkSession.createDataFrame(rows, "field string, status string")


def stamp(df: DataFrame, **values) -> DataFrame:
    """Constant / provenance columns (C8). Dates are passed in (`as_of`), never read from
    the clock."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def unpivot_metrics(df: DataFrame, metrics: Mapping[str, Sequence[str]], id_cols: Sequence[str] = ()
                    ) -> DataFrame:
    """Wide one-row file to named metrics (C9): a column feeds metric m when its lower-case
    name contains all words of m; the first such column wins. Values are parsed with the
    strict number parser; NULLs dropped. Rows: (*id_cols, metric, value)."""
    pairs = []
    for m, words in metrics.items():
        for c in df.columns:
            if all(w.lower() in c.lower() for w in words):
                pairs.append((m, c))
                break
    if not pairs:
        return df.sparkSession.createDataFrame([], "metric string, value double")
    stack = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), num(F.col(f"`{c}`")).alias("value"))
                                for m, c in pairs])).alias("_m")
    return (df.select(*id_cols, stack).select(*id_cols, "_m.metric", "_m.value")
            .where(F.col("value").isNotNull()))
