"""Row predicates (D1-D8). Filters are plain `where` clauses so Catalyst can push the
parts that touch raw columns down to the Parquet scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .expr import ColumnOrName, _all, _any, _c, clean, is_present, num


def where_in(df: DataFrame, col: str, codes: Sequence, active: Column | None = None,
             normalize: bool = True) -> DataFrame:
    """Rows whose code is in a list, optionally also `active`.

    Codes are compared upper-cased and trimmed (T17), which a scan cannot test; with
    `normalize=False` (columns cleaned when they were landed) the list is an `IN` predicate on
    the raw column and reaches the scan. Codes that live in a table belong in a semi join."""
    key = clean(col, case="upper") if normalize else _c(col)
    codes = [str(c).strip().upper() for c in codes] if normalize else list(codes)
    out = df.where(active) if active is not None else df
    return out.where(key.isin(codes))


def present(*cols: ColumnOrName) -> Column:
    """All listed columns non-NULL and non-blank after trimming."""
    return _all(_c(c).isNotNull() & is_present(c) for c in cols)


def where_present(df: DataFrame, *cols: ColumnOrName) -> DataFrame:
    return df.where(present(*cols))


def scope_eq(col: ColumnOrName, value: str) -> Column:
    return clean(col, case="upper") == str(value).strip().upper()


def available_values(df: DataFrame, col: str) -> DataFrame:
    """All values a scope filter on `col` can take, cleaned, in order (D3)."""
    return df.select(clean(col, case="upper").alias(col)).where(F.col(col).isNotNull()).distinct().orderBy(col)


def where_scope(df: DataFrame, col: str, value: str | None, check: bool = False) -> DataFrame:
    """One-scope filter (D3). With `check=True`, an empty result raises an error; the probe
    reads one row only, and `available_values` lists what there is."""
    if value is None:
        return df
    out = df.where(scope_eq(col, value))
    if check and not out.limit(1).count():
        raise ValueError(f"No rows for {col}={value!r}; see available_values(df, {col!r})")
    return out


def has_prefix(col: ColumnOrName, prefixes: Sequence[str], null_matches: bool = False,
               case_insensitive: bool = False) -> Column:
    """Starts with any prefix; NULL input -> `null_matches`."""
    c = _c(col).cast("string")
    if case_insensitive:
        c = F.upper(c)
        prefixes = [p.upper() for p in prefixes]
    return F.coalesce(_any(c.startswith(p) for p in prefixes), F.lit(null_matches))


def where_prefix(df: DataFrame, col: str, prefixes: Sequence[str], negate: bool = False,
                 null_matches: bool = False) -> DataFrame:
    cond = has_prefix(col, prefixes, null_matches)
    return df.where(~cond if negate else cond)


def zero_or_null(col: ColumnOrName) -> Column:
    """NULL or exactly zero, never NULL itself."""
    c = _c(col)
    return c.isNull() | F.coalesce(c == 0, F.lit(False))


def where_rankable(df: DataFrame, exclude_flag: str, require: str) -> DataFrame:
    """Drop flagged rows and rows with no denominator, keep small-denominator rows."""
    return df.where((F.coalesce(_c(exclude_flag).cast("int"), F.lit(0)) == 0) & _c(require).isNotNull())


_OPS = {">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__", "==": "__eq__", "!=": "__ne__"}


def num_cmp(col: ColumnOrName, op: str, x: float) -> Column:
    """Numeric comparison on a text column through the strict parser."""
    return F.coalesce(getattr(num(col), _OPS[op])(F.lit(float(x))), F.lit(False))


def where_num(df: DataFrame, col: str, op: str, x: float) -> DataFrame:
    return df.where(num_cmp(col, op, x))


def matches(col: ColumnOrName, pattern: str) -> Column:
    """Full-pattern regex test, NULL -> False."""
    return F.coalesce(_c(col).cast("string").rlike(pattern), F.lit(False))


def where_matches(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.where(matches(col, pattern))
