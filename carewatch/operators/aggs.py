"""Aggregations (F1-F22). All are hash aggregates with partial (map-side) and final
stages; no `collect_list`, no per-group Python."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import ColumnOrName, _c, clean, has_any, round_to
from .ranking import exact_quantiles


def _keys(k) -> list:
    if k is None:
        return []
    return [k] if isinstance(k, (str, Column)) else list(k)


def count_by(df: DataFrame, keys, out: str = "n", order: str | None = "desc") -> DataFrame:
    """Count by group, ordered by count then keys."""
    ks = _keys(keys)
    g = df.groupBy(*ks).agg(F.count(F.lit(1)).alias(out))
    if order == "desc":
        return g.orderBy(F.col(out).desc(), *[F.col(k).asc_nulls_last() for k in ks if isinstance(k, str)])
    if order == "asc":
        return g.orderBy(F.col(out).asc(), *[F.col(k).asc_nulls_last() for k in ks if isinstance(k, str)])
    return g


def distinct_counts(df: DataFrame, cols: Sequence[str], by=None) -> DataFrame:
    """Exact distinct counts (F2)."""
    return df.groupBy(*_keys(by)).agg(*[F.count_distinct(c).alias(f"distinct_{c}") for c in cols])


def bucket_counts(df: DataFrame, keys, buckets: Mapping[str, Column], distinct: Mapping[str, str] | None = None,
                  other: str | None = None) -> DataFrame:
    """Conditional counts in one pass (F3): `count_if(cond)` per bucket, optional exact
    distinct counts, and an `other` count of rows in no bucket (T14)."""
    aggs = [F.count_if(c).alias(n) for n, c in buckets.items()]
    aggs += [F.count_distinct(c).alias(n) for n, c in (distinct or {}).items()]
    if other:
        anyb = None
        for c in buckets.values():
            cc = F.coalesce(c, F.lit(False))
            anyb = cc if anyb is None else (anyb | cc)
        aggs.append(F.count_if(~anyb).alias(other))
    aggs.append(F.count(F.lit(1)).alias("total_rows"))
    return df.groupBy(*_keys(keys)).agg(*aggs)


def rollup_groups(df: DataFrame, keys, count_col: str, sum_cols: Sequence[str]) -> DataFrame:
    """Roll-up of already aggregated rows."""
    return df.groupBy(*_keys(keys)).agg(F.count(count_col).alias(f"n_{count_col}"),
                                        *[F.sum(c).alias(f"sum_{c}") for c in sum_cols])


def weighted_rate(df: DataFrame, keys, num: str, den: str, scale: float = 1.0, digits: int | None = 2,
                  out: str = "rate", mode: str = "half_up") -> DataFrame:
    """Ratio of sums (population-weighted rate, F5): round(sum(n) / nullif(sum(d),0) * k).
    Never the mean of per-row ratios."""
    g = df.groupBy(*_keys(keys)).agg(F.sum(num).alias(f"sum_{num}"), F.sum(den).alias(f"sum_{den}"))
    r = F.col(f"sum_{num}").cast("double") / F.nullif(F.col(f"sum_{den}").cast("double"), F.lit(0.0)) * scale
    return g.withColumn(out, round_to(r, digits, mode) if digits is not None else r)


def rate_of_sums(num: ColumnOrName, den: ColumnOrName, scale: float = 1.0) -> Column:
    """Aggregate expression for F5 inside a larger `agg`."""
    return F.sum(num).cast("double") / F.nullif(F.sum(den).cast("double"), F.lit(0.0)) * scale


def event_rollup(df: DataFrame, key, type_col: str, amount: str, date: str, seq: str,
                 name_col: str | None = None, fine_words=("fine",), denial_words=("denial", "payment"),
                 extra_first: Sequence[str] = ()) -> DataFrame:
    """Per-key event roll-up (F7): total events, fines (type contains 'fine'), the fine
    dollar sum with 0.0 when none (T21), denials (contains 'denial' or 'payment', T22),
    the latest date, and the first row's name by an explicit sequence (T18)."""
    is_fine = has_any(type_col, fine_words)
    is_denial = has_any(type_col, denial_words)
    first = [F.min_by(F.col(c), F.col(seq)).alias(c) for c in ([name_col] if name_col else []) + list(extra_first)]
    return df.groupBy(*_keys(key)).agg(
        *first,
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(is_fine).alias("fine_count"),
        F.coalesce(F.sum(F.when(is_fine, F.col(amount))), F.lit(0.0)).alias("fine_total"),
        F.count_if(is_denial).alias("payment_denial_count"),
        F.max(date).alias("most_recent"))


def any_flags(df: DataFrame, key, flag_cols: Sequence[str], yes: str = "Y", type_col: str | None = None,
              individual: str = "I", name_col: str | None = None, seq: str | None = None,
              suffix: str = "_any") -> DataFrame:
    """'Any row has the flag' per key over Y/N text columns (F8), plus owner counts:
    rows, individuals (type = I) and the last row's name by `seq`."""
    aggs = [F.bool_or(F.coalesce(F.upper(clean(c)) == yes, F.lit(False))).alias(f"{c}{suffix}") for c in flag_cols]
    aggs.append(F.count(F.lit(1)).alias("n_rows"))
    if type_col:
        aggs.append(F.count_if(F.upper(clean(type_col)) == individual).alias("n_individual"))
    if name_col and seq:
        aggs.append(F.max_by(F.col(name_col), F.col(seq)).alias(f"last_{name_col}"))
    return df.groupBy(*_keys(key)).agg(*aggs)


def score_summary(df: DataFrame, key, score: str, digits: int = 1, conds: Mapping[str, Column] | None = None
                  ) -> DataFrame:
    """Group score summary (F9): count, mean, min, max (half-even rounded like numpy),
    plus conditional counts."""
    aggs = [F.count(score).alias("n_scored"),
            F.bround(F.avg(score), digits).alias("mean_score"),
            F.bround(F.min(score), digits).alias("min_score"),
            F.bround(F.max(score), digits).alias("max_score")]
    aggs += [F.count_if(c).alias(n) for n, c in (conds or {}).items()]
    return df.groupBy(*_keys(key)).agg(*aggs)


def band_means(df: DataFrame, band: str, metrics: Mapping[str, int], count_name: str = "n",
               mode: str = "half_up", prefix: str = "avg_", extra: Mapping[str, Column] | None = None
               ) -> DataFrame:
    """Band averages of several metrics, each with its own rounding (F10); NULLs ignored.
    `extra` adds further aggregate expressions to the same pass."""
    aggs = [F.count(F.lit(1)).alias(count_name)]
    aggs += [round_to(F.avg(m), d, mode).alias(f"{prefix}{m}") for m, d in metrics.items()]
    aggs += [e.alias(n) for n, e in (extra or {}).items()]
    return df.groupBy(band).agg(*aggs)


def mean_by(df: DataFrame, keys, col: ColumnOrName, out: str = "mean", digits: int | None = None) -> DataFrame:
    """Mean of a (text) metric per group (F11), strict numeric parse upstream."""
    a = F.avg(_c(col))
    return df.groupBy(*_keys(keys)).agg((F.round(a, digits) if digits is not None else a).alias(out))


def quartiles(df: DataFrame, col: str, by=None) -> DataFrame:
    """Exact q25 / median / q75 with linear interpolation."""
    return exact_quantiles(df, col, (0.25, 0.5, 0.75), by, ["q25", "median", "q75"])


def median_by(df: DataFrame, col: str, by=None, below: float | None = None) -> DataFrame:
    """Median per group and overall-style count beyond a threshold."""
    med = exact_quantiles(df, col, (0.5,), by, ["median"])
    if below is None:
        return med
    keys = _keys(by)
    cnt = df.groupBy(*keys).agg(F.count_if(F.col(col) < below).alias("n_below"))
    if keys:
        return med.join(cnt, keys, "left")
    return med.withColumn("_g", F.lit(0)).join(F.broadcast(cnt.withColumn("_g", F.lit(0))), "_g").drop("_g")


def flag_rates(df: DataFrame, flags: Sequence[str], by=None, denom: int | None = None, digits: int = 4
               ) -> DataFrame:
    """Flag rates with an explicit denominator (F15): the share of rows (or of a supplied
    universe size `denom`) where each flag is true. Also returns counts."""
    aggs = []
    for f in flags:
        cnt = F.count_if(F.coalesce(F.col(f), F.lit(False)))
        aggs.append(cnt.alias(f"{f}_n"))
        d = F.lit(float(denom)) if denom else F.count(F.lit(1)).cast("double")
        aggs.append(F.round(cnt / F.nullif(d, F.lit(0.0)), digits).alias(f"{f}_rate"))
    aggs.append(F.count(F.lit(1)).alias("rows"))
    return df.groupBy(*_keys(by)).agg(*aggs)


def rows_per_key(df: DataFrame, key: str, by=None, digits: int = 4) -> DataFrame:
    """Average rows per key (F16)."""
    return df.groupBy(*_keys(by)).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys"),
        F.round(F.count(F.lit(1)) / F.count_distinct(key), digits).alias("rows_per_key"))


def match_rate(df: DataFrame, matched: str, by=None, digits: int = 4) -> DataFrame:
    """Match rate by group."""
    return df.groupBy(*_keys(by)).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(matched)).alias("matched"),
        F.round(F.avg(F.col(matched).cast("double")), digits).alias("match_rate"))


def crosstab(df: DataFrame, row: str, col: str, values: Sequence | None = None) -> DataFrame:
    """Wide cross-tab counts (F18). Pass `values` so the pivot needs no extra job."""
    return df.groupBy(row).pivot(col, list(values) if values is not None else None).count()


def league_table(df: DataFrame, group: str, measures: Mapping[str, Column]) -> DataFrame:
    """State league table (F19): any set of aggregate expressions per group."""
    return df.groupBy(group).agg(*[e.alias(n) for n, e in measures.items()])


def share_with_event(events: DataFrame, universe: DataFrame, key: str, cond: Column | None = None,
                     by=None, digits: int = 4) -> DataFrame:
    """Share of a declared universe with at least one qualifying event (F20). The event
    side contributes distinct keys only (a semi-join), so repeated events cannot inflate
    the numerator; the denominator is the universe, never the event table."""
    ev = (events.where(cond) if cond is not None else events).select(key).distinct().withColumn("_e", F.lit(True))
    u = universe.join(ev, key, "left")
    return u.groupBy(*_keys(by)).agg(
        F.count(F.lit(1)).alias("universe"), F.count_if(F.col("_e").isNotNull()).alias("with_event"),
        F.round(F.count_if(F.col("_e").isNotNull()) / F.count(F.lit(1)), digits).alias("share"))


def value_range(df: DataFrame, col: str, by=None) -> DataFrame:
    """Min / max / non-null count of a metric."""
    return df.groupBy(*_keys(by)).agg(F.min(col).alias("min"), F.max(col).alias("max"),
                                      F.count(col).alias("n"))


def compare_to_benchmark(df: DataFrame, key: str, focus: str, baseline: str, metrics: Sequence[str],
                         low_margin: float = -0.1, digits: int = 4) -> DataFrame:
    """One group vs the baseline row, metric by metric (F22, T38): rows (metric, focus,
    baseline, diff, flag); HIGHER when diff > 0, LOWER when diff < low_margin, else ''.
    Both rows are unpivoted and joined on the metric name."""
    def one(who: str, name: str) -> DataFrame:
        st = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v"))
                                 for m in metrics]))
        return df.where(F.col(key) == who).select(st.alias("_s")).select(
            "_s.metric", F.col("_s.v").alias(name))
    j = one(focus, "focus_value").join(one(baseline, "baseline_value"), "metric", "full")
    diff = F.round(F.col("focus_value") - F.col("baseline_value"), digits)
    return j.select("metric", "focus_value", "baseline_value", diff.alias("diff"),
                    F.when(diff > 0, "HIGHER").when(diff < low_margin, "LOWER").otherwise("").alias("flag"))


def with_group_total(df: DataFrame, col: str, by=None, out: str = "group_total") -> DataFrame:
    """Attach a group sum without a self join (window over the group keys)."""
    return df.withColumn(out, F.sum(col).over(Window.partitionBy(*_keys(by))))
