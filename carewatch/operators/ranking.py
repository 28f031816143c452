"""Ranking, percentiles, tiers, top-n and sorting.

National (un-partitioned) ranks are the hard case: `rank().over(Window.orderBy(x))`
moves every row into one task. Here every order statistic comes from a *cumulative
count table* built without any single-partition step over raw rows:

  1. `groupBy(by, value).count()`            - partial+final hash aggregate; a hot value
                                               collapses into one row with a big count.
  2. value buckets from approximate quantiles of the distinct values (`n_buckets - 1` edges,
     a one-row aggregate broadcast inside the same plan), so every bucket holds a similar
     number of distinct values; there are as many buckets as the shuffle is wide, which is
     the figure that follows the input.
  3. running sum inside `(by, bucket)` windows  - many balanced partitions.
  4. bucket totals -> offsets with a window over `(by)` on at most groups x n_buckets
     rows, joined back on (by, bucket).

Result: for each (by, value) the count of rows strictly below (`cum_lt`), at or below
(`cum_le`) and the group total. Ranks, average-rank percentiles and exact interpolated
quantiles are all exact functions of that table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import ColumnOrName, _c

MATERIALIZE = "none"


def _buckets(df: DataFrame, n: int | None) -> int:
    """Value buckets: as given, else the width of the session's shuffles."""
    return max(2, n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def materialize(df: DataFrame, how: str) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the session's `spark.checkpoint.dir`
    (a private folder is set only when the session has none, as in local tests)."""
    if how == "checkpoint":
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "cache":
        return df.persist()
    return df


def _by(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _valid(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value.cast("double"))


def distinct_value_counts(df: DataFrame, value: str, by=None, how: str = MATERIALIZE) -> DataFrame:
    """(by..., value, n) over non-NULL, non-NaN values, materialised once. A coarser
    scope is derived from it without touching the input again: see `rollup_counts`."""
    v = F.col(value)
    vc = df.where(_valid(v)).groupBy(*_by(by), value).agg(F.count(F.lit(1)).alias("n"))
    return materialize(vc, how)


def rollup_counts(counts: DataFrame, value: str, by=None, how: str = MATERIALIZE) -> DataFrame:
    """Re-aggregate a (finer..., value, n) table to (by..., value, n), e.g. state -> nation,
    reading only the (small) finer table."""
    return materialize(counts.groupBy(*_by(by), value).agg(F.sum("n").alias("n")), how)


def cumulative_counts(df: DataFrame, value: str, by=None, n_buckets: int | None = None,
                      rel_err: float = 0.001, how: str = MATERIALIZE,
                      counts: DataFrame | None = None) -> DataFrame:
    """(by..., value, n, cum_lt, cum_le, total) for every distinct non-NULL value.

    The distinct-value count table feeds three branches (bucket edges, running sums,
    bucket totals), which share its one exchange, so the input is scanned once and building
    the plan runs no job. `how="checkpoint"` writes it to the session's shared
    checkpoint folder instead; "cache" keeps it in executor storage."""
    keys = _by(by)
    n_buckets = _buckets(df, n_buckets)
    v = F.col(value)
    vc = counts if counts is not None else distinct_value_counts(df, value, by, how)
    # Bucket edges: approximate quantiles of the distinct values, computed inside the plan
    # as a one-row aggregate (n_buckets - 1 doubles) and broadcast on a constant key.
    probs = F.array(*[F.lit(i / n_buckets) for i in range(1, n_buckets)])
    acc = max(100, int(round(1.0 / rel_err)))
    edges = vc.agg(F.percentile_approx(v.cast("double"), probs, acc).alias("_edges")).withColumn("_g", F.lit(0))
    vc = vc.withColumn("_g", F.lit(0)).join(F.broadcast(edges), "_g")
    # number of edges below the value, in two steps of about sqrt(n_buckets) tests
    step = max(1, int(n_buckets ** 0.5))
    below = lambda arr: F.size(F.filter(arr, lambda e: e < v.cast("double")))
    coarse = F.transform(F.sequence(F.lit(step), F.greatest(F.size("_edges"), F.lit(step)), F.lit(step)),
                         lambda i: F.try_element_at("_edges", i))
    vc = vc.withColumn("_c", below(coarse) * step)
    vc = vc.withColumn("_b", F.coalesce(F.col("_c") + below(F.slice("_edges", F.col("_c") + 1, F.lit(step))), F.lit(0))) \
           .drop("_g", "_edges", "_c")
    run = Window.partitionBy(*keys, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    vc = vc.withColumn("_cum_b", F.sum("n").over(run))
    bt = vc.groupBy(*keys, "_b").agg(F.sum("n").alias("_bt"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bt = bt.select(*keys, "_b",
                   F.coalesce(F.sum("_bt").over(before), F.lit(0)).alias("_off"),
                   F.sum("_bt").over(Window.partitionBy(*keys)).alias("total"))
    if not keys:  # at most n_buckets rows: bounded by construction
        bt = F.broadcast(bt)
    out = vc.join(bt, [*keys, "_b"])
    return out.select(*keys, value, "n",
                      (F.col("_off") + F.col("_cum_b") - F.col("n")).alias("cum_lt"),
                      (F.col("_off") + F.col("_cum_b")).alias("cum_le"),
                      "total")


def _attach(df: DataFrame, table: DataFrame, value: str, by, cols: dict) -> DataFrame:
    keys = _by(by)
    t = table.select(*keys, value, *[e.alias(n) for n, e in cols.items()])
    return df.join(t, [*keys, value], "left")


def quantiles_from_counts(cc: DataFrame, value: str, probs: Sequence[float], by=None,
                          names: Sequence[str] | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles per group from a cumulative-count table:
    position p*(N-1) lies between the order statistics at floor and ceil; each is the
    distinct value whose [cum_lt, cum_le) range holds that position. One aggregate."""
    keys = _by(by)
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probs])
    aggs = [F.max("total").alias("n")]
    for p, nm in zip(probs, names):
        pos = F.lit(float(p)) * (F.col("total") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        has_lo = (F.col("cum_lt") <= lo) & (lo < F.col("cum_le"))
        has_hi = (F.col("cum_lt") <= hi) & (hi < F.col("cum_le"))
        aggs += [F.max(F.when(has_lo, F.col(value))).alias(f"_{nm}_lo"),
                 F.max(F.when(has_hi, F.col(value))).alias(f"_{nm}_hi"),
                 F.max(pos - lo).alias(f"_{nm}_f")]
    g = cc.groupBy(*keys).agg(*aggs)
    outs = [(F.col(f"_{nm}_lo") + (F.col(f"_{nm}_hi") - F.col(f"_{nm}_lo")) * F.col(f"_{nm}_f")).alias(nm)
            for nm in names]
    return g.select(*keys, "n", *outs)


def _join_groups(left: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Attach one row per group: an equi-join on the group keys, or (no keys) a one-row
    broadcast on a constant key. A group table is broadcast if its measured size allows (AQE)."""
    if keys:
        return left.join(small, keys, "left")
    return left.withColumn("_g", F.lit(0)).join(F.broadcast(small.withColumn("_g", F.lit(0))), "_g", "left") \
               .drop("_g")


def rank_values(df: DataFrame, value: str, by=None, rank: str | None = None, rank_desc: bool = False,
                pct: str | None = None, pct_digits: int | None = 3, tier: str | None = None,
                n_buckets: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """One row per (by..., value) with the requested order statistics, all read off ONE
    cumulative-count table:

    * `rank`  - SQL RANK() ascending (or descending with `rank_desc`) (G1)
    * `pct`   - average-rank percentile, pandas rank(pct=True), half-even rounded (G2, G3)
    * `tier`  - quartile tier with <= edges from exact interpolated quartiles (G4, T5)
    """
    keys = _by(by)
    cc = cumulative_counts(df, value, by, n_buckets, counts=counts)
    cols: dict = {}
    if tier:
        q = quantiles_from_counts(cc, value, (0.25, 0.5, 0.75), by, ["_q1", "_q2", "_q3"]).drop("n")
        cc = _join_groups(cc, q, keys)
        cols[tier] = tier_label(value, "_q1", "_q2", "_q3")
    if rank:
        r = (F.col("total") - F.col("cum_le") + 1) if rank_desc else (F.col("cum_lt") + 1)
        cols[rank] = r.cast("long")
    if pct:
        p = ((F.col("cum_lt") + 1 + F.col("cum_le")) / F.lit(2.0)) / F.col("total")
        cols[pct] = F.bround(p, pct_digits) if pct_digits is not None else p
    return cc.select(*keys, value, *[e.alias(n) for n, e in cols.items()])


def attach_ranks(df: DataFrame, values: DataFrame, value: str, by=None, tier: str | None = None,
                 unscored: str | None = None) -> DataFrame:
    """Left-join a `rank_values` table back on (by..., value). NULL / NaN values match
    nothing, so unscored rows keep NULL statistics and tier `unscored` (T6, E10); a spread
    second key keeps them from meeting in one partition."""
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(4096)).cast("int") + 1
    out = (df.withColumn("_spread", F.when(_valid(F.col(value)), 0).otherwise(spread))
           .join(values.withColumn("_spread", F.lit(0)), [*_by(by), value, "_spread"], "left").drop("_spread"))
    if tier and unscored is not None:
        out = out.withColumn(tier, F.coalesce(F.col(tier), F.lit(unscored)))
    return out


def rank_table(df: DataFrame, value: str, by=None, rank: str | None = None, rank_desc: bool = False,
               pct: str | None = None, pct_digits: int | None = 3, tier: str | None = None,
               unscored: str | None = None, n_buckets: int | None = None) -> DataFrame:
    """`rank_values` attached to `df` with one join."""
    vals = rank_values(df, value, by, rank, rank_desc, pct, pct_digits, tier, n_buckets)
    return attach_ranks(df, vals, value, by, tier, unscored)


# ------------------------------------------------------------------- G1 / G2 / G3
def rank_by(df: DataFrame, col: str, asc: bool = True, by=None, out: str = "rank",
            n_buckets: int | None = None) -> DataFrame:
    """SQL `RANK()` (ties share the lowest position, gaps follow) over `col`, nationally or
    within `by`, without a single-partition window (G1). NULL values get NULL rank."""
    return rank_table(df, col, by, rank=out, rank_desc=not asc, n_buckets=n_buckets)


def pct_rank_avg(df: DataFrame, col: str, by=None, out: str = "pct_rank", digits: int | None = 3,
                 n_buckets: int | None = None) -> DataFrame:
    """Average-rank percentile, pandas `rank(pct=True)` (G2, G3, trap T4):
    (mean of the tied positions) / (non-NULL count). Rounded half-even like pandas."""
    return rank_table(df, col, by, pct=out, pct_digits=digits, n_buckets=n_buckets)


def pct_rank_window(df: DataFrame, col: str, by=None, out: str = "pct_rank", digits: int | None = 3
                    ) -> DataFrame:
    """Reference formula with plain windows (used for small inputs and in tests):
    (rank + (peers - 1) / 2) / count."""
    keys = _by(by)
    w = Window.partitionBy(*keys).orderBy(col)
    peers = Window.partitionBy(*keys, col)
    allw = Window.partitionBy(*keys)
    v = F.col(col)
    p = (F.rank().over(w) + (F.count(F.lit(1)).over(peers) - 1) / 2.0) / F.count(v).over(allw)
    scored = df.where(_valid(v)).withColumn(out, F.bround(p, digits) if digits is not None else p)
    return scored.unionByName(df.where(~_valid(v) | v.isNull()).withColumn(out, F.lit(None).cast("double")))


# ------------------------------------------------------------------- F12 quantiles
def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float] = (0.25, 0.5, 0.75), by=None,
                    names: Sequence[str] | None = None, n_buckets: int | None = None,
                    counts: DataFrame | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy 'linear', SQL `percentile` /
    `quantile_cont`) per group. No per-group value map is held in memory: the order
    statistics are read off the cumulative-count table. Rows: (by..., n, q_...)."""
    return quantiles_from_counts(cumulative_counts(df, col, by, n_buckets, counts=counts), col, probs, by, names)


# ------------------------------------------------------------------------- G4
def tier_label(score: ColumnOrName, q1: ColumnOrName, med: ColumnOrName, q3: ColumnOrName,
               unscored: str | None = None) -> Column:
    """Quartile tier with `<=` edges: ties at Q1 go to the bottom (T5)."""
    s = _c(score)
    return (F.when(s.isNull(), F.lit(unscored))
             .when(s <= _c(q1), F.lit("BOTTOM_QUARTILE"))
             .when(s <= _c(med), F.lit("BELOW_MEDIAN"))
             .when(s <= _c(q3), F.lit("ABOVE_MEDIAN"))
             .otherwise(F.lit("TOP_QUARTILE")))


def quartile_tier(df: DataFrame, col: str, by=None, out: str = "tier", unscored: str | None = None,
                  n_buckets: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Quartile tiers nationally or within `by` (G4). Edges are exact quartiles of the
    scored rows only (T6), one row per group; that small table is joined to the rows on
    the group keys (nationally, as one broadcast row), so the rows themselves are never
    shuffled by value. Unscored rows get `unscored` (default NULL)."""
    keys = _by(by)
    q = exact_quantiles(df, col, (0.25, 0.5, 0.75), by, ["_q1", "_q2", "_q3"], n_buckets, counts).drop("n")
    j = _join_groups(df, q, keys)
    return j.withColumn(out, tier_label(col, "_q1", "_q2", "_q3", unscored)).drop("_q1", "_q2", "_q3")


# ------------------------------------------------------------------------- G5
def position_of(df: DataFrame, key: str, col: str, focus, tie_key: str | None = None) -> DataFrame:
    """1-based position of one key after sorting `col` descending, ties broken by
    `tie_key` ascending (G5). Computed as 1 + rows strictly ahead: one pass over the data
    plus a one-row broadcast of the focus row; no global sort. Rows: (key, value, position,
    of_n)."""
    tk = tie_key or key
    f = df.where(F.col(key) == F.lit(focus)).select(
        F.col(key).alias("_fk"), F.col(col).alias("_fv"), F.col(tk).alias("_ft")).limit(1)
    j = df.where(F.col(col).isNotNull()).withColumn("_g", F.lit(0)).join(
        F.broadcast(f.withColumn("_g", F.lit(0))), "_g")
    ahead = (F.col(col) > F.col("_fv")) | ((F.col(col) == F.col("_fv")) & (F.col(tk) < F.col("_ft")))
    return j.groupBy("_fk", "_fv").agg((F.count_if(ahead) + 1).alias("position"),
                                       F.count(F.lit(1)).alias("of_n")) \
            .select(F.col("_fk").alias(key), F.col("_fv").alias(col), "position", "of_n")


# ------------------------------------------------------------------------- G6
def dedupe_keep(df: DataFrame, key, order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per key: the first (smallest `order` tuple) or last (largest).
    Runs as a hash aggregate of `min/max(struct(order..., row))`, so a hot key is reduced
    map-side instead of being sorted in one task. Order columns must be non-NULL tie-free
    for a deterministic pick."""
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in df.columns if c not in keys]
    st = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*payload).alias("_row"))
    agg = F.min(st) if keep == "first" else F.max(st)
    return df.groupBy(*keys).agg(agg.alias("_s")).select(*keys, *[F.col("_s._row")[c].alias(c) for c in payload])


# ------------------------------------------------------------------- G7 / H1-H6
def order_cols(spec: Sequence[tuple]) -> list[Column]:
    """[(col, 'asc'|'desc', 'first'|'last')] -> explicit null placement."""
    out = []
    for item in spec:
        c, d = item[0], (item[1] if len(item) > 1 else "asc")
        nulls = item[2] if len(item) > 2 else "last"
        col = _c(c)
        out.append(getattr(col, f"{d}_nulls_{nulls}")())
    return out


def top_n(df: DataFrame, col: ColumnOrName, n: int, by=None, asc: bool = False,
          tie_break: Sequence[str] = (), out: str = "rn") -> DataFrame:
    """Top / bottom n rows per scope (G7). `row_number() <= n` lets Spark insert a
    partial WindowGroupLimit before the shuffle, so each task forwards at most n rows
    per group."""
    keys = _by(by)
    o = [(_c(col).asc_nulls_last() if asc else _c(col).desc_nulls_last())] + [F.col(t).asc() for t in tie_break]
    if not keys:  # global: per-task top-n then an n-row merge (TakeOrdered), numbered after
        top = df.orderBy(*o).limit(n)
        return top.withColumn(out, F.row_number().over(Window.orderBy(*o)).cast("long"))
    w = Window.partitionBy(*keys).orderBy(*o)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n) \
             .withColumn(out, F.col(out).cast("long"))


def top_k(df: DataFrame, col: ColumnOrName, k: int, asc: bool = False, tie_break: Sequence[str] = ()
          ) -> DataFrame:
    """Global top-k (H1, H2): `orderBy(...).limit(k)` plans as TakeOrderedAndProject, a
    per-task top-k followed by a k-row merge."""
    o = [(_c(col).asc_nulls_last() if asc else _c(col).desc_nulls_last())] + [F.col(t).asc() for t in tie_break]
    return df.orderBy(*o).limit(k)


def sort_rows(df: DataFrame, spec: Sequence[tuple]) -> DataFrame:
    """Multi-key sort, mixed directions, explicit null placement (H3, H6)."""
    return df.orderBy(*order_cols(spec))


def sort_num(df: DataFrame, col: str, asc: bool = True, tie_break: Sequence[str] = ()) -> DataFrame:
    """Sort a text column numerically (strict parse, unparsable last) (H4)."""
    from ..functions.expr import num
    n = num(col)
    o = [n.asc_nulls_last() if asc else n.desc_nulls_last()] + [F.col(t).asc() for t in tie_break]
    return df.orderBy(*o)


def value_counts(df: DataFrame, col: str, n: int | None = None, out: str = "n") -> DataFrame:
    """Most frequent values (H5): hash aggregate then top-k with value as tie-break."""
    vc = df.groupBy(col).agg(F.count(F.lit(1)).alias(out))
    return top_k(vc, out, n, tie_break=[col]) if n else vc
