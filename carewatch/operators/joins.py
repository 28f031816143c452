"""Joins (E1-E13).

Broadcast policy: no operator here forces a broadcast of data. The planner broadcasts a
scan or a literal table whose bytes are under `spark.sql.autoBroadcastJoinThreshold`, and AQE
a side whose measured bytes are; beyond that the join is a shuffled sort-merge join, and AQE
splits skewed partitions of the large side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import ColumnOrName, _c, clean, pad_key
from ..session import ensure_checkpoint_dir
from .ordering import AT, PART, count_before, in_order, place


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def dedupe_last(ref: DataFrame, on, seq: str | None) -> DataFrame:
    """One row per key, so a lookup can never fan out rows (T11, T19): the row with the
    highest `seq` wins (dict 'last wins'); without a sequence, the largest payload wins
    (deterministic). Runs as a hash aggregate, so a hot key is combined map-side."""
    keys = _keys(on)
    payload = [c for c in ref.columns if c not in keys]
    if not payload:
        return ref.select(*keys).distinct()
    pick = F.max_by(F.struct(*payload), F.col(seq)) if seq is not None else F.max(F.struct(*payload))
    agg = ref.groupBy(*keys).agg(pick.alias("_r"))
    return agg.select(*keys, *[F.col("_r")[c].alias(c) for c in payload])


# ------------------------------------------------------------------- E1 / E6
def lookup(df: DataFrame, ref: DataFrame, on, cols: Sequence[str] | None = None,
           seq: str | None = None, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Left lookup of reference columns by key (E1, E6). Duplicated reference keys are
    resolved by `seq` (last wins) so the lookup can never fan out rows; missing matches
    take `defaults`."""
    keys = _keys(on)
    cols = list(cols) if cols is not None else [c for c in ref.columns if c not in keys and c != seq]
    r = dedupe_last(ref.select(*keys, *cols, *([seq] if seq else [])), keys, seq)
    r = r.select(*keys, *cols)
    out = df.join(r, keys, "left")
    for c, v in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


# ------------------------------------------------------------------------ E2
def enrich(df: DataFrame, on: str, context: DataFrame, cols: Sequence[str],
           flag_ref: DataFrame | None = None, flag_name: str = "flag",
           flag_key: str | None = None) -> DataFrame:
    """Left join a context table, then flag hits in a second table (E2). The flag table
    contributes only distinct keys, so it cannot fan out rows."""
    out = df.join(dedupe_last(context.select(on, *cols), on, None), on, "left")
    if flag_ref is not None:
        fk = flag_key or on
        hits = flag_ref.select(F.col(fk).alias(on)).distinct().withColumn("_hit", F.lit(1))
        out = (out.join(hits, on, "left")
               .withColumn(flag_name, F.coalesce(F.col("_hit"), F.lit(0)))
               .drop("_hit"))
    return out


# ---------------------------------------------------------------- E3 / E4 hub
@dataclass
class Source:
    """One source of a hub build (E3). `key` is an expression over the spine, `ref_key` a
    column (or expression) of the source; `cols` are carried, `flag` names the match flag.
    `optional=True` with `df=None` skips the source (E4)."""
    name: str
    df: DataFrame | None
    key: ColumnOrName
    ref_key: ColumnOrName
    cols: Sequence[str] = field(default_factory=list)
    flag: str | None = None
    optional: bool = False
    seq: str | None = None
    pad: int | None = None


def _spread(df: DataFrame) -> Column:
    """A number from the whole row, 1 to 4096: rows that match nothing need no common key."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(4096)).cast("int") + 1


def build_hub(spine: DataFrame, sources: Sequence[Source], row_id: str | None = None) -> DataFrame:
    """Spine left-joined to several sources on normalised keys, one match flag per source.

    Keys are cleaned (and zero-padded when `pad` is set) on both sides; blank keys never
    match (T9). A source with repeated keys is reduced to one row per key (by `seq`, or
    by taking the row with the largest payload) so the spine row count is preserved (T11);
    `check_join` in `quality` verifies it.

    All sources are joined at once: the spine's keys are unpivoted to narrow rows (source, key, row
    id) and meet one union of all sources, reduced by one aggregate; the hits are pivoted back by row
    id. So the spine's rows are exchanged once, whatever the number of sources, and keys that match
    nothing are not carried further. `row_id` is a column that identifies the spine's rows (a
    repeated one fails the job); without one, rows are numbered and the numbered spine is written
    first, so that a lost executor does not number them anew."""
    used = []
    for s in sources:
        if s.df is not None:
            used.append(s)
        elif not s.optional:
            raise ValueError(f"required source {s.name!r} is missing")
    if not used:
        return spine
    if row_id:
        base = spine.withColumn("_rid", F.col(f"`{row_id}`"))
    else:
        ensure_checkpoint_dir(spine.sparkSession)
        base = spine.withColumn("_rid", F.monotonically_increasing_id()).checkpoint()
    refs = keys = None
    for i, s in enumerate(used):
        norm = (lambda c, pad=s.pad: pad_key(c, pad)) if s.pad else clean
        payload = F.struct(*[F.col(f"`{c}`").alias(f"c{j}") for j, c in enumerate(s.cols)], F.lit(True).alias("hit"))
        ref = s.df.select(F.lit(i).alias("_src"), norm(_c(s.ref_key)).alias("_key"),
                          F.struct(F.col(s.seq).alias("o") if s.seq else F.lit(0).alias("o"), payload.alias("p")).alias(f"_p{i}"))
        key = base.select("_rid", F.lit(i).alias("_src"), norm(_c(s.key)).alias("_key"))
        refs = ref if refs is None else refs.unionByName(ref, allowMissingColumns=True)
        keys = key if keys is None else keys.unionByName(key)
    used_key = "_key is not null and _key <> ''"
    refs = refs.where(used_key).groupBy("_src", "_key").agg(*[F.max(f"_p{i}").alias(f"_p{i}") for i in range(len(used))])
    hits = keys.where(used_key).join(refs, ["_src", "_key"])
    once = None
    for i in range(len(used)):
        ok = F.count_if(F.col("_src") == i) <= 1
        once = ok if once is None else once & ok
    back = hits.groupBy(F.col("_rid").alias("_hid")).agg(
        *[F.max(f"_p{i}").alias(f"_p{i}") for i in range(len(used))], once.alias("_once"))
    # a filter keeps the partitioning by row id, so the hits are not exchanged again
    back = back.where(F.when(F.col("_once"), F.lit(True)).otherwise(F.raise_error(
        F.concat(F.lit("build_hub: repeated row id "), F.col("_hid").cast("string"))).cast("boolean")))
    out = base.join(back, F.col("_rid") == F.col("_hid"), "left")
    return out.select(*[base[f"`{c}`"] for c in spine.columns], *[c for i, s in enumerate(used) for c in (
        *[F.col(f"_p{i}.p.c{j}").alias(name) for j, name in enumerate(s.cols)],
        F.coalesce(F.col(f"_p{i}.p.hit"), F.lit(False)).alias(s.flag or f"{s.name}_matched"))])


# ------------------------------------------------------------------------ E5
def lookup_or_self(df: DataFrame, ref: DataFrame, on, mapping: Mapping[str, tuple[str, str]],
                   matched: str = "ref_matched", seq: str | None = None) -> DataFrame:
    """Composite-key lookup whose outputs fall back, per row, to the row's own value when
    the key is not in the reference (E5). `mapping` = {out: (ref_col, own_col)}.
    Adds a `matched` flag so misses can be counted."""
    keys = _keys(on)
    ref_cols = sorted({rc for rc, _ in mapping.values()})
    r = dedupe_last(ref.select(*keys, *ref_cols, *([seq] if seq else [])), keys, seq)
    r = r.select(*keys, *[F.col(c).alias(f"_ref_{c}") for c in ref_cols]).withColumn("_hit", F.lit(True))
    out = df.join(r, keys, "left")
    out = out.withColumn(matched, F.coalesce(F.col("_hit"), F.lit(False)))
    for o, (rc, own) in mapping.items():
        out = out.withColumn(o, F.when(F.col(matched), F.col(f"_ref_{rc}")).otherwise(F.col(own)))
    return out.drop("_hit", *[f"_ref_{c}" for c in ref_cols])


# ------------------------------------------------------------------------ E7
def left_fill(df: DataFrame, agg: DataFrame, on, fill: Mapping[str, object] | None = None,
              value: object = 0) -> DataFrame:
    """Left join an aggregate and zero-fill the unmatched rows."""
    keys = _keys(on)
    cols = [c for c in agg.columns if c not in keys]
    out = df.join(agg, keys, "left")
    fill = fill or {c: value for c in cols}
    for c, v in fill.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


# ------------------------------------------------------------------------ E8
def outer_merge(dfs: Sequence[DataFrame], key: str, assume_unique: bool = True) -> DataFrame:
    """Full outer merge of several tables on one key: the union of keys with every
    table's columns (E8, I2).

    With unique keys per table (the contract of the census tables) this runs as ONE
    shuffle: all tables are unioned by name and grouped by key, each column taking its
    only non-NULL value. A repeated key fails the job rather than mixing values of different
    rows. Otherwise it falls back to chained full joins with key coalescing (duplicates then
    multiply like SQL)."""
    if not assume_unique:
        out = dfs[0]
        for d in dfs[1:]:
            out = out.join(d, key, "full")
        return out
    cols: list[str] = []
    for d in dfs:
        cols += [c for c in d.columns if c != key and c not in cols]
    u = dfs[0].withColumn("_t", F.lit(0))
    for i, d in enumerate(dfs[1:], 1):
        u = u.unionByName(d.withColumn("_t", F.lit(i)), allowMissingColumns=True)
    once = None
    for i in range(len(dfs)):
        ok = F.count_if(F.col("_t") == i) <= 1
        once = ok if once is None else once & ok
    g = u.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.max(c).alias(c) for c in cols], once.alias("_once"))
    checked = F.when(F.col("_once"), F.col(key)).otherwise(
        F.raise_error(F.concat(F.lit("outer_merge: repeated key "), F.col(key).cast("string"))))
    return g.select(checked.alias(key), *cols)


# ------------------------------------------------------------------------ E9
def interval_label(key: ColumnOrName, ranges: Sequence[tuple], default=None) -> dict[str, Column]:
    """Literal range lookup as an ordered CASE ladder: first range (lo <= key <= hi) wins.
    `ranges` = [(label, lo, hi, *extra)]; returns {'label': Column, 'extra_i': Column}.
    No join at all, so it costs one expression per row (E9 with literal ranges)."""
    k = _c(key)
    n_extra = len(ranges[0]) - 3 if ranges else 0
    outs = {}
    for j in range(-1, n_extra):
        expr = None
        for r in ranges:
            lab, lo, hi = r[0], r[1], r[2]
            val = lab if j < 0 else r[3 + j]
            cond = k.between(lo, hi)
            expr = F.when(cond, F.lit(val)) if expr is None else expr.when(cond, F.lit(val))
        name = "label" if j < 0 else f"extra_{j}"
        outs[name] = expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)
    return outs


def _kind(t: T.DataType) -> str:
    return "number" if isinstance(t, T.NumericType) else "time" if isinstance(t, (T.DateType, T.TimestampType)) else t.typeName()


#: Blocks of keys: 2^4 of a level make one of the next.
_BLOCK_BITS = 4


def range_winners(keys: DataFrame, ranges: DataFrame) -> DataFrame:
    """(v, rank) for the distinct `keys` (column v) that one of `ranges` (rank, lo, hi; ranks are
    different) holds: the least rank of the ranges with lo <= v <= hi, a null bound being open.

    A sweep in four steps, none of which sees all ranges of a place in one task:

    1. starts, ends and keys are put into one order (a start before equal keys, an end after them);
       the keys before a start and before an end make a range an interval of key numbers. Ranges
       without a key go, and of those with the same keys the least rank stays;
    2. an interval is cut into runs of blocks of 16^k keys, at most two for each k, and the least
       rank of each run is kept (a hash aggregate, so a run that many ranges have costs a row);
    3. from the largest blocks down, a block hands its least rank to the 16 below it, each of which
       keeps the lesser of that and its own: all levels together are little more than the keys;
    4. a block of level 0 is a key."""
    points = ranges.where("lo is null or hi is null or lo <= hi").select("rank", F.explode(F.array(
        F.struct(F.col("lo").alias("v"), F.lit(0).alias("side")), F.struct(F.col("hi").alias("v"), F.lit(2).alias("side")))).alias("p"))
    points = points.select("rank", "p.*").where("side = 0 or v is not null")  # no lower bound: before all keys
    asked = keys.select(F.lit(None).cast("long").alias("rank"), "v", F.lit(1).alias("side"))
    ordered = in_order(points.unionByName(asked), ["v", "side"])
    n = ordered.where("side = 1").count()
    bounds = count_before(ordered.select("rank", "side", PART, AT), F.col("side") == 1, "at").where("side <> 1")
    spans = bounds.groupBy("rank").agg(F.max(F.when(F.col("side") == 0, F.col("at"))).alias("i"),
                                       F.coalesce(F.max(F.when(F.col("side") == 2, F.col("at"))), F.lit(n)).alias("j"))
    spans = spans.where("i < j").groupBy("i", "j").agg(F.min("rank").alias("rank"))
    best = None
    for k in reversed(range(max(1, -(-n.bit_length() // _BLOCK_BITS)))):
        low, high = k * _BLOCK_BITS, (k + 1) * _BLOCK_BITS
        # blocks of level k: those of [ceil(i / 16^k), floor(j / 16^k)) that level k + 1 does not take
        runs = spans.selectExpr(
            "rank", f"shiftright(i + {(1 << low) - 1}L, {low}) AS a", f"shiftright(j, {low}) AS b",
            f"shiftright(i + {(1 << high) - 1}L, {high}) * {1 << _BLOCK_BITS}L AS c", f"shiftright(j, {high}) * {1 << _BLOCK_BITS}L AS d")
        runs = runs.where("a < b").selectExpr("rank", """inline(CASE WHEN c >= d THEN array(struct(a AS a, b AS b))
            ELSE array(struct(a AS a, c AS b), struct(d AS a, b AS b)) END) AS (a, b)""").where("a < b")
        runs = runs.groupBy("a", "b").agg(F.min("rank").alias("rank"))
        cells = runs.selectExpr("explode(sequence(a, b - 1)) AS block", "rank")
        if best is not None:
            last = (n - 1) >> low
            cells = cells.unionByName(best.selectExpr(
                f"explode(sequence(block * {1 << _BLOCK_BITS}L, least(block * {1 << _BLOCK_BITS}L + {(1 << _BLOCK_BITS) - 1}L, {last}L))) AS block", "rank"))
        best = cells.groupBy("block").agg(F.min("rank").alias("rank"))
    numbered = count_before(ordered.where("side = 1").select("v", PART, AT), F.lit(True), "block")
    # sizes are estimated from compressed files, before rows multiply: no side is broadcast on an estimate
    return numbered.hint("merge").join(best, "block").select("v", "rank")


#: Edges, about, of the cells in which ranges are compared before any is moved.
_EDGES = 1 << 15


def _place_in(df: DataFrame, col: str, edges: str, n: int, name: str) -> DataFrame:
    """`name`: 2 i + 1 if `col` is the i-th of the `n` ascending values in `edges`, 2 i if it lies before it, 2 n
    after the last; 0 for a null. A binary search, unrolled so that it compiles."""
    df = df.withColumn(name, F.lit(0))
    for k in reversed(range(n.bit_length())):
        df = df.withColumn(name, F.col(name) + F.when(F.get(edges, F.col(name) + ((1 << k) - 1)) < F.col(col), 1 << k).otherwise(0))
    return df.withColumn(name, 2 * F.col(name) + F.when(F.get(edges, F.col(name)) == F.col(col), 1).otherwise(0))


def ranges_in_question(keys: DataFrame, ranges: DataFrame) -> DataFrame:
    """`ranges` (seq, lo, hi and more) without those that hold nothing and those that come after others, by `seq`,
    wherever they may hold a key of `keys` (column v): none that goes is the first of a key.

    Edges, about 2^15 of the different bounds, make cells: an edge is one, and so is what lies between two. The least
    `seq` of the ranges that hold all of a cell is the cell's limit, and a range goes if its `seq` is over the limits of
    all cells that it touches. If there are no more keys than that, they are the edges, and cells between them are empty.
    The ranges are read anew for each step, so they must be the same each time; what is moved is, of each task, the least
    `seq` of runs of cells (two runs of 2^k cells cover what a range holds) and the ranges that are left."""
    spark = ranges.sparkSession
    ensure_checkpoint_dir(spark)
    spans = ranges.where("lo is null or hi is null or lo <= hi")
    few, every, values = keys.agg(F.approx_count_distinct("v")).first()[0] <= _EDGES, 1, keys
    if not few:
        values = spans.select(F.explode(F.array("lo", "hi")).alias("v"))
        every = max(1, values.agg(F.approx_count_distinct("v")).first()[0] // _EDGES)
    values = values.where(F.col("v").isNotNull() & (F.pmod(F.xxhash64("v"), F.lit(every)) == 0)).distinct()
    edges = values.agg(F.array_sort(F.collect_list("v")).alias("__edges")).checkpoint()
    n = edges.select(F.size("__edges")).first()[0]
    cells, levels = 2 * n + 1, (2 * n + 1).bit_length()

    spans = spans.crossJoin(F.broadcast(edges))  # of one row
    for bound, name in (("lo", "__i"), ("hi", "__j")):
        spans = _place_in(spans, bound, "__edges", n, name)
    spans = spans.withColumn("__j", F.when(F.col("hi").isNull(), 2 * n).otherwise(F.col("__j")))
    # cells that a range holds wholly, and (i, j) that it touches
    whole = {"__a": F.when(F.col("lo").isNull(), 0).otherwise(F.col("__i").bitwiseOR(1)),
             "__b": F.when(F.col("hi").isNull(), 2 * n).otherwise((F.col("__j") - 1).bitwiseOR(1))}
    spans = spans.withColumns(whole)
    if few:
        spans = spans.withColumns({"__i": F.col("__a"), "__j": F.col("__b")})

    def runs(i, j):  # (k, first cell) of the two runs of 2^k cells that cover cells i to j
        k = F.floor(F.log2(F.greatest(F.col(j) - F.col(i), F.lit(0)) + 1.5)).cast("int")
        return k, F.col(i), F.col(j) + 1 - F.call_function("shiftleft", F.lit(1), k)

    # filters stand after an explode: moved below it, they would write out the searches many times over
    k, a, b = runs("__a", "__b")
    some = F.col("__a") <= F.col("__b")
    held = spans.select("seq", F.explode(F.array(F.when(some, k * cells + a), F.when(some, k * cells + b))).alias("run"))
    held = held.where("run is not null").groupBy("run").agg(F.min("seq").alias("seq"))
    none = spark.range(cells).select(F.lit(None).cast(held.schema["seq"].dataType).alias("seq"), F.col("id").alias("run"))
    k, order = F.floor(F.col("run") / cells), Window.orderBy("cell")  # a bounded table: one task
    limits = held.unionByName(none).groupBy((F.col("run") % cells).alias("cell")).agg(
        *[F.min(F.when(k == x, F.col("seq"))).alias(f"l{x}") for x in range(levels)])
    for x in reversed(range(levels - 1)):  # a run hands its limit to its halves
        limits = limits.withColumn(f"l{x}", F.least(f"l{x}", f"l{x + 1}", F.lag(f"l{x + 1}", 1 << x).over(order)))
    for x in range(1, levels):  # the highest limit in a run, null if a cell has none
        here, there = F.col(f"l{x - 1}"), F.lead(f"l{x - 1}", 1 << (x - 1)).over(order)
        limits = limits.withColumn(f"l{x}", F.when(here.isNotNull() & there.isNotNull(), F.greatest(here, there)))
    limits = limits.agg(F.array(*[F.array_sort(F.collect_list(F.struct("cell", f"l{x}")))[f"l{x}"] for x in range(levels)]).alias("__limits"))
    limits = limits.checkpoint()
    k, i, j = runs("__i", "__j")
    over = [F.col("seq") > F.get(F.get("__limits", k), x) for x in (i, j)]
    asked = F.when((F.col("__i") <= F.col("__j")) & F.coalesce(~(over[0] & over[1]), F.lit(True)), True)
    left = spans.crossJoin(F.broadcast(limits)).select(*[f"`{c}`" for c in ranges.columns], F.explode(F.array(asked)).alias("__asked"))
    return left.where("__asked").drop("__asked")


def interval_lookup(df: DataFrame, ranges: DataFrame, key: ColumnOrName, lo: str, hi: str,
                    cols: Sequence[str], seq: str | None = None) -> DataFrame:
    """Range join of rows to a table of ranges (E9) for number, text and time keys: `cols` of the first
    range that holds the key, both bounds included (first by `seq`, else by the lowest bounds, then by
    `cols`); a null bound is open. A row never becomes two, rows without a range get NULLs, and
    a range with `lo > hi` holds nothing.

    Ranges may overlap, nest, repeat and cover everything: with a `seq`, those that come after others wherever they
    hold keys go before anything is moved (`ranges_in_question`); of those with equal bounds the first is kept,
    `range_winners` sweeps these against the distinct keys, and rows look their key's range up by equality."""
    k = _c(key)
    kinds = {_kind(f.dataType) for f in df.select(k.alias("v")).schema} | {_kind(ranges.schema[c].dataType) for c in (lo, hi)}
    if len(kinds) > 1:
        raise TypeError(f"interval_lookup: key and bounds are of different kinds: {sorted(kinds)}")
    # of ranges with the same bounds one counts, combined before the shuffle; the bounds then order the ranges of a `seq`
    first = ranges.select((F.col(seq) if seq else F.lit(0)).alias("seq"), F.col(lo).alias("lo"), F.col(hi).alias("hi"),
                          *[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    first = ranges_in_question(df.select(k.alias("v")), first) if seq else first.where("lo is null or hi is null or lo <= hi")
    first = first.groupBy("lo", "hi").agg(F.min(F.struct("seq", *[f"c{i}" for i in range(len(cols))])).alias("r"))
    first = first.select("r.seq", "lo", F.col("hi").isNull().alias("open"), "hi", *[f"r.c{i}" for i in range(len(cols))])
    ranked = place(in_order(first, ["seq", "lo", "open", "hi"]), "rank")
    won = range_winners(df.select(k.alias("v")).where("v is not null").distinct(), ranked.select("rank", "lo", "hi"))
    found = won.hint("merge").join(ranked, "rank").select(F.col("v").alias("__v"), F.lit(0).alias("__t"),
                                            *[F.col(f"c{i}").alias(f"__c{i}") for i in range(len(cols))])
    # null keys match nothing; a spread second key keeps them out of one partition
    rows = df.withColumn("__k", k).withColumn("__s", F.when(k.isNull(), _spread(df)).otherwise(F.lit(0)))
    out = rows.join(found, (F.col("__k") == F.col("__v")) & (F.col("__s") == F.col("__t")), "left")
    return out.select(*[rows[f"`{c}`"] for c in df.columns], *[F.col(f"__c{i}").alias(c) for i, c in enumerate(cols)])


# ----------------------------------------------------------------------- E10
def score_all(df: DataFrame, scored: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Carry scores computed on a subset back to the whole universe (E10); unscored rows
    keep NULLs. The scored side is reduced to one row per key first, so the join can
    neither drop nor multiply universe rows."""
    one = scored.groupBy(key).agg(F.max(F.struct(*cols)).alias("_s")).select(
        key, *[F.col("_s")[c].alias(c) for c in cols])
    return df.join(one, key, "left")


# ----------------------------------------------------------------------- E11
def override_lookup(df: DataFrame, manual: DataFrame, df_key: ColumnOrName, manual_key: str,
                    date_col: str, seq: str, cols: Sequence[str] = (), pad: int | None = None,
                    prefix: str = "manual_") -> DataFrame:
    """Manual overrides joined by padded key (E11): rows whose date does not parse as
    ISO yyyy-MM-dd are dropped, the last row (highest `seq`) per key wins."""
    norm = (lambda c: pad_key(c, pad)) if pad else (lambda c: clean(c))
    d = clean(date_col)
    m = (manual
         .select(norm(F.col(manual_key)).alias("_mk"),
                 F.when(d.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
                        F.try_to_timestamp(d, F.lit("yyyy-MM-dd")).cast("date")).alias(f"{prefix}{date_col}"),
                 *[F.col(c).alias(f"{prefix}{c}") for c in cols], F.col(seq).alias("_seq"))
         .where(F.col(f"{prefix}{date_col}").isNotNull() & F.col("_mk").isNotNull()))
    m = dedupe_last(m, "_mk", "_seq").drop("_seq")
    out = df.withColumn("_mk", norm(_c(df_key))).join(m, "_mk", "left")
    return out.drop("_mk")


# ----------------------------------------------------------------- E12 / E13
def reconcile_keys(spine: DataFrame, spine_key: str, others: Mapping[str, tuple[DataFrame, str]],
                   spine_name: str = "spine") -> DataFrame:
    """Universe reconciliation (E12): for every source, rows, distinct keys, keys matched
    in the spine, spine-only and source-only keys.

    All sources are unioned as (source, key) and aggregated once; the spine's distinct
    keys are joined once; the final per-source table is tiny."""
    parts = [spine.select(F.lit(spine_name).alias("source"), F.col(spine_key).cast("string").alias("_key"))]
    for name, (d, k) in others.items():
        parts.append(d.select(F.lit(name).alias("source"), F.col(k).cast("string").alias("_key")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    per_key = u.where(F.col("_key").isNotNull()).groupBy("source", "_key").agg(F.count(F.lit(1)).alias("_n"))
    spine_keys = (spine.select(F.col(spine_key).cast("string").alias("_key")).where(F.col("_key").isNotNull())
                  .distinct().withColumn("_in_spine", F.lit(True)))
    j = per_key.join(spine_keys, "_key", "left")
    agg = j.groupBy("source").agg(
        F.sum("_n").cast("long").alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("_in_spine").isNotNull()).alias("matched"))
    w = Window.partitionBy()  # over one row per source only
    spine_n = F.max(F.when(F.col("source") == spine_name, F.col("keys"))).over(w)
    return agg.select("source", "rows", "keys", "matched",
                      (spine_n - F.col("matched")).alias("spine_only"),
                      (F.col("keys") - F.col("matched")).alias("source_only"))


def reconcile_pairs(sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Universe reconciliation of every pair of sources (E12): rows (left, right, matched, left_only,
    right_only) of distinct keys, a pair with nothing in it included; pairs in the order of `sources`.

    One aggregate over all keys makes a membership bitmap per key (`bit_or`, combined before the one
    shuffle of keys, so a key of many rows is no hot key); keys of one bitmap are then counted
    together, and all pairs are read off those counts. Keys are compared as trimmed text; blank and
    null keys match nothing (T9) and are no keys."""
    names = list(sources)
    if not 2 <= len(names) <= 62:
        raise ValueError("reconcile_pairs: 2 to 62 sources, one bit of a long each")
    keys = None
    for i, (d, k) in enumerate(sources.values()):
        part = d.select(clean(F.col(f"`{k}`").cast("string")).alias("key"), F.lit(1 << i).cast("long").alias("bit"))
        keys = part if keys is None else keys.unionByName(part)
    members = keys.where("key is not null and key <> ''").groupBy("key").agg(F.bit_or("bit").alias("mask"))
    counts = members.groupBy("mask").agg(F.count(F.lit(1)).alias("n"))
    pairs = [(a, b) for a in range(len(names)) for b in range(a + 1, len(names))]
    inside = [F.col("mask").bitwiseAND(F.lit(1 << i).cast("long")) != 0 for i in range(len(names))]
    sums = []
    for i, (a, b) in enumerate(pairs):
        sums += [F.sum(F.when(c, F.col("n")).otherwise(0)).alias(f"{what}{i}") for what, c in (
            ("m", inside[a] & inside[b]), ("l", inside[a] & ~inside[b]), ("r", inside[b] & ~inside[a]))]
    one = counts.agg(*sums)  # one row, three numbers a pair
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return one.select(F.explode(F.array(*[F.struct(
        F.lit(names[a]).alias("left"), F.lit(names[b]).alias("right"), zero(f"m{i}").alias("matched"),
        zero(f"l{i}").alias("left_only"), zero(f"r{i}").alias("right_only")) for i, (a, b) in enumerate(pairs)])).alias("p")).select("p.*")


def missing_by_group(expected: DataFrame, actual: DataFrame, key, group: str) -> DataFrame:
    """Expected keys absent from `actual`, counted per group."""
    keys = _keys(key)
    return (expected.join(actual.select(*keys).distinct(), keys, "left_anti")
            .groupBy(group).agg(F.count(F.lit(1)).alias("missing")))
