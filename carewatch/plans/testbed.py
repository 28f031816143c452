"""Operators exercised on the driver's test tables.

The domain inputs (nursing-home files) are not available here, so every operator runs on
the star schema: customer/supplier = facility, nation = state, orders = dated penalty
events, lineitem = citations, part = code reference, documents/labels = a partially
matched source, events = landed pages. Each function takes (spark, sf_dir) and returns a
DataFrame over the WHOLE tables; `testbed_sql.SQL` holds the equivalent DuckDB SQL.

Deterministic NULL / sentinel injection uses key arithmetic expressible in both engines
(the test tables have no NULLs of their own); it never filters rows out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import constants as K
from ..functions import expr as X
from ..functions import predicates as P
from ..operators import aggs as A
from ..operators import contracts as C
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import ranking as R
from ..operators import sets as S
from ..sources.catalog import table
from ..sources.readers import literal_table

AS_OF = dt.date(1999, 6, 30)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return table(spark, d, name)


def money(col: str):
    """Money as exact decimal so sums agree bit-for-bit across engines."""
    return F.col(col).cast("decimal(18,2)")


# --------------------------------------------------------------------- star_band
def star_band(spark, d):
    """F1 + E7 + F10: children per parent, zero-filled left join, band means."""
    orders = _t(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    lines = A.count_by(_t(spark, d, "lineitem"), "l_orderkey", out="n_lines", order=None) \
        .withColumnRenamed("l_orderkey", "o_orderkey")
    j = J.left_fill(orders, lines, "o_orderkey", {"n_lines": 0})
    return A.band_means(j, "o_orderpriority", {"n_lines": 4, "o_totalprice": 4}, count_name="n_orders",
                        extra={"n_without_lines": F.count_if(F.col("n_lines") == 0)})


# -------------------------------------------------------------------- predicates
def predicates(spark, d):
    """D3 scope, D4 (negated) prefix, D5 zero-or-null, D8 pattern."""
    c = _t(spark, d, "customer")
    bal = (F.when(F.col("c_custkey") % 7 == 0, F.lit(None).cast("double"))
            .when(F.col("c_custkey") % 11 == 0, F.lit(0.0)).otherwise(F.col("c_acctbal")))
    key3 = P.matches(F.col("c_custkey").cast("string"), r"^[0-9]{3}$")
    in_scope = P.scope_eq("c_mktsegment", " building ")
    out = c.select("c_custkey", "c_name", in_scope.alias("in_scope"), key3.alias("key3"),
                   P.zero_or_null(bal).alias("bal_missing"))
    out = out.where(F.col("in_scope") | F.col("key3"))
    return P.where_prefix(out, "c_name", ["Customer#00000000"], negate=True).drop("c_name")


# ------------------------------------------------------------- code_filter_lookup
TYPE_GROUPS = [("ECONOMY", "budget"), ("PROMO", "budget"), ("LARGE", "bulk"), ("SMALL", "compact")]


def code_filter_lookup(spark, d):
    """D1 code list with an 'active' condition, D2 presence, E1 lookup, E6 literal lookup
    with default, A11 literal table."""
    codes = literal_table(spark, TYPE_GROUPS, "p_type string, type_group string")
    # the codes are clean in the file, so the list reaches the scan
    parts = P.where_in(_t(spark, d, "part"), "p_type", [c for c, _ in TYPE_GROUPS],
                       active=F.col("p_size") > 10, normalize=False).select(F.col("p_partkey").alias("l_partkey"), "p_type")
    lines = P.where_present(_t(spark, d, "lineitem"), "l_returnflag").select("l_partkey", "l_quantity", "l_returnflag")
    j = J.lookup(lines, parts, "l_partkey", ["p_type"])
    j = J.lookup(j, codes, "p_type", ["type_group"], defaults={"type_group": "other"})
    return j.groupBy("type_group", "l_returnflag").agg(F.count(F.lit(1)).alias("n_lines"),
                                                       F.sum("l_quantity").alias("sum_qty"))


# ------------------------------------------------------------------ bucket_counts
SEGMENT_BUCKETS = ["BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD"]


def bucket_counts(spark, d):
    """F2 exact distinct counts + F3 conditional buckets + 'other' (T14)."""
    c = _t(spark, d, "customer")
    buckets = {s.lower(): F.col("c_mktsegment") == s for s in SEGMENT_BUCKETS}
    buckets["neg_balance"] = F.col("c_acctbal") < 0
    buckets["high_balance"] = F.col("c_acctbal") >= 5000
    return A.bucket_counts(c, "c_nationkey", buckets,
                           distinct={"distinct_customers": "c_custkey", "distinct_segments": "c_mktsegment"},
                           other="other")


# ------------------------------------------------------------- weighted_rate_rank
def _customer_revenue(spark, d) -> DataFrame:
    per = _t(spark, d, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(money("o_totalprice")).alias("revenue"))
    c = _t(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey",
        (F.col("c_mktsegment") == "HOUSEHOLD").cast("int").alias("flag"))
    return c.join(per, "o_custkey", "left")


def weighted_rate_rank(spark, d):
    """D6 rankable rows, F5 ratio of sums, G1 rank ascending (scalable, no global window)."""
    rankable = P.where_rankable(_customer_revenue(spark, d), "flag", "n_orders")
    rates = A.weighted_rate(rankable, "c_nationkey", "revenue", "n_orders", scale=1.0, digits=2,
                            out="revenue_per_order")
    rates = rates.select("c_nationkey", F.col("sum_revenue").cast("double").alias("sum_revenue"),
                         "sum_n_orders", "revenue_per_order")
    return R.rank_by(rates, "revenue_per_order", asc=True, out="access_rank")


def naive_vs_weighted(spark, d):
    """the ratio of sums next to the (wrong) mean of ratios."""
    cr = _customer_revenue(spark, d).where(F.col("n_orders").isNotNull())
    per_row = F.col("revenue").cast("double") / F.col("n_orders")
    return cr.groupBy("c_nationkey").agg(
        F.round(A.rate_of_sums(F.col("revenue"), F.col("n_orders")), 2).alias("weighted"),
        F.round(F.avg(per_row), 2).alias("naive")).withColumn(
        "differs", F.col("weighted") != F.col("naive"))


# ---------------------------------------------------------------- small_flag_label
def small_flag_label(spark, d, threshold: int = 60):
    """E2 two context joins (population, military flag), K15 guarded ratio, K23 small
    denominator, K22 precedence label."""
    z = _t(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("nk")).agg(F.count(F.lit(1)).alias("providers"))
    nat = _t(spark, d, "nation").select(F.col("n_nationkey").alias("nk"), "n_name")
    pop = _t(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nk")) \
        .agg(F.count(F.lit(1)).alias("population"))
    mil = _t(spark, d, "nation").where(F.col("n_regionkey") == 4).select(F.col("n_nationkey").alias("nk"))
    base = z.join(nat, "nk", "left")
    e = J.enrich(base, "nk", pop, ["population"], flag_ref=mil, flag_name="military_flag")
    return e.select(
        "nk", "n_name", "providers", "population", "military_flag",
        X.small_flag("population", threshold).cast("int").alias("small_denominator_flag"),
        X.reliability_label("n_name", F.col("military_flag") == 1, "population", threshold).alias("label"),
        X.ratio("providers", "population", 1000, 2, guard=F.col("population") > 0).alias("providers_per_thousand"))


# ---------------------------------------------------------------- sentinel_numbers
def sentinel_text(key: str, value: str):
    v = F.col(value).cast("decimal(18,2)").cast("string")
    k = F.col(key)
    return (F.when(k % 7 == 0, F.lit("---")).when(k % 11 == 0, F.lit("N/A"))
             .when(k % 13 == 0, F.lit("")).when(k % 17 == 0, F.concat(F.lit("$"), v))
             .when(k % 19 == 0, F.lit("5d")).when(k % 23 == 0, F.lit("1_000"))
             .when(k % 29 == 0, F.concat(F.lit("  "), v, F.lit(" ")))
             .otherwise(v))


def sentinel_numbers(spark, d):
    """K1 sentinel-aware parse (NULL and zero policies, strict pattern T2), K2 finite,
    D7 numeric predicate on text."""
    o = _t(spark, d, "orders").select("o_orderkey", sentinel_text("o_orderkey", "o_totalprice").alias("price_text"))
    sent = ["", "---", "N/A", "Not Available"]
    return o.select("o_orderkey", "price_text",
                    X.num("price_text", sent).alias("price"),
                    X.num("price_text", sent, on_missing=0).alias("price_or_zero"),
                    X.finite(X.num("price_text", sent)).alias("price_finite"),
                    P.num_cmp("price_text", ">", 300000).alias("is_big"))


# ------------------------------------------------------------------------ pad_keys
def pad_keys(spark, d):
    """K3 zero-pad without truncation (blank -> NULL, parity mode '000000'), K4 first
    five characters, K5 whitespace cleaning."""
    k = F.col("c_custkey")
    raw = (F.when(k % 10 == 0, F.lit(""))
            .when(k % 3 == 0, F.concat(F.lit("  "), (k * 997).cast("string"), F.lit(" ")))
            .otherwise((k * 997).cast("string")))
    c = _t(spark, d, "customer").select("c_custkey", raw.alias("raw_key"))
    return c.select("c_custkey", X.pad_key("raw_key", 6).alias("padded"),
                    X.pad_key("raw_key", 6, blank="000000").alias("padded_parity"),
                    X.zip5("raw_key").alias("zip5"), X.clean("raw_key").alias("cleaned"))


# ------------------------------------------------------------------------ hub_build
def hub_build(spark, d):
    """E3 hub: spine left-joined to several sources on normalised (padded) keys with one
    match flag per source; E4 optional source absent; J13 keeps the spine count."""
    spine = _t(spark, d, "documents").select("doc_id", "lang")
    sources = [
        J.Source("labels", _t(spark, d, "labels"), "doc_id", "doc_id", ["quality", "toxic"], "label_matched", pad=8),
        J.Source("pages", _t(spark, d, "pages"), "doc_id", "page_id", ["url"], "page_matched", pad=8),
        J.Source("embeddings", None, "doc_id", "vec_id", ["label"], optional=True),
    ]
    return J.build_hub(spine, sources)


def match_rates(spark, d):
    """F17 match rate by group."""
    hub = J.build_hub(_t(spark, d, "documents").select("doc_id", "lang"),
                      [J.Source("labels", _t(spark, d, "labels"), "doc_id", "doc_id", [], "label_matched")])
    return A.match_rate(hub, "label_matched", by="lang")


# ------------------------------------------------------------------ lookup_or_self
def lookup_or_self(spark, d):
    """E5: reference value when the key is in the reference, else the row's own value,
    with a matched flag for miss counting."""
    ref = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("l_partkey"), F.col("s_name").alias("p_name"))
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                         F.concat(F.lit("part-"), F.col("l_partkey").cast("string")).alias("own_name"))
    out = J.lookup_or_self(li, ref, "l_partkey", {"part_name": ("p_name", "own_name")}, matched="ref_matched")
    return out.drop("own_name")


# ----------------------------------------------------------------- override_lookup
def override_lookup(spark, d):
    """E11 manual overrides: unparsable dates dropped, last row per key (by sequence)
    wins; G6 dedupe by aggregate."""
    o = _t(spark, d, "orders")
    manual = o.select(F.col("o_custkey").cast("string").alias("ccn"),
                      F.when(F.col("o_orderkey") % 9 == 0, F.lit("not a date"))
                       .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("term_date"),
                      F.col("o_orderpriority").alias("source"), F.col("o_orderkey").alias("seq"))
    c = _t(spark, d, "customer").select("c_custkey")
    return J.override_lookup(c, manual, F.col("c_custkey").cast("string"), "ccn", "term_date", "seq",
                             cols=["source"])


# --------------------------------------------------------------------- outer_merge
def outer_merge(spark, d):
    """E8 full outer merge of three tables whose keys overlap in part, in one shuffle; I2
    union of keys."""
    cust = _t(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("k"), "c_acctbal")
    supp = _t(spark, d, "supplier").select((F.col("s_suppkey") * 31).cast("long").alias("k"), "s_name")
    nat = _t(spark, d, "nation").select((F.col("n_nationkey") * -3).cast("long").alias("k"), "n_name")
    return J.outer_merge([cust, supp, nat], "k")


# ------------------------------------------------------------------ interval_lookup
def _codes(spark, d) -> DataFrame:
    p = _t(spark, d, "part")
    code = F.concat(F.upper(F.substring("p_name", 1, 1)), F.lpad(F.col("p_size").cast("string"), 2, "0"),
                    (F.col("p_partkey") % 10).cast("string"))
    return p.select("p_partkey", code.alias("code"))


def interval_lookup(spark, d):
    """E9 range lookup as an ordered CASE ladder over literal ranges; K8 dotted codes;
    K24 prefix range/membership flags."""
    c = _codes(spark, d)
    ch = J.interval_label(X.category3("code"), K.ICD10_CHAPTERS, default="Unknown")
    flags = X.prefix_flags("code")
    return c.select("p_partkey", "code", X.dot_code("code").alias("dotted"),
                    X.undot_code(X.dot_code("code")).alias("undotted"),
                    ch["label"].alias("chapter"),
                    F.when(ch["label"] == "Unknown", F.lit("")).otherwise(ch["extra_0"]).alias("chapter_title"),
                    *[v.alias(k) for k, v in flags.items()])


# -------------------------------------------------------------- reconcile_universes
def reconcile_universes(spark, d):
    """E12 universe reconciliation across three sources in one union + aggregate."""
    spine = _t(spark, d, "customer")
    return J.reconcile_keys(spine, "c_custkey", {"orders": (_t(spark, d, "orders"), "o_custkey"),
                                                 "supplier": (_t(spark, d, "supplier"), "s_suppkey")})


def missing_by_group(spark, d):
    """Customers whose key no supplier has, counted per nation."""
    return J.missing_by_group(_t(spark, d, "customer"),
                              _t(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey")),
                              "c_custkey", "c_nationkey")


# --------------------------------------------------------------------- event_rollup
def event_rollup(spark, d):
    """F7 per-key event roll-up: counts by type words (K9), sum with 0 default (T21),
    latest date, first row's status by sequence (T18)."""
    o = _t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus",
                                      money("o_totalprice").alias("amount"),
                                      F.col("o_orderdate").cast("date").alias("order_date"))
    return A.event_rollup(o, "o_custkey", "o_orderpriority", "amount", "order_date", "o_orderkey",
                          name_col="o_orderstatus", fine_words=("urgent",), denial_words=("high", "low"))


# ------------------------------------------------------------------------ any_flags
def any_flags(spark, d):
    """F8 'any row has flag' over Y/N text, individual count."""
    li = _t(spark, d, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("returned"),
        F.when(F.col("l_linestatus") == "O", " y").otherwise("N").alias("open"),
        F.when(F.col("l_linenumber") == 1, "I").otherwise("O").alias("owner_type"))
    return A.any_flags(li, "l_orderkey", ["returned", "open"], type_col="owner_type")


# -------------------------------------------------------------------- score_summary
def score_summary(spark, d):
    """F9 state score summary with K19 direction counts."""
    o = _t(spark, d, "orders").join(
        _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    o = o.select("c_nationkey", (F.col("o_totalprice") / 1000).alias("score"),
                 X.direction(F.col("o_totalprice") / 200000).alias("direction"))
    return A.score_summary(o, "c_nationkey", "score", 1, {
        "n_bonus": F.col("direction") == "BONUS", "n_penalty": F.col("direction") == "PENALTY",
        "n_neutral": F.col("direction") == "NEUTRAL"})


# --------------------------------------------------------------- quartiles_by_group
def quartiles_by_group(spark, d):
    """F12 exact interpolated quartiles per group from the cumulative-count table; F13
    count beyond a threshold."""
    o = _t(spark, d, "orders")
    q = A.quartiles(o, "o_totalprice", by="o_orderpriority")
    below = o.groupBy("o_orderpriority").agg(F.count_if(F.col("o_totalprice") < 50000).alias("n_below"))
    return q.join(below, "o_orderpriority").select(
        "o_orderpriority", "n", *[F.round(c, 4).alias(c) for c in ("q25", "median", "q75")], "n_below")


# ------------------------------------------------------------------ pct ranks G2 G3
def _scores(spark, d) -> DataFrame:
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_discount")
    return li.withColumn("score", F.when(F.col("l_orderkey") % 13 == 0, F.lit(None).cast("double"))
                         .otherwise(F.col("l_discount"))).drop("l_discount")


def pct_rank_national(spark, d):
    """G2 average-rank percentile over all rows (T4), scored rows only (T6), E10 the
    unscored rows kept with NULL."""
    return R.pct_rank_avg(_scores(spark, d), "score", out="national_pct_rank").drop("l_suppkey")


def pct_rank_state(spark, d):
    """G3 the same within state (supplier nation)."""
    s = _scores(spark, d).join(
        _t(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"),
        "l_suppkey", "left")
    return R.pct_rank_avg(s, "score", by="s_nationkey", out="state_pct_rank").drop("l_suppkey")


# ------------------------------------------------------------------- quartile_tiers
def _order_scores(spark, d) -> DataFrame:
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", F.when(
        F.col("o_orderkey") % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("score"))
    return o.join(_t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"),
                  "o_custkey").drop("o_custkey")


def quartile_tiers(spark, d):
    """G4 quartile tiers with <= edges, national and within nation; NULL scores keep a
    NULL tier (T5, T6)."""
    s = _order_scores(spark, d)
    per_nation = R.distinct_value_counts(s, "score", "c_nationkey")  # national = its roll-up
    s = R.quartile_tier(s, "score", out="national_tier", counts=R.rollup_counts(per_nation, "score"))
    # nations are a fixed small domain
    return R.quartile_tier(s, "score", by="c_nationkey", out="nation_tier", counts=per_nation)


# ---------------------------------------------------------------------- position_of
def _nation_revenue(spark, d) -> DataFrame:
    o = _t(spark, d, "orders").join(
        _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    return o.groupBy("c_nationkey").agg(F.sum(money("o_totalprice")).cast("double").alias("revenue"))


def position_of(spark, d, focus: int = 7):
    """G5 position of one key after a descending sort with tie-break, no global sort."""
    return R.position_of(_nation_revenue(spark, d), "c_nationkey", "revenue", focus)


# ------------------------------------------------------------------ top_n_per_scope
def top_n_per_scope(spark, d, n: int = 5):
    """G7 top and bottom n per scope with tie-break (partial WindowGroupLimit before the
    shuffle)."""
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").join(
        _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey") \
        .drop("o_custkey")
    top = R.top_n(o, "o_totalprice", n, "c_nationkey", asc=False, tie_break=["o_orderkey"]).withColumn("which", F.lit("top"))
    bot = R.top_n(o, "o_totalprice", n, "c_nationkey", asc=True, tie_break=["o_orderkey"]).withColumn("which", F.lit("bottom"))
    return top.unionByName(bot)


# ---------------------------------------------------------------------- dedupe_keep
def dedupe_keep(spark, d):
    """G6 first event per user by (ts, event_id) as a min-struct aggregate."""
    e = _t(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return R.dedupe_keep(e, "user_id", ["ts", "event_id"], keep="first")


# ----------------------------------------------------------------- value_counts_top
def value_counts_top(spark, d, n: int = 10):
    """H5 most frequent values, top n with value tie-break (the limit is the feature)."""
    return R.value_counts(_t(spark, d, "part"), "p_name", n)


# ------------------------------------------------------------------------ sort_nulls
def sort_nulls(spark, d, k: int = 20):
    """H2 nlargest on a numeric parse of text, H3 mixed directions with explicit null
    placement, H4 numeric order of text, H6 key order."""
    o = _t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, F.lit(None).cast("string"))
                                      .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
                                      .alias("price_text"))
    o = o.withColumn("price_num", X.num("price_text"))
    return R.sort_rows(o, [("price_num", "desc", "last"), ("o_orderkey", "asc", "last")]).limit(k)


# ------------------------------------------------------------------ benchmark_compare
def _benchmarks(spark, d) -> DataFrame:
    c = _t(spark, d, "customer").withColumn("state", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")))
    aggs = [F.round(F.avg("c_acctbal"), 4).alias("avg_balance"),
            F.count(F.lit(1)).cast("double").alias("n_customers"),
            F.round(F.avg((F.col("c_mktsegment") == "BUILDING").cast("double")), 4).alias("share_building")]
    per = c.groupBy("state").agg(*aggs)
    nat = c.agg(*aggs).select(F.lit("NATION").alias("state"), "*")
    return per.unionByName(nat)


def benchmark_compare(spark, d, focus: str = "NATION_3"):
    """F22 one group vs the national row, metric by metric with HIGHER/LOWER/'' (T38)."""
    return A.compare_to_benchmark(_benchmarks(spark, d), "state", focus, "NATION",
                                  ["avg_balance", "n_customers", "share_building"])


# ------------------------------------------------------------------- union_sources
UNION_SCHEMA = [("key", "bigint"), ("name", "string"), ("nationkey", "int"), ("acctbal", "double"),
                ("segment", "string")]


def union_sources(spark, d):
    """I1 union of differently shaped sources: C2 rename maps, C4 alignment, C8 stamp."""
    renames = {"customer": {"c_custkey": "key", "c_name": "name", "c_nationkey": "nationkey",
                            "c_acctbal": "acctbal", "c_mktsegment": "segment"},
               "supplier": {"s_suppkey": "key", "s_name": "name", "s_nationkey": "nationkey",
                            "s_acctbal": "acctbal"}}
    u = S.union_sources([(_t(spark, d, "customer"), "customer"), (_t(spark, d, "supplier"), "supplier")],
                        UNION_SCHEMA, renames)
    return C.stamp(u, vintage="2024")


def required_members(spark, d):
    """I4 required values present or not."""
    return S.required_members(_t(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "6-NONE"])


# ------------------------------------------------------------------- row_sum_flags
def row_sum_flags(spark, d):
    """F14 row-wise sum (NULL only when all NULL), K18 pair flag, K16/K17 threshold flags."""
    li = _t(spark, d, "lineitem")
    a = F.when(F.col("l_orderkey") % 3 == 0, F.lit(None).cast("double")).otherwise(F.col("l_quantity"))
    b = F.when(F.col("l_orderkey") % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("l_tax") * 100)
    li = li.select("l_orderkey", "l_linenumber", a.alias("a"), b.alias("b"))
    return li.select("l_orderkey", "l_linenumber", "a", "b", X.row_sum(["a", "b"]).alias("total"),
                     X.pair_sum_flag("a", "b", 30).alias("pair_flag"),
                     X.gt_flag("a", 25).alias("gt_false"), X.gt_flag("a", 25, missing=None).alias("gt_null"))


# ------------------------------------------------------------------- four_part_test
FOUR_PART_MINIMUMS = {"l_quantity": 10.0, "discount": 0.02, "l_tax": 0.01, "l_extendedprice": 5000.0}


def four_part_test(spark, d):
    """K13 multi-part minimum test: tri-state parts, False overall when any part is
    missing (T7), count of missing parts."""
    li = _t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_extendedprice",
        F.when(F.col("l_orderkey") % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("l_discount")).alias("discount"))
    parts = X.meets_all(FOUR_PART_MINIMUMS)
    return li.select("l_orderkey", "l_linenumber", *[v.alias(k) for k, v in parts.items()])


# ------------------------------------------------------------ severity_grid / tiers
def severity_grid(spark, d):
    """K10 scope/severity grid, K12 jeopardy / harm flags (letters A-M; M is unknown)."""
    li = _t(spark, d, "lineitem")
    pos = ((F.col("l_orderkey") + F.col("l_linenumber")) % 13 + 1).cast("int")
    li = li.select("l_orderkey", "l_linenumber", F.lit("ABCDEFGHIJKLM").substr(pos, F.lit(1)).alias("code"))
    g = X.severity_grid("code")
    li = li.select("*", *[v.alias(k) for k, v in g.items()])
    f = X.level_flags("code", "severity_level")
    return li.select("*", *[v.alias(k) for k, v in f.items()])


EXCLUSION_SAMPLES = ["1128a1", " 1128 B4 ", "1156", "XYZ", "", "1128a2"]
FOOTNOTES = ["", "---", "Below case minimum", "Other text"]


def code_tiers(spark, d):
    """K11 code -> tier with default, K21 footnote suppression reason."""
    p = _t(spark, d, "part")
    k = F.col("p_partkey")
    code = F.element_at(F.array(*[F.lit(x) for x in EXCLUSION_SAMPLES]), (k % len(EXCLUSION_SAMPLES) + 1).cast("int"))
    note = F.element_at(F.array(*[F.lit(x) for x in FOOTNOTES]), (k % len(FOOTNOTES) + 1).cast("int"))
    p = p.select("p_partkey", code.alias("code"), note.alias("footnote"))
    return p.select("p_partkey", "code", X.code_tier("code").alias("tier"),
                    X.suppression("footnote").alias("suppression"))


# ------------------------------------------------------------------ ratios_rounding
def ratios_rounding(spark, d):
    """K15 guarded ratio, K20 delta (half-even), K31 half-up vs half-even on exact
    binary ties."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_discount")
    r = X.ratio("l_tax", "l_discount", 100)
    return li.select("l_orderkey", "l_linenumber", X.round_to(r, 2).alias("tax_per_discount"),
                     X.round_half_up(r, 0).alias("half_up"), X.round_half_even(r, 0).alias("half_even"),
                     X.delta("l_tax", "l_discount").alias("delta"))


# ----------------------------------------------------------------------- text_codes
def text_codes(spark, d):
    """K6 URI, K7 composite code, K14 presence flag, K32 individual / real-id tests,
    K33 differs."""
    p = _t(spark, d, "part")
    k = F.col("p_partkey")
    name = F.when(k % 6 == 0, F.lit("N/A")).when(k % 9 == 0, F.lit(" ")).otherwise(F.col("p_name"))
    npi = F.when(k % 8 == 0, F.lit("0000000000")).when(k % 15 == 0, F.lit("")).otherwise(F.lpad(k.cast("string"), 10, "1"))
    practice = F.lpad((F.col("p_size") % 10).cast("string"), 5, "0")
    mailing = F.when(k % 4 == 0, F.lit("")).otherwise(F.lpad((k % 10).cast("string"), 5, "0"))
    p = p.select("p_partkey", "p_brand", "p_type", name.alias("name"), npi.alias("npi"),
                 F.when(F.col("p_size") % 2 == 0, "I").otherwise("O").alias("owner_type"),
                 practice.alias("practice_zip"), mailing.alias("mailing_zip"))
    return p.select("p_partkey", X.uri("https://example.org/part/", "npi").alias("npi_uri"),
                    X.join_code("p_brand", "p_type").alias("brand_type"),
                    X.yn_present("name").alias("has_name"), X.is_individual("owner_type").alias("is_individual"),
                    X.has_real_id("npi").alias("has_real_id"),
                    X.differs("mailing_zip", "practice_zip").alias("multi_location"))


# ------------------------------------------------------------------- calendar_alerts
FY_SAMPLES = ["13-01", "Not Available", "02-30", "", "2-29"]


def calendar_alerts(spark, d, as_of: dt.date = AS_OF):
    """K25-K29 compliance calendar: licence alert from a term date, next staffing-report
    deadline, cost-report due date from a fiscal year end text, worst alert; K30 year.
    Built in stages (one column per step) so no date expression is evaluated twice."""
    o = _t(spark, d, "orders")
    k = F.col("o_orderkey")
    odate = F.col("o_orderdate").cast("date")
    fy = F.when(k % 10 < len(FY_SAMPLES), F.element_at(F.array(*[F.lit(x) for x in FY_SAMPLES]),
                                                        (k % 10 + 1).cast("int"))) \
          .otherwise(F.date_format(odate, "MM-dd"))
    o = o.select("o_orderkey", (F.col("o_orderpriority") == "1-URGENT").alias("is_snf"), odate.alias("odate"),
                 fy.alias("fy_text"))
    o = o.withColumn("term", F.date_add("odate", 365))
    nd = cal.next_deadline(as_of)  # constant-folded: as_of is a literal
    o = o.withColumns({"license_alert": cal.alert("term", F.date_sub("term", K.STATE_LICENSE_ACTION_LEAD), as_of),
                       "pbj_deadline": nd["deadline"], "pbj_action": nd["action_date"], "pbj_label": nd["deadline_label"]})
    o = cal.with_fy_bounds(o, "fy_text", as_of)
    o = o.withColumn("due", cal.month_end_after("fy_end_next"))
    is_snf = F.col("is_snf")
    out = o.select(
        "o_orderkey", "license_alert",
        F.when(is_snf, cal.alert("pbj_deadline", "pbj_action", as_of)).otherwise(F.lit("N_A")).alias("pbj_alert"),
        F.when(is_snf, F.col("pbj_label")).otherwise(F.lit("")).alias("pbj_quarter"),
        F.when(is_snf, F.col("fy_end_next")).alias("fy_end_next"),
        F.when(is_snf, F.col("due")).alias("cost_report_due"),
        F.when(~is_snf, F.lit("N_A")).otherwise(
            cal.alert("due", F.date_sub("due", K.COST_REPORT_ACTION_LEAD), as_of)).alias("cost_report_alert"),
        X.year4(F.date_format("odate", "yyyy-MM-dd")).alias("order_year"))
    return out.withColumn("overall_alert", cal.worst("license_alert", "pbj_alert", "cost_report_alert"))


def hotlist(spark, d, as_of: dt.date = AS_OF):
    """H3 urgent subset (D1 on alert labels) sorted by severity then key.
    It reads the finished calendar, as it does when the calendar is a file."""
    c = R.materialize(calendar_alerts(spark, d, as_of), "checkpoint")
    h = P.where_in(c, "overall_alert", ["OVERDUE", "CRITICAL", "WARNING"], normalize=False)
    h = h.withColumn("priority", cal.alert_priority("overall_alert"))
    return R.sort_rows(h.select("o_orderkey", "overall_alert", "priority", "cost_report_due"),
                       [("priority", "desc", "last"), ("cost_report_due", "asc", "last"), ("o_orderkey", "asc", "last")])


# ------------------------------------------------------------------------- checks
def check_counts(spark, d):
    """J1 registered count ranges overall and for sub-populations."""
    li = _t(spark, d, "lineitem")
    return Q.check_counts(li, [("all_rows", None, 1, 10 ** 12), ("returned", F.col("l_returnflag") == "R", 1, 10 ** 12),
                               ("big_qty", F.col("l_quantity") > 45, 0, 100)])


def check_ranges(spark, d):
    """J15 / F21 warn-vs-fail range checks with min and max."""
    return Q.check_ranges(_t(spark, d, "lineitem"), [("discount", "l_discount", 0.0, 0.1, "fail"),
                                                     ("tax", "l_tax", 0.0, 0.05, "warn"),
                                                     ("quantity", "l_quantity", 1.0, None, "fail")])


def singleton_nonempty(spark, d):
    """J17 exactly-one-row and J5 non-empty checks."""
    n = _t(spark, d, "nation")
    return Q.check_singleton(n, F.col("n_name") == "NATION_3", "nation_3_singleton").unionByName(
        Q.check_nonempty(n, "nation_nonempty").select(
            "check", F.lit(None).cast("long").alias("value"), "ok"))


# ------------------------------------------------------------------ profile checks
def profiled_frame(spark, d) -> DataFrame:
    """Customer with injected blanks: ~95% blank, constant, 40% numeric text columns."""
    c = _t(spark, d, "customer")
    k = F.col("c_custkey")
    return c.select(
        "c_custkey", "c_mktsegment",
        F.when(k % 20 == 0, F.col("c_name")).otherwise(F.lit("")).alias("sparse_name"),
        F.lit("x").alias("const_col"),
        F.when(k % 5 < 3, F.lit("n/a-text")).otherwise(F.col("c_acctbal").cast("string")).alias("balance_rate"))


def null_rates(spark, d):
    """J2 null rate per column with blank words counted."""
    return Q.null_rates(profiled_frame(spark, d), "customer_x")


def constant_columns(spark, d):
    """J3 constant columns over at least 100 rows."""
    return Q.constant_columns(profiled_frame(spark, d), "customer_x").drop("min_value")


def type_anomalies(spark, d):
    """J4 numeric-by-name columns that parse below 50%."""
    return Q.type_anomalies(profiled_frame(spark, d), "customer_x")


KNOWN_ANOMALIES = [("customer_x", "const_col", "constant_value"), ("customer_x", "ghost_field", "null_rate")]
FINDING_FIELDS = [("customer_x", "sparse_name")]


def suppress_and_tier(spark, d):
    """J7 suppressions, J8 BLOCKING/LATENT tier by exact finding fields, J6/C7 field
    set diff folded in as 'schema' findings."""
    p = Q.profile(profiled_frame(spark, d), "customer_x", numeric_hints=("rate",), materialize="checkpoint")
    findings = Q.findings_from_profile(p).select("dataset", "check", "field")
    diff = C.schema_diff(profiled_frame(spark, d), ["c_custkey", "c_mktsegment", "sparse_name", "const_col", "c_phone"],
                         computed=["balance_rate"]).where(F.col("status") != "present")
    findings = findings.unionByName(diff.select(F.lit("customer_x").alias("dataset"),
                                                F.concat(F.lit("field_"), F.col("status")).alias("check"), "field"))
    known = literal_table(spark, KNOWN_ANOMALIES, "dataset string, field string, check string")
    ff = literal_table(spark, FINDING_FIELDS, "dataset string, field string")
    kept = Q.apply_suppressions(findings, known)
    return Q.classify(kept, ff)


def findings_summary(spark, d):
    """J12 totals per severity plus suppressed count; J7 ghost suppressions counted."""
    p = Q.profile(profiled_frame(spark, d), "customer_x", numeric_hints=("rate",), materialize="checkpoint")
    findings = Q.findings_from_profile(p).select("dataset", "check", "field")
    known = literal_table(spark, KNOWN_ANOMALIES, "dataset string, field string, check string")
    ff = literal_table(spark, FINDING_FIELDS, "dataset string, field string")
    cls = Q.classify(Q.apply_suppressions(findings, known), ff)
    s = Q.findings_summary(cls, Q.suppressed_findings(findings, known))
    fields = literal_table(spark, [("customer_x", c) for c in profiled_frame(spark, d).columns], "dataset string, field string")
    ghosts = Q.ghost_suppressions(known, fields).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("GHOST").alias("severity"), "n")
    return s.unionByName(ghosts)


def drift(spark, d):
    """J9 profiles of two vintages, J10 drift signals."""
    s, c = _t(spark, d, "supplier"), _t(spark, d, "customer")
    prev = Q.profile(s.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"), F.lit("x").alias("segment"),
                              "s_name", F.col("s_name").alias("note")), "party", materialize="checkpoint")
    curr = Q.profile(c.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"),
                              F.col("c_mktsegment").alias("segment"), "c_name", F.lit("").alias("note")), "party",
                     materialize="checkpoint")
    return Q.drift(prev, curr, row_pct=0.05, null_at=0.96).select("dataset", "field", "signal")


def cross_source(spark, d):
    """J11 paired datasets must agree in row count within 0.1%."""
    sp = spark
    counts = (_t(sp, d, "customer").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("customer").alias("dataset"), "rows")
              .unionByName(_t(sp, d, "orders").agg(F.count_distinct("o_custkey").alias("rows"))
                           .select(F.lit("ordering_customers").alias("dataset"), "rows"))
              .unionByName(_t(sp, d, "orders").agg(F.count(F.lit(1)).alias("rows"))
                           .select(F.lit("orders").alias("dataset"), "rows"))
              .unionByName(_t(sp, d, "lineitem").agg(F.count_distinct("l_orderkey").alias("rows"))
                           .select(F.lit("ordered_lines").alias("dataset"), "rows")))
    pairs = literal_table(sp, [("customer", "ordering_customers"), ("orders", "ordered_lines")], "left string, right string")
    return Q.cross_source(counts, pairs)


def vintage_changes(spark, d):
    """J21 two vintages of one keyed table (customers, then suppliers under keys of their
    own): added, removed and changed values."""
    prev = _t(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("k"), F.col("c_name").alias("name"),
                                           F.col("c_nationkey").alias("nation"))
    curr = _t(spark, d, "supplier").select((F.col("s_suppkey") * 31).cast("long").alias("k"), F.col("s_name").alias("name"),
                                           F.col("s_nationkey").alias("nation"))
    return Q.vintage_changes(prev, curr, "k", ["name", "nation"])


def unique_keys(spark, d):
    """J14 duplicate composite keys."""
    return Q.check_unique(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


EXPECTED_BANDS = [(p, "n_orders", 3000.0, 10.0) for p in
                  ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]]


def expected_bands(spark, d):
    """J16 expected-value regression (+/- tolerance) on the star-band aggregate."""
    exp = literal_table(spark, EXPECTED_BANDS, "o_orderpriority string, metric string, expected double, tol_pct double")
    return Q.check_expected(star_band(spark, d), "o_orderpriority", exp, ["n_orders"])


# ------------------------------------------------------------------------ page_audit
PAGE_SIZE = 3


def landed_pages(spark, d) -> DataFrame:
    """Labels as API pages over all documents (count + results), then parsed back (A6 round
    trip). Labels cover some documents only, so pages are short or missing. A page holds at
    most PAGE_SIZE records, so collect_list is bounded."""
    total = _t(spark, d, "documents").agg(F.count(F.lit(1)).alias("declared"))
    e = _t(spark, d, "labels").withColumn("offset", (F.floor(F.col("doc_id") / PAGE_SIZE) * PAGE_SIZE).cast("long"))
    pages = e.groupBy("offset").agg(F.collect_list(F.struct(F.col("doc_id").cast("string").alias("event_id"),
                                                            F.col("toxic").cast("string").alias("event_type"))).alias("results"))
    pages = pages.withColumn("_g", F.lit(0)).join(F.broadcast(total.withColumn("_g", F.lit(0))), "_g").drop("_g")
    js = pages.select("offset", F.to_json(F.struct(F.col("declared").alias("count"), "results")).alias("page"))
    rec_t = "struct<count:bigint, results:array<struct<event_id:string, event_type:string>>>"
    parsed = js.select("offset", F.from_json("page", rec_t).alias("p"))
    return parsed.select(F.lit("labels").alias("dataset"), "offset", F.col("p.count").alias("declared"),
                         F.size("p.results").cast("long").alias("n_rows"))


def page_audit(spark, d):
    """J18 page completeness: declared vs landed rows, missing offsets, short pages."""
    return Q.audit_pages(landed_pages(spark, d), PAGE_SIZE)


def json_props(spark, d):
    """A6 JSON scalar parse: mean of props.k per event type."""
    e = _t(spark, d, "events").select("event_type", F.from_json("props", "k long").alias("p"))
    return e.groupBy("event_type").agg(F.round(F.avg("p.k"), 4).alias("mean_k"), F.count("p.k").alias("n"))


# ------------------------------------------------------------ reconcile / figures
def reconcile_totals(spark, d):
    """J19 detail roll-up vs pre-aggregated totals: lines counted per order, and the highest
    line number an order states."""
    li = _t(spark, d, "lineitem")
    detail = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    summary = li.groupBy("l_orderkey").agg(F.max("l_linenumber").cast("long").alias("n_lines"))
    return Q.reconcile_totals(detail, summary, "l_orderkey", ["n_lines"])


def published_figures(spark, d):
    """J20 recompute numerator/denominator of stated percentages; F20 share of a universe
    with an event; F15 flag rate with a declared denominator."""
    cust = _t(spark, d, "customer")
    orders = _t(spark, d, "orders")
    urgent = A.share_with_event(orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority"), cust,
                                "c_custkey", F.col("o_orderpriority") == "1-URGENT")
    ret = A.flag_rates(_t(spark, d, "lineitem").select((F.col("l_returnflag") == "R").alias("returned")), ["returned"])
    computed = urgent.select(F.lit("customers_with_urgent").alias("figure"), F.col("with_event").alias("numerator"),
                             F.col("universe").alias("denominator")).unionByName(
        ret.select(F.lit("returned_lines").alias("figure"), F.col("returned_n").alias("numerator"),
                   F.col("rows").alias("denominator")))
    figures = literal_table(spark, [("customers_with_urgent", 60.0, 1), ("returned_lines", 25.0, 1),
                                    ("not_computed", 1.0, 1)], "figure string, stated_pct double, digits int")
    return Q.check_figures(computed, figures)


def league_table(spark, d):
    """F19 state league table: orders per customer, fine dollars, % below a threshold;
    E7 facility denominator zero-filled."""
    c = _t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    per = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", money("o_totalprice"))).alias("urgent_dollars"))
    j = J.left_fill(c, per, "c_custkey", {"n_orders": 0})
    return A.league_table(j, "c_nationkey", {
        "facilities": F.count(F.lit(1)),
        "orders_per_facility": F.round(F.sum("n_orders") / F.count(F.lit(1)), 4),
        "urgent_dollars": F.coalesce(F.sum("urgent_dollars"), F.lit(0)).cast("double"),
        "pct_negative_balance": F.round(F.avg((F.col("c_acctbal") < 0).cast("double")) * 100, 2)})


def rows_per_key(spark, d):
    """F16 average rows per key per group."""
    return A.rows_per_key(_t(spark, d, "lineitem"), "l_orderkey", by="l_returnflag")


def crosstab(spark, d):
    """F18 pivot counts, F4 roll-up of the roll-up, F11 mean per group, F6 latest value."""
    o = _t(spark, d, "orders")
    ct = A.crosstab(o, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])
    ct = ct.select("o_orderpriority", *[F.coalesce(F.col(s), F.lit(0)).alias(s) for s in ["F", "O", "P"]])
    ct = ct.withColumn("total", F.col("F") + F.col("O") + F.col("P"))
    m = A.mean_by(o, "o_orderpriority", "o_totalprice", out="mean_price", digits=4)
    latest = o.groupBy("o_orderpriority").agg(F.max(F.col("o_orderdate").cast("date")).alias("latest_order"))
    return ct.join(m, "o_orderpriority").join(latest, "o_orderpriority")
