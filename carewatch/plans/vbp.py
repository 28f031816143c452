"""Value-based purchasing scoring.

Ranks and tiers are always national even when one state is reported (scope filter is
applied after scoring). Percentile ranks and quartile edges come from the cumulative
count plan in `operators.ranking`, so neither the national nor a huge state becomes a
single task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import expr as X
from ..functions import predicates as P
from ..operators import aggs as A
from ..operators import contracts as C
from ..operators import ranking as R
from ..sources import readers

NUMERIC = [v for v in K.VBP_COLUMNS.values()
           if v not in ("ccn", "provider_name", "provider_address", "city", "state", "zip_code")]


def conform(raw: DataFrame) -> DataFrame:
    """Rename verbose columns (C2), footnote -> suppression reason (K21), '---' and other
    sentinels -> NULL and strict numeric parse (K1), state upper-cased."""
    d = raw
    fn = {src: dst for src, dst in K.VBP_FOOTNOTES.items() if src in d.columns}
    d = d.select("*", *[X.suppression(F.col(f"`{s}`")).alias(f"{dst}_flag") for s, dst in fn.items()],
                 *[F.col(f"`{s}`").alias(dst) for s, dst in fn.items()])
    d = C.rename_map(d, {k: v for k, v in K.VBP_COLUMNS.items() if k in d.columns})
    sent = K.SENTINELS_VBP + K.SENTINELS_COMMON
    d = d.withColumns({c: X.num(c, sent, strip="") for c in NUMERIC if c in d.columns})
    if "state" in d.columns:
        d = d.withColumn("state", X.clean("state", case="upper"))
    return d


def score(d: DataFrame, by: str = "state", unscored: str | None = None) -> DataFrame:
    """National and within-state average-rank percentiles (G2, G3) and quartile tiers
    (G4), payment direction (K19), period deltas (K20), and `in_vbp`. Unscored rows are kept,
    with NULL in all of them (E10, T6)."""
    v = "performance_score"
    per_state = R.distinct_value_counts(d, v, by)  # one scan; the national table is its roll-up
    nat = R.rank_values(d, v, pct="national_pct_rank", tier="national_vbp_tier",
                        counts=R.rollup_counts(per_state, v))
    st = R.rank_values(d, v, by, pct="state_pct_rank", tier="state_vbp_tier", counts=per_state)
    s = R.attach_ranks(d, nat, v, tier="national_vbp_tier", unscored=unscored)
    s = R.attach_ranks(s, st, v, by, tier="state_vbp_tier", unscored=unscored)
    has = F.col(v).isNotNull()
    s = s.withColumn("in_vbp", has).withColumn("payment_direction", F.when(has, X.direction("incentive_multiplier")))
    for base, perf, out in K.VBP_DELTAS:
        if base in s.columns and perf in s.columns:
            s = s.withColumn(out, F.when(has, X.delta(perf, base)))
    return s


def state_summary(scored: DataFrame, by: str = "state", digits: int = 2) -> DataFrame:
    """Per-state summary over scored rows (F9), rounded half-even like the pandas source."""
    r = scored.where(F.col("performance_score").isNotNull())
    return r.groupBy(by).agg(
        F.count("ccn").alias("facility_count"),
        F.bround(F.avg("performance_score"), digits).alias("avg_performance_score"),
        F.bround(F.min("performance_score"), digits).alias("min_performance_score"),
        F.bround(F.max("performance_score"), digits).alias("max_performance_score"),
        F.count_if(F.col("payment_direction") == "BONUS").alias("bonus_count"),
        F.count_if(F.col("payment_direction") == "PENALTY").alias("penalty_count"),
        F.count_if(F.col("national_vbp_tier") == "BOTTOM_QUARTILE").alias("nat_bottom_quartile_count"),
        F.count_if(F.col("national_vbp_tier") == "TOP_QUARTILE").alias("nat_top_quartile_count"))


def national_summary(scored: DataFrame) -> DataFrame:
    """Counts, quartiles and direction totals for the narrative summary."""
    q = A.quartiles(scored, "performance_score").withColumnRenamed("n", "n_scored")
    d = scored.agg(F.count(F.lit(1)).alias("n_facilities"),
                   F.count_if(F.col("payment_direction") == "BONUS").alias("bonus"),
                   F.count_if(F.col("payment_direction") == "PENALTY").alias("penalty"))
    return d.withColumn("_g", F.lit(0)).join(F.broadcast(q.withColumn("_g", F.lit(0))), "_g").drop("_g")


MEASURE_COLS = ["ccn", "provider_name", "state", "performance_score", "national_vbp_tier", "state_vbp_tier",
                "snfrm_score", "fn_snfrm_flag", "hai_score", "fn_hai_flag", "turnover_score", "fn_turnover_flag",
                "staffing_score", "fn_staffing_flag"]


def facility(raw: DataFrame, scope: str | None = None) -> DataFrame:
    """Output 1: every facility; a scope filters after ranking, ranks stay national."""
    return P.where_scope(score(conform(raw)), "state", scope)


def states(raw: DataFrame, scope: str | None = None) -> DataFrame:
    """Output 2: the state summary."""
    return state_summary(facility(raw, scope))


def components(raw: DataFrame, scope: str | None = None) -> DataFrame:
    """Output 3: measure scores and suppression reasons beside score and tiers."""
    view = facility(raw, scope)
    return view.select(*C.present_columns(view, MEASURE_COLS))


def summary(raw: DataFrame, scope: str | None = None) -> DataFrame:
    """The figures of the narrative summary; they need no ranks and no tiers."""
    d = P.where_scope(conform(raw), "state", scope)
    has = F.col("performance_score").isNotNull()
    return national_summary(d.withColumn("payment_direction", F.when(has, X.direction("incentive_multiplier"))))


# FIXED VALUES: note at the end of the narrative summary.
METHOD_NOTE = [
    "METHODOLOGY NOTE: VBP Performance Score is a composite of 4 measure scores.",
    "  Facilities missing case minimums on 1+ measures are still in the program",
    "  but scored only on available measures — composite may be artificially",
    "  inflated or deflated. See fn_*_flag columns for per-measure suppression status.",
    "  national_vbp_tier: relative to full national distribution.",
    "  state_vbp_tier:    relative to within-state distribution only.",
]


def report(raw: DataFrame, run_date: str, scope: str | None = None, vintage: str = "FY2026", dataset_id: str = "284v-j9fz",
           benchmarks: Mapping[str, float] | None = None, n: int = 5) -> DataFrame:
    """The narrative summary (B6, P14) as rows (line_no, text): universe, bonus and penalty totals, the
    national distribution, benchmarks where given, for a scope its own distribution and its lowest and
    highest facilities with score, multiplier and national tier, and the method note. Ties go by ccn."""
    v = "performance_score"
    national = conform(raw)
    view = P.where_scope(national, "state", scope)
    name = scope or "NATIONAL"

    def fixed(c, digits):  # rounds the binary value half to even, as printf does
        return F.call_function("format_number", c, F.lit("0." + "0" * digits))

    def quartiles(df):
        return A.quartiles(df.where(F.col(v).isNotNull()), v)

    def distribution(df, title, no):
        edges = [fixed(F.col(c), 1) for c in ("q25", "median", "q75")]
        return quartiles(df).select(F.explode(F.array(
            F.struct(F.lit(no).alias("line_no"), F.format_string(f"{title} VBP DISTRIBUTION (n=%d scored facilities):", "n").alias("text")),
            F.struct(F.lit(no + 1).alias("line_no"), F.format_string("  Q1=%s  Median=%s  Q3=%s", *edges).alias("text")))).alias("l")).select("l.*")

    def lines(texts, no):
        return readers.literal_table(raw.sparkSession, [(no + i, t) for i, t in enumerate(texts)], "line_no int, text string")
    totals = view.agg(F.count(F.lit(1)).alias("n"), F.count(v).alias("s"), F.count_if(F.col("incentive_multiplier") > 1.0).alias("b"),
                      F.count_if(F.col("incentive_multiplier") < 1.0).alias("p"))
    totals = totals.select(F.explode(F.array(
        F.struct(F.lit(6).alias("line_no"), F.format_string(
            "UNIVERSE: %d facilities (%d with VBP score, %d below case minimum / not scored)", "n", "s", F.col("n") - F.col("s")).alias("text")),
        F.struct(F.lit(7).alias("line_no"), F.format_string("  Bonus (multiplier > 1.0):   %d", "b").alias("text")),
        F.struct(F.lit(8).alias("line_no"), F.format_string("  Penalty (multiplier < 1.0): %d", "p").alias("text")))).alias("l")).select("l.*")
    parts = [lines([f"SNF VBP PERFORMANCE — {vintage}", f"Scope: {name}", f"Run date: {run_date}",
                    f"Data: CMS dataset {dataset_id} ({vintage})", ""], 1), totals, lines([""], 9),
             distribution(national, "NATIONAL", 10), lines([""], 12)]
    if benchmarks:
        parts.append(lines(["NATIONAL SNFRM BENCHMARKS (readmission):", *[f"  {k}: {x:.5f}" for k, x in benchmarks.items()], ""], 20))
    if scope:
        parts += [distribution(view, name, 100), lines(["", f"BOTTOM {n} {name} VBP PERFORMERS:"], 102),
                  lines(["", f"TOP {n} {name} VBP PERFORMERS:"], 200), lines([""], 300)]
        scored = view.where(F.col(v).isNotNull())
        edges = quartiles(national).withColumn("_g", F.lit(0))  # one row
        for no, asc in ((110, True), (210, False)):
            top = R.top_n(scored, v, n, None, asc=asc, tie_break=["ccn"])
            top = top.withColumn("_g", F.lit(0)).join(F.broadcast(edges), "_g").withColumn(
                "national_vbp_tier", R.tier_label(v, "q25", "median", "q75"))
            parts.append(top.select((F.col("rn") + no).cast("int"), F.concat(
                F.lit("  "), F.rpad(F.coalesce("provider_name", F.lit("")), 45, " "), F.lit(" Score="), fixed(F.col(v), 2), F.lit("  Multiplier="),
                F.coalesce(fixed(F.col("incentive_multiplier"), 4), F.lit("N/A")), F.lit("  NatTier="), F.col("national_vbp_tier"))))
    parts.append(lines(METHOD_NOTE, 400))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


# FIXED VALUES: columns of the simple VBP table and the substrings that find them in normalised headers.
SIMPLE_COLUMNS = {
    "ccn": [["cms_certification_number"], ["ccn"]],
    "provider_name": [["provider_name"]],
    "state": [["state"]],
    "city": [["city"]],
    "zip": [["zip"]],
    "snfrm_achievement": [["snfrm", "achievement"]],
    "snfrm_improvement": [["snfrm", "improvement"]],
    "snfrm_measure_score": [["snfrm", "measure_score"], ["snfrm_score"]],
    "hai_achievement": [["hai", "achievement"]],
    "hai_improvement": [["hai", "improvement"]],
    "hai_measure_score": [["hai", "measure_score"], ["hai_score"]],
    "turnover_score": [["turnover_measure"], ["turnover_score"]],
    "staffing_score": [["staffing_measure"], ["staffing_score"]],
    "performance_score": [["performance_score"], ["total_performance"]],
    "incentive_payment_multiplier": [["incentive_payment_multiplier"], ["multiplier"]],
}
SIMPLE_EXCLUDED = {"snfrm_achievement": ["improvement"], "hai_achievement": ["improvement"]}
SIMPLE_REQUIRED = ("ccn", "provider_name", "state")
SIMPLE_NUMBERS = ("performance_score", "incentive_payment_multiplier")


def snf_vbp_simple(raw: DataFrame) -> DataFrame:
    """The simple VBP table (P13): 17 columns, resolved by substrings of the normalised headers, text but
    for score and multiplier, with bare threshold flags (NULL stays NULL, K17). A column that the
    source lacks is empty."""
    contract = [C.Field(out, found, match="substr", exclude=SIMPLE_EXCLUDED.get(out, []), required=out in SIMPLE_REQUIRED,
                        parse="number" if out in SIMPLE_NUMBERS else "text",
                        sentinels=K.SENTINELS_COMMON if out in SIMPLE_NUMBERS else None)
                for out, found in SIMPLE_COLUMNS.items()]
    normal = C.normalize_headers(raw)
    d, _ = C.resolve_columns(normal, contract)
    d = C.align(d, [(c, "double" if c in SIMPLE_NUMBERS else "string") for c in SIMPLE_COLUMNS])
    m = F.col("incentive_payment_multiplier")
    return d.withColumns({"vbp_penalty": m < 1.0, "vbp_bonus": X.gt_flag("incentive_payment_multiplier", 1.0, missing=None)})
