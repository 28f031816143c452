"""Provider info, citations, penalties, quality measures, post-acute, cost report,
survey summary, state benchmarks and star bands (P9-P12, P15-P19).

All builds take already-landed raw DataFrames (every column text, see `sources`) and
return DataFrames; nothing is collected. Lookups against code references (tags,
measure intervals) are small reference tables joined by key; the fact tables (citations,
measures) are never shuffled for a lookup unless AQE measures the reference as large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import expr as X
from ..functions import predicates as P
from ..operators import aggs as A
from ..operators import contracts as C
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import ranking as R

Field = C.Field


# --------------------------------------------------------------------- P9
# FIXED VALUES: output name -> header of the published provider file.
PROVIDER_INFO_HEADERS = {
    "ccn": "cms_certification_number_ccn",
    "provider_name": "provider_name",
    "legal_business_name": "legal_business_name",
    "address": "provider_address",
    "city": "citytown",
    "state": "state",
    "zip": "zip_code",
    "phone": "telephone_number",
    "county": "countyparish",
    "urban_rural": "urban",
    "lat": "latitude",
    "lon": "longitude",
    "ownership_type": "ownership_type",
    "provider_type": "provider_type",
    "in_hospital": "provider_resides_in_hospital",
    "certified_beds": "number_of_certified_beds",
    "avg_daily_census": "average_number_of_residents_per_day",
    "overall_star": "overall_rating",
    "health_inspection_star": "health_inspection_rating",
    "qm_star": "qm_rating",
    "longstay_qm_star": "longstay_qm_rating",
    "shortstay_qm_star": "shortstay_qm_rating",
    "staffing_star": "staffing_rating",
    "total_hprd": "reported_total_nurse_staffing_hours_per_resident_per_day",
    "rn_hprd": "reported_rn_staffing_hours_per_resident_per_day",
    "lpn_hprd": "reported_lpn_staffing_hours_per_resident_per_day",
    "cna_hprd": "reported_nurse_aide_staffing_hours_per_resident_per_day",
    "rn_weekend_hprd": "registered_nurse_hours_per_resident_per_day_on_the_weekend",
    "total_weekend_hprd": "total_number_of_nurse_staff_hours_per_resident_per_day_on_t_4a14",
    "casemix_index": "nursing_casemix_index",
    "total_nurse_turnover": "total_nursing_staff_turnover",
    "rn_turnover": "registered_nurse_turnover",
    "admin_left_count": "number_of_administrators_who_have_left_the_nursing_home",
    "special_focus_status": "special_focus_status",
    "abuse_icon": "abuse_icon",
    "chain_name": "chain_name",
    "chain_id": "chain_id",
    "latest_standard_survey": "rating_cycle_1_standard_survey_health_date",
    "health_defic_cycle1": "rating_cycle_1_total_number_of_health_deficiencies",
    "weighted_health_score": "total_weighted_health_survey_score",
    "infection_control_citations": "number_of_citations_from_infection_control_inspections",
    "fine_count": "number_of_fines",
    "fine_total_dollars": "total_amount_of_fines_in_dollars",
    "payment_denials": "number_of_payment_denials",
    "total_penalties": "total_number_of_penalties",
}
# End of fixed values.
NUMERIC_INFO = {"certified_beds", "avg_daily_census", "total_hprd", "rn_hprd", "lpn_hprd", "cna_hprd", "rn_weekend_hprd",
                "total_weekend_hprd", "casemix_index", "total_nurse_turnover", "rn_turnover", "admin_left_count",
                "health_defic_cycle1", "weighted_health_score", "infection_control_citations", "fine_count",
                "fine_total_dollars", "payment_denials", "total_penalties", "lat", "lon"}
PROVIDER_INFO_CONTRACT = [Field(out, [src], required=out == "ccn", parse="number" if out in NUMERIC_INFO else "text")
                          for out, src in PROVIDER_INFO_HEADERS.items()]


def provider_info(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contract-resolved provider table with the four-part staffing test (K13; a
    missing part makes the overall flag False, T7), chain flag (K14). Returns (table,
    column mapping report)."""
    d, mapping = C.resolve_columns(raw, PROVIDER_INFO_CONTRACT)
    parts = X.meets_all({"rn_hprd": K.RN_HPRD_MIN, "cna_hprd": K.AIDE_HPRD_MIN,
                         "total_hprd": K.TOTAL_HPRD_MIN, "rn_weekend_hprd": K.RN_HPRD_MIN}, prefix="_m_")
    d = d.select("*",
                 parts["_m_rn_hprd"].alias("lm_rn_meets_3442f"),
                 parts["_m_cna_hprd"].alias("lm_aide_meets_3442f"),
                 parts["_m_total_hprd"].alias("lm_total_meets_3442f"),
                 parts["_m_rn_weekend_hprd"].alias("lm_rn_weekend_meets_3442f"),
                 parts["_m_all"].alias("lm_meets_3442f_thresholds"),
                 parts["n_missing_parts"].alias("lm_missing_parts"),
                 X.yn_present("chain_name", ["", "N/A"]).alias("lm_chain_affiliated"))
    return d, mapping


def staffing_summary(info: DataFrame, by=None) -> DataFrame:
    """Share of facilities that would not meet the staffing minimums (F15), with the
    denominator declared: every facility in the table."""
    return info.groupBy(*([by] if by else [])).agg(
        F.count(F.lit(1)).alias("facilities"),
        F.count_if(~F.col("lm_meets_3442f_thresholds")).alias("would_not_meet"),
        F.round(F.count_if(~F.col("lm_meets_3442f_thresholds")) / F.count(F.lit(1)) * 100, 1).alias("pct_would_not_meet"),
        F.count_if(F.col("lm_missing_parts") > 0).alias("with_missing_parts"))


# -------------------------------------------------------------------- P10
# FIXED VALUES: substrings that find the columns of the source.
CITATION_CONTRACT = [
    Field("ccn", [["cms_certification_number"], ["ccn"]], match="substr", required=True),
    Field("provider_name", [["provider_name"]], match="substr"),
    Field("state", [["state"]], match="substr"),
    Field("city", [["city"], ["citytown"]], match="substr"),
    Field("zip", [["zip"]], match="substr"),
    Field("survey_date", [["survey_date"], ["inspection_date"]], match="substr", required=True),
    Field("prefix", [["deficiency_prefix"]], match="substr", required=True),
    Field("category", [["deficiency_category"]], match="substr", required=True),
    Field("tag_number", [["deficiency_tag_number"], ["tag_number"]], match="substr", required=True),
    Field("tag_desc", [["deficiency_description"], ["short_description"]], match="substr"),
    Field("scope_sev", [["scope_severity"]], match="substr", required=True),
    Field("deficiency_corrected", [["corrected"]], match="substr"),
    Field("is_standard", [["standard"]], match="substr"),
    Field("is_complaint", [["complaint"]], match="substr"),
    Field("is_infection_control", [["infection_control"]], match="substr"),
]


def citations(raw: DataFrame, ftag: DataFrame | None = None, seq: str | None = None) -> dict[str, DataFrame]:
    """P10: citation rows with the scope/severity grid (K10), tag lookup falling back to
    the row's own description/category (E5), composite tag (K7), jeopardy/harm flags
    (K12) and category keyword flags (K9). Returns the table, the column mapping and
    the tag-lookup miss count."""
    d, mapping = C.resolve_columns(raw, CITATION_CONTRACT)
    d = d.withColumns({"tag_prefix": X.clean("prefix", case="upper"), "tag_number": X.clean("tag_number"),
                       "scope_severity_code": X.clean("scope_sev", case="upper")})
    d = d.withColumns({"tag_desc": F.coalesce(F.col("tag_desc"), F.lit("")),
                       "category": F.coalesce(F.col("category"), F.lit(""))})
    if ftag is not None:
        ref = ftag.select(X.clean("tag_prefix", case="upper").alias("tag_prefix"), X.clean("tag_number").alias("tag_number"),
                          F.col("description").alias("ftag_description"), F.col("category").alias("ftag_category"),
                          *([seq] if seq and seq in ftag.columns else []))
        d = J.lookup_or_self(d, ref, ["tag_prefix", "tag_number"],
                             {"tag_description": ("ftag_description", "tag_desc"), "category_out": ("ftag_category", "category")},
                             matched="ftag_matched", seq=seq if seq and seq in ftag.columns else None)
        d = d.drop("category").withColumnRenamed("category_out", "category")
    else:
        d = d.withColumn("tag_description", F.col("tag_desc")).withColumn("ftag_matched", F.lit(False))
    grid = X.severity_grid("scope_severity_code")
    d = d.withColumns(grid)
    d = d.withColumns(X.level_flags("scope_severity_code", "severity_level"))
    cat = F.col("category")
    d = d.withColumns({
        "prefix_tag": X.join_code("tag_prefix", "tag_number"),
        "is_abuse_neglect": X.has_any(cat, ["abuse", "neglect"]),
        "is_infection_ctrl_cat": X.has_any(cat, ["infection control"]),
        "is_resident_rights": X.has_any(cat, ["resident rights"]),
        "is_quality_care": X.has_any(cat, ["quality of life"])})
    d = d.drop("prefix", "scope_sev", "tag_desc")
    misses = d.agg(F.count_if(~F.col("ftag_matched")).alias("ftag_misses"), F.count(F.lit(1)).alias("rows"))
    return {"citations": d, "mapping": mapping, "misses": misses}


def citation_summary(cit: DataFrame, universe: DataFrame | None = None, key: str = "ccn") -> DataFrame:
    """Facilities with at least one citation of each kind, over a declared universe
    (F20); severity within state (F18)."""
    kinds = {"immediate_jeopardy": "is_immediate_jeopardy", "actual_harm": "is_actual_harm",
             "abuse_neglect": "is_abuse_neglect", "infection_control": "is_infection_ctrl_cat"}
    agg = cit.groupBy(key).agg(*[F.bool_or(F.col(c)).alias(k) for k, c in kinds.items()])
    base = universe.select(key).distinct() if universe is not None else agg.select(key)
    j = base.join(agg, key, "left")
    return j.agg(F.count(F.lit(1)).alias("universe"),
                 *[F.count_if(F.coalesce(F.col(k), F.lit(False))).alias(f"with_{k}") for k in kinds])


# -------------------------------------------------------------------- P11
# FIXED VALUES: substrings that find the columns of the source.
PENALTY_CONTRACT = [
    Field("ccn", [["cms_certification_number"], ["ccn"]], match="substr", required=True),
    Field("provider_name", [["provider_name"]], match="substr"),
    Field("state", [["state"]], match="substr"),
    Field("city", [["city"]], match="substr"),
    Field("zip", [["zip"]], match="substr"),
    Field("penalty_date", [["penalty_date"]], match="substr", required=True),
    Field("penalty_type", [["penalty_type"]], match="substr", required=True),
    Field("fine_id", [["fine_id"]], match="substr"),
    Field("fine_amount_text", [["fine_amount"]], match="substr", required=True),
    Field("payment_denial_start", [["payment_denial_start"], ["denial_start"]], match="substr"),
    Field("payment_denial_days", [["payment_denial_length"], ["denial_length"]], match="substr"),
]


def penalties(raw: DataFrame, seq: str) -> dict[str, DataFrame]:
    """Penalty events (money text -> number with '$' and ',' removed, K1) with fine
    and denial flags (K9, T22) and the per-facility roll-up (F7): event count, fines,
    fine dollars (0.0 when none, T21), denials, latest date, first row's name and state
    by `seq` (T18)."""
    d, _ = C.resolve_columns(raw.withColumn("_seq_", F.col(seq)), PENALTY_CONTRACT + [Field("_seq", ["_seq_"])])
    d = d.withColumn("_seq", F.col("_seq").cast("long"))
    # money as DECIMAL(18,2): exact sums, independent of partitioning
    d = d.withColumns({"fine_amount": X.num("fine_amount_text", ["", "N/A"]).cast("decimal(18,2)"),
                       "is_fine": X.has_any("penalty_type", ["fine"]),
                       "is_payment_denial": X.has_any("penalty_type", ["denial", "payment"])}).drop("fine_amount_text")
    roll = A.event_rollup(d, "ccn", "penalty_type", "fine_amount", "penalty_date", "_seq", name_col="provider_name",
                          extra_first=["state"])
    roll = (roll.withColumn("fine_total", F.col("fine_total").cast("double"))
                .withColumnRenamed("fine_total", "fine_total_dollars")
                .withColumnRenamed("most_recent", "most_recent_penalty"))
    return {"events": d.drop("_seq"), "by_facility": roll}


# -------------------------------------------------------------------- P12
# FIXED VALUES: source header substrings, newer spelling first.
MEASURE_COMMON = [
    Field("ccn", [["cms_certification_number"], ["ccn"]], match="substr", required=True),
    Field("provider_name", [["provider_name"]], match="substr"),
    Field("state", [["state"]], match="substr"),
    Field("measure_code", [["measure_code"], ["measure_id"]], match="substr", required=True),
]
MEASURE_SHAPES = {
    "mds": [
        Field("measure_desc", [["measure_description"], ["measure_name"]], match="substr"),
        Field("resident_type", [["resident_type"], ["stay_type"]], match="substr"),
        Field("q1_score", [["q1"], ["quarter_1"]], match="substr"),
        Field("q2_score", [["q2"], ["quarter_2"]], match="substr"),
        Field("q3_score", [["q3"], ["quarter_3"]], match="substr"),
        Field("q4_score", [["q4"], ["quarter_4"]], match="substr"),
        Field("four_qtr_avg", [["four_quarter_average"], ["average_score"]], match="substr"),
        Field("used_in_five_star", [["used_in_qm_five_star"], ["used_in_five_star"]], match="substr"),
        Field("footnote", [["footnote"]], match="substr"),
    ],
    "claims": [
        Field("measure_desc", [["measure_description"], ["measure_name"]], match="substr"),
        Field("resident_type", [["resident_type"], ["stay_type"]], match="substr"),
        Field("adjusted_score", [["adjusted_score"], ["risk_adjusted"]], match="substr"),
        Field("observed_score", [["observed_score"]], match="substr"),
        Field("expected_score", [["expected_score"]], match="substr"),
        Field("used_in_five_star", [["used_in_qm_five_star"], ["used_in_five_star"]], match="substr"),
        Field("footnote", [["footnote"]], match="substr"),
    ],
    "qrp": [
        Field("county", [["county"]], match="substr"),
        Field("score", [["score"]], match="substr", required=True),
        Field("footnote", [["footnote"]], match="substr"),
        Field("start_date", [["start_date"]], match="substr"),
        Field("end_date", [["end_date"]], match="substr"),
    ],
}


def quality_measures(raw: DataFrame, intervals: DataFrame | None, shape: str = "mds",
                     seq: str | None = None) -> dict[str, DataFrame]:
    """One of the three measure shapes (mds, claims, qrp) resolved by substrings,
    with the measure-code lookup of collection dates (E6, blank default; of a repeated code
    the last row by `seq`, the row order of the file, counts). The lookup's
    match rate is always reported (J13; a rate of 0 means the codes did not bind, T40)."""
    d, mapping = C.resolve_columns(raw, MEASURE_COMMON + MEASURE_SHAPES[shape])
    if intervals is not None:
        iv = intervals.select(X.clean("measure_code").alias("measure_code"),
                              F.col("data_collection_period_from_date").alias("collection_from"),
                              F.col("data_collection_period_through_date").alias("collection_through"),
                              *([F.col(seq).alias("_seq")] if seq else []))
        d = d.withColumn("measure_code", X.clean("measure_code"))
        d = J.lookup(d, iv.withColumn("_hit", F.lit(True)), "measure_code", ["collection_from", "collection_through", "_hit"], seq="_seq" if seq else None,
                     defaults={"collection_from": "", "collection_through": "", "_hit": False})
        rate = A.match_rate(d, "_hit")
        d = d.drop("_hit")
    else:
        rate = d.agg(F.count(F.lit(1)).alias("rows")).withColumn("matched", F.lit(0)).withColumn("match_rate", F.lit(0.0))
    return {"measures": d, "mapping": mapping, "interval_match": rate}


def measure_means(measures: DataFrame, value: str, by=("measure_code",), top: int = 10) -> DataFrame:
    """Mean of a text metric per measure (F11), strictly parsed, top `top` (H1) and the
    average rows per facility (F16)."""
    m = measures.withColumn("_v", X.num(value))
    return R.top_k(A.mean_by(m, list(by), "_v", out="mean_value", digits=4), "mean_value", top,
                   tie_break=list(by))


# -------------------------------------------------------------------- P15
# FIXED VALUES: source header substrings, newer spelling first.
PAC_CONTRACT = {
    "smry_ctgry": Field("smry_ctgry", [["smry_ctgry"]], match="substr", required=True),
    "pt": Field("pt", [["pt_mnts"], ["tot_pt"]], match="substr"),
    "ot": Field("ot", [["ot_mnts"], ["tot_ot"]], match="substr"),
    "dual": Field("dual", [["dual_pct"], ["dual"]], match="substr", required=True),
}


def pac_puf(raw: DataFrame, summary_category: str = "PROVIDER") -> DataFrame:
    """Provider-level rows only (A7), all source columns kept, plus the therapy flag
    (K18: NULL when both minutes are missing, False when one is) and the dual-eligible flag
    (K17). Columns are found by the substrings of the contract."""
    at = {k: C.find_column(raw.columns, f) for k, f in PAC_CONTRACT.items()}
    lacking = [k for k, f in PAC_CONTRACT.items() if f.required and at[k] is None]
    if lacking:
        raise KeyError(f"required columns not found: {lacking}")
    d = raw.where(P.scope_eq(F.col(f"`{at['smry_ctgry']}`"), summary_category))

    def number(k: str):
        return X.num(F.col(f"`{at[k]}`"), K.SENTINELS_PAC) if at[k] else F.lit(None).cast("double")
    return d.withColumns({"high_therapy_intensity": X.pair_sum_flag(number("pt"), number("ot"), K.THERAPY_MINUTES_MIN),
                          "high_dual_pct": X.gt_flag(number("dual"), K.DUAL_PCT_MIN, missing=None)})


# -------------------------------------------------------------------- P16
# FIXED VALUES: source header substrings. The file holds each day and bed count several times;
# only the columns of the skilled-nursing unit carry `SNF`.
def _money(out: str, *names: str, required: bool = False) -> Field:
    return Field(out, [[n] for n in names], match="substr", parse="number", sentinels=K.SENTINELS_COMMON,
                 required=required)


COST_CONTRACT = [
    Field("ccn_raw", [["provider ccn"], ["ccn"]], match="substr", required=True),
    Field("facility_name", [["facility name"], ["provider name"]], match="substr", required=True),
    Field("state", [["state code"], ["state"]], match="substr", required=True),
    Field("type_of_control", [["type of control"]], match="substr"),
    Field("fy_begin", [["fiscal year begin"], ["fy begin"]], match="substr", required=True),
    Field("fy_end", [["fiscal year end"], ["fy end"]], match="substr", required=True),
    _money("beds", "snf number of beds", "number of beds"),
    _money("days_medicare", "snf days title xviii", required=True),
    _money("days_medicaid", "snf days title xix", required=True),
    _money("days_other", "snf days other"),
    _money("days_total", "snf days total", required=True),
    _money("bed_days_available", "snf bed days available", required=True),
    _money("net_patient_revenue", "net patient revenue", required=True),
    _money("net_income", "net income", required=True),
    _money("total_costs", "total costs", required=True),
    _money("total_salaries", "total salaries"),
    _money("contract_labor", "contract labor"),
]


def cost_report(raw: DataFrame) -> DataFrame:
    """Day mix, margin, occupancy and contract-labour ratios (K15, half-even like
    Python `round`) with the source's guards (T23: margin NULL when revenue is 0,
    occupancy NULL when days are 0; T24 follows the code: bed-days denominator, 'other
    days' numerator), stress flags (K16) and padded CCN (K3)."""
    d, _ = C.resolve_columns(raw, COST_CONTRACT)
    tot, bd, rev, sal = F.col("days_total"), F.col("bed_days_available"), F.col("net_patient_revenue"), F.col("total_salaries")
    days_ok = tot.isNotNull() & (tot != 0)
    d = d.select(
        X.pad_key("ccn_raw", 6).alias("ccn"), *[c for c in d.columns if c != "ccn_raw"],
        X.ratio("days_medicare", "days_total", 100, 1, "half_even", guard=days_ok).alias("medicare_days_pct"),
        X.ratio("days_medicaid", "days_total", 100, 1, "half_even", guard=days_ok).alias("medicaid_days_pct"),
        X.ratio("days_other", "days_total", 100, 1, "half_even", guard=days_ok).alias("private_other_pct"),
        X.ratio("net_income", "net_patient_revenue", 100, 2, "half_even", guard=rev != 0).alias("operating_margin_pct"),
        X.ratio("days_total", "bed_days_available", 100, 1, "half_even", guard=days_ok & (bd > 0)).alias("occupancy_pct"),
        X.ratio("contract_labor", "total_salaries", 100, 1, "half_even", guard=sal > 0).alias("contract_labor_pct"),
        X.year4("fy_end").alias("fy_end_year"))
    return d.withColumns({"medicaid_heavy": X.gt_flag("medicaid_days_pct", K.MEDICAID_HEAVY_PCT),
                          "financially_stressed": F.coalesce(F.col("operating_margin_pct") < K.STRESSED_MARGIN_PCT,
                                                             F.lit(False))})


def cost_checks(cost: DataFrame) -> DataFrame:
    """Range checks on the cost ratios (J15): occupancy <= 110 warns."""
    return Q.check_ranges(cost, [("occupancy", "occupancy_pct", 0.0, 110.0, "warn"),
                                 ("margin", "operating_margin_pct", -1000.0, 100.0, "warn")])


def margin_summary(cost: DataFrame, by=None, below: float = K.STRESSED_MARGIN_PCT) -> DataFrame:
    """Median operating margin and the count below a threshold."""
    return A.median_by(cost, "operating_margin_pct", by, below)


# -------------------------------------------------------------------- P17
# FIXED VALUES: source header substrings, newer spelling first.
SURVEY_CONTRACT = [
    Field("ccn", [["cms_certification_number"], ["ccn"]], match="substr", required=True),
    Field("state", [["state"]], match="substr", required=True),
    Field("cycle", [["cycle"]], match="substr", required=True),
    Field("date", [["survey_date"], ["date"]], match="substr", required=True),
]
SURVEY_COUNTS = [
    Field("cat_abuse", [["abuse"]], match="substr", required=True),
    Field("cat_qol", [["quality_of_life"], ["qol"]], match="substr", required=True),
    Field("cat_assess", [["resident_assessment"], ["assessment"]], match="substr", required=True),
    Field("cat_nursing", [["nursing"]], match="substr", required=True),
    Field("cat_rights", [["resident_rights"], ["rights"]], match="substr", required=True),
    Field("cat_nutrition", [["nutrition"]], match="substr", required=True),
    Field("cat_pharmacy", [["pharmacy"]], match="substr", required=True),
    Field("cat_environ", [["environmental"], ["environ"]], match="substr", required=True),
    Field("cat_admin", [["administration"]], match="substr", required=True),
    Field("cat_infection", [["infection_control"], ["infection"]], match="substr", required=True),
    Field("cat_emergency", [["emergency_preparedness"], ["emergency"]], match="substr", required=True),
]


def survey_summary(raw: DataFrame) -> DataFrame:
    """All source columns, trimmed, plus the computed health total: the row-wise sum of
    the category counts, NULL only when every count is missing (F14). Counts are whole
    numbers; any other text is missing."""
    at = {f.out: C.find_column(raw.columns, f) for f in SURVEY_CONTRACT + SURVEY_COUNTS}
    lacking = [k for k, c in at.items() if c is None]
    if lacking:
        raise KeyError(f"required columns not found: {lacking}")

    def count(name: str):
        c = F.btrim(F.col(f"`{at[name]}`").cast("string"))
        return F.when(c.rlike("^[+-]?[0-9]+$"), c.try_cast("long"))
    total = X.row_sum([count(f.out) for f in SURVEY_COUNTS])
    return raw.select(*[F.btrim(F.col(f"`{c}`").cast("string")).alias(c) for c in raw.columns],
                      total.alias("computed_health_total"))


# -------------------------------------------------------------------- P18
def state_benchmarks(bench: DataFrame, focus: str, metrics: Sequence[str], key: str = "state_or_nation",
                     national: str = "NATION", rank_metric: str | None = None) -> dict[str, DataFrame]:
    """One state vs the national row metric by metric (F22, T38), and the state's
    1-based position among states on `rank_metric` (G5). The national row must be a
    singleton (J17)."""
    num = bench.select(key, *[X.num(m).alias(m) for m in metrics])
    out = {"comparison": A.compare_to_benchmark(num, key, focus, national, metrics),
           "nation_singleton": Q.check_singleton(num, F.col(key) == national, "nation_row")}
    if rank_metric:
        out["position"] = R.position_of(num.where(F.col(key) != national), key, rank_metric, focus)
    return out


# -------------------------------------------------------------------- P19
def star_bands(citations_ccn: DataFrame, info: DataFrame) -> DataFrame:
    """Citations per facility (F1) left-joined to rated facilities with zero fill
    (E7), then band means at the source's roundings (F10: 1, 2 and 1 digits,
    half-even like pandas)."""
    cit = citations_ccn.select(X.pad_key("ccn", 6, blank="000000").alias("ccn")).groupBy("ccn") \
        .agg(F.count(F.lit(1)).alias("total_citations"))
    rated = P.where_in(info, "overall_star", ["1", "2", "3", "4", "5"], normalize=False)
    rated = rated.select(X.pad_key("ccn", 6, blank="000000").alias("ccn"),
                         F.col("overall_star").cast("int").alias("overall_star"),
                         X.num("rn_hprd").alias("rn_hprd") if dict(info.dtypes).get("rn_hprd") == "string"
                         else F.col("rn_hprd").cast("double").alias("rn_hprd"),
                         X.num("total_nurse_turnover").alias("total_nurse_turnover")
                         if dict(info.dtypes).get("total_nurse_turnover") == "string"
                         else F.col("total_nurse_turnover").cast("double").alias("total_nurse_turnover"))
    j = J.left_fill(rated, cit, "ccn", {"total_citations": 0})
    return j.groupBy("overall_star").agg(
        F.count("ccn").alias("facility_count"),
        F.bround(F.avg("total_citations"), 1).alias("avg_total_citations"),
        F.bround(F.avg("rn_hprd"), 2).alias("avg_rn_hprd"),
        F.bround(F.avg("total_nurse_turnover"), 1).alias("avg_total_turnover_pct"))


def star_band_checks(bands: DataFrame, expected: DataFrame) -> DataFrame:
    """Exact facility counts and +/-5% bands on the averages (expected rows
    (overall_star, metric, expected, tol_pct))."""
    return Q.check_expected(bands, "overall_star", expected,
                            ["facility_count", "avg_total_citations", "avg_rn_hprd", "avg_total_turnover_pct"])
