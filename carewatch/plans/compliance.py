"""Compliance calendar and hotlist.

Per facility: state licence (manual dates, E11), staffing-report deadline (constant for
the run, K27) and cost-report due date from the fiscal year end (K25, K26), each with an
alert (K28), and the worst alert (K29). Every date depends on the explicit `as_of` (T29).
The build is row-local after two small lookups, so it scales with the facility table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import constants as K
from ..functions import expr as X
from ..functions import predicates as P
from ..operators import joins as J
from ..operators import ranking as R

# FIXED VALUES: texts of the published calendar.
NO_LICENSE_SOURCE = "Not on file — add to input/manual_license_dates.csv"
PBJ_REG_REF = "42 CFR §483.75(l)(2)"
COST_REG_REF = "42 CFR §413.20(b)"
PBJ_SOURCE = "CMS Payroll-Based Journal (PBJ) Submission Requirements"
COST_SOURCE = "CMS Medicare Cost Report (CMS-2540-10)"


def calendar(master: DataFrame, pos: DataFrame | None, manual: DataFrame | None, as_of: dt.date,
             snf_label: str = "SNF", basis: str = "next", include_prior_q4: bool = False,
             pos_seq: str | None = None) -> DataFrame:
    """`master` needs ccn and provider_type_label; `pos` prvdr_num + fy_end_mo_day_cd, and of a
    repeated provider the last row by `pos_seq` (the file's row order) with a value counts;
    `manual` ccn, term_date, license_type, source, regulatory_ref, notes and a `_seq`
    file-order column. `basis="next"` keeps the source's choice of the next fiscal year
    end for the cost report (T25); "most_recent" uses the last one."""
    m = master.withColumn("_ccn", X.pad_key("ccn", 6))
    is_snf = F.coalesce(F.col("provider_type_label") == snf_label, F.lit(False))
    if manual is not None:
        m = J.override_lookup(m, manual, "_ccn", "ccn", "term_date", "_seq",
                              cols=["license_type", "source", "regulatory_ref", "notes"], pad=6, prefix="lic_")
    else:
        m = m.withColumns({"lic_term_date": F.lit(None).cast("date"),
                           **{f"lic_{c}": F.lit(None).cast("string")
                              for c in ("license_type", "source", "regulatory_ref", "notes")}})
    m = m.withColumn("lic_source", F.when(F.col("lic_term_date").isNull(), F.lit(NO_LICENSE_SOURCE)).otherwise(F.col("lic_source")))
    m = m.withColumn("state_lic_action_date", F.date_sub("lic_term_date", K.STATE_LICENSE_ACTION_LEAD))
    m = m.withColumn("state_lic_alert", cal.alert("lic_term_date", "state_lic_action_date", as_of))
    nd = cal.next_deadline(as_of, include_prior_q4=include_prior_q4)
    m = m.withColumns({"_snf": is_snf, "_pbj_dl": nd["deadline"], "_pbj_act": nd["action_date"], "_pbj_lab": nd["deadline_label"]})
    m = m.withColumns({
        "pbj_quarter": F.when(F.col("_snf"), F.col("_pbj_lab")).otherwise(F.lit("")),
        "pbj_term_date": F.when(F.col("_snf"), F.col("_pbj_dl")),
        "pbj_action_date": F.when(F.col("_snf"), F.col("_pbj_act")),
        "pbj_source": F.when(F.col("_snf"), F.lit(PBJ_SOURCE)).otherwise(F.lit("")),
        "pbj_reg_ref": F.when(F.col("_snf"), F.lit(PBJ_REG_REF)).otherwise(F.lit("")),
        "pbj_alert": F.when(F.col("_snf"), cal.alert("_pbj_dl", "_pbj_act", as_of)).otherwise(F.lit("N_A"))})
    if pos is not None:
        fy = pos.select(X.pad_key("prvdr_num", 6).alias("_ccn"), X.clean("fy_end_mo_day_cd").alias("_fy"),
                        *([F.col(pos_seq).alias("_seq")] if pos_seq else []))
        fy = J.dedupe_last(fy.where(X.is_present("_fy")), "_ccn", "_seq" if pos_seq else None).select("_ccn", "_fy")
        m = m.join(fy, "_ccn", "left")
    else:
        m = m.withColumn("_fy", F.lit(None).cast("string"))
    m = cal.with_fy_bounds(m, "_fy", as_of, prefix="_fyb_")
    fy_end = F.col("_fyb_end_next") if basis == "next" else F.col("_fyb_end_most_recent")
    m = m.withColumn("cost_report_fy_end", F.when(F.col("_snf"), fy_end))
    m = m.withColumn("cost_report_term_date", cal.month_end_after("cost_report_fy_end"))
    m = m.withColumn("cost_report_action_date", F.date_sub("cost_report_term_date", K.COST_REPORT_ACTION_LEAD))
    m = m.withColumns({
        "cost_report_source": F.when(F.col("_snf"), F.lit(COST_SOURCE)).otherwise(F.lit("")),
        "cost_report_reg_ref": F.when(F.col("_snf"), F.lit(COST_REG_REF)).otherwise(F.lit("")),
        "cost_report_alert": F.when(~F.col("_snf"), F.lit("N_A")).otherwise(
            cal.alert("cost_report_term_date", "cost_report_action_date", as_of))})
    m = m.withColumn("overall_alert", cal.worst("state_lic_alert", "pbj_alert", "cost_report_alert"))
    return m.drop("_ccn", "_snf", "_pbj_dl", "_pbj_act", "_pbj_lab", "_fy", "_fyb_end_next", "_fyb_end_most_recent")


URGENT = ["OVERDUE", "CRITICAL", "WARNING"]


def hotlist(cal_df: DataFrame) -> DataFrame:
    """Urgent subset by severity, then the licence term date, then the staffing-report term
    date (D1, H3), missing dates first as in a file where they are empty text; CCN decides
    ties. Reads a
    finished calendar: over an unwritten one the filter would repeat every date expression."""
    h = P.where_in(cal_df, "overall_alert", URGENT, normalize=False)
    h = h.withColumn("alert_priority", cal.alert_priority("overall_alert"))
    order = [("alert_priority", "desc", "last"), ("lic_term_date", "asc", "first"),
             ("pbj_term_date", "asc", "first"), ("ccn", "asc", "last")]
    return R.sort_rows(h, order)
