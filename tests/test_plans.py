"""Domain builds (P-jobs) on small hand-computed fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from carewatch.plans import access, compliance, conformance, facility, measures, references, vbp
from conftest import rows


def test_cost_report_ratios_and_guards(spark):
    raw = spark.createDataFrame([("12009", "n", "HI", "a", "b", "500", "90", "999", "7", "50", "30", "20", "100", "200", "0",
                                  "5", "10", "40")],
                                "`Provider CCN` string, `Facility Name` string, `State Code` string, `Fiscal Year Begin Date` "
                                "string, `Fiscal Year End Date` string, `Total Days Title XVIII` string, `Total Days Title V` "
                                "string, `Total Bed Days Available` string, `Total Costs` string, `SNF Days Title XVIII` string, `SNF Days Title XIX` string, "
                                "`SNF Days Other` string, `SNF Days Total` string, `SNF Bed Days Available` string, "
                                "`Net Patient Revenue` string, `Net Income` string, `Contract Labor` string, "
                                "`Total Salaries` string")
    r = measures.cost_report(raw).collect()[0]
    assert r["ccn"] == "012009"
    assert (r["medicare_days_pct"], r["occupancy_pct"], r["operating_margin_pct"], r["contract_labor_pct"]) == \
        (50.0, 50.0, None, 25.0)
    assert (r["financially_stressed"], r["medicaid_heavy"]) == (False, False)


def test_penalty_rollup(spark):
    raw = spark.createDataFrame([
        ("A", "Name A", "HI", "2025-01-02", "Fine", "$100.00", 1), ("A", "Other", "HI", "2025-03-01", "Fine", "", 2),
        ("A", "x", "HI", "2025-02-01", "Payment Denial", "", 3), ("B", "Name B", "HI", "2025-01-05", "Payment Denial", "N/A", 1)],
        "cms_certification_number string, provider_name string, state string, penalty_date string, penalty_type string, "
        "fine_amount string, pos int")
    out = measures.penalties(raw, "pos")["by_facility"]
    got = rows(out, "ccn", "provider_name", "total_events", "fine_count", "fine_total_dollars", "payment_denial_count",
               "most_recent_penalty")
    assert got == [("A", "Name A", 3, 2, 100.0, 1, "2025-03-01"), ("B", "Name B", 1, 0, 0.0, 1, "2025-01-05")]


def test_owner_flags(spark):
    o = spark.createDataFrame([("e1", "Org", "I", "Y"), ("e1", "Org", "O", "N"), ("e2", "Org2", "O", "n"), ("", "z", "I", "Y")],
                              "`ENROLLMENT ID` string, `ORGANIZATION NAME` string, `TYPE - OWNER` string, "
                              "`PRIVATE EQUITY COMPANY - OWNER` string")
    got = rows(facility.owner_flags(o), "enrollment_id", "owner_count", "individual_owner_count",
               "private_equity_company_owner")
    assert got == [("e1", 2, 1, True), ("e2", 1, 0, False)]


def test_state_table_military_parity(spark):
    an = spark.createDataFrame([
        ("a", "HI", 10, 10, 0, 1000, 1000, 0, 0, "2023"), ("b", "HI", 1, 1, 0, 10, 10, 1, 0, "2023"),
        ("m", "HI", 5, 5, 0, 500, 500, 0, 1, "2023")],
        "ZIP string, State string, total_providers long, facility_count long, individual_count long, "
        "population_total long, population_65plus long, small_denominator_flag int, military_installation_flag int, "
        "acs_year string")
    r = access.access_by_state(an).collect()[0]
    assert r["providers_per_thousand_elderly"] == 10.89
    assert (r["military_zip_count"], r["excluded_military_zips"], r["access_rank"]) == (0, 1, 1)


def test_access_zip_chain(spark):
    npi = spark.createDataFrame([
        ("1", "2", "314000000X", "hi", "96701-1234", "96701", None),
        ("2", "1", "311z00000x", "HI", "96701", "96702", None),
        ("3", "2", "314000000X", "HI", "96701", "96701", "DT"),
        ("4", "2", "999999999X", "HI", "96701", "96701", None)],
        "NPI string, EntityTypeCode string, TaxonomyCode_1 string, PracticeLocationState string, "
        "PracticeLocationPostalCode string, BusinessMailingPostalCode string, NPIDeactivationReasonCode string")
    tax = spark.createDataFrame([("314000000X", "SNF", "", "SNF")], "Code string, Classification string, "
                                "Specialization string, DisplayName string")
    census = spark.createDataFrame([("96701", 1000, 99, "2023")], "ZIP string, Population_Total long, "
                                   "Population_65Plus long, ACS_Year string")
    mil = spark.createDataFrame([("96999",)], "ZIP string")
    out = access.build(npi, tax, census, mil, as_of=dt.date(2026, 1, 1))
    r = out["analysis"].collect()[0]
    assert (r["total_providers"], r["snf_count"], r["other_count"], r["multi_location_indicator"]) == (2, 1, 1, 1)
    assert (r["zip_label"], r["providers_per_thousand_elderly"]) == ("96701 *", 20.2)


def test_vbp_scoring(spark):
    raw = spark.createDataFrame([("000001", "hi", "10", "1.01", ""), ("000002", "HI", "20", "0.99", "---"),
                                 ("000003", "hi", "---", "1.0", "Below case minimum"), ("000004", "CA", "40", "N/A", "x")],
                                "`CMS Certification Number (CCN)` string, State string, `Performance Score` string, "
                                "`Incentive Payment Multiplier` string, "
                                "`Footnote -- Performance Period: FY 2024 Risk-Standardized Readmission Rate` string")
    got = rows(vbp.facility(raw), "ccn", "national_pct_rank", "national_vbp_tier", "state_pct_rank", "payment_direction",
               "fn_snfrm_flag")
    assert got == [("000001", 0.333, "BOTTOM_QUARTILE", 0.5, "BONUS", ""),
                   ("000002", 0.667, "BELOW_MEDIAN", 1.0, "PENALTY", ""),
                   ("000003", None, None, None, None, "VOL_SUPPRESSED"),
                   ("000004", 1.0, "TOP_QUARTILE", 1.0, "NEUTRAL", "SUPPRESSED")]
    st = {r["state"]: r["facility_count"] for r in vbp.states(raw).collect()}
    assert st == {"HI": 2, "CA": 1}
    s = vbp.summary(raw).first()
    assert (s["n_facilities"], s["n_scored"], s["bonus"], s["penalty"]) == (4, 3, 1, 1)
    assert rows(vbp.components(raw), "ccn", "fn_snfrm_flag")[2] == ("000003", "VOL_SUPPRESSED")
    scoped = vbp.facility(raw, scope="ca")
    assert rows(scoped, "ccn", "national_pct_rank") == [("000004", 1.0)]


def test_provider_info_staffing(spark):
    raw = spark.createDataFrame([("1", "0.6", "0.6", "2.5", "3.5", "Chain"), ("2", "", "0.6", "2.5", "3.5", "N/A")],
                                "cms_certification_number_ccn string, reported_rn_staffing_hours_per_resident_per_day string, "
                                "registered_nurse_hours_per_resident_per_day_on_the_weekend string, "
                                "reported_nurse_aide_staffing_hours_per_resident_per_day string, "
                                "reported_total_nurse_staffing_hours_per_resident_per_day string, chain_name string")
    info, mapping = measures.provider_info(raw)
    assert rows(info, "ccn", "lm_rn_meets_3442f", "lm_meets_3442f_thresholds", "lm_chain_affiliated") == \
        [("1", True, True, "Y"), ("2", None, False, "N")]
    assert rows(measures.staffing_summary(info), "facilities", "would_not_meet") == [(2, 1)]
    assert "missing_optional" in {r["status"] for r in mapping.collect()}


def test_citations_with_tag_fallback(spark):
    raw = spark.createDataFrame([("015009", "F", "600", "Own cat", "desc", "J", "2025-01-01"),
                                 ("015009", "F", "999", "Other", "own", "x", "2025-01-01")],
                                "cms_certification_number string, deficiency_prefix string, deficiency_tag_number string, "
                                "deficiency_category string, deficiency_description string, scope_severity_code string, "
                                "survey_date string")
    ftag = spark.createDataFrame([("F", "600", "Free from Abuse", "Freedom from Abuse, Neglect")],
                                 "tag_prefix string, tag_number string, description string, category string")
    out = measures.citations(raw, ftag)
    got = rows(out["citations"], "tag_number", "category", "prefix_tag", "severity_level", "is_immediate_jeopardy",
               "is_abuse_neglect")
    assert got == [("600", "Freedom from Abuse, Neglect", "F-600", 4, True, True), ("999", "Other", "F-999", None, False, False)]
    assert rows(out["misses"], "ftag_misses") == [(1,)]


def test_pac_and_survey(spark):
    pac = spark.createDataFrame([("PROVIDER", "300", "250", "40"), ("PROVIDER", "300", "*", "*"), ("NATION", "1", "1", "1")],
                                "smry_ctgry string, pt_mnts string, ot_mnts string, dual_pct string")
    assert rows(measures.pac_puf(pac), "high_therapy_intensity", "high_dual_pct") == [(False, None), (True, True)]
    old = spark.createDataFrame([("PROVIDER", "300", "250", "40")], "smry_ctgry string, tot_pt string, tot_ot string, dual string")
    assert rows(measures.pac_puf(old), "high_therapy_intensity", "high_dual_pct") == [(True, True)]
    names = ["ccn", "state", "cycle", "survey_date", "count_of_abuse", "count_of_quality_of_life", "count_of_assessment",
             "count_of_nursing", "count_of_rights", "count_of_nutrition", "count_of_pharmacy", "count_of_environ",
             "count_of_administration", "count_of_infection", "count_of_emergency"]
    sv = spark.createDataFrame([("1", "HI", "1", "d", " 2 ", "", "N/A", "3.5", "4", "", "", "", "", "", ""),
                                ("2", "HI", "1", "d", *[""] * 11)], ", ".join(f"{n} string" for n in names))
    assert rows(measures.survey_summary(sv), "ccn", "computed_health_total") == [("1", 6), ("2", None)]
    try:
        measures.survey_summary(sv.drop("count_of_abuse"))
        raise AssertionError("a missing category passed")
    except KeyError:
        pass


def test_compliance_calendar_and_hotlist(spark):
    master = spark.createDataFrame([("12009", "SNF"), ("55", "HHA")], "ccn string, provider_type_label string")
    pos = spark.createDataFrame([("012009", "06-30", 1), ("012009", "12-31", 2), ("012009", "", 3)],
                                "prvdr_num string, fy_end_mo_day_cd string, row int")
    manual = spark.createDataFrame([("12009", "2026-07-31", "State License", "m", "", "", 1)],
                                   "ccn string, term_date string, license_type string, source string, "
                                   "regulatory_ref string, notes string, _seq int")
    c = compliance.calendar(master, pos, manual, dt.date(2026, 7, 15), pos_seq="row")
    got = rows(c.select("ccn", "state_lic_alert", "pbj_alert", F.col("cost_report_term_date").cast("string"),
                        "cost_report_alert", "overall_alert"))
    assert got == [("12009", "CRITICAL", "CRITICAL", "2027-05-31", "OK", "CRITICAL"),
                   ("55", "MANUAL_CHECK", "N_A", None, "N_A", "MANUAL_CHECK")]
    assert rows(compliance.hotlist(c), "ccn") == [("12009",)]


def test_icd_reference(spark):
    raw = spark.createDataFrame([("'E1165'", "Type 2 diabetes"), ("Y07", "Perpetrator")],
                                "`ICD-10-CM CODE` string, `ICD-10-CM CODE DESCRIPTION` string")
    out = references.icd10_reference(raw)
    assert rows(out, "icd10_code", "icd10_dotted", "chapter", "is_perpetrator_code") == \
        [("E1165", "E11.65", "Chapter 4", False), ("Y07", "Y07", "Chapter 20", True)]


def test_conformance_run(spark):
    data = [("v" if i < 5 else "", "x", str(i)) for i in range(120)]
    df = spark.createDataFrame(data, "a string, b string, n_count string")
    reg = [{"name": "t", "known_anomalies": [{"field": "b", "check": "constant_value"}], "finding_fields": ["a"]}]
    out = conformance.run(spark, {"t": df}, reg, pairs=[("t", "t")], expected_fields={"t": ["a", "b", "n_count", "gone"]})
    f = rows(out["findings"], "check", "field", "severity")
    assert ("null_rate", "a", "BLOCKING") in f and ("field_missing", "gone", "LATENT") in f
    assert all(x[1] != "b" for x in f)
    none = conformance.run(spark, {"t": df.limit(0)}, reg)
    assert ("empty_output", "*", "BLOCKING") in rows(none["findings"], "check", "field", "severity")
    assert {r["field"]: r["nunique"] for r in out["profile"].collect()} == {"a": 1, "b": 1, "n_count": 120}
    assert rows(out["status"]) == [("t", "BLOCKING")]
    assert rows(out["cross_source"], "ok") == [(True,)]
    snap = out["profile"]
    assert conformance.run(spark, {"t": df}, reg, previous_snapshot=snap)["drift"].count() == 0
