"""More domain builds: census pivot and merge, facility hub, exclusions, quality
measures, state benchmarks; gzip CSV and numeric-text sort."""

import gzip
import json
import os
import tempfile

from carewatch.functions import constants as K
from carewatch.operators import ranking as R
from carewatch.plans import access, facility, measures
from carewatch.sources import readers as RD
from conftest import rows


def test_census_pivot_and_merge(spark):
    d = tempfile.mkdtemp(prefix="cw-test-")
    header = [K.CENSUS_TOTAL_CELL] + K.CENSUS_65PLUS_CELLS + ["zip code tabulation area"]
    r1 = ["1000"] + ["10"] * 11 + ["-666666666"] + ["96701"]
    with open(os.path.join(d, "b01001.json"), "w") as f:
        json.dump([header, r1], f)
    raw = RD.read_array_rows(spark, os.path.join(d, "b01001.json"))
    c = access.census_65plus(raw, "2023-5yr")
    assert rows(c, "ZIP", "Population_Total", "Population_65Plus", "suppressed_cells") == [("96701", 1000, 110, 1)]
    inc = spark.createDataFrame([("96701", 50000.0), ("96702", 1.0)], "zcta string, median_hh_income double")
    race = spark.createDataFrame([("96701", 0.5)], "zcta string, pct_white double")
    assert rows(access.census_demographics([inc, race])) == [("96701", 50000.0, 0.5), ("96702", 1.0, None)]


def test_facility_master_hub_and_checks(spark):
    enroll = spark.createDataFrame([("e1", "1234567890", "12009", "96701-0001"), ("e2", "", "", "96702")],
                                   "enrollment_id string, npi string, ccn string, zip string")
    pos = spark.createDataFrame([("012009", "Fac A")], "prvdr_num string, pos_fac_name string")
    demo = spark.createDataFrame([("96701", 50000.0)], "zcta string, median_hh_income double")
    master, checks = facility.facility_master(enroll, pos, None, demo, None)
    assert master.count() == 2
    assert rows(master, "enrollment_id", "pos_matched", "zcta_matched", "npi_uri") == [
        ("e1", True, True, K.NPI_URI_BASE + "1234567890"), ("e2", False, False, "")]
    assert rows(checks, "check", "ok") == [("match_rate", True), ("row_count_unchanged", True), ("zcta_match_rate", False)]


def test_exclusion_tiers(spark):
    ex = spark.createDataFrame([("0000000000", "DOE", "", "1128a2", "HI"), ("1234567890", "", "ACME LLC", "1128b7", "HI"),
                                ("", "ROE", "", "9999", "CA")],
                               "NPI string, LASTNAME string, BUSNAME string, EXCLTYPE string, STATE string")
    out = facility.exclusion_tiers(ex)
    assert rows(out["exclusions"], "EXCLTYPE", "severity_tier", "npi_present", "is_individual") == [
        ("1128a2", "CRITICAL", False, True), ("1128b7", "ELEVATED", True, False), ("9999", "INFORMATIONAL", False, True)]
    assert rows(out["by_state"], "STATE", "n") == [("CA", 1), ("HI", 2)]


def test_quality_measures_interval_match(spark):
    raw = spark.createDataFrame([("015009", "401", "12.5"), ("015009", "999", "N/A")],
                                "ccn string, measure_code string, four_quarter_average_score string")
    iv = spark.createDataFrame([("401", "01/01/2024", "12/31/2024")],
                               "measure_code string, data_collection_period_from_date string, "
                               "data_collection_period_through_date string")
    out = measures.quality_measures(raw, iv, "mds")
    assert rows(out["measures"], "measure_code", "collection_from") == [("401", "01/01/2024"), ("999", "")]
    assert rows(out["interval_match"], "rows", "matched") == [(2, 1)]


def test_state_benchmarks(spark):
    b = spark.createDataFrame([("HI", "3.9", "20"), ("CA", "4.1", "30"), ("NATION", "3.8", "25")],
                              "state_or_nation string, avg_hprd string, fines string")
    out = measures.state_benchmarks(b, "HI", ["avg_hprd", "fines"], rank_metric="avg_hprd")
    assert rows(out["comparison"], "metric", "flag") == [("avg_hprd", "HIGHER"), ("fines", "LOWER")]
    assert rows(out["position"], "state_or_nation", "position", "of_n") == [("HI", 2, 2)]
    assert rows(out["nation_singleton"], "ok") == [(True,)]


def test_gzip_csv_and_numeric_sort(spark):
    d = tempfile.mkdtemp(prefix="cw-test-")
    with gzip.open(os.path.join(d, "a.csv.gz"), "wt") as f:
        f.write("k,v\na,10\nb,9\nc,x\nd,100\n")
    df = RD.read_text_table(spark, os.path.join(d, "a.csv.gz"), partitions=2)
    assert [r["k"] for r in R.sort_num(df, "v").collect()] == ["b", "a", "d", "c"]
