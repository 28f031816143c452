"""Column builders on the FIXTURES hand-computed cases (K1-K33, traps T2, T3, T7-T10)."""

from pyspark.sql import functions as F

from carewatch.functions import calendar as cal
from carewatch.functions import constants as K
from carewatch.functions import expr as X


def one_col(spark, values, name="v", t="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {t}")


def test_num_sentinels_and_strict_pattern(spark):
    vals = ["$1,250.50", " 7 ", "N/A", "---", "*", "5d", "1_000", "nan", ""]
    df = one_col(spark, vals)
    sent = ["", "N/A", "Not Available", "---", "*"]
    got = [r[0] for r in df.select(X.num("v", sent)).collect()]
    assert got == [1250.5, 7.0] + [None] * 7


def test_census_count_zero_vs_median_null(spark):
    df = one_col(spark, ["-666666666", "12"])
    got = df.select(X.num("v", K.SENTINELS_CENSUS, on_missing=0).alias("count"),
                    X.is_sentinel("v").alias("suppressed"),
                    X.num("v", K.SENTINELS_CENSUS).alias("median")).collect()
    assert [tuple(r) for r in got] == [(0.0, True, None), (12.0, False, 12.0)]


def test_pad_key_never_truncates(spark):
    df = one_col(spark, ["12009", "125009", "1250091", "", " 42\t"])
    got = [tuple(r) for r in df.select(X.pad_key("v", 6), X.pad_key("v", 6, blank="000000")).collect()]
    assert got == [("012009", "012009"), ("125009", "125009"), ("1250091", "1250091"),
                   (None, "000000"), ("000042", "000042")]


def test_four_part_test_false_when_part_missing(spark):
    rows = [(0.60, 0.60, 2.50, 3.50), (0.60, 0.60, 2.44, 3.50), (None, 0.60, 2.50, 3.50), (0.55, 0.55, 2.45, 3.48)]
    df = spark.createDataFrame(rows, "rn double, rnw double, cna double, total double")
    m = X.meets_all({"rn": 0.55, "rnw": 0.55, "cna": 2.45, "total": 3.48})
    got = [tuple(r) for r in df.select(m["meets_rn"], m["meets_all"], m["n_missing_parts"]).collect()]
    assert got == [(True, True, 0), (True, False, 0), (None, False, 1), (True, True, 0)]


def test_severity_grid_and_flags(spark):
    df = one_col(spark, ["D", "G", "J", "x"])
    g = X.severity_grid("v")
    df = df.select("v", *[c.alias(k) for k, c in g.items()])
    f = X.level_flags("v", "severity_level")
    got = [tuple(r) for r in df.select("severity_level", "scope", f["is_actual_harm"], f["is_immediate_jeopardy"]).collect()]
    assert got == [(2, "Isolated", False, False), (3, "Isolated", True, False), (4, "Isolated", True, True),
                   (None, "", False, False)]


def test_direction_footnote_pair_flag(spark):
    df = spark.createDataFrame([(1.01, "", 300.0, 250.0), (0.99, "---", 300.0, None),
                                (1.0, "Below Case Minimum", None, None), (None, "Other text", 100.0, 100.0)],
                               "m double, fn string, a double, b double")
    got = [tuple(r) for r in df.select(X.direction("m"), X.suppression("fn"), X.pair_sum_flag("a", "b", 500)).collect()]
    assert got == [("BONUS", "", True), ("PENALTY", "", False), ("NEUTRAL", "VOL_SUPPRESSED", None),
                   ("NEUTRAL", "SUPPRESSED", False)]


def test_rounding_families(spark):
    df = spark.createDataFrame([(0.125,), (12.5,)], "x double")
    got = [tuple(r) for r in df.select(X.round_half_up("x", 2), X.round_half_even("x", 2),
                                       X.round_half_up("x", 0), X.round_half_even("x", 0)).collect()]
    assert got == [(0.13, 0.12, 0.0, 0.0), (12.5, 12.5, 13.0, 12.0)]


def test_ratio_guards(spark):
    df = spark.createDataFrame([(50.0, 100.0), (5.0, 0.0), (None, 10.0)], "n double, d double")
    got = [r[0] for r in df.select(X.ratio("n", "d", 100, 1)).collect()]
    assert got == [50.0, None, None]


def test_label_precedence(spark):
    df = spark.createDataFrame([("z", True, 50), ("z", False, None), ("z", False, 99), ("z", False, 100)],
                               "k string, mil boolean, pop int")
    got = [r[0] for r in df.select(X.reliability_label("k", "mil", "pop", 100)).collect()]
    assert got == ["z **", "z ***", "z *", "z"]
    small = [r[0] for r in df.select(X.small_flag("pop", 100)).collect()]
    assert small == [True, True, True, False]


def test_chapters_and_codes(spark):
    from carewatch.operators.joins import interval_label
    df = one_col(spark, ["E1165", "O9A1", "Y07", "ZZZ", "A0"])
    ch = interval_label(X.category3("v"), K.ICD10_CHAPTERS, default="Unknown")
    got = [tuple(r) for r in df.select(ch["label"], X.dot_code("v"), X.prefix_flags("v")["is_perpetrator_code"]).collect()]
    assert got == [("Chapter 4", "E11.65", False), ("Chapter 15", "O9A.1", False), ("Chapter 20", "Y07", True),
                   ("Unknown", "ZZZ", False), ("Unknown", "A0", None)]


def test_code_tier_and_ids(spark):
    df = spark.createDataFrame([(" 1128 a2 ", "0000000000", "I"), ("XYZ", "1234567890", "o")],
                               "code string, npi string, t string")
    got = [tuple(r) for r in df.select(X.code_tier("code"), X.has_real_id("npi"), X.is_individual("t")).collect()]
    assert got == [("CRITICAL", False, True), ("INFORMATIONAL", True, False)]


def test_text_helpers(spark):
    df = spark.createDataFrame([("F", "600", "12345", "12345"), ("", "9", "", "99999")],
                               "p string, n string, a string, b string")
    got = [tuple(r) for r in df.select(X.join_code("p", "n"), X.uri("u/", "n"), X.differs("a", "b"),
                                       X.yn_present("p")).collect()]
    assert got == [("F-600", "u/600", False, "Y"), ("", "u/9", False, "N")]


def test_row_sum(spark):
    df = spark.createDataFrame([(1, 2), (None, 3), (None, None)], "a int, b int")
    assert [r[0] for r in df.select(X.row_sum(["a", "b"])).collect()] == [3, 3, None]


def test_alert_ladder(spark):
    as_of = "2026-07-15"
    terms = ["2026-07-31", "2026-09-30", "2026-12-31", "2027-06-30", "2026-07-14"]
    df = spark.createDataFrame([(t,) for t in terms], "t string").select(F.col("t").cast("date").alias("t"))
    a = cal.alert("t", F.date_sub("t", 90), as_of)
    assert [r[0] for r in df.select(a).collect()] == ["CRITICAL", "WARNING", "UPCOMING", "OK", "OVERDUE"]


def test_deadline_parity_and_option(spark):
    df = spark.createDataFrame([("2026-07-15",), ("2026-01-10",)], "a string")
    nd = cal.next_deadline(F.col("a"))
    nd2 = cal.next_deadline(F.col("a"), include_prior_q4=True)
    got = [tuple(r) for r in df.select(nd["deadline"].cast("string"), nd["deadline_label"],
                                       nd2["deadline"].cast("string")).collect()]
    assert got == [("2026-08-14", "Q2 2026 (Apr-Jun 2026)", "2026-08-14"),
                   ("2026-05-15", "Q1 2026 (Jan-Mar 2026)", "2026-02-14")]


def test_fiscal_year_end(spark):
    df = spark.createDataFrame([("12-31",), ("02-30",), ("13-01",), ("Not Available",)], "fy string")
    b = cal.fy_bounds("fy", "2026-07-15")
    due = cal.month_end_after(b["fy_end_next"])
    got = [tuple(r) for r in df.select(b["fy_end_next"].cast("string"), due.cast("string")).collect()]
    assert got == [("2026-12-31", "2027-05-31"), ("2027-02-28", "2027-07-31"), (None, None), (None, None)]
    staged = cal.with_fy_bounds(df, "fy", "2026-07-15").select(F.col("fy_end_next").cast("string"))
    assert [r[0] for r in staged.collect()] == ["2026-12-31", "2027-02-28", None, None]


def test_worst_alert(spark):
    df = spark.createDataFrame([("MANUAL_CHECK", "CRITICAL", "N_A"), ("MANUAL_CHECK", "N_A", "N_A")], "a string, b string, c string")
    assert [r[0] for r in df.select(cal.worst("a", "b", "c")).collect()] == ["CRITICAL", "MANUAL_CHECK"]
