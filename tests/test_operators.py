"""Joins, aggregates, ranking and set operators on FIXTURES cases."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from carewatch.operators import aggs as A
from carewatch.operators import joins as J
from carewatch.operators import ranking as R
from carewatch.operators import sets as S
from conftest import rows


def test_lookup_or_self_and_miss_count(spark):
    ref = spark.createDataFrame([("F", "600", "Abuse", "d600")], "p string, n string, cat string, descr string")
    df = spark.createDataFrame([("F", "600", "Own", "x"), ("F", "999", "Other", "y")],
                               "p string, n string, own_cat string, own_desc string")
    out = J.lookup_or_self(df, ref, ["p", "n"], {"category": ("cat", "own_cat")}, matched="hit")
    assert rows(out, "n", "category", "hit") == [("600", "Abuse", True), ("999", "Other", False)]
    assert out.where(~F.col("hit")).count() == 1


def test_lookup_never_fans_out(spark):
    ref = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new")], "k string, seq int, v string")
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    out = J.lookup(df, ref, "k", ["v"], seq="seq", defaults={"v": "none"})
    assert rows(out) == [("a", "new"), ("b", "none")]


def test_left_fill_and_star_bands(spark):
    from carewatch.plans.measures import star_bands
    info = spark.createDataFrame([("x", "1", 0.5, 50.0), ("y", "1", 0.7, None), ("z", "2", 0.9, 40.0),
                                  ("w", "N/A", 1.0, 1.0)], "ccn string, overall_star string, rn_hprd double, "
                                                           "total_nurse_turnover double")
    cit = spark.createDataFrame([("x",), ("x",), ("x",), ("z",)], "ccn string")
    got = rows(star_bands(cit, info), "overall_star", "facility_count", "avg_total_citations")
    assert got == [(1, 2, 1.5), (2, 1, 1.0)]


def test_hub_keeps_spine_count(spark):
    spine = spark.createDataFrame([("1",), ("2",), ("3",), ("",)], "k string")
    src = spark.createDataFrame([("000001", "a"), ("000001", "b"), ("000002", "c"), ("", "blank")], "k2 string, v string")
    hub = J.build_hub(spine, [J.Source("s", src, "k", "k2", ["v"], "s_matched", pad=6),
                              J.Source("opt", None, "k", "k", optional=True)])
    assert hub.count() == 4
    assert rows(hub, "k", "s_matched") == [("", False), ("1", True), ("2", True), ("3", False)]


def test_outer_merge_union_of_keys(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(2, 20), (3, 30)], "k int, b int")
    assert rows(J.outer_merge([a, b], "k")) == [(1, "x", None), (2, "y", 20), (3, None, 30)]
    assert rows(J.outer_merge([a, b], "k", assume_unique=False)) == [(1, "x", None), (2, "y", 20), (3, None, 30)]


def test_reconcile_keys(spark):
    spine = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    src = spark.createDataFrame([(2,), (3,), (4,), (4,)], "k int")
    got = rows(J.reconcile_keys(spine, "k", {"src": (src, "k")}).where(F.col("source") == "src"))
    assert got == [("src", 4, 3, 2, 1, 1)]


def test_override_lookup_last_valid_wins(spark):
    manual = spark.createDataFrame([("12", "2026-01-01", 1), ("12", "bad", 2), ("12", "2026-03-01", 3),
                                    ("7", "nope", 1)], "ccn string, term_date string, seq int")
    df = spark.createDataFrame([("000012",), ("000007",)], "ccn string")
    out = J.override_lookup(df, manual, "ccn", "ccn", "term_date", "seq", pad=6)
    assert rows(out.select("ccn", F.col("manual_term_date").cast("string"))) == [("000007", None), ("000012", "2026-03-01")]


def test_interval_lookup_join(spark):
    ranges = spark.createDataFrame([("A00", "B99", "c1"), ("C00", "D49", "c2")], "lo string, hi string, ch string")
    df = spark.createDataFrame([("A10",), ("D40",), ("Z00",)], "code string")
    assert rows(J.interval_lookup(df, ranges, "code", "lo", "hi", ["ch"])) == [("A10", "c1"), ("D40", "c2"), ("Z00", None)]


def test_weighted_rate_not_mean_of_ratios(spark):
    df = spark.createDataFrame([("s", 10, 1000), ("s", 1, 10)], "st string, n int, d int")
    got = rows(A.weighted_rate(df, "st", "n", "d", scale=1000, digits=2), "rate")
    assert got == [(10.89,)]


def test_event_rollup(spark):
    ev = spark.createDataFrame([
        ("A", 1, "Fine", 100.0, "2025-01-02", "Name A"), ("A", 2, "Fine", None, "2025-03-01", "Other"),
        ("A", 3, "Payment Denial", None, "2025-02-01", "x"), ("B", 1, "Payment Denial", None, "2025-01-05", "Name B")],
        "ccn string, seq int, t string, amt double, d string, name string")
    out = A.event_rollup(ev, "ccn", "t", "amt", "d", "seq", name_col="name")
    got = rows(out, "ccn", "name", "total_events", "fine_count", "fine_total", "payment_denial_count", "most_recent")
    assert got == [("A", "Name A", 3, 2, 100.0, 1, "2025-03-01"), ("B", "Name B", 1, 0, 0.0, 1, "2025-01-05")]


def test_any_flags_owner_counts(spark):
    o = spark.createDataFrame([("e1", "I", "Y"), ("e1", "O", "N"), ("e2", "O", "n")], "e string, t string, pe string")
    got = rows(A.any_flags(o, "e", ["pe"], type_col="t"), "e", "n_rows", "n_individual", "pe_any")
    assert got == [("e1", 2, 1, True), ("e2", 1, 0, False)]


def test_bucket_other_count(spark):
    df = spark.createDataFrame([("z", "314000000X"), ("z", "311Z00000X")], "zip string, code string")
    out = A.bucket_counts(df, "zip", {"snf": F.col("code") == "314000000X"}, other="other")
    assert rows(out, "snf", "other", "total_rows") == [(1, 1, 2)]


def test_average_rank_percentile(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 2, 8])] + [(9, None)], "id int, x double")
    got = rows(R.pct_rank_avg(df, "x", out="p"), "id", "p")
    assert got == [(0, 0.25), (1, 0.625), (2, 0.625), (3, 1.0), (9, None)]
    win = rows(R.pct_rank_window(df, "x", out="p"), "id", "p")
    assert win == got


def test_quartile_tiers_and_quantiles(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 4, 8]] + [(None,)], "x double")
    q = rows(A.quartiles(df, "x"), "q25", "median", "q75")
    assert q == [(1.75, 3.0, 5.0)]
    got = rows(R.quartile_tier(df, "x", out="t"), "x", "t")
    assert got == [(1.0, "BOTTOM_QUARTILE"), (2.0, "BELOW_MEDIAN"), (4.0, "ABOVE_MEDIAN"), (8.0, "TOP_QUARTILE"),
                   (None, None)]
    no = rows(R.quartile_tier(df, "x", out="t", unscored="NO_SCORE").where(F.col("x").isNull()), "t")
    assert no == [("NO_SCORE",)]


def test_rank_matches_sql_rank_and_is_partition_invariant(spark):
    import random
    rnd = random.Random(7)
    data = [(i, rnd.choice([1.0, 2.0, 2.0, 3.0, 5.0, 5.0, 5.0, 8.0]), rnd.choice("ab")) for i in range(400)]
    df = spark.createDataFrame(data, "id int, x double, g string")
    ours = rows(R.rank_by(df, "x", by="g", out="r"), "id", "r")
    ref = rows(df.select("id", F.rank().over(Window.partitionBy("g").orderBy("x")).alias("r")))
    assert ours == ref
    again = rows(R.rank_by(df.repartition(7), "x", by="g", out="r", n_buckets=5), "id", "r")
    assert again == ours


def test_position_of(spark):
    df = spark.createDataFrame([("a", 10.0), ("b", 30.0), ("c", 30.0), ("d", 5.0)], "k string, v double")
    assert rows(R.position_of(df, "k", "v", "c")) == [("c", 30.0, 2, 4)]


def test_top_n_and_dedupe(spark):
    df = spark.createDataFrame([("s", 1, 5.0), ("s", 2, 9.0), ("s", 3, 9.0), ("t", 4, 1.0)], "g string, id int, v double")
    assert rows(R.top_n(df, "v", 2, "g", tie_break=["id"]), "g", "id", "rn") == [("s", 2, 1), ("s", 3, 2), ("t", 4, 1)]
    assert rows(R.dedupe_keep(df, "g", ["v", "id"]), "g", "id") == [("s", 1), ("t", 4)]


def test_union_and_required_members(spark):
    a = spark.createDataFrame([("1", "x")], "`ENROLLMENT ID` string, PROPRIETARY_NONPROFIT string")
    b = spark.createDataFrame([("2", "y")], "`ENROLLMENT ID` string, `PROPRIETARY NONPROFIT` string")
    from carewatch.plans.facility import enrollments_all_types
    u = enrollments_all_types([(a, "SNF"), (b, "HHA")])
    assert rows(u, "enrollment_id", "proprietary_nonprofit", "provider_type_label") == [("1", "x", "SNF"), ("2", "y", "HHA")]
    req = S.required_members(spark.createDataFrame([("p",)], "c string"), "c", ["p", "q"])
    assert rows(req) == [("p", True), ("q", False)]
    assert rows(S.except_keys(b.withColumnRenamed("ENROLLMENT ID", "k"), a.withColumnRenamed("ENROLLMENT ID", "k"), "k"),
                "k") == [("2",)]


def test_compare_to_benchmark(spark):
    df = spark.createDataFrame([("HI", 5.0, 1.0, 2.0), ("NATION", 4.0, 1.05, 2.0)], "s string, a double, b double, c double")
    got = rows(A.compare_to_benchmark(df, "s", "HI", "NATION", ["a", "b", "c"]), "metric", "flag")
    assert got == [("a", "HIGHER"), ("b", ""), ("c", "")]


def test_lookup_without_sequence_keeps_row_count(spark):
    ref = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "k string, v string")
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "k string")
    out = J.lookup(df, ref, "k", ["v"])
    assert out.count() == 4
    assert rows(out) == [("a", "y"), ("a", "y"), ("b", "z"), ("c", None)]
    own = spark.createDataFrame([("a", "own")], "k string, own string")
    assert J.lookup_or_self(own, ref, "k", {"v2": ("v", "own")}).count() == 1
