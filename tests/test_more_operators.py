"""Remaining operators: bulk load, replace table, findings/snapshot sinks, metric
unpivot, medians, rows per key, score carry-back, contracts."""

import os
import tempfile

from pyspark.sql import functions as F

from carewatch.operators import aggs as A
from carewatch.operators import contracts as C
from carewatch.operators import joins as J
from carewatch.sources import readers as RD
from carewatch.sources import sinks as SK
from conftest import rows


def test_load_table_and_sinks(spark):
    d = tempfile.mkdtemp(prefix="cw-test-")
    with open(os.path.join(d, "c.csv"), "w") as f:
        f.write("ZIP,Population_Total,Population_65Plus,ACS_Year\n96701,1000,150,2023-5yr\n")
    t = RD.load_table(spark, os.path.join(d, "c.csv"),
                      "ZIP string, Population_Total int, Population_65Plus int, ACS_Year string", os.path.join(d, "t"))
    assert rows(t) == [("96701", 1000, 150, "2023-5yr")]
    f = spark.createDataFrame([("d", "null_rate", "a", 0.99, "m")], "dataset string, check string, field string, "
                              "metric double, message string")
    SK.write_findings(f, os.path.join(d, "findings"), "2026-07-15")
    SK.write_snapshot(f, os.path.join(d, "snap"), "2026-07-15")
    assert os.path.isdir(os.path.join(d, "findings", "run_date=2026-07-15"))
    assert spark.read.parquet(os.path.join(d, "snap")).count() == 1


def test_unpivot_metrics_and_contracts(spark):
    wide = spark.createDataFrame([("12.5", "---", "x")], "`Baseline Readmission Rate` string, "
                                 "`Performance Readmission Rate` string, other string")
    got = rows(C.unpivot_metrics(wide, {"base": ["baseline", "readmission"], "perf": ["performance", "readmission"]}))
    assert got == [("base", 12.5)]
    raw = spark.createDataFrame([("1", " 5 ", "x")], "`Provider CCN` string, `Total Beds` string, junk string")
    out, rep = C.resolve_columns(raw, [C.Field("ccn", [["ccn"]], match="substr", required=True),
                                       C.Field("beds", [["beds"]], match="substr", parse="int"),
                                       C.Field("missing", [["nope"]], match="substr")])
    assert rows(out) == [("1", 5, None)] and out.columns == ["ccn", "beds", "missing"]
    assert rows(rep, "field", "status") == [("beds", "bound"), ("ccn", "bound"), ("missing", "missing_optional")]
    assert C.select_present(raw, ["junk", "zzz"]).columns == ["junk"]
    assert rows(C.schema_diff(raw, ["junk", "gone"]), "field", "status") == \
        [("Provider CCN", "unexpected"), ("Total Beds", "unexpected"), ("gone", "missing"), ("junk", "present")]
    assert C.normalize_headers(raw).columns == ["provider_ccn", "total_beds", "junk"]


def test_median_rows_per_key_score_all(spark):
    df = spark.createDataFrame([("a", 1, -6.0), ("a", 1, -2.0), ("b", 2, 4.0)], "s string, k int, m double")
    assert rows(A.median_by(df, "m", below=-5), "median", "n_below") == [(-2.0, 1)]
    assert rows(A.median_by(df, "m", by="s", below=-5), "s", "median", "n_below") == [("a", -4.0, 1), ("b", 4.0, 0)]
    assert rows(A.rows_per_key(df, "k"), "rows", "keys", "rows_per_key") == [(3, 2, 1.5)]
    uni = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    sc = spark.createDataFrame([(1, 0.5), (2, 0.9)], "k int, p double")
    assert rows(J.score_all(uni, sc, "k", ["p"])) == [(1, 0.5), (2, 0.9), (3, None)]
    assert rows(A.value_range(df, "m"), "min", "max", "n") == [(-6.0, 4.0, 3)]
    assert rows(A.distinct_counts(df, ["k"], by="s"), "s", "distinct_k") == [("a", 1), ("b", 1)]


def test_replace_table(spark):
    df = spark.createDataFrame([(1,)], "x int")
    SK.replace_table(df, "cw_tmp_replace")
    SK.replace_table(df.union(df), "cw_tmp_replace")
    assert spark.table("cw_tmp_replace").count() == 2
    spark.sql("DROP TABLE cw_tmp_replace")


def test_share_with_event_and_flag_rates(spark):
    uni = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k int")
    ev = spark.createDataFrame([(1, True), (1, True), (2, False)], "k int, fine boolean")
    assert rows(A.share_with_event(ev, uni, "k", F.col("fine")), "universe", "with_event", "share") == [(4, 1, 0.25)]
    assert rows(A.flag_rates(ev, ["fine"], denom=4), "fine_n", "fine_rate") == [(2, 0.5)]


def test_overlapping_ranges_and_repeated_keys(spark):
    df = spark.createDataFrame([("B20",), ("C10",), (None,)], "code string")
    ranges = spark.createDataFrame([("A00", "C99", "first", 1), ("B00", "B99", "second", 2)],
                                   "lo string, hi string, ch string, pos int")
    got = rows(J.interval_lookup(df, ranges, "code", "lo", "hi", ["ch"], seq="pos"))
    assert got == [("B20", "first"), ("C10", "first"), (None, None)]
    nums = spark.createDataFrame([(5.0,), (250.0,)], "x double")
    bands = spark.createDataFrame([(0.0, 9.0, "low"), (100.0, 400.0, "high")], "lo double, hi double, b string")
    assert rows(J.interval_lookup(nums, bands, "x", "lo", "hi", ["b"])) == [(250.0, "high"), (5.0, "low")]
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    try:
        J.outer_merge([twice, spark.createDataFrame([(1, 2)], "k int, w int")], "k").collect()
        raise AssertionError("a repeated key passed")
    except Exception as e:  # noqa: BLE001
        assert "repeated key" in str(e)


def test_hub_exchanges_the_spine_once(spark):
    """Four sources, one exchange that carries the spine's columns."""
    import re
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spine = spark.range(1000).select(F.col("id").cast("string").alias("rid"), (F.col("id") % 7).cast("string").alias("a"),
                                         (F.col("id") % 11).cast("string").alias("b"), F.hex("id").alias("payload"))
        srcs = [spark.range(5).select(F.col("id").cast("string").alias("k"), F.col("id").alias(f"v{i}")) for i in range(4)]
        hub = J.build_hub(spine, [J.Source(f"s{i}", s, "a" if i % 2 else "b", "k", [f"v{i}"]) for i, s in enumerate(srcs)], row_id="rid")
        plan = hub._jdf.queryExecution().executedPlan().toString()
        top = plan.split("SortMergeJoin")[1]  # the spine's own side of its join with the hits
        assert top.count("payload") >= 1 and plan.count("AS payload") == 1
        assert len(re.findall(r"Exchange hashpartitioning\(_rid", plan)) + len(re.findall(r"Exchange hashpartitioning\(_hid", plan)) <= 2
        assert len(re.findall(r"Exchange hashpartitioning\(_src#\d+, _key", plan)) == 2  # all keys, all sources
        got = {r["rid"]: r for r in hub.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(got) == 1000
    for i in range(1000):
        r = got[str(i)]
        assert (r["v0"], r["s0_matched"]) == ((i % 11, True) if i % 11 < 5 else (None, False))
        assert (r["v3"], r["s3_matched"]) == ((i % 7, True) if i % 7 < 5 else (None, False))
    twice = spark.createDataFrame([("1", "1"), ("1", "2")], "rid string, a string")
    try:
        J.build_hub(twice, [J.Source("s", srcs[0], "a", "k", ["v0"])], row_id="rid").collect()
        raise AssertionError("a repeated row id passed")
    except Exception as e:  # noqa: BLE001
        assert "repeated row id" in str(e)
    same = J.build_hub(twice, [J.Source("s", srcs[0].withColumn("o", F.lit(1)), "a", "k", ["v0"], seq="o")])
    assert rows(same, "a", "v0") == [("1", 1), ("2", 2)]


def test_reconcile_pairs(spark):
    a = spark.createDataFrame([(" 1",), ("1",), ("2",), ("",), (None,)], "k string")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    none = spark.createDataFrame([], "k string")
    got = [tuple(r) for r in J.reconcile_pairs({"a": (a, "k"), "b": (b, "k"), "none": (none, "k")}).collect()]
    assert got == [("a", "b", 1, 1, 1), ("a", "none", 0, 2, 0), ("b", "none", 0, 2, 0)]
    assert [tuple(r) for r in J.reconcile_pairs({"x": (none, "k"), "y": (none, "k")}).collect()] == [("x", "y", 0, 0, 0)]
