"""Page gaps, run history, figures and the report lines against brute force and hand-made cases."""

import random

from pyspark.sql import functions as F

from carewatch.operators import quality as Q
from carewatch.plans import feature_queries, references, vbp
from carewatch.sources import sinks as SK
from conftest import rows


def test_page_gaps(spark):
    rng = random.Random(6)
    pages, want = [], []
    for ds in ("a", "b", None):
        top, held = 0, 0
        own = sorted((rng.randint(0, 900), rng.choice([0, 1, 7, 40])) for _ in range(60))
        for at, n in sorted((a, a + n) for a, n in own if n):
            if at > held:
                want.append((ds, held, at, "missing"))
            elif at < held:
                want.append((ds, at, min(n, held), "overlap"))
            held = max(held, n)
            top = max(top, held)
        want.append((ds, top, 2000, "missing"))
        pages += [(ds, a, n, 2000) for a, n in own]
    pages.append(("empty", 0, 0, 5))
    want.append(("empty", 0, 5, "missing"))
    pages.append(("whole", 0, 5, 5))
    pages.append(("unknown", 0, 5, None))
    df = spark.createDataFrame(pages, "dataset string, offset int, n_rows int, declared int").repartition(3)
    got = [(r["dataset"], r["gap_start"], r["gap_end"], r["kind"]) for r in Q.page_gaps(df).collect()]
    named = [w for w in want if w[0] is not None]
    assert sorted(g for g in got if g[0] is not None) == sorted(named)


def test_history_and_as_of(spark, tmp_path):
    a = spark.createDataFrame([(i, "x") for i in range(20)], "k int, v string")
    for day, df in (("2026-01-01", a), ("2026-02-01", a), ("2026-03-01", a.where("k < 10").withColumn("w", F.lit(1)))):
        SK.write_snapshot(Q.profile(df, "t"), str(tmp_path / "s"), day)
    store = spark.read.parquet(str(tmp_path / "s"))
    assert SK.last_run_before(store) == "2026-03-01"
    assert SK.last_run_before(store, "2026-03-01") == "2026-02-01"
    assert SK.last_run_before(store, "2026-01-01") is None
    assert SK.read_run(spark, str(tmp_path / "s"), None).count() == 0
    got = rows(Q.drift_history(store), "run_date", "prev_run", "field", "signal")
    assert got == [("2026-03-01", "2026-02-01", "*", "row_count_moved"), ("2026-03-01", "2026-02-01", "w", "field_new")]


def test_figures(spark):
    t = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (None, "b")], "x int, s string")
    f = [{"figure": "share", "dataset": "t", "kind": "pct", "numerator": "s = 'a'", "denominator": None, "stated": 50, "digits": 0},
         {"figure": "within", "dataset": "t", "kind": "pct", "numerator": "x > 1", "denominator": "s = 'a'", "stated": 50.04, "digits": 1},
         {"figure": "off", "dataset": "t", "kind": "count", "numerator": "x > 1", "denominator": None, "stated": 3, "digits": 0},
         {"figure": "sum", "dataset": "t", "kind": "value", "numerator": "sum(x)", "denominator": None, "stated": 6, "digits": 0},
         {"figure": "none", "dataset": "t", "kind": "pct", "numerator": "x > 1", "denominator": "s = 'z'", "stated": 0, "digits": 0}]
    assert rows(Q.compute_figures({"t": t}, f), "figure", "computed", "ok") == [
        ("none", None, False), ("off", 2.0, False), ("share", 50.0, True), ("sum", 6.0, True), ("within", 50.0, True)]


def test_vbp_report_rounds_as_print_does(spark):
    raw = spark.createDataFrame([(f"{i:06d}", f"Fac {i}", "HI" if i < 6 else "CA", s, m) for i, (s, m) in enumerate([
        ("20.25", "1.00005"), ("20.35", "0.99"), ("---", "1"), ("40", "N/A"), ("60", "1.01"), ("80.125", "1.02"), ("10", "0.9")])],
        "`CMS Certification Number (CCN)` string, `Provider Name` string, State string, `Performance Score` string, `Incentive Payment Multiplier` string")
    text = {r["line_no"]: r["text"] for r in vbp.report(raw, "2026-07-21", scope="HI", n=2).collect()}
    assert text[6] == "UNIVERSE: 6 facilities (5 with VBP score, 1 below case minimum / not scored)"
    assert text[7].endswith(" 3") and text[8].endswith(" 1")
    assert text[11] == f"  Q1={20.275:.1f}  Median={30.175:.1f}  Q3={55.0:.1f}"
    assert text[111] == f"  {'Fac 0':<45} Score={20.25:.2f}  Multiplier={1.00005:.4f}  NatTier=BOTTOM_QUARTILE"
    assert text[211] == f"  {'Fac 5':<45} Score={80.125:.2f}  Multiplier={1.02:.4f}  NatTier=TOP_QUARTILE"
    assert sorted(text)[-1] == 405 and len(text) == len(set(text))


def test_required_reference_members(spark):
    pages = spark.createDataFrame([(" 99307", "Visits", 0), ("10000", "Visits", 1)], "HCPCS string, rbcs_category string, _pos int")
    table, members, per = references.rbcs_reference(pages)
    assert table.columns == ["HCPCS", "rbcs_category"]
    assert rows(members) == [("99307", True), ("99308", False), ("99309", False), ("99310", False)] and rows(per) == [("Visits", 2)]


def test_preamble_files_are_written_by_every_task(spark, tmp_path):
    """A4: no task writes a whole layout; every file has a head of its own, and a layout without rows has one."""
    made = spark.range(1, 4001).selectExpr("id AS l_orderkey", "substring('ANR', CAST(id % 3 AS INT) + 1, 1) AS l_returnflag",
                                           "CAST(id % 7 + 1 AS INT) AS l_linenumber")
    for i, li in enumerate((made, made.where("l_linenumber <= 2"), made.limit(0))):
        li.repartition(6).write.parquet(f"{tmp_path}/{i}/lineitem.parquet")
        spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a file a task
        try:
            got = feature_queries.preamble_csv(spark, f"{tmp_path}/{i}")
        finally:
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert rows(got) == rows(li.selectExpr("CAST(l_orderkey AS STRING)", "l_returnflag", "CAST(l_linenumber AS STRING)"))
        assert len(got.inputFiles()) == (14, 8, 2)[i]
