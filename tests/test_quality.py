"""Data-quality checks (J1-J21) on FIXTURES cases."""

from pyspark.sql import functions as F

from carewatch.operators import quality as Q
from conftest import rows


def frame(spark):
    data = []
    for i in range(100):
        a = f"v{i}" if i < 5 else ""
        c = str(i * 1.5) if i < 40 else "text"
        data.append((a, "x", c))
    return spark.createDataFrame(data, "a string, b string, c_rate string")


def test_null_constant_type(spark):
    df = frame(spark)
    nr = {r["field"]: (r["null_rate"], r["flagged"]) for r in Q.null_rates(df, "d").collect()}
    assert nr["a"] == (0.95, True) and nr["b"][1] is False
    cc = {r["field"]: r["flagged"] for r in Q.constant_columns(df, "d").collect()}
    assert cc == {"a": False, "b": True, "c_rate": False}
    ta = {r["field"]: (r["parse_rate"], r["flagged"]) for r in Q.type_anomalies(df, "d").collect()}
    assert ta == {"c_rate": (0.4, True)}


def test_suppression_and_ghosts(spark):
    p = Q.profile(frame(spark), "d", numeric_hints=("rate",))
    f = Q.findings_from_profile(p).select("dataset", "check", "field")
    known = spark.createDataFrame([("d", "b", "constant_value"), ("d", "zz", "null_rate")], "dataset string, field string, check string")
    kept = rows(Q.apply_suppressions(f, known), "field", "check")
    assert ("b", "constant_value") not in kept and ("a", "null_rate") in kept
    have = spark.createDataFrame([("d", c) for c in frame(spark).columns], "dataset string, field string")
    assert rows(Q.ghost_suppressions(known, have), "field") == [("zz",)]
    ff = spark.createDataFrame([("d", "a")], "dataset string, field string")
    cls = rows(Q.classify(Q.apply_suppressions(f, known), ff), "field", "severity")
    assert ("a", "BLOCKING") in cls and ("c_rate", "LATENT") in cls
    assert rows(Q.dataset_status(Q.classify(f, ff))) == [("d", "BLOCKING")]


def test_drift_five_signals_and_idempotent(spark):
    prev = spark.createDataFrame([("t", f, 100, n, c) for f, n, c in
                                  [("e", 0.0, False), ("f", 0.10, False), ("g", 0.0, True)]],
                                 "dataset string, field string, row_count long, null_rate double, is_constant boolean")
    curr = spark.createDataFrame([("t", f, 106, n, c) for f, n, c in
                                  [("d", 0.0, False), ("f", 0.92, False), ("g", 0.0, False)]],
                                 "dataset string, field string, row_count long, null_rate double, is_constant boolean")
    sig = rows(Q.drift(prev, curr, 0.05, 0.90), "field", "signal")
    assert sig == [("*", "row_count_moved"), ("d", "field_new"), ("e", "field_dropped"), ("f", "null_rate_crossed"),
                   ("g", "constant_flipped")]
    assert Q.drift(prev, prev).count() == 0


def test_page_audit(spark):
    pages = spark.createDataFrame([("ds", 0, 25, 1), ("ds", 10, 25, 10), ("ds", 20, 25, 5)],
                                  "dataset string, offset long, declared long, n_rows long")
    r = Q.audit_pages(pages, 10).collect()[0]
    assert (r["landed"], r["missing_rows"], r["missing_pages"], r["short_pages"]) == (16, 9, 0, 1)
    gap = spark.createDataFrame([("ds", 0, 25, 10), ("ds", 20, 25, 5)], "dataset string, offset long, declared long, n_rows long")
    r = Q.audit_pages(gap, 10).collect()[0]
    assert (r["missing_pages"], r["first_missing_offset"]) == (1, 10)


def test_counts_ranges_unique_singleton(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 200.0), (2, 50.0)], "k int, v double")
    assert rows(Q.check_counts(df, [("all", None, 1, 10), ("big", F.col("v") > 100, 0, 0)]), "check", "value", "ok") == \
        [("all", 3, True), ("big", 1, False)]
    assert rows(Q.check_ranges(df, [("v", "v", 0.0, 110.0, "warn")]), "n_outside", "ok") == [(1, False)]
    assert rows(Q.check_unique(df, "k")) == [(1, 2)]
    assert rows(Q.check_singleton(df, F.col("k") == 2), "ok") == [(True,)]
    assert rows(Q.check_nonempty(df.where("k > 5")), "ok") == [(False,)]


def test_join_check_and_cross_source(spark):
    before = spark.createDataFrame([(1,), (2,)], "k int")
    after = spark.createDataFrame([(1, True), (2, False)], "k int, m boolean")
    assert rows(Q.check_join(before, after, "m", 0.5), "check", "ok") == [("match_rate", True), ("row_count_unchanged", True)]
    counts = spark.createDataFrame([("a", 1000), ("b", 1001), ("c", 900)], "dataset string, rows long")
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "none")], "left string, right string")
    assert rows(Q.cross_source(counts, pairs), "right", "rel_diff", "ok") == [("b", 0.001, True), ("c", 0.1, False)]


def test_reconcile_figures_vintage(spark):
    d = spark.createDataFrame([(1, 3), (2, 1)], "k int, n int")
    s = spark.createDataFrame([(1, 3), (3, 2)], "k int, n int")
    assert rows(Q.reconcile_totals(d, s, "k", ["n"]), "k", "diff_n", "agree") == [(1, 0, True), (2, 1, False), (3, -2, False)]
    comp = spark.createDataFrame([("f", 6563, 14425)], "figure string, numerator long, denominator long")
    figs = spark.createDataFrame([("f", 45.5, 1), ("g", 1.0, 1)], "figure string, stated_pct double, digits int")
    assert rows(Q.check_figures(comp, figs), "figure", "ok") == [("f", True), ("g", False)]
    prev = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    curr = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert rows(Q.vintage_changes(prev, curr, "k", ["v"]), "k", "change", "old", "new") == \
        [(1, "removed", None, None), (2, "changed", "b", "c"), (3, "added", None, None)]


def test_expected_values(spark):
    actual = spark.createDataFrame([(1, 2873, 47.3)], "star int, n long, avg double")
    exp = spark.createDataFrame([(1, "n", 2873.0, 0.0), (1, "avg", 47.2, 5.0)], "star int, metric string, expected double, tol_pct double")
    assert rows(Q.check_expected(actual, "star", exp, ["n", "avg"]), "metric", "ok") == [("avg", True), ("n", True)]
