"""E9 range lookup against brute force: numbers, texts and dates; overlapping, nested, repeated and
open ranges."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from carewatch.operators import joins as J
from carewatch.operators import ordering as O


def brute(keys, ranges, seq):
    def order(r):
        low = (r[0] is not None, r[0] if r[0] is not None else 0 if not isinstance(r[1], str) else "")
        high = (r[1] is None, r[1] if r[1] is not None else 0 if not isinstance(r[0], str) else "")
        return ((r[3],) if seq else ()) + (low, high, r[2])
    out = []
    for k in keys:
        fit = [r for r in ranges if k is not None and (r[0] is None or r[0] <= k) and (r[1] is None or k <= r[1])]
        out.append((k, min(fit, key=order)[2] if fit else None))
    return sorted(out, key=repr)


def make(kind, rng, n):
    if kind == "int":
        return lambda: rng.randint(-n, n)
    if kind == "string":
        return lambda: "".join(rng.choice("aAzé0") for _ in range(rng.randint(0, 3)))
    return lambda: datetime.date(2020, 1, 1) + datetime.timedelta(days=rng.randint(0, n))


@pytest.mark.parametrize("kind", ["int", "string", "date"])
def test_range_lookup(spark, kind):
    rng = random.Random(kind)
    one = make(kind, rng, 400)
    ranges = []
    for k in range(300):
        a, b = one(), one()
        if rng.random() < 0.9 and kind != "string":
            b = a + (b - a) // 12 if kind == "int" else a + abs(b - a) // 12
        ranges.append((a, b, f"r{k}", rng.randint(0, 40)))  # some are the wrong way round
    low, high = min(r[0] for r in ranges), max(r[1] for r in ranges)
    ranges += [(low, None, "open above", 41), (None, low, "open below", 41), (high, high, "point", 0), ranges[0], ranges[1]]
    keys = [one() for _ in range(700)] + [None] * 20 + [low] * 300 + [high] + [r[0] for r in ranges[:50]] + [r[1] for r in ranges[:50]]
    df = spark.createDataFrame([(k, "x") for k in keys], f"k {kind}, winner string").repartition(3)
    rdf = spark.createDataFrame(ranges, f"lo {kind}, hi {kind}, name string, seq int").repartition(4)
    for seq in (None, "seq"):
        got = J.interval_lookup(df, rdf, "k", "lo", "hi", ["name"], seq=seq)
        assert got.columns == ["k", "winner", "name"]
        assert sorted((tuple(r) for r in got.select("k", "name").collect()), key=repr) == brute(keys, ranges, seq)
    assert J.interval_lookup(df, rdf.limit(0), "k", "lo", "hi", ["name"]).where("name is not null").count() == 0
    assert J.interval_lookup(df.limit(0), rdf, "k", "lo", "hi", ["name"]).count() == 0


def test_number_types_meet_and_kinds_do_not(spark):
    nums = spark.createDataFrame([(6,), (7,), (11,)], "k int")
    bands = spark.createDataFrame([(5.0, 10.5, "in")], "lo double, hi double, b string")
    assert sorted(map(tuple, J.interval_lookup(nums, bands, "k", "lo", "hi", ["b"]).collect())) == [(6, "in"), (7, "in"), (11, None)]
    with pytest.raises(TypeError):
        J.interval_lookup(nums, spark.createDataFrame([("a", "b", 1)], "lo string, hi string, b int"), "k", "lo", "hi", ["b"])


def test_place_and_carry(spark):
    df = spark.createDataFrame([(k % 7, k if k % 11 == 0 else None) for k in range(500)], "v int, x int")
    done = O.place(O.in_order(df, ["v"]))
    assert sorted(r[0] for r in done.select("place").collect()) == list(range(500))
    rows = sorted(O.carry_last(done, F.col("x"), "last").select("place", "v", "x", "last").collect())
    assert [r["v"] for r in rows] == sorted(r["v"] for r in rows)
    last = None
    for r in rows:
        last = r["x"] if r["x"] is not None else last
        assert r["last"] == last


def test_nothing_that_grows_is_broadcast(spark, tmp_path):
    """A file's size says little of the rows made from it: only tables of one row a partition are broadcast."""
    spark.range(3000).selectExpr("id AS k").write.parquet(f"{tmp_path}/k")
    spark.range(3000).selectExpr("id AS lo", "id + 500 AS hi", "id % 7 AS seq", "id").write.parquet(f"{tmp_path}/r")
    keys, ranges = (spark.read.parquet(f"{tmp_path}/{x}") for x in "kr")
    won = J.range_winners(keys.selectExpr("k AS v"), ranges.selectExpr("id AS rank", "lo", "hi"))
    joins = re.findall(r"BroadcastHashJoin \[(\w+)#", won._jdf.queryExecution().executedPlan().toString())
    assert joins and set(joins) == {"__part"}
    assert sorted(map(tuple, won.collect())) == [(k, max(0, k - 500)) for k in range(3000)]


@pytest.mark.parametrize("seq", [None, "seq"])
def test_ranges_of_equal_bounds_are_one(spark, monkeypatch, seq):
    """What is put into order grows with the different bounds and keys, not with the ranges."""
    rng = random.Random(5)
    bounds = [(a, a + rng.randint(-2, 30)) for a in range(0, 200, 4)] + [(None, 20), (190, None)]
    ranges = [(a, b, f"r{rng.randint(0, 10**6)}", rng.randint(0, 90)) for a, b in bounds for _ in range(40)]
    keys = list(range(-5, 230))
    held, real = [], J.in_order
    monkeypatch.setattr(J, "in_order", lambda df, order: held.append(real(df, order)) or held[-1])
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    rdf = spark.createDataFrame(ranges, "lo int, hi int, name string, seq int").repartition(4)
    got = [tuple(r) for r in J.interval_lookup(df, rdf, "k", "lo", "hi", ["name"], seq=seq).collect()]
    assert sorted(got, key=repr) == brute(keys, ranges, seq)
    assert [t.count() <= most for t, most in zip(held, (len(bounds), 2 * len(bounds) + len(keys)), strict=True)] == [True, True]


@pytest.mark.parametrize(("edges", "kind"), [(256, "int"), (1 << 15, "string")])
def test_ranges_behind_others_are_not_moved(spark, monkeypatch, edges, kind):
    """With a `seq`: what is put into order grows with the ranges that may be the first of a key, not with all that differ."""
    rng = random.Random(edges)
    monkeypatch.setattr(J, "_EDGES", edges, raising=False)
    spans = [(a, a + rng.randint(-20, 400), f"r{a}", rng.randint(0, 2000)) for a in (rng.randint(0, 9000) for _ in range(6000))]
    spans += [(None, 40, "open below", 1), (8000, None, "open above", 1), (None, None, "last", 5000)]
    keys = [rng.randint(-50, 9500) for _ in range(900)]
    if kind == "string":
        spans = [tuple(x if x is None else f"{x + 100:08}" for x in r[:2]) + r[2:] for r in spans]
        keys = [f"{k + 100:08}" for k in keys]
    moved, real = [], J.in_order
    monkeypatch.setattr(J, "in_order", lambda df, order: moved.append(real(df, order)) or moved[-1])
    df = spark.createDataFrame([(k,) for k in keys], f"k {kind}").repartition(3)
    rdf = spark.createDataFrame(spans, f"lo {kind}, hi {kind}, name string, seq int").repartition(4)
    got = [tuple(r) for r in J.interval_lookup(df, rdf, "k", "lo", "hi", ["name"], seq="seq").collect()]
    assert sorted(got, key=repr) == brute(keys, spans, "seq")
    assert moved[0].count() < len(spans) / 4


def test_no_first_range_goes(spark, monkeypatch):
    """Few edges or all keys: of every set of ranges the first of each key is left, ranges without a `seq` too."""
    for t, edges in enumerate([4, 30, 1000]):
        rng = random.Random(t)
        monkeypatch.setattr(J, "_EDGES", edges)
        spans = [(rng.choice([None, a]) if k < 6 else a, rng.choice([None, b]) if k < 9 else b, rng.choice([None, *range(9)]), k)
                 for k, (a, b) in enumerate((x, x + rng.randint(-3, 12)) for x in (rng.randint(0, 200) for _ in range(150)))]
        keys = [rng.randint(-5, 215) for _ in range(120)]
        left = J.ranges_in_question(spark.createDataFrame([(k,) for k in keys], "v int"), spark.createDataFrame(spans, "lo int, hi int, seq int, c0 int"))
        assert left.columns == ["lo", "hi", "seq", "c0"]
        kept = {r["c0"] for r in left.collect()}
        for v in keys:
            fit = [((s is not None, s or 0), k) for lo, hi, s, k in spans if (lo is None or lo <= v) and (hi is None or v <= hi)]
            assert {k for s, k in fit if s == min(fit)[0]} <= kept


def test_periods_grow_with_days(spark, monkeypatch):
    """Dates: any number of periods is as many rows of the sweep as they have different first and last days."""
    seen, real = [], J.range_winners
    monkeypatch.setattr(J, "range_winners", lambda keys, ranges: seen.append(ranges.count()) or real(keys, ranges))
    spans = spark.range(3000).selectExpr("date_add(DATE'2020-01-01', CAST(id % 20 AS INT)) AS lo",
                                         "date_add(DATE'2020-01-01', CAST(id % 20 + id % 3 AS INT)) AS hi", "lpad(id, 5, '0') AS name")
    days = spark.range(30).selectExpr("date_add(DATE'2020-01-01', CAST(id AS INT)) AS day")
    got = [tuple(r) for r in J.interval_lookup(days, spans, "day", "lo", "hi", ["name"]).collect()]
    assert sorted(got, key=repr) == brute([r[0] for r in days.collect()], [(*r, 0) for r in spans.collect()], None)
    assert seen == [60]


def test_count_before(spark):
    df = O.in_order(spark.range(500).selectExpr("id % 7 AS v", "id % 3 = 0 AS x"), ["v"])
    rows = O.place(O.count_before(df, F.col("x"), "n")).select("place", "x", "n").collect()
    n = 0
    for r in sorted(rows):
        assert r["n"] == n
        n += r["x"]
