"""Operator 13 against brute force over documents, its SQL, and its edge cases."""

import itertools
import random
import re
from fractions import Fraction

import duckdb
from pyspark.sql import functions as F

from carewatch.llm import filteraudit, registry

COLS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels):
    """Every document through every order, one filter after the other."""
    marks = {}
    for i, q, t in labels:
        if i is not None:
            a = marks.setdefault(i, [0, 0])
            a[0] |= q == 1
            a[1] |= t == 1
    low = {}
    for i, t, _ in docs:
        if i is not None:
            low[t or ""] = min(low.get(t or "", i), i)
    parts = {}
    for i, text, lang in docs:
        t = text or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t),
                 "E": i is not None and i > low[t]}
        parts.setdefault(lang or "", []).append((fails, marks.get(i, [0, 0])))
    out, totals = [], {}
    for part, rows in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                totals[part, f] = totals.get((part, f), 0) + len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), sum(r[0][f] for r in rows) - len(gone),
                            sum(r[0][f] and sum(r[0].values()) == 1 for r in rows),
                            sum(r[1][0] for r in gone), sum(r[1][1] for r in gone), f])
    return sorted(tuple(r[:-1]) + (totals[r[0], r[-1]],) for r in out)


def got(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def frames(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    d = d.withColumn("removed", F.lit("x")).withColumn("mask", F.lit(1)).withColumn("part", F.lit("p"))
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_query_equals_brute_force_and_sql(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    have = got(registry.QUERIES["op13_filter_audit"](spark, sf))
    assert have == brute(docs, labels)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    assert sorted(con.execute(f"SELECT {', '.join(COLS)} FROM ({registry.OP13_SQL})").fetchall()) == have


def test_edges(spark):
    rng = random.Random(5)
    long = " ".join(rng.choice("abcdefghij") + str(rng.randint(0, 999)) for _ in range(60_000))
    docs = [(1, None, None), (2, "", "en"), (3, "same text", "en"), (4, "same text", "de"), (4, "same text", "de"),
            (5, "same text", None), (None, "same text", "en"), (None, None, ""), (None, None, ""), (6, long, "fr"),
            (7, long, "fr"), (8, " A b# \x1c x\x85y", "fr"), (9, "SHOUT " * 300, "fr"), (9, "SHOUT " * 300, "fr")]
    docs += [(20 + k, "copy " * 250, "es") for k in range(400)]
    labels = [(1, 1, None), (3, 0, 1), (3, 1, 0), (4, 1, 1), (None, 1, 1), (6, None, None), (7, 1, 1), (99, 1, 1)]
    d, marks = frames(spark, docs, labels)
    assert got(filteraudit.filter_audit(d, marks)) == brute(docs, labels)
    none, nothing = frames(spark, [], [])
    assert filteraudit.filter_audit(none, nothing).count() == 0
    assert got(filteraudit.filter_audit(d, nothing)) == brute(docs, [])


def test_least_squares_is_shapley():
    rng = random.Random(3)
    for n in (1, 2, 3, 5):
        v = [0] + [rng.randint(0, 50) for _ in range((1 << n) - 1)]
        want = [Fraction(0)] * n
        orders = list(itertools.permutations(range(n)))
        for order in orders:
            at = 0
            for i in order:
                want[i] += Fraction(v[at | 1 << i] - v[at], len(orders))
                at |= 1 << i
        assert filteraudit.least_squares_shapley(v) == want
