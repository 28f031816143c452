"""Operator 1 against its SQL and its edge cases."""

import hashlib

import duckdb
from pyspark.sql import functions as F

from carewatch.llm import imatch, registry

SF = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    cols = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    want = sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({registry.OP1_SQL})").fetchall())
    got = sorted(map(tuple, registry.QUERIES["op1_imatch"](spark, SF).select(*cols).collect()))
    assert got == want
    text = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    ids = sorted(text)
    for k, g in enumerate(got):
        a, b = text[ids[k]], text[ids[(k + 1) % len(ids)]]
        h = len(a) // 2
        assert g[2] == hashlib.sha256((a[:len(a) - h] + b[:h]).encode()).hexdigest()
    by = {}
    for g in got:
        by.setdefault(text[g[0]], set()).add(g[3])
    assert all(len(v) == 1 for v in by.values())
    assert sum(g[5] for g in got) > 10 * sum(g[6] for g in got)


def edge(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumn("fingerprint", F.lit("old")).withColumn("n_chars", F.lit(5)).withColumn("__extra", F.lit(1))


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    return [(r[0], len(r[1] or ""), (r[1] or "")[:len(r[1] or "") - len(r[1] or "") // 2]
             + (rows[(k + 1) % len(rows)][1] or "")[:len(r[1] or "") // 2]) for k, r in enumerate(rows)]


def check(spark, rows):
    got = imatch.edited_likeness(edge(spark, rows)).collect()
    want = [(i, n, hashlib.sha256(t.encode()).hexdigest()) for i, n, t in brute(rows)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted([tuple(g[:3]) for g in got], key=key) == sorted(want, key=key)
    for g in got:
        assert 0 <= g["near_edited"] <= 1 and 0 <= g["near_next"] <= 1
    return got


def test_edges(spark):
    check(spark, [(1, "one two three"), (5, None), (9, ""), (12, "one two three"), (13, "word " * 20_000),
                  (-4, "é漢😀 ß mark!"), (None, "last row here")])
    check(spark, [(3, "only one")])
    check(spark, [(None, "no id at all")])
    same = check(spark, [(1, "a b c d"), (2, "a b c d"), (3, "a b c d")])
    assert {g["near_next"] for g in same} == {1.0} and len({g["fingerprint"] for g in same}) == 1
    assert imatch.edited_likeness(edge(spark, [])).count() == 0
    # repeated rows follow each other
    assert len(check(spark, [(1, "a b c d"), (1, "a b c d"), (2, "x y z w q")])) == 3


def test_many_ranges(spark):
    rows = [(i * 7 - 50, f"text number {i} " + "x" * (i % 13)) for i in range(300)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        check(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_half_of_a_text_is_recognised(spark):
    """Nearly every text is more like its half-edited version than like the next one, whatever its language
    and length; a language of one document in a thousand as well."""
    got = [g for g in registry.QUERIES["op1_imatch"](spark, "/root/testdata/sf0.1").collect() if g["n_chars"] >= 400]
    assert sum(g["near_edited"] > g["near_next"] for g in got) > 0.95 * len(got)
    assert sum(g["near_edited"] == 0 for g in got) < 0.05 * len(got)
    common = [(i, " ".join(f"w{(i * 37 + k * k) % 900}" for k in range(120))) for i in range(2000)]
    rare = [(5000 + i, " ".join(f"ξ{i}λ{k}" for k in range(120))) for i in range(2)]
    rows = {g["doc_id"]: g for g in imatch.edited_likeness(spark.createDataFrame(common + rare, "doc_id long, text string")).collect()}
    one_word = [(7, rare[0][1]), (8, rare[0][1] + " more"), (9, "something else " * 40)]
    near = {g["doc_id"]: g for g in imatch.edited_likeness(spark.createDataFrame(one_word, "doc_id long, text string")).collect()}
    assert all(rows[i]["near_edited"] > 0 for i, _ in rare) and near[7]["near_next"] > 0.8 and near[8]["near_next"] == 0
