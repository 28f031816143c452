"""Operator 12 against a tree built by hand, its SQL, and its edge cases."""

import random
import zlib
from hashlib import sha256

import duckdb
import numpy as np
from pyspark.sql import functions as F

from carewatch.llm import merkle, registry

COLS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "source"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """Top of a list of nodes, and for each its runs on the way up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k:k + 16] for k in range(0, len(nodes), 16)]
        for k, i in enumerate(at):
            paths[k].append((runs[i // 16], i % 16))
            at[k] = i // 16
        nodes = [h("".join(r)) for r in runs]
    return nodes[0], paths


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        own = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((own, *climb([leaf(r) for r in own])))
    root, tops = climb([t[1] for t in trees])
    out = []
    for (own, subroot, paths), top in zip(trees, tops, strict=True):
        for r, path in zip(own, paths, strict=True):
            up = path + top
            changed = r[4] if r[4] is None or r[0] is None or zlib.crc32(str(r[0]).encode()) % 5 else r[4].translate(LOWER)
            f = leaf((*r[:4], changed))
            for run, p in up:
                f = h("".join([*run[:p], f, *run[p + 1:]]))
            proof = h("".join("".join(run[:p] + run[p + 1:]) for run, p in up))
            out.append((r[0], leaf(r), subroot, root, proof, f, f == root, r[1]))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=repr)


def tampered():
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.translate("text", *[
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"]))


def test_query_equals_brute_force_and_sql(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*merkle.FIELDS).collect()]
    have = got(registry.QUERIES["op12_merkle_manifest"](spark, sf))
    assert have == brute(rows)
    assert 0 < sum(not r[6] for r in have) < 0.2 * len(have)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    assert sorted(con.execute(f"SELECT {', '.join(COLS)} FROM ({registry.OP12_SQL})").fetchall(), key=repr) == have


def fixture():
    rng = random.Random(4)
    rows = [(k * 7 % 5003, "hot", "en", k, f"Text {k}") for k in range(5003)]  # 4 levels and a lone last node
    rows += [(k, f"s{k % 37}", None, None, "Ü" * (k % 4)) for k in range(600)]
    rows += [(None, None, None, None, None), (None, None, None, None, None), (None, "hot", "x", 1, "A"), (-3, None, "", 0, "")]
    rows += [(9, "one", "en", 3, "AbC" * 100_000), (10, "", "en", 3, "Q")] + [(77, "same", "de", 2, "A b")] * 70
    rng.shuffle(rows)
    return rows


def test_edges_and_many_partitions(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df = df.repartition(5).withColumn("leaf", F.lit("old")).withColumn("__tie", F.lit(0)).withColumn("tree", F.lit(1))
    want = brute(rows)
    out = merkle.proofs_after_edits(df, tampered(), leaves_a_part=700, with_proofs=True)
    assert got(out) == want
    for r in out.select("leaf", "proof", "proof_sha256", "verified", "folded_root", "root").limit(200).collect():
        assert h("".join("".join(x) for x in r["proof"])) == r["proof_sha256"] and r["verified"] == (r["folded_root"] == r["root"])
    few = df.limit(0)
    assert merkle.proofs_after_edits(few, tampered()).count() == 0
    alone = df.where("source = 'one'")
    assert got(merkle.proofs_after_edits(alone, tampered())) == brute([r for r in rows if r[1] == "one"])


def test_proofs_of_some_leaves(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    leaves, nodes = merkle.manifest(df, changed=tampered())
    want = [r for r in brute(rows) if (r[0] or 0) % 50 == 3]
    assert got(merkle.prove(leaves.where("coalesce(doc_id, 0) % 50 = 3"), nodes)) == want


def test_lacking_is_minimal():
    rng = random.Random(8)
    for width in (1, 2, 16, 17, 300, 5000):
        idx = np.array(sorted(rng.sample(range(width), min(width, 40))))
        known, asked, n, level = set(idx.tolist()), {}, width, 0
        for level, ids in merkle.lacking(idx, width):
            asked[level] = set(ids.tolist())
        for level in range(len(asked)):  # nothing that can be derived, and nothing missing
            assert not asked[level] & known
            up = {i >> 4 for i in known}
            assert asked[level] | known == {k for i in up for k in range(i << 4, min(n, (i + 1) << 4))}
            known, n = up, -(-n // 16)
        assert n == 1
    whole = list(merkle.lacking(np.arange(5000), 5000))
    assert all(len(ids) == 0 for _, ids in whole)
