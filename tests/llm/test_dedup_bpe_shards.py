"""Brute-force, round-trip and edge-case tests of operators 2, 4, 5 and 9."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from carewatch.llm import bpe, components, mixing, registry, sharding, simhash

ROWS = [(1, "a b c d e f"), (2, None), (3, ""), (4, "  \n "), (5, "a b c d e f"), (None, "x y"),
        (7, "A B C D E F"), (7, "A B C D E F"), (8, "word " * 30_000), (9, "é漢 😀 ß")]
SCHEMA = "doc_id long, text string"


def edge(spark, extra=True):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("source", F.when(F.col("doc_id") > 3, "s").otherwise(None))
    if extra:  # columns whose names clash with results
        for c in ("size", "ids", "shard", "slot", "fingerprint", "component_id", "taken", "law", "n_tokens"):
            df = df.withColumn(c, F.lit("old"))
    return df


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string")


# ------------------------------------------------------------------ op 9

def slow_components(fps, bits):
    fps = list(fps)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= bits:
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def slow_fingerprint(text):
    import xxhash
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    import re
    w = re.findall("[^\x20\x09-\x0d]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_codes_cover():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 40, dtype=np.int64).view(np.uint64)
    for codes in (simhash.CODES, (simhash.GOLAY, simhash.GOLAY, simhash.HAMMING15)):
        anchor, row, home = simhash.replicate(x, 2, codes)
        assert home.sum() == len(x)  # one home each
        got = [set(anchor[row == i].tolist()) for i in range(len(x))]
        for i in range(len(x)):  # every neighbour within 2 bits has its home among the anchors
            for a, b in [(0, 1), (3, 40), (22, 23), (60, 63), (5, 5)]:
                y = np.array([x[i] ^ np.uint64(1 << a) ^ (np.uint64(1 << b) if a != b else np.uint64(0))])
                ya, _, yh = simhash.replicate(y, 2, codes)
                assert int(ya[yh][0]) in got[i]


def test_fingerprint_matches_definition():
    for _, t in ROWS:
        assert simhash.fingerprint(t) == slow_fingerprint(t)


@pytest.mark.parametrize("block", [2048, 4])
def test_links_equal_brute_force(spark, monkeypatch, block):
    rng = random.Random(5)
    fps = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 30])):
            y = base
            for _ in range(rng.randint(0, 5)):
                y ^= 1 << rng.randrange(64)
            fps.add(y)
    dense = rng.getrandbits(64)
    for a, b in itertools.combinations(range(0, 64, 3), 2):
        fps.add(dense ^ (1 << a) ^ (1 << b))
    want = slow_components(fps, 2)
    signed = np.array(sorted(fps), np.uint64).view(np.int64).tolist()
    # run the anchors' comparison in this process, so that block sizes can be varied
    import pyarrow as pa
    monkeypatch.setattr(simhash, "BLOCK", block)
    x = np.array(signed, np.int64).view(np.uint64)
    anchor, row, home = simhash.replicate(x)
    order = np.lexsort((~home, anchor))
    rb = pa.RecordBatch.from_arrays([pa.array(anchor[order]), pa.array(x[row][order].view(np.int64)),
                                     pa.array(home[order])], names=["anchor", "fp", "home"])
    parts = [rb.slice(i, 700) for i in range(0, rb.num_rows, 700)]
    out = simhash._compare_blocks(2)(simhash._meet(2)(iter(parts)))
    pairs = [(int(a), int(b)) for o in out for a, b in zip(o.column(0).to_pylist(), o.column(1).to_pylist(), strict=True)]
    links = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["root"] for r in components.connected_components(links).collect()}

    def classes(m):
        by = {}
        for k, v in m.items():
            by.setdefault(v, set()).add(k)
        return {frozenset(v) for v in by.values() if len(v) > 1}
    unsigned = {k % 2**64: v for k, v in got.items()}
    assert classes(unsigned) == classes(want)


def test_simhash_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fp = {r["doc_id"]: slow_fingerprint(r["text"]) for r in rows}
    root = slow_components(set(fp.values()), 2)
    low = {}
    for d, f in fp.items():
        low[root[f]] = min(low.get(root[f], d), d)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"])
           for r in registry.QUERIES["op9_simhash"](spark, "/root/testdata/sf0.01").collect()}
    assert got == {d: (f"{f:016x}", low[root[f]]) for d, f in fp.items()}


def test_simhash_edges(spark):
    got = simhash.near_duplicates(edge(spark)).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r["component_id"], []).append(r["doc_id"])
    assert sorted(by[1]) == [1, 5, 7, 7] and sorted(by[2]) == [2, 3, 4]
    kept = simhash.deduplicated(edge(spark))
    assert "fingerprint" in kept.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i or 0 for i in ids) == [0, 1, 2, 8, 9]
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.deduplicated(empty(spark)).count() == 0


def test_components_chain(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 300), (7, 7)]
    got = dict(components.connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 200: 100, 300: 100}


# ------------------------------------------------------------------ op 2

def tiktoken_encoding():
    import public_tokenizers as P
    import tiktoken
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    return P, ranks, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_library(spark):
    P, ranks, enc = tiktoken_encoding()
    mine = bpe.Encoder(bpe.Vocabulary(ranks), P.PATTERN)
    rng = random.Random(3)
    bits = ["a", "b", " ", "  ", "the", "ing", "é", "ß", "漢", "!", "\n", "0", "12", "'s", "'ll", "😀", "zz",
            "aaaa", "́", "\xa0", "\x1c", "<|endoftext|>", "²", ".", ", "]
    for _ in range(2000):
        s = "".join(rng.choice(bits) for _ in range(rng.randint(0, 50)))
        assert mine.encode(s) == enc.encode_ordinary(s), s
    for s in ["a" * 50_000, " " * 30_001 + "x", "ab" * 20_000, "the" * 9_999, "\n" * 5_000, "=-" * 10_000]:
        ids = mine.encode(s)
        assert ids == enc.encode_ordinary(s) and mine.decode(ids) == s.encode()


def test_bpe_backtracks():
    # rank order makes the longest match wrong: "ab" + "cd" merges before "abc" exists
    ranks = {bytes([i]): i for i in range(256)}
    for t in (b"bc", b"cd", b"ab", b"abc", b"bcd"):
        ranks[t] = len(ranks)
    v = bpe.Vocabulary(ranks)

    def merged(data):
        parts = [bytes([c]) for c in data]
        while True:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks),
                       default=None)
            if best is None:
                return tuple(ranks[p] for p in parts)
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    for n in range(1, 8):
        for t in itertools.product(b"abcd", repeat=n):
            assert v.encode_piece(bytes(t).decode("latin-1")) == merged(bytes(t))


def test_bpe_query_and_edges(spark):
    P, ranks, enc = tiktoken_encoding()
    got = {r["doc_id"]: r for r in registry.QUERIES["op2_byte_bpe"](spark, "/root/testdata/sf0.01").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect():
        ids = enc.encode_ordinary(r["text"])
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(ids)
        assert g["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
    path = P.path("byte_bpe_50k.tiktoken")
    out = bpe.digests(bpe.decode_documents(bpe.encode_documents(edge(spark), path, P.PATTERN), path, P.PATTERN))
    for r in out.collect():
        assert r["ids"] == enc.encode_ordinary(r["text"] or "") and bytes(r["decoded"]).decode() == (r["text"] or "")
    assert bpe.encode_documents(empty(spark), path, P.PATTERN).count() == 0


# ------------------------------------------------------------------ op 5

def test_differencing():
    rng = random.Random(2)
    sizes = [rng.randint(1, 1000) for _ in range(500)]
    parts = [np.array([s] + [0] * 7) for s in sizes]
    places, total = sharding.difference(parts, 8)
    check = [0] * 8
    for s, p in zip(sizes, places, strict=True):
        assert sorted(p.tolist()) == list(range(8))
        check[p[0]] += s
    assert check == total.tolist() and max(check) - min(check) <= 2
    greedy = [0] * 8
    for s in sorted(sizes, reverse=True):
        greedy[greedy.index(min(greedy))] += s
    assert max(check) - min(check) <= max(greedy) - min(greedy)


def check_shards(rows, texts):
    by, slots, total = {}, {}, [0] * 8
    for r in rows:
        t = texts[r["doc_id"]] or ""
        assert r["size"] == len(t.encode()) + 1 and r["text_crc32"] == zlib.crc32(t.encode())
        assert r["law"] == "bytes" and r["grown_shard"] is None
        by.setdefault(t, set()).add(r["shard"])
        slots.setdefault(r["shard"], []).append(r["slot"])
        total[r["shard"]] += r["size"]
    assert all(len(v) == 1 for v in by.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return total


def test_shards_query(spark, monkeypatch):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    total = check_shards(registry.QUERIES["op5_shards"](spark, "/root/testdata/sf0.01").collect(), texts)
    assert max(total) - min(total) <= 0.001 * sum(total)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    many = sharding.shard_documents(docs, 8, groups_a_cell=40).collect()  # many cells
    total = check_shards(many, texts)
    assert max(total) - min(total) <= 0.02 * sum(total)
    rounds = sharding.shard_documents(docs, 8, groups_a_cell=100, cells_a_round=3).collect()  # three rounds
    total = check_shards(rounds, texts)
    assert max(total) - min(total) <= 0.01 * sum(total)


def test_shards_of_one_group_of_many(spark):
    """A third of all rows are one text: its group stays whole, the others fill up around it."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy " * 3).otherwise(
        F.concat(F.lit("own "), F.col("id").cast("string"), F.repeat(F.lit("x"), (F.col("id") % 40).cast("int")))).alias("text"))
    texts = {r[0]: r[1] for r in docs.collect()}
    total = check_shards(sharding.shard_documents(docs, 8, groups_a_cell=300).collect(), texts)
    assert max(total) == 1000 * 16 and max(sorted(total)[:7]) - min(total) <= 64
    assert sharding._uneven(np.array([9, 3, 0]), 3).tolist() == [3, 3, 0] and not sharding._uneven(np.array([4, 4]), 0).any()


def test_shards_edges(spark):
    got = sharding.shard_documents(edge(spark)).collect()
    assert len(got) == len(ROWS)
    check_shards(got, dict(ROWS))
    assert sharding.shard_documents(empty(spark)).count() == 0


# ------------------------------------------------------------------ op 4

def test_mix_budgets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = mixing.mix_sources(docs).select("source", "size", "source_size", "target", "taken").collect()
    src = {}
    for r in rows:
        s = src.setdefault(r["source"], [0, r["source_size"], r["target"], 0])
        s[0] += r["size"]
        s[3] += r["taken"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    total = sum(s[0] for s in src.values())
    target = dict.fromkeys(src, 0.0)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(src))}
    left, open_ = 1.5 * total, set(src)
    while open_:  # resharing step by step
        w = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / w >= 2 * src[s][0]}
        if not full:
            for s in open_:
                target[s] = left * weight[s] / w
            break
        for s in full:
            target[s] = 2.0 * src[s][0]
            left -= target[s]
        open_ -= full
    for s, (own, size, goal, taken) in src.items():
        assert own == size and abs(goal - target[s]) < 1e-6 * max(1, goal)
        assert abs(taken - goal) <= 12_000
    assert abs(sum(s[3] for s in src.values()) - 1.5 * total) < 0.02 * total


def test_mix_prefers_quality(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"),
                                    F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("source"))
    out = mixing.mix_sources(docs, weight=F.when(F.col("doc_id") % 4 < 2, 4.0).otherwise(1.0), share=0.5)
    n = {r[0]: r[1] for r in out.groupBy(F.col("doc_id") % 4 < 2).agg(F.sum("taken")).collect()}
    assert n[True] > 1.5 * n[False]


def test_mix_edges(spark):
    out = mixing.mix_sources(edge(spark))
    assert out.count() == len(ROWS) and out.columns.count("size") == 1
    assert mixing.mix_sources(empty(spark)).count() == 0
    mixed = mixing.mixed_documents(edge(spark, extra=False))
    assert mixed.columns == ["doc_id", "text", "source"]
    again = mixing.mix_sources(edge(spark)).select("doc_id", "taken").collect()
    key = lambda r: (r[0] or 0, r[1])
    assert sorted(map(key, again)) == sorted(map(key, out.select("doc_id", "taken").collect()))


def test_mix_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.01/documents.parquet')")
    want = sorted(con.execute("SELECT doc_id, size, source_size, target, taken FROM (" + registry.OP4_SQL + ")").fetchall())
    got = registry.QUERIES["op4_mix_sources"](spark, "/root/testdata/sf0.01")
    assert sorted(map(tuple, got.select("doc_id", "size", "source_size", "target", "taken").collect())) == want
