"""Operator 8: the trie against plain dictionaries, the base score exactly, and held-out gain."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from carewatch.llm import ngram

SF = "/root/testdata/sf0.01"


def test_elias_fano():
    rng = random.Random(1)
    for universe in (1, 7, 64, 1000, 1 << 20, 1 << 45):
        for n in (0, 1, 2, 63, 64, 65, 500):
            v = np.array(sorted(rng.randrange(universe) for _ in range(n)), np.int64)
            ef = ngram.EliasFano.build(v, universe)
            assert (ef.access(np.arange(n)) == v).all()
            u = np.unique(v)
            ef = ngram.EliasFano.build(u, universe)
            x = np.array([rng.randrange(universe) for _ in range(200)] + u.tolist()[:50], np.int64)
            if len(u):
                assert (ef.successor(x) == np.searchsorted(u, x)).all()
            where = {k: i for i, k in enumerate(u.tolist())}
            assert ef.find(x).tolist() == [where.get(k, -1) for k in x.tolist()]


def words(t):
    import re
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall("[^\x20\x09-\x0d]+", low) + ["\n"]


class Slow:
    """The same model with dictionaries."""

    def __init__(self, texts, share=ngram.NGRAM_SHARE):
        self.c1, c2, c3 = Counter(), Counter(), Counter()
        for t in texts:
            w = words(t)
            self.c1.update(w)
        self.n, self.v = sum(self.c1.values()), len(self.c1)
        least = max(1, share * self.n)
        for t in texts:
            w = words(t)
            c2.update(zip(w, w[1:]))
            c3.update(zip(w, w[1:], w[2:]))
        self.vocab = {w for w, c in self.c1.items() if c >= share * self.n or w == "\n"}
        self.c2 = {k: c for k, c in c2.items() if c >= least and set(k) <= self.vocab}
        self.c3 = {k: c for k, c in c3.items() if c >= least and k[:2] in self.c2 and k[1:] in self.c2}
        self.b1, self.b2 = Counter(), Counter()
        for (a, _), c in self.c2.items():
            self.b1[a] += (c - 0.75) / self.c1[a]
        for (a, b, _), c in self.c3.items():
            self.b2[a, b] += (c - 0.75) / self.c2[a, b]

    def p1(self, w):
        return (self.c1[w] + 0.1) / (self.n + 0.1 * (self.v + 1))

    def p2(self, a, w):
        p = (1 - self.b1[a]) * self.p1(w)
        return p + (self.c2[a, w] - 0.75) / self.c1[a] if (a, w) in self.c2 else p

    def p3(self, a, b, w):
        if (a, b) not in self.c2:
            return self.p2(b, w)
        p = max(1e-12, 1 - self.b2[a, b]) * self.p2(b, w)
        return p + (self.c3[a, b, w] - 0.75) / self.c2[a, b] if (a, b, w) in self.c3 else p

    def score(self, t):
        w = words(t)
        return sum(math.log10(self.p3(w[i - 2], w[i - 1], x) if i > 1 else self.p2(w[0], x) if i else self.p1(x))
                   for i, x in enumerate(w))


@pytest.mark.parametrize("share", [ngram.NGRAM_SHARE, 2e-5])
def test_scores_equal_dictionaries(spark, share):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    slow = Slow([r["text"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 10], share)
    model = ngram.train(docs, vocabulary_share=share, ngram_share=share)
    got = {r["doc_id"]: r for r in ngram.score_documents(docs, model).collect()}
    assert len(got) == len(rows)
    gain = base = 0.0
    for r in rows:
        w, g = words(r["text"]), got[r["doc_id"]]
        assert g["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (len(w), sum(slow.c1[x] > 0 for x in w), slow.n)
        assert abs(g["base_score"] - sum(math.log10(slow.p1(x)) for x in w)) < 1e-6 * len(w)
        assert abs(g["score"] - slow.score(r["text"])) < 2e-4 * len(w)
        if g["held_out"]:
            gain, base = gain + g["score"] - g["base_score"], base + g["base_score"]
    assert gain > 0.005 * -base  # better than the unigrams on unseen documents
    a, b = next(iter(slow.c3))[:2]  # probabilities add up to one
    mass = sum(slow.p3(a, b, x) for x in slow.c1) + 0.1 / (slow.n + 0.1 * (slow.v + 1)) * (1 - slow.b1[b]) * max(
        1e-12, 1 - slow.b2[a, b])
    assert abs(mass - 1) < 1e-9


def test_pack_round_trip():
    trie = ngram._trie(np.array([2, 5, 3]), 10, 3, (np.array([4, 5]), np.array([2, 2])), (np.array([0]), np.array([1])))
    again = ngram.Trie.open(trie.pack())
    ids = np.array([1, 1, 2, 0, 2, -1, 0])
    assert np.allclose(trie.score(ids), again.score(ids))


def test_edges(spark):
    rows = [(1, "a b a b"), (2, None), (3, ""), (None, "a b"), (5, "a b a b"), (5, "a b a b"), (7, "é漢 " * 40_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("word", F.lit(1))
    got = ngram.score_documents(df, ngram.train(df)).collect()
    assert len(got) == len(rows)
    assert sorted(r["n_tokens"] for r in got) == [1, 1, 3, 5, 5, 5, 40_001]
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [True]
    assert ngram.score_documents(df.limit(0), ngram.train(df)).count() == 0
    none = ngram.score_documents(df, ngram.train(df.limit(0))).collect()
    assert {(r["n_known"], r["train_tokens"], r["score"]) for r in none} == {(0, 0, 0.0)}


def test_nothing_is_cut_whatever_the_size(spark):
    """A word, pair and triple that a corpus of any size holds once are in the model, also when only
    the most frequent words are held and the tries are many."""
    assert ngram.VOCABULARY_SHARE == ngram.NGRAM_SHARE == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    slow = Slow([r["text"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 10], 0)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "67")
    try:
        model = ngram.train(docs, held=400)  # nearly all words are rare, frequent ones divided
        assert model.rare.count() > 0.9 * slow.v and (ngram.Deal(ngram.n_tries(model), model.counts, model.total).parts > 1).any()
        got = {r["doc_id"]: r for r in ngram.score_documents(docs, model).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(got) == len(rows)
    for r in rows:
        w, g = words(r["text"]), got[r["doc_id"]]
        assert (g["n_tokens"], g["n_known"]) == (len(w), sum(slow.c1[x] > 0 for x in w))
        assert abs(g["base_score"] - sum(math.log10(slow.p1(x)) for x in w)) < 1e-6 * len(w)
        assert abs(g["score"] - slow.score(r["text"])) < 2e-4 * len(w)


def test_other_rows_than_the_learnt_ones(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(300)
    model = ngram.train(docs, held=400)
    key = lambda r: r["doc_id"]
    at_once = sorted(ngram.score_documents(docs, model).collect(), key=key)
    apart = sorted(ngram.score_documents(docs.select("text", "doc_id"), model).collect(), key=key)
    assert len(apart) == 300
    for a, b in zip(at_once, apart):
        assert a[:5] == b[:5] and abs(a["score"] - b["score"]) < 2e-4 * a["n_tokens"]
