"""Operator 7 against counting the edited text anew."""

import random

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from carewatch.llm import bpe, registry, tokencount

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(bpe.read_ranks(PATH)), P.PATTERN)


def test_edits_equal_a_full_count(encoder):
    rng = random.Random(7)
    bits = ["a", "b", " ", "  ", "the", " word", "é", "漢", "!", "\n", "0", "'s", "'ll", "'", "😀", "\n\n ", "ll", "s "]
    make = lambda n: "".join(rng.choices(bits, k=n))
    for _ in range(400):
        text = make(rng.choice([0, 3, 40, 700]))
        tree = tokencount.Tree(text, encoder)
        assert tree.n_tokens == len(encoder.encode(text))
        for _ in range(rng.randint(1, 6)):
            start, length, insert = rng.randint(-1, len(text) + 3), rng.choice([0, 1, 2, 9, 300]), make(rng.choice([0, 1, 2, 30, 600]))
            tree.edit(start, length, insert)
            s = min(max(0, start), len(text))
            text = text[:s] + insert + text[s + length:]
            assert tree.text == text
            assert tree.n_tokens == len(encoder.encode(text)), (start, length, insert)
            lengths = [n for leaf in tree.leaves for n in leaf[0]]
            assert lengths == [len(x) for x in encoder.findall(text)]


def test_edits_touch_little(encoder):
    text = "some words of a long text, " * 4000
    tree = tokencount.Tree(text, encoder)
    before = tree.encoded
    tree.edit(50_000, 3, "xyz")
    assert tree.encoded - before < 12
    assert tree.n_tokens == len(encoder.encode(tree.text))


def test_query_equals_full_counts(spark, encoder):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in registry.QUERIES["op7_edit_counts"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        t, g = r["text"], got[r["doc_id"]]
        n = len(t)
        assert (g["n_tokens"], g["n_pretokens"]) == (len(encoder.encode(t)), len(encoder.findall(t)))
        for start, length, insert in ((int(n / 3), 0, t[:20]), (int(n * 2 / 3), 15, ""), (int(n / 2), 1, "'s")):
            start = min(start, len(t))
            t = t[:start] + insert + t[start + length:]
        assert (g["edited_tokens"], g["edited_chars"]) == (len(encoder.encode(t)), len(t))
        assert g["reencoded"] <= 60 or g["n_pretokens"] < 100 or n > 20 * g["n_pretokens"]


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "x y"), (3, "a b c"), (3, "a b c"), (4, "w " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("old"))
    out = tokencount.count_with_edits(df, tokencount.usual_edits(F.col("text")), PATH, P.PATTERN)
    assert out.columns.count("n_tokens") == 1 and out.count() == 6
    none = tokencount.count_with_edits(df, F.lit(None), PATH, P.PATTERN).collect()
    assert all(r["n_tokens"] == r["edited_tokens"] and r["reencoded"] == 0 for r in none)
    assert tokencount.count_with_edits(df.limit(0), F.lit(None), PATH, P.PATTERN).count() == 0
