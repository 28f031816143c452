"""Every stage of the pipeline against a brute-force version of it."""

import hashlib
from collections import Counter

import duckdb
import numpy as np

import corpus_pipeline
from carewatch.llm import quality, registry, toxicity

SF = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append(docs.collect())
    source = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    # 1: the operator's verdicts are tested against brute force; here they take effect
    verdict = {r["doc_id"]: r["kept"] for r in registry.QUERIES["op3_quality_rules"](spark, SF).collect()}
    first = {r["doc_id"] for r in kept[0]}
    assert first == {d for d, k in verdict.items() if k}
    # 2
    one = spark.read.parquet(str(tmp_path / "0"))
    model = toxicity.train(one, spark.read.parquet(f"{SF}/labels.parquet"))
    second = {d for d in first if model.probability(model.passages(source[d]["text"])) < 0.7}
    assert {r["doc_id"] for r in kept[1]} == second and len(kept[1]) == len(second)
    # 3
    from tests.llm.test_dedup_bpe_shards import slow_components, slow_fingerprint
    fp = {d: slow_fingerprint(source[d]["text"]) for d in second}
    root = slow_components(set(fp.values()), 2)
    low = {}
    for d, f in fp.items():
        low[root[f]] = min(low.get(root[f], d), d)
    assert Counter(r["doc_id"] for r in kept[2]) == Counter(low.values())
    # 4
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/2/*.parquet')")
    times = {d: t // max(1, s) for d, s, t in con.execute(
        f"SELECT doc_id, size, taken FROM ({registry.OP4_SQL})").fetchall()}
    assert Counter(r["doc_id"] for r in kept[3]) == Counter({d: t for d, t in times.items() if t})
    # 5
    from tests.llm.test_dedup_bpe_shards import tiktoken_encoding
    enc = tiktoken_encoding()[2]
    assert Counter(r["doc_id"] for r in kept[4]) == Counter(r["doc_id"] for r in kept[3])
    for r in kept[4]:
        t = source[r["doc_id"]]["text"]
        assert r["ids"] == enc.encode_ordinary(t) and r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_run_and_edges(spark, tmp_path):
    rows = [(1, None, "en", None, 0), (None, "a few words of a text that is long enough to stay in", None, "s", 5),
            (3, "", "de", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data in (("some", rows), ("none", [])):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
            str(tmp_path / name / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "some")).collect()
    assert {r["doc_id"] for r in got} == {None} and all(r["n_tokens"] > 5 for r in got)
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    assert quality.distance(np.array([1.0]), np.array([2.0])) == 0.0


def test_columns_named_like_results(spark):
    """Input columns that an operator's results are named like keep their values through every stage."""
    rows = [(i, f"{w} some words of a text number {i} that is long enough to stay in the corpus, it says", "en", "s", 40, f"size{i}", i, "k", 2.5)
            for i, w in enumerate("alpha beta gamma delta epsilon zeta eta theta".split())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string, copies long, "
                                       "KEPT string, score double")
    want = {r[0]: r for r in rows}
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "copies", "KEPT", "score"]
    got = docs.collect()
    assert got and all(tuple(r) == want[r["doc_id"]] for r in got)
