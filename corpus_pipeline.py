"""The training-data pipeline: quality rules, toxicity, SimHash near-duplicates, mixing sources
to target weights, byte-level BPE.

`STAGES` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next one's docs. All but the last return the
columns of their docs with their values, also of columns named like an operator's results. Every stage works on all rows that its predecessor kept:

1. documents that the quality rules reject go;
2. documents whose toxicity score is 0.7 or more go (labels are learned from the stage's rows);
3. one document of each group of near-duplicates stays, the one with the smallest doc_id;
4. every document comes as often as the mix takes it;
5. the last stage returns doc_id, lang, source, the ids, their number, and digests of the ids and
   of the bytes decoded from them.

Null texts count as empty and are rejected by the first stage; an empty table stays empty.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carewatch.llm import bpe, common, mixing, quality, simhash, toxicity
from carewatch.session import ensure_checkpoint_dir


def _kept(docs: DataFrame, stage) -> DataFrame:
    """`stage(docs)` with the columns of `docs` and their values. Columns that the operators do not read
    are out of their sight, so they may be named like an operator's results."""
    read = ("doc_id", "text", "lang", "source")
    hidden = {f"__in{i}": c for i, c in enumerate(docs.columns) if c not in read}
    out = stage(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c in read], *[F.col(f"`{c}`").alias(h) for h, c in hidden.items()]))
    names = {c: h for h, c in hidden.items()}
    return out.select(*[F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship_package(spark)
    return _kept(docs, lambda d: quality.quality_rules(d).filter("kept"))


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = common.table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels)
    return _kept(docs, lambda d: toxicity.toxicity(d, model).filter("predicted = 0"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship_package(spark)
    return _kept(docs, simhash.deduplicated)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship_package(spark)
    return _kept(docs, mixing.mixed_documents)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    common.ship_package(spark)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode_documents(docs.select("doc_id", "lang", "source", "text"), path, pattern, keep_text=False)
    return bpe.digests(bpe.decode_documents(encoded, path, pattern)).select(
        "doc_id", "lang", "source", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_documents),
    ("near_dedup", near_duplicates),
    ("mixing", mix),
    ("byte_bpe", byte_bpe),
]

#: Neither the divergence references' word order nor SimHash and BPE can be said in SQL; the
#: tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what passes between stages is a table in the session's
    shared checkpoint folder, so a lost executor repeats one stage at most."""
    docs = common.table(spark, sf_dir, "documents")
    folder = os.path.join(ensure_checkpoint_dir(spark), f"corpus-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
