"""Operator 3: quality rules by distribution divergence.

Each document's histogram of character classes and of its language's common words is compared
with the language's reference by Jensen-Shannon distance (base 2, 0 to 1). References come
from all documents of the language. A document is rejected if it fails the base rules, or if a
distance is over its limit. Short texts vary by chance, so a distance counts only from a
minimum length on, and its limit falls with length to its final value.

Every language with at least `MIN_REFERENCE` words has its own reference, whatever its share of
the documents. The `HELD` largest references go to the workers at once; should there be more,
they are joined to their documents. A reference counts `COMMON` words and one bin for all others.

Defined cases: a null text has no words and fails the base rules (fewer than 10 words); a null
lang, and one of fewer than `MIN_REFERENCE` words, has no reference: only the base rules, which
need no language, reject there, and both distances are 0; equal rows get equal results; an empty table gives an empty result; an input column
named like a result is replaced.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpointed, without

COMMON = 60
HELD = 2_000
MIN_REFERENCE = 2_000
MIN_CHARS, MIN_WORDS = 100, 40
CHAR_LIMIT, WORD_LIMIT = 0.25, 0.25
CHAR_SLACK, WORD_SLACK = 1.2, 2.2
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_LOWER = bytes(range(97, 123))
_UPPER = bytes(range(65, 91))
_DIGIT = b"0123456789"
_STOPS = b".,;:!?'\"()-"
_BLANK_BYTES = BLANKS.encode()
OUTPUTS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
           "n_repeat_words": "long", "base_failed": "boolean", "char_distance": "double",
           "word_distance": "double", "kept": "boolean"}


def char_classes(text: str, data: bytes) -> np.ndarray:
    """Counts of lower-case, upper-case, digits, stops, other ASCII marks, and characters
    beyond ASCII; blanks do not count."""
    def n(chars):
        return len(data) - len(data.translate(None, chars))
    lower, upper, digit, stops, blank = n(_LOWER), n(_UPPER), n(_DIGIT), n(_STOPS), n(_BLANK_BYTES)
    beyond = 0 if len(data) == len(text) else sum(map("\x7f".__lt__, text))
    return np.array([lower, upper, digit, stops,
                     len(text) - beyond - lower - upper - digit - stops - blank, beyond], float)


def distance(a: np.ndarray, b: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms."""
    p, q = a / a.sum(), b / b.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return math.sqrt(min(1.0, max(0.0, d / 2)))


def repeated_words(words: list) -> int:
    """Words in 5-word windows that occur twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    total = end = 0
    for i, window in enumerate(windows):
        if count[window] > 1:
            total += i + 5 - max(i, end)
            end = i + 5
    return total


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8").split()
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(BLANKS):
            seen.add(line)
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            dup, repeated_words(words))


def references(docs: DataFrame, text_col="text", lang_col="lang") -> DataFrame:
    """(key, chars, total, common): a row for each language of at least `MIN_REFERENCE` words with
    its character-class histogram, its number of words, and its common words (rank, word, n)."""
    rows = (docs.select(F.col(lang_col).alias("key"), F.col(text_col).alias("__text"))
            .filter(F.col("key").isNotNull() & F.col("__text").isNotNull()))

    def classes(batches):
        for rb in batches:
            sums: dict[str, np.ndarray] = {}
            for key, text in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                data = text.encode("utf-8")
                c = np.append(char_classes(text, data), len(data.split()))
                sums[key] = sums[key] + c if key in sums else c
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([list(c) for c in sums.values()], pa.list_(pa.float64()))],
                names=["key", "c"])

    summed = rows.mapInArrow(classes, "key string, c array<double>").groupBy("key").agg(
        F.array(*[F.sum(F.col("c")[i]) for i in range(6)]).alias("chars"), F.sum(F.col("c")[6]).alias("total"))
    words = (rows.select("key", F.explode(F.split(F.lower("__text"), r"[\x20\x09-\x0D]+")).alias("w"))
             .filter("w <> ''").groupBy("key", "w").agg(F.count("*").alias("n")))
    top = (words.withColumn("r", F.row_number().over(W.partitionBy("key").orderBy(F.desc("n"), "w")))
           .filter(F.col("r") <= COMMON)
           .groupBy("key").agg(F.collect_list(F.struct("r", "w", "n")).alias("common")))
    return summed.filter(F.col("total") >= MIN_REFERENCE).join(top, "key")


def _reference(chars, total, common) -> tuple:
    """(character-class histogram, common word -> bin, word histogram) from a row of `references`."""
    hist = np.zeros(COMMON + 1)
    for r, _, n in common:
        hist[r - 1] = n
    hist[COMMON] = total - hist.sum()
    return np.array(chars, float), {w.encode("utf-8"): r - 1 for r, w, _ in common}, hist


def _fields(packed: str) -> tuple:
    """chars, total, common from the JSON form of a reference."""
    r = json.loads(packed)
    return r["chars"], r["total"], [(int(k), w, int(n)) for k, w, n in r["common"]]


def judge(text: str | None, reference) -> tuple:
    """All results for one text."""
    base = base_counts(text)
    n = base[0]
    failed = n < 10 or 100 * base[4] > 20 * n
    far_chars = far_words = 0.0
    if reference is not None and n:
        chars, common, hist = reference
        own = char_classes(text, text.encode("utf-8"))
        far_chars = distance(own, chars)
        words = np.zeros(COMMON + 1)
        for w, k in Counter(text.lower().encode("utf-8").split()).items():
            words[common.get(w, COMMON)] += k
        far_words = distance(words, hist)
    off = ((own_len := base[1]) >= MIN_CHARS and far_chars > CHAR_LIMIT + CHAR_SLACK / math.sqrt(own_len)
           or n >= MIN_WORDS and far_words > WORD_LIMIT + WORD_SLACK / math.sqrt(n)) if n else False
    return (*base, failed, far_chars, far_words, not failed and not off)


def quality_rules(docs: DataFrame, *, text_col="text", lang_col="lang", held=HELD) -> DataFrame:
    """`docs` with the base counts, both distances and the verdict `kept`."""
    docs = without(docs, OUTPUTS, keep=(text_col, lang_col))
    table = checkpointed(references(docs, text_col, lang_col))
    top = table.orderBy(F.desc("total"), "key").limit(held).collect()
    shared = docs.sparkSession.sparkContext.broadcast({r[0]: _reference(*r[1:]) for r in top})
    schema = ", ".join(f"{k} {v}" for k, v in OUTPUTS.items())

    @F.pandas_udf(schema)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        refs = shared.value
        for texts, langs in batches:
            yield pd.DataFrame([judge(t, refs.get(lang)) for t, lang in zip(texts, langs, strict=True)],
                               columns=list(OUTPUTS))

    @F.pandas_udf(schema)
    def run_joined(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, packed in batches:
            yield pd.DataFrame([judge(t, None if r is None else _reference(*_fields(r)))
                                for t, r in zip(texts, packed, strict=True)], columns=list(OUTPUTS))

    def results(judged: DataFrame) -> DataFrame:
        return judged.select(*[f"`{c}`" for c in docs.columns], *[F.col(f"__q.{k}").alias(k) for k in OUTPUTS])

    if len(top) < held or table.count() == held:
        return results(docs.withColumn("__q", run(F.col(text_col), F.col(lang_col))))
    own = F.col(lang_col).isNull() | F.col(lang_col).isin([r[0] for r in top])
    triples = F.transform("common", lambda x: F.array(x["r"].cast("string"), x["w"], x["n"].cast("string")))
    more = table.select(F.col("key").alias("__key"), F.to_json(F.struct(
        "chars", "total", triples.alias("common"))).alias("__reference"))
    joined = docs.filter(~own).join(more, F.col(lang_col) == F.col("__key"), "left")
    return results(docs.filter(own).withColumn("__q", run(F.col(text_col), F.col(lang_col)))).unionByName(
        results(joined.withColumn("__q", run_joined(F.col(text_col), F.col("__reference")))))
