"""Operator 13: audit of how filters act together (exact constrained least squares).

A document's outcome depends only on the set of filters it fails, so all orders of the filters
follow from one small table: for each of the 2^n sets of filters (coalitions) the number of
documents that it removes together. From that table

* step counts are differences of coalitions: filter f after the set P removes v(P + f) - v(P);
* Shapley values are the additive model that fits the table best: least squares over the proper
  coalitions, weighted by the Shapley kernel, under the constraint that the values sum to v(all).
  The normal equations are solved in rationals (`fractions.Fraction`), so the values are exact
  and n! times a value is an integer.

Documents meet Spark only to become counts: one row (digest of the text, doc_id, part, mask) each,
combined before every shuffle, and one join that tells copies from first texts on the key
(digest, doc_id), which a large group of copies does not make hot.

Defined cases: a null text is empty, a null part is the empty string (and one part with it); a
null doc_id is never a copy and smaller than none, and has no labels; equal rows count each, and
rows with one doc_id and one text are no copies of each other; a doc_id with several label rows
has a label if one of them does; texts are read whole, whatever their length; other columns, also
such as clash with a result's name, are not read; an empty table has no parts and no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

BLANKS = r"[\x20\x09-\x0D]+"
#: Null ids are spread over so many values of a second join key.
SPREAD = 4096


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of a (not null) text that need no other document."""
    words = F.array_remove(F.split(text, BLANKS), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    return {
        "A": n < 200,
        "B": 100 * distinct < 50 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 3 * F.char_length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_counts(docs: DataFrame, labels: DataFrame, *, copies="E", filters=text_filters, id_col="doc_id",
                   text_col="text", part_col="lang", outcomes: Mapping[str, Column] | None = None) -> DataFrame:
    """(part, mask, n, and one count an outcome) over all documents: `mask` has bit i for the
    i-th of `filters` and the highest bit for `copies`, the filter that fails a text equal to one
    of a smaller id. `outcomes` are conditions on columns of `labels` (same id column)."""
    outcomes = outcomes or {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       text.alias("text"))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(filters(F.col("text")).values())]
    n_own = len(bits)
    own = read.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), sum(bits, F.lit(0)).alias("mask"))
    # equal rows become one before they travel; read twice below, so written once
    rows = checkpointed(own.groupBy("digest", "id", "part", "mask").agg(F.count("*").alias("n")))
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    told = rows.join(first, ["digest", "id"], "left").select(
        "id", "part", "n", F.when(F.col("id").isNotNull() & F.col("first").isNull(), F.col("mask") + (1 << n_own))
        .otherwise(F.col("mask")).alias("mask"))
    marks = labels.groupBy(F.col(id_col).alias("id")).agg(
        *[F.max(F.when(c, 1).otherwise(0)).alias(name) for name, c in outcomes.items()])
    spread = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("part", "mask", "n"), F.lit(SPREAD)) + 1).otherwise(F.lit(0))
    marked = told.withColumn("s", spread.cast("int")).join(marks.withColumn("s", F.lit(0)), ["id", "s"], "left")
    return marked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *[F.coalesce(F.sum(F.col("n") * F.col(o)), F.lit(0)).alias(o) for o in outcomes])


def coalition_removals(counts: DataFrame, n_filters: int, outcomes=("good", "toxic")) -> DataFrame:
    """(part, coalition, documents, removed, removed_<outcome>): for all 2^n sets of filters, what
    they remove together. At most 4^n rows a part go into the aggregate."""
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    return (counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << n_filters) - 1))))
            .groupBy("part", "coalition").agg(
                F.sum("n").alias("documents"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("removed"),
                *[F.sum(F.when(hit, F.col(o)).otherwise(0)).alias(f"removed_{o}") for o in outcomes]))


def least_squares_shapley(v: list[int]) -> list[Fraction]:
    """Shapley values of the game `v` (index: coalition as a bit set, v[0] = 0): minimises
    sum over proper coalitions S of k(S) (v(S) - sum of x_i in S)^2 under sum x = v(all), with
    k(S) = (n - 1) / (C(n, s) s (n - s)), by the normal equations with a Lagrange multiplier."""
    n = len(v).bit_length() - 1
    if n == 1:
        return [Fraction(v[1])]
    a = [[Fraction(0)] * (n + 2) for _ in range(n + 1)]  # n normal equations, the constraint, right side
    for s in range(1, len(v) - 1):
        members = [i for i in range(n) if s >> i & 1]
        k = Fraction(n - 1, math.comb(n, len(members)) * len(members) * (n - len(members)))
        for i in members:
            for j in members:
                a[i][j] += k
            a[i][-1] += k * v[s]
    for i in range(n):
        a[i][n] = a[n][i] = Fraction(1)
    a[n][-1] = Fraction(v[-1])
    for c in range(n + 1):  # Gauss-Jordan
        p = next(r for r in range(c, n + 1) if a[r][c])
        a[c], a[p] = a[p], a[c]
        a[c] = [x / a[c][c] for x in a[c]]
        for r in range(n + 1):
            if r != c and a[r][c]:
                a[r] = [x - a[r][c] * y for x, y in zip(a[r], a[c], strict=True)]
    return [a[i][-1] for i in range(n)]


def order_steps(coalitions: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step, from the coalition table (2^n rows a part
    in one task, whatever the number of documents)."""
    n = len(letters)

    def run(key, pdf):
        table = pdf.set_index("coalition").sort_index()
        v, good, toxic = ([int(x) for x in table[c]] for c in ("removed", "removed_good", "removed_toxic"))
        total, every = int(table["documents"].iloc[0]), len(v) - 1
        values = [math.factorial(n) * x for x in least_squares_shapley(v)]
        assert all(x.denominator == 1 for x in values)
        out = []
        for order in itertools.permutations(range(n)):
            before, name = 0, "".join(letters[i] for i in order)
            for step, i in enumerate(order, 1):
                after = before | 1 << i
                removed = v[after] - v[before]
                out.append((key[0], name, step, total - v[after], removed, v[1 << i] - removed,
                            v[every] - v[every ^ 1 << i], good[after] - good[before],
                            toxic[after] - toxic[before], int(values[i])))
                before = after
        return pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return coalitions.groupBy("part").applyInPandas(run, SCHEMA)


SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E over `docs` (doc_id, text, lang) and `labels` (doc_id, quality,
    toxic)."""
    return order_steps(coalition_removals(failure_counts(docs, labels), 5), "ABCDE")
