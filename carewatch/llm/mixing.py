"""Operator 4: mixing sources to target weights (DataFrame functions only).

Sources get token budgets by weight; a source's budget stops at `max_epochs` times its size
and the excess is shared anew among the others. Inside a source, complete epochs come
first; the rest of the budget goes to documents in Efraimidis-Spirakis order: the key of a
document is an exponential draw divided by its quality weight, and a prefix sum of sizes in
key order selects up to the budget.

No task sees a whole source. Keys are dealt into ordered buckets of the key, as many as
the shuffle is wide, so a source with a third of all rows spreads over all of them; one
small table of (source, bucket) sums carries the prefix sums across buckets.

Defined cases: a null text has size 0; a null source is a source of its own and sorts last;
a null doc_id is drawn like any other; equal rows have equal keys and are taken in any
order (the result is the same); an empty table gives an empty result; a source of size 0
has target 0. Draws come from md5 of (seed, doc_id, text), so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import n_words, shuffle_width, without

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 20240607
OUTPUTS = ("size", "source_size", "target", "copies", "taken")


def quality_weight(text: Column, size: Column) -> Column:
    """Quality weight from the text alone: 1, halved where the mean word length is unusual
    (under 3 or over 12 code points) and halved again for texts under 20 words."""
    mean = F.char_length(text) / F.greatest(size, F.lit(1))
    return (F.when(mean.between(3, 12), 1.0).otherwise(0.5)
            * F.when(size >= 20, 1.0).otherwise(0.5))


def draw(seed: int, *parts: Column) -> Column:
    """Uniform draw in (0, 1) with 48 bits from md5 of the seed and the parts."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    n = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
    return (n.cast("double") + 0.5) / float(1 << 48)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS) -> DataFrame:
    """(__source, __size) with one row per source -> its target. The level L at which
    sum(min(max_epochs * size, weight * L)) equals the budget is found with running sums over
    the sources in the order in which they fill up, instead of repeated resharing."""
    pos = F.row_number().over(W.orderBy(F.col("__source").asc_nulls_last())) - 1
    every = W.partitionBy()
    s = (sizes.withColumn("__w", F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                                              (pos % len(weights) + 1).cast("int")).cast("long"))
         .withColumn("__cap", F.col("__size") * max_epochs)
         .withColumn("__ratio", F.col("__cap") / F.col("__w"))
         .withColumn("__budget", F.sum("__size").over(every) * float(share)))
    before = (W.orderBy("__ratio", F.col("__source").asc_nulls_last())
              .rowsBetween(W.unboundedPreceding, -1))
    s = (s.withColumn("__full", F.coalesce(F.sum("__cap").over(before), F.lit(0)))
         .withColumn("__left", F.sum("__w").over(every) - F.coalesce(F.sum("__w").over(before), F.lit(0)))
         .withColumn("__level", (F.col("__budget") - F.col("__full")) / F.col("__left")))
    level = F.max(F.when(F.col("__level") <= F.col("__ratio"), F.col("__level"))).over(every)
    return s.withColumn("__target", F.least(F.col("__cap").cast("double"),
                                            F.coalesce(F.col("__w") * level, F.col("__cap").cast("double")))) \
        .select("__source", F.col("__size").alias("__source_size"), "__target")


def mix_sources(docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source",
                weight: Column | None = None, weights=WEIGHTS, share=SHARE,
                max_epochs=MAX_EPOCHS, seed=SEED) -> DataFrame:
    """`docs` with size, source_size, target, copies (times the document is used) and taken
    (size * copies). `weight`: a positive quality weight per row, else `quality_weight`.

    The document at the edge of a budget is used if that brings the sum nearer the target,
    so a source's sum is off by at most half that document's size."""
    spark = docs.sparkSession
    buckets = 4 * shuffle_width(spark)
    docs = without(docs, OUTPUTS, keep=(id_col, text_col, source_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    rows = (docs.withColumn("size", n_words(F.col(text_col)))
            .withColumn("__key", -F.log(draw(seed, ident, text))
                        / (weight if weight is not None else quality_weight(text, F.col("size"))))
            .withColumn("__bucket", F.least(F.lit(buckets - 1), F.floor(
                F.col("__key") / (F.col("__key") + 1) * buckets)).cast("int"))
            .withColumn("__src", F.col(source_col)))
    cells = (rows.groupBy(F.col("__src").alias("__source"), F.col("__bucket").alias("__b"))
             .agg(F.sum("size").alias("__cell")))
    targets = source_targets(cells.groupBy("__source").agg(F.sum("__cell").alias("__size")),
                             weights, share, max_epochs)
    before = W.partitionBy("__source").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    offsets = (cells.withColumn("__offset", F.coalesce(F.sum("__cell").over(before), F.lit(0)))
               .join(targets.withColumnRenamed("__source", "__s"),
                     F.col("__source").eqNullSafe(F.col("__s")))
               .select("__source", "__b", "__offset", "__source_size", "__target"))
    joined = rows.join(offsets, F.col("__src").eqNullSafe(F.col("__source"))
                       & (F.col("__bucket") == F.col("__b")))
    inside = (W.partitionBy("__source", "__b").orderBy("__key", id_col)
              .rowsBetween(W.unboundedPreceding, -1))
    prefix = F.col("__offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    epochs = F.when(F.col("__source_size") > 0,
                    F.floor(F.col("__target") / F.col("__source_size"))).otherwise(1).cast("long")
    rest = F.col("__target") - epochs * F.col("__source_size")
    picked = (epochs < max_epochs) & (prefix + F.col("size") / 2.0 <= rest) & (F.col("__source_size") > 0)
    return (joined.withColumn("copies", epochs + F.when(picked, 1).otherwise(0))
            .withColumn("source_size", F.col("__source_size"))
            .withColumn("target", F.col("__target"))
            .withColumn("taken", F.col("size") * F.col("copies"))
            .select(*[f"`{c}`" for c in docs.columns], *OUTPUTS))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every document of `docs` as many times as the mix uses it."""
    cols = [c for c in docs.columns]
    out = mix_sources(docs, **how)
    return (out.filter("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*[f"`{c}`" for c in cols if c in out.columns]))
