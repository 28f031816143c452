"""Operator 1: I-Match document fingerprints (DataFrame functions only).

Terms are the lower-cased pieces of a text between blanks and line ends. The lexicon holds the
terms whose inverse document frequency lies in a band: at least ln(1 / `MOST_SHARE`), so that no
more than that share of the documents hold them, and at most that of a term in one document. The band's
lower end is a number of documents, the same at every size, so terms of a rare language or script
are in the lexicon as well. A document keeps its distinct lexicon terms,
sorted, and hashes them once for each of several randomised subsets of the lexicon: there are
scales, each of which samples the lexicon with chance 2^(3 - k) by the term's MD5, and `FUNCTIONS`
random digits for each term, from its SHA-256; the subset of scale k and function j holds the terms
sampled at k whose j-th digit is below 2 of 16 (scales under 3 sample all terms and have a higher
limit, so that a subset takes a term with chance 2^-k). A document of about 2^s terms uses the
scales s to s + 2, whose subsets hold about two, one and half a term of it; so some of them stay
the same when half of its terms change, whatever its length. A fingerprint is s and the list of the subsets' hashes;
its likeness to another is the share of equal hashes among the subsets of the scales that both
use and that hold a term of either.

Only terms outside the band need to be known, and at most (mean distinct terms a document) /
`MOST_SHARE` terms can be too frequent, because document frequencies add up to the number of
(document, distinct term) pairs. These go into the plan as a set; texts are never shuffled for it.

The text after a document's own, by doc_id, is found without a single sorted task: documents
are dealt into ranges between quantiles of doc_id, and each range also receives the first
document of the next (the last range: of the first).

Defined cases: a null text is empty; a text without terms has the fingerprint `none`, like an equal
one only; a text none of whose terms is in the lexicon keeps all of its terms, in the same
subsets; equal texts have equal fingerprints; rows of equal doc_id follow each other by text hash; null doc_ids come last and
are followed by the first document; the only document is followed by itself; an empty table
gives an empty result; an input column named like a result is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import shuffle_width

#: The band: a term in one document or more, and in at most this share of them.
MOST_SHARE = 0.25
#: Random digits of a term, and scales that a text uses.
FUNCTIONS, SCALES = 32, 3
#: First digits of the MD5 of the terms that scale k samples are below the k-th of these; a digit
#: of the SHA-256 is below the k-th of those with what is left of the chance 2^-k (fixed from 3 on).
SAMPLED = ("g", "g", "g", "g", *(f"{1 << (16 - k):04x}" for k in range(1, 16)))
TAKEN = ("g", "8", "4", *["2"] * (len(SAMPLED) - 3))
#: Hex digits of a subset's hash.
DIGITS = 4
NONE = "none"


def terms(text: Column) -> Column:
    """Distinct lower-case terms of a text (null: none)."""
    plain = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("\n"), F.lit(" "))
    return F.array_distinct(F.array_remove(F.split(plain, " "), ""))


def frequent_terms(docs: DataFrame, *, text_col="text", most=MOST_SHARE) -> list[str]:
    """Terms that more than the share `most` of all rows of `docs` hold: fewer than the mean number of
    distinct terms of a row divided by `most`."""
    n = docs.count()
    found = (docs.select(F.explode(terms(F.col(text_col))).alias("t")).groupBy("t")
             .agg(F.count("*").alias("df")).filter(F.col("df") > most * n).select("t"))
    return sorted(r[0] for r in found.collect())


def _among(words: list[str]) -> str:
    """SQL list of strings."""
    return ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words) or "''"


def with_fingerprint(df: DataFrame, text: Column, name: str, frequent: list[str]) -> DataFrame:
    """`df` with the fingerprint of `text` in column `name`: its first scale, and the subsets' hashes
    (none for a subset without a term) in the order of scales, then functions, joined by `-`."""
    def bounds(of):
        return f"slice(array({_among(list(of))}), __scale + 1, {SCALES})"
    subsets = ", ".join(
        f"array_join(transform(filter(__few, x -> x.m < element_at(__sampled, {k}) AND substr(x.h, {j}, 1) < element_at(__taken, {k})), x -> x.t), ' ')"
        for k in range(1, SCALES + 1) for j in range(1, FUNCTIONS + 1))
    # an empty subset joins to '', whose hash is left out
    return (df.withColumn("__own", terms(text))
            .withColumn("__kept", F.expr(f"filter(__own, t -> t NOT IN ({_among(['', *frequent])}))"))
            .withColumn("__kept", F.expr("if(size(__kept) = 0, __own, __kept)"))
            .withColumn("__scale", F.expr(f"least(cast(floor(log2(greatest(size(__kept), 1))) as int), {len(SAMPLED) - SCALES})"))
            .withColumn("__sampled", F.expr(bounds(SAMPLED)))
            .withColumn("__taken", F.expr(bounds(TAKEN)))
            # the sample of the first scale holds those of the others
            .withColumn("__few", F.expr("sort_array(filter(__kept, t -> left(md5(t), 4) < __sampled[0]))"))
            .withColumn("__few", F.expr("transform(__few, t -> struct(t AS t, left(md5(t), 4) AS m, sha2(t, 256) AS h))"))
            .withColumn(name, F.expr(f"if(size(__kept) = 0, '{NONE}', concat(__scale, ':', array_join(transform(array({subsets}), "
                                     f"j -> if(j = '', '', left(md5(j), {DIGITS}))), '-')))"))
            .drop("__own", "__kept", "__scale", "__sampled", "__taken", "__few"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets of the scales of both that hold a term of either."""
    scale = lambda x: F.split(x, ":")[0].try_cast("int")
    off = scale(b) - scale(a)
    both = (F.lit(SCALES) - F.abs(off)) * FUNCTIONS

    def shared(x, skip):
        return F.slice(F.split(F.split(x, ":").getItem(1), "-"), skip * FUNCTIONS + 1, F.greatest(both, F.lit(0)))
    # for each subset: 0 no term, 1 different, 3 equal
    marks = F.zip_with(shared(a, F.greatest(off, F.lit(0))), shared(b, F.greatest(-off, F.lit(0))), lambda x, y: F.when(
        (x == "") & (y == ""), 0).when(x == y, 3).otherwise(1))
    total = F.aggregate(marks, F.lit(0), lambda z, m: z + F.when(m > 0, 1).otherwise(0)
                        + F.when(m == 3, 1 << 16).otherwise(0))
    held, same = total.bitwiseAND(0xFFFF), F.shiftright(total, 16)
    apart = (a == NONE) | (b == NONE) | (F.abs(off) >= SCALES)
    return F.when(a == b, 1.0).when(apart, 0.0).otherwise(F.coalesce(F.try_divide(same, held), F.lit(0.0)))


def id_ranges(docs: DataFrame, ranges: int, id_col="doc_id") -> list[int]:
    """Ascending distinct doc_ids of `docs` that cut it into about `ranges` equal ranges; the
    first is the smallest doc_id (none if all are null)."""
    share = [k / ranges for k in range(ranges)]
    r = docs.agg(F.min(id_col).alias("low"), F.percentile_approx(id_col, share, 20 * ranges).alias("cuts")).first()
    return [] if r["low"] is None else sorted({r["low"], *r["cuts"]})


def with_next(docs: DataFrame, columns: list[str], names: list[str], *, id_col="doc_id",
              hash_col="__hash") -> DataFrame:
    """`docs` with `columns` of the next row by (doc_id, text hash), null ids last, the first
    after the last, under `names`."""
    cuts = id_ranges(docs, shuffle_width(docs.sparkSession), id_col)
    n = len(cuts)
    edges = F.expr(f"array({', '.join(f'{c}L' for c in cuts)})") if n else F.array().cast("array<bigint>")
    own = F.when(F.col(id_col).isNull(), F.lit(max(1, n))).otherwise(
        F.size(F.filter(edges, lambda e: e <= F.col(id_col))))
    # the row that begins a range is a visitor in the range before
    before = F.when(F.col("__range") == 1, F.lit(max(1, n))).otherwise(F.col("__range") - 1)
    places = F.when(F.array_contains(edges, F.col(id_col)), F.array(
        F.struct(F.col("__range").alias("r"), F.lit(False).alias("visits")),
        F.struct(before.alias("r"), F.lit(True).alias("visits")))).otherwise(
        F.array(F.struct(F.col("__range").alias("r"), F.lit(False).alias("visits"))))
    dealt = docs.withColumn("__range", own).withColumn("__at", F.explode(places))
    order = W.partitionBy("__at.r").orderBy("__at.visits", F.col(id_col).asc_nulls_last(), hash_col)
    first = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    both = F.struct(*columns)
    follow = F.coalesce(F.lead(both).over(order), F.first(both).over(first)) if not n else F.lead(both).over(order)
    return (dealt.withColumn("__next", follow).filter("not __at.visits")
            .select(*[f"`{c}`" for c in docs.columns], *[F.col(f"__next.{c}").alias(m) for c, m in
                                                        zip(columns, names, strict=True)]))


def half_replaced(text: Column, following: Column) -> Column:
    """`text` with its last floor(n / 2) code points replaced by the first as many of `following`."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def edited_likeness(docs: DataFrame, *, id_col="doc_id", text_col="text", most=MOST_SHARE) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    for every row of `docs`."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = frequent_terms(rows, most=most)
    own = with_fingerprint(rows.withColumn("__hash", F.xxhash64("text")), F.col("text"), "fingerprint", words)
    pairs = with_next(own, ["text", "fingerprint"], ["__text", "__fingerprint"])
    edited = pairs.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "fingerprint",
                          "__fingerprint", half_replaced(F.col("text"), F.col("__text")).alias("__edited"))
    return (with_fingerprint(edited, F.col("__edited"), "edited_fingerprint", words)
            .select("doc_id", "n_chars", F.sha2("__edited", 256).alias("edited_sha256"), "fingerprint",
                    "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("__fingerprint")).alias("near_next")))
