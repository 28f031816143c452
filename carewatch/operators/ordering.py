"""Global order of a large table without a single task.

`in_order` range-partitions rows by their sort columns, sorts each partition and writes the result,
so that every later step sees the same partitions: `place` numbers the rows of the whole table,
`count_before` counts some of them before each row, `carry_last` hands the last value before a row down
to it. All work inside partitions and across a table of one row a partition (the session's shuffle
width), which alone is broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Partition, number in the partition and tie-breaker of an ordered table.
PART, AT, TIE = "__part", "__at", "__tie"


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """`df`, written, in ascending `order` (nulls first) with its columns `__part` and `__at`. Rows equal in
    all of `order` may be cut between partitions, so no value is too frequent for a task."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()  # the partition from bit 33 up, the number in it below
    return (df.withColumn(TIE, place)
            .repartitionByRange(width, *order, TIE).sortWithinPartitions(*order, TIE)
            .withColumn(TIE, place)
            .select(*[f"`{c}`" for c in df.columns], F.shiftright(TIE, 33).alias(PART),
                    F.col(TIE).bitwiseAND((1 << 33) - 1).alias(AT))
            .checkpoint())


def place(ordered: DataFrame, name: str = "place") -> DataFrame:
    """The number of each row of an `in_order` table, from 0."""
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = ordered.groupBy(PART).agg(F.count(F.lit(1)).alias("__n")).select(
        PART, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return ordered.join(F.broadcast(starts), PART).withColumn(name, F.col("__start") + F.col(AT)).drop("__start")


def count_before(ordered: DataFrame, which: Column, name: str) -> DataFrame:
    """The number of rows with `which` (true or false) before each row, in the order of an `in_order` table
    (or of rows that kept its `__part` and `__at`)."""
    df = ordered.withColumn("__c", which.cast("long"))
    here = F.sum("__c").over(Window.partitionBy(PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = df.groupBy(PART).agg(F.sum("__c").alias("__n")).select(PART, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return (df.withColumn("__here", here).join(F.broadcast(starts), PART)
            .withColumn(name, F.col("__start") + F.coalesce("__here", F.lit(0))).drop("__c", "__here", "__start"))


def carry_last(ordered: DataFrame, value: Column, name: str) -> DataFrame:
    """The last value that is not null up to each row, in the order of an `in_order` table (or of rows
    that kept its `__part` and `__at`)."""
    df = ordered.withColumn("__v", value)
    here = F.last("__v", ignorenulls=True).over(Window.partitionBy(PART).orderBy(AT))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    ends = df.groupBy(PART).agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col(AT))).alias("__end")).select(
        PART, F.last("__end", ignorenulls=True).over(before).alias("__carried"))
    return (df.withColumn("__here", here).join(F.broadcast(ends), PART)
            .withColumn(name, F.coalesce("__here", "__carried")).drop("__v", "__here", "__carried"))
