"""Shared pieces of the training-data operators.

Conventions that hold for every operator here:

* a word is a match of ``[^\\x20\\x09-\\x0D]+`` (only the six ASCII blanks separate words);
  `bytes.split()` cuts UTF-8 at exactly these blanks;
* an input column whose name an operator gives to one of its results is replaced;
* nothing collects rows to the driver except tables whose size has a stated bound.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carewatch.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


#: Texts are long and some are very long: Arrow batches of at most so many rows and bytes bound
#: what a Python worker holds, and what it keeps from the system when it idles.
BATCH_ROWS, BATCH_BYTES = 1_000, 8 << 20


def _bounded_batches(spark: SparkSession) -> None:
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        held = spark.conf.get(key)
        if not (held.isdigit() and 0 < int(held) <= most):
            spark.conf.set(key, str(most))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session, wherever they run:
    its modules (a few dozen kilobytes) go out with Spark's own file distribution, once a
    session. Also bounds the session's Arrow batches."""
    _bounded_batches(spark)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(), f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, for a registered query."""
    ship_package(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def without(df: DataFrame, names, keep=()) -> DataFrame:
    """`df` without columns that an operator is about to add (names compare as Spark does,
    ignoring case); columns the operator reads are kept."""
    wanted = {n.lower() for n in names} - {n.lower() for n in keep}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in wanted])


def n_words(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the session's shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shuffle_width(spark: SparkSession) -> int:
    """Partitions of a shuffle: the figure by which a cluster is sized for its input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
