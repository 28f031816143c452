"""Sinks (B1-B7)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import exact_quantiles, top_n
from .versions import publish_table


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, compression: str | None = None,
                encoding: str | None = None) -> None:
    """CSV with header (B1), also compressed or in a legacy encoding, or Parquet with all columns (B2)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    if encoding:  # cp1252 and the like are no charsets of Spark's own list
        df.sparkSession.conf.set("spark.sql.legacy.javaCharsets", "true")
        w = w.option("encoding", encoding)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def replace_table(df: DataFrame, name: str, min_rows: int = 1) -> None:
    """Replace a derived table (B3) without a moment in which it is gone or half written, also by
    rows computed from itself; see `versions.publish_table`."""
    publish_table(df, name, min_rows=min_rows, same_fields=False)


def write_scoped(df: DataFrame, path: str, by: str = "state", fmt: str = "parquet") -> None:
    """One output per scope value (B4). Ranks computed before this call stay national;
    the partitioned layout gives later readers partition pruning on `by`."""
    write_table(df, path, fmt, partition_by=[by])


class LeakRefused(ValueError):
    """Restricted values occur in the public output; nothing public was written."""


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def leaked_cells(restricted: DataFrame, public: DataFrame, cols: Sequence[str], least_chars: int = 4) -> DataFrame:
    """(column, cells, values): text cells of `public` in which a value of a restricted column occurs as a
    run of whole words, whatever the case and punctuation around it. Values of fewer than
    `least_chars` letters and digits are not looked for (an id `7` is in any text).

    Distinct values and the word runs of the cells, of those lengths that values have, meet by
    equality; nothing is compared pair by pair and no value is returned."""
    secret = restricted.select(F.explode(F.array(*[F.col(f"`{c}`").cast("string") for c in cols])).alias("v")).where(
        "v is not null").select(_words(F.col("v")).alias("w"))
    secret = secret.select(F.array_join("w", " ").alias("run"), F.size("w").alias("k")).where(
        F.length(F.array_join("w", "")) >= least_chars).distinct()
    lengths = secret.agg(F.sort_array(F.collect_set("k")).alias("ks"))  # one row: how many words values have
    texts = [c for c, t in public.dtypes if t == "string"]
    if not texts:
        return public.sparkSession.createDataFrame([], "column string, cells long, values long")
    cells = public.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("v")) for c in texts])).alias("c"))
    cells = cells.select("c.*").where("v is not null").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    runs = (cells.withColumn("w", _words(F.col("v"))).withColumn("_g", F.lit(0))
            .join(F.broadcast(lengths.withColumn("_g", F.lit(0))), "_g").withColumn("k", F.explode("ks"))
            .where(F.size("w") >= F.col("k"))
            .withColumn("i", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)))
            .select("column", "v", "n", F.array_join(F.slice("w", F.col("i"), F.col("k")), " ").alias("run")).distinct())
    return runs.join(secret.select("run"), "run").groupBy("column").agg(
        F.sum("n").alias("cells"), F.count_distinct("run").alias("values"))


def write_split(df: DataFrame, restricted_path: str, public: Callable[[DataFrame], DataFrame], public_path: str,
                restricted_cols: Sequence[str], fmt: str = "parquet", least_chars: int = 4) -> None:
    """Restricted and public outputs from one pass (B5): `df` is computed and written once, and the public
    part is made from the written rows by `public`. Refuses to write a public output that has a
    restricted column or in whose texts a restricted value occurs (`leaked_cells`)."""
    write_table(df, restricted_path, fmt)
    written = df.sparkSession.read.format(fmt).schema(df.schema).load(restricted_path)
    out = public(written)
    held = {c.lower() for c in restricted_cols}
    if leaked := [c for c in out.columns if c.lower() in held]:
        raise LeakRefused(f"public output holds restricted columns {leaked}")
    if found := leaked_cells(written, out, restricted_cols, least_chars).collect():  # a row a public column
        raise LeakRefused("restricted values occur in " + ", ".join(f"{r['column']} ({r['cells']} cells)" for r in found))
    write_table(out, public_path, fmt)


def scope_report(df: DataFrame, scope_col: str, score: str, label: str, n: int = 5,
                 digits: int = 1) -> DataFrame:
    """Narrative summary per scope (B6): rows (scope, line_no, text) with counts,
    quartiles, bottom n and top n. Entirely aggregates + `format_string`; nothing is
    collected. Write with `write_text`."""
    scored = df.where(F.col(score).isNotNull())
    cnt = df.groupBy(scope_col).agg(F.count(F.lit(1)).alias("_n"), F.count(score).alias("_s"))
    q = exact_quantiles(scored, score, (0.25, 0.5, 0.75), scope_col, ["_q1", "_q2", "_q3"]).drop("n")
    head = cnt.join(q, scope_col, "left")
    def number(c):  # rounds the binary value half to even, as printf does
        return F.expr(f"format_number(`{c}`, '0.{'0' * digits}')")
    lines = [
        head.select(scope_col, F.lit(1).alias("line_no"),
                    F.format_string("Facilities: %d (scored %d)", "_n", "_s").alias("text")),
        head.select(scope_col, F.lit(2).alias("line_no"),
                    F.format_string("Quartiles: Q1=%s  Median=%s  Q3=%s", number("_q1"), number("_q2"), number("_q3")).alias("text")),
    ]
    bottom = top_n(scored, score, n, scope_col, asc=True, tie_break=[label])
    top = top_n(scored, score, n, scope_col, asc=False, tie_break=[label])
    lines.append(bottom.select(scope_col, (F.col("rn") + 10).alias("line_no"),
                               F.format_string("Bottom %d: %s (%s)", "rn", label, number(score)).alias("text")))
    lines.append(top.select(scope_col, (F.col("rn") + 20).alias("line_no"),
                            F.format_string("Top %d: %s (%s)", "rn", label, number(score)).alias("text")))
    out = lines[0]
    for part in lines[1:]:
        out = out.unionByName(part)
    return out.withColumnRenamed(scope_col, "scope")


def write_text(report: DataFrame, path: str) -> None:
    """Write (scope, line_no, text) rows as one text file per scope."""
    (report.repartition("scope").sortWithinPartitions("scope", "line_no")
     .select("scope", "text").write.mode("overwrite").partitionBy("scope").text(path))


def write_findings(findings: DataFrame, path: str, run_date: str) -> None:
    """Machine-readable findings, partitioned by run date."""
    findings.withColumn("run_date", F.lit(run_date)).write.mode("append").partitionBy("run_date").json(path)


def write_snapshot(profile: DataFrame, path: str, run_date: str) -> None:
    """Column-profile snapshot for the next drift comparison."""
    profile.withColumn("run_date", F.lit(run_date)).write.mode("append").partitionBy("run_date").parquet(path)


def last_run_before(df: DataFrame, date: str | None = None) -> str | None:
    """The last `run_date` of a store partitioned by it, before `date` if given: reads partition values
    alone, no file's rows."""
    runs = df.where(F.col("run_date") < date) if date else df
    r = runs.agg(F.max(F.col("run_date").cast("string")).alias("d")).first()
    return r["d"]


def read_run(spark: SparkSession, path: str, run_date: str | None) -> DataFrame:
    """The rows of one run of a snapshot or findings store; only its partition is read (no run: no rows)."""
    df = spark.read.parquet(path)
    return (df.where(F.col("run_date") == run_date) if run_date else df.limit(0)).drop("run_date")


def with_line_numbers(df: DataFrame, by: str, order: Sequence[str], out: str = "line_no") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(by).orderBy(*order)))
