"""Registered queries of operators, readers and sinks that no domain build shows by itself.

Round trips write to a folder of their own below the session's checkpoint folder and read the
files back, so the rows compared have been through the sink and the reader."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions import expr as X
from ..operators import aggs as A
from ..operators import contracts as C
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import ranking as R
from ..operators import sets as S
from ..session import ensure_checkpoint_dir
from ..sources import readers, sinks
from ..sources.catalog import table
from . import access, references, testbed
from .domain_queries import with_position


def _folder(spark) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"round-trip-{uuid.uuid4().hex}")


def csv_round_trip(spark, d) -> DataFrame:
    """A1, B1: suppliers to CSV and back; every column text, blank cells NULL."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_acctbal") < 0, F.lit("")).otherwise(
        F.col("s_acctbal").cast("decimal(18,2)").cast("string")).alias("balance"))
    path = _folder(spark)
    sinks.write_table(s, path, "csv")
    return readers.read_text_table(spark, path)


def scoped_parquet_round_trip(spark, d) -> DataFrame:
    """Orders written one folder a status, two columns read back."""
    path = _folder(spark)
    sinks.write_scoped(table(spark, d, "orders"), path, by="o_orderstatus")
    return readers.read_columns(spark, path, ["o_orderkey", "o_orderstatus"])


def page_json_round_trip(spark, d) -> DataFrame:
    """Label pages as JSON files, read back as records."""
    path = _folder(spark)
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("name"),
                                         "n_regionkey")
    pages = n.groupBy("n_regionkey").agg(F.collect_list(F.struct("key", "name")).alias("results"),
                                         F.count(F.lit(1)).alias("count"))
    # one page a file: each region's page goes to a folder of its own
    (pages.select("n_regionkey", F.to_json(F.struct("count", "results")).alias("value"))
     .write.partitionBy("n_regionkey").text(path))
    record = T.StructType([T.StructField("key", T.StringType()), T.StructField("name", T.StringType())])
    return readers.read_pages(spark, path, schema=record).select("key", "name")


def snapshot_round_trip(spark, d) -> DataFrame:
    """A profile written as snapshot and read back shows no drift against itself but for
    what differs: rows (field, row_count)."""
    path = _folder(spark)
    sinks.write_snapshot(Q.profile(table(spark, d, "part"), "part"), path, "2026-01-01")
    return spark.read.parquet(path).select("field", "row_count")


def scope_report(spark, d) -> DataFrame:
    """The narrative lines of every nation's customers."""
    c = table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("nation"), "c_name", "c_acctbal")
    return sinks.scope_report(c, "nation", "c_acctbal", "c_name", n=2, digits=2)


def interval_join(spark, d) -> DataFrame:
    """E9 table form: part codes joined to the chapter table by range."""
    codes = testbed._codes(spark, d).withColumn("cat", X.category3("code"))
    ranges = readers.literal_table(spark, [(i, r[0], r[1], r[2]) for i, r in enumerate(K.ICD10_CHAPTERS)],
                                   "pos int, chapter string, lo string, hi string")
    return J.interval_lookup(codes, ranges, "cat", "lo", "hi", ["chapter"], seq="pos").select("p_partkey", "chapter")


def join_checks(spark, d) -> DataFrame:
    """A join of documents and labels keeps the row count; its match rate."""
    docs = table(spark, d, "documents").select("doc_id")
    lab = table(spark, d, "labels").select("doc_id").distinct().withColumn("hit", F.lit(True))
    after = docs.join(lab, "doc_id", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    return Q.check_join(docs, after, "hit", 0.2)


def score_universe(spark, d) -> DataFrame:
    """Labels carried back to all documents; unscored rows keep NULL."""
    return J.score_all(table(spark, d, "documents").select("doc_id", "lang"),
                       table(spark, d, "labels").select("doc_id", "quality", "toxic"), "doc_id", ["quality", "toxic"])


def sort_numeric_text(spark, d) -> DataFrame:
    """H4: text sorted as numbers, unparsable last; the position of each row."""
    p = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") == 7, F.lit("seven")).otherwise(
        F.col("p_size").cast("string")).alias("size_text"))
    return with_position(R.sort_num(p, "size_text", tie_break=["p_partkey"]))


def sort_mixed(spark, d) -> DataFrame:
    """H3, H6: mixed directions and explicit null placement; the position of each row."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", F.when(
        F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"))
    return with_position(R.sort_rows(c, [("c_mktsegment", "desc", "last"), ("bal", "asc", "first"),
                                         ("c_custkey", "desc", "last")]))


def rollup_rows(spark, d) -> DataFrame:
    """orders per customer, rolled up by nation."""
    per = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return A.rollup_groups(c.join(per, "o_custkey", "left"), "c_nationkey", "o_custkey", ["n_orders"])


def key_sets(spark, d) -> DataFrame:
    """Keys of customers without those of suppliers, with all keys beside them."""
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("k"))
    s = table(spark, d, "supplier").select((F.col("s_suppkey") * 31).cast("long").alias("k"))
    only = S.except_keys(c, s, "k").select("k").withColumn("customer_only", F.lit(True))
    return S.union_keys([c, s], "k").join(only, "k", "left").select("k", F.coalesce("customer_only", F.lit(False)).alias(
        "customer_only"))


def wide_metrics(spark, d) -> DataFrame:
    """One wide row of text figures becomes named metrics."""
    o = table(spark, d, "orders").agg(
        F.count(F.lit(1)).cast("string").alias("Total Number of Orders"),
        F.count_if(F.col("o_orderstatus") == "F").cast("string").alias("Orders Finished"),
        F.lit("N/A").alias("Orders Refused"))
    return C.unpivot_metrics(o, {"orders": ["number", "orders"], "finished": ["finished"], "refused": ["refused"]})


def text_means(spark, d) -> DataFrame:
    """mean of a text measure with sentinels per group, strictly parsed."""
    li = table(spark, d, "lineitem").select("l_returnflag", F.when(F.col("l_linenumber") == 2, F.lit("N/A")).otherwise(
        F.col("l_quantity").cast("string")).alias("text"))
    return A.mean_by(li.withColumn("v", X.num("text")), "l_returnflag", "v", out="mean_value", digits=4)


def census_demographics(spark, d) -> DataFrame:
    """Race, origin, income and disability tables derived and merged on the area."""
    o = table(spark, d, "orders").join(table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    areas = o.groupBy(F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("zip code tabulation area"), "c_nationkey").agg(
        *[F.count_if(F.col("o_orderkey") % 9 == i).alias(f"n{i}") for i in range(9)], F.count(F.lit(1)).alias("n"))

    def cell(i, bad="-666666666"):
        return F.when(F.col("c_nationkey") % 7 == i, F.lit(bad)).otherwise(F.col(f"n{i}").cast("string"))
    raw = areas.select("zip code tabulation area", F.when(F.col("c_nationkey") % 5 == 4, F.lit("0")).otherwise(
        F.col("n").cast("string")).alias("B02001_001E"), *[cell(i - 1).alias(f"B02001_00{i}E") for i in range(2, 9)],
        F.col("n").cast("string").alias("B03002_001E"), cell(0).alias("B03002_003E"), cell(1).alias("B03002_012E"),
        cell(2, "N").alias("B19013_001E"), F.col("n").cast("string").alias("S1811_C01_001E"), cell(3).alias("S1811_C02_001E"),
        F.when(F.col("c_nationkey") % 6 == 1, F.lit("null")).otherwise(
            F.concat((F.col("n4") % 90).cast("string"), F.lit(".4"))).alias("S1811_C03_001E"))
    return access.census_demographics([access.census_race(raw), access.census_origin(raw), access.census_income(raw),
                                       access.census_disability(raw)])


def icd_categories(spark, d) -> DataFrame:
    """P20: body system, categories and version of the code reference, quotes removed."""
    p = table(spark, d, "part")
    k = F.col("p_partkey").cast("string")
    raw = p.select(F.concat(F.lit("'A"), k, F.lit("'")).alias("'ICD-10-CM CODE'"), F.lit("x").alias("'ICD-10-CM CODE DESCRIPTION'"),
                   F.concat(F.lit("'B"), k, F.lit("'")).alias("'BODY SYSTEM'"),
                   *[c for n in (1, 2, 3) for c in (
                       F.concat(F.lit(f"'C{n}-"), k, F.lit("'")).alias(f"'CCSR CATEGORY {n}'"),
                       F.lit(f"'text {n}'").alias(f"'CCSR CATEGORY {n} DESCRIPTION'"))])
    return references.icd10_reference(raw, "v2026-1").select(
        "icd10_code", "body_system", "ccsr_cat_1", "ccsr_cat_1_desc", "ccsr_cat_3", "ccsr_cat_3_desc", "ccsr_cat_6", "ccsr_version")


QUERIES = {f.__name__: f for f in (
    census_demographics, icd_categories,
    csv_round_trip, scoped_parquet_round_trip, page_json_round_trip, snapshot_round_trip, scope_report, interval_join,
    join_checks, score_universe, sort_numeric_text, sort_mixed, rollup_rows, key_sets, wide_metrics, text_means)}


def _chapters() -> str:
    return "CASE " + " ".join(f"WHEN cat BETWEEN '{r[1]}' AND '{r[2]}' THEN '{r[0]}'" for r in K.ICD10_CHAPTERS) + " END"


_CELL = "CASE WHEN c_nationkey % 7 = {0} THEN 0 ELSE n{0} END"
_PCT = "round_even({0} / NULLIF(CAST({1} AS DOUBLE), 0.0) * 100.0, 1)"
SQL = {
    "census_demographics": f"""
    WITH a AS (SELECT c_nationkey, COUNT(*) AS n, {", ".join(f"COUNT(*) FILTER (o_orderkey % 9 = {i}) AS n{i}" for i in range(9))}
               FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey),
    b AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zcta, CASE WHEN c_nationkey % 5 = 4 THEN 0 ELSE n END AS race_total,
            {", ".join(f"{_CELL.format(i)} AS r{i}" for i in range(8))}, n, c_nationkey, n2, n3, n4 FROM a)
    SELECT zcta, race_total, r1 AS race_white, r2 AS race_black, r3 AS race_aian, r4 AS race_asian, r5 AS race_nhpi,
      r6 AS race_other, r7 AS race_multi, {_PCT.format("r1", "race_total")} AS pct_white, {_PCT.format("r2", "race_total")} AS pct_black,
      {_PCT.format("r4", "race_total")} AS pct_asian, {_PCT.format("r5", "race_total")} AS pct_nhpi,
      n AS hispanic_total, r1 AS hispanic_count, {_PCT.format("r1", "n")} AS pct_hispanic, r0 AS non_hisp_white,
      CASE WHEN c_nationkey % 7 = 2 THEN NULL ELSE n2 END AS median_hh_income, n AS disability_pop_total, r3 AS disability_count,
      CASE WHEN c_nationkey % 6 = 1 THEN NULL ELSE CAST(CAST(n4 % 90 AS VARCHAR) || '.4' AS DOUBLE) END AS pct_disability FROM b""",
    "icd_categories": """
    SELECT 'A' || CAST(p_partkey AS VARCHAR) AS icd10_code, 'B' || CAST(p_partkey AS VARCHAR) AS body_system,
      'C1-' || CAST(p_partkey AS VARCHAR) AS ccsr_cat_1, 'text 1' AS ccsr_cat_1_desc, 'C3-' || CAST(p_partkey AS VARCHAR) AS ccsr_cat_3,
      'text 3' AS ccsr_cat_3_desc, CAST(NULL AS VARCHAR) AS ccsr_cat_6, 'v2026-1' AS ccsr_version FROM part""",
    "csv_round_trip": """
    SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
           CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS balance FROM supplier""",
    "scoped_parquet_round_trip": "SELECT o_orderkey, o_orderstatus FROM orders",
    "page_json_round_trip": "SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS name FROM nation",
    "snapshot_round_trip": """
    SELECT field, (SELECT COUNT(*) FROM part) AS row_count
    FROM (SELECT column_name AS field FROM (DESCRIBE SELECT * FROM part))""",
    "scope_report": """
    WITH c AS (SELECT CAST(c_nationkey AS VARCHAR) AS scope, c_name, c_acctbal FROM customer),
    r AS (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY c_acctbal, c_name) AS lo,
                 row_number() OVER (PARTITION BY scope ORDER BY c_acctbal DESC, c_name) AS hi FROM c)
    SELECT scope, CAST(1 AS BIGINT) AS line_no, format('Facilities: {} (scored {})', COUNT(*), COUNT(c_acctbal)) AS text FROM c GROUP BY scope
    UNION ALL SELECT scope, 2, printf('Quartiles: Q1=%.2f  Median=%.2f  Q3=%.2f', quantile_cont(c_acctbal, 0.25),
      quantile_cont(c_acctbal, 0.5), quantile_cont(c_acctbal, 0.75)) FROM c GROUP BY scope
    UNION ALL SELECT scope, lo + 10, printf('Bottom %d: %s (%.2f)', lo, c_name, c_acctbal) FROM r WHERE lo <= 2
    UNION ALL SELECT scope, hi + 20, printf('Top %d: %s (%.2f)', hi, c_name, c_acctbal) FROM r WHERE hi <= 2""",
    "interval_join": f"""
    WITH p AS (SELECT p_partkey, substring(upper(substring(p_name, 1, 1)) || lpad(CAST(p_size AS VARCHAR), 2, '0')
                 || CAST(p_partkey % 10 AS VARCHAR), 1, 3) AS cat FROM part)
    SELECT p_partkey, {_chapters()} AS chapter FROM p""",
    "join_checks": """
    WITH m AS (SELECT COUNT(*) AS n, AVG(CASE WHEN l.doc_id IS NULL THEN 0.0 ELSE 1.0 END) AS rate
               FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id)
    SELECT 'row_count_unchanged' AS "check", CAST(n AS DOUBLE) AS value, n = (SELECT COUNT(*) FROM documents) AS ok FROM m
    UNION ALL SELECT 'match_rate', ROUND(rate, 6), rate >= 0.2 FROM m""",
    "score_universe": """
    SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "sort_numeric_text": """
    SELECT p_partkey, CASE WHEN p_size = 7 THEN 'seven' ELSE CAST(p_size AS VARCHAR) END AS size_text,
           row_number() OVER (ORDER BY CASE WHEN p_size <> 7 THEN p_size END ASC NULLS LAST, p_partkey) AS position FROM part""",
    "sort_mixed": """
    SELECT c_custkey, c_mktsegment, bal, row_number() OVER (ORDER BY c_mktsegment DESC NULLS LAST, bal ASC NULLS FIRST,
           c_custkey DESC) AS position
    FROM (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal FROM customer)""",
    "rollup_rows": """
    WITH p AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1)
    SELECT c_nationkey, COUNT(*) AS n_o_custkey, CAST(SUM(n) AS BIGINT) AS sum_n_orders
    FROM customer LEFT JOIN p ON c_custkey = o_custkey GROUP BY c_nationkey""",
    "key_sets": """
    WITH c AS (SELECT CAST(c_custkey AS BIGINT) AS k FROM customer), s AS (SELECT CAST(s_suppkey * 31 AS BIGINT) AS k FROM supplier)
    SELECT k, k IN (SELECT k FROM c) AND k NOT IN (SELECT k FROM s) AS customer_only FROM (SELECT k FROM c UNION SELECT k FROM s)""",
    "wide_metrics": """
    SELECT 'orders' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM orders
    UNION ALL SELECT 'finished', CAST(COUNT_IF(o_orderstatus = 'F') AS DOUBLE) FROM orders""",
    "text_means": """
    SELECT l_returnflag, round_even(AVG(CASE WHEN l_linenumber <> 2 THEN CAST(l_quantity AS DOUBLE) END), 4) AS mean_value
    FROM lineitem GROUP BY l_returnflag""",
}
