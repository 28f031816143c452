"""Registered queries of range joins, reconciliation, landed files and stored runs over the whole test
tables, each with SQL of its own."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import contracts as C
from ..operators import joins as J
from ..operators import quality as Q
from ..session import ensure_checkpoint_dir
from ..sources import readers, sinks, versions
from ..sources.catalog import table
from ..streaming import ingest_pages_stream
from . import measures, references

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f
    return add


def _folder(spark) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"feature-{uuid.uuid4().hex}")


# ------------------------------------------------------------------ ranges

_SEQ = "(l_partkey * 7919 + l_suppkey * 31 + l_linenumber) % 100003"
_LABEL = "concat_ws('-', CAST(l_orderkey AS {0}), CAST(l_linenumber AS {0}), CAST(l_partkey AS {0}))"


@query(f"""
WITH r AS (
  SELECT {_SEQ} AS seq, {_LABEL.format("VARCHAR")} AS label, l_extendedprice AS lo,
         CASE WHEN l_linenumber = 7 AND l_quantity = 50 THEN NULL ELSE l_extendedprice + l_quantity END AS hi FROM lineitem
  UNION ALL
  SELECT {_SEQ} + 100003, 'wide ' || {_LABEL.format("VARCHAR")}, CASE WHEN l_linenumber = 6 AND l_quantity = 49 THEN NULL ELSE 2 * l_extendedprice END,
         2 * l_extendedprice + 4 * l_quantity FROM lineitem),
k AS (SELECT DISTINCT o_totalprice AS v FROM orders),
w AS (SELECT v, min(struct_pack(seq := seq, lo := coalesce(lo, -1e300), hi := coalesce(hi, 1e300), label := label)).label AS label
      FROM k JOIN r ON (lo <= v OR lo IS NULL) AND (v <= hi OR hi IS NULL) GROUP BY v)
SELECT o_orderkey, label FROM orders LEFT JOIN w ON o_totalprice = v""")
def range_numbers(spark, d) -> DataFrame:
    """E9 over number keys: two overlapping, nested and partly open ranges a line item, the first by `seq`."""
    li = table(spark, d, "lineitem")
    label, price, q = F.expr(_LABEL.format("STRING")), F.col("l_extendedprice"), F.col("l_quantity")
    line = F.col("l_linenumber")
    narrow = li.select(F.expr(_SEQ).alias("seq"), label.alias("label"), price.alias("lo"),
                       F.when(~((line == 7) & (q == 50)), price + q).alias("hi"))
    wide = li.select((F.expr(_SEQ) + 100003).alias("seq"), F.concat(F.lit("wide "), label).alias("label"),
                     F.when(~((line == 6) & (q == 49)), 2 * price).alias("lo"), (2 * price + 4 * q).alias("hi"))
    return J.interval_lookup(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), narrow.unionByName(wide),
                             "o_totalprice", "lo", "hi", ["label"], seq="seq").select("o_orderkey", "label")


@query(f"""
WITH r AS (SELECT CAST(l_shipdate AS DATE) AS lo, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) AS hi,
                  {_LABEL.format("VARCHAR")} AS label FROM lineitem),
k AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS v FROM orders),
w AS (SELECT v, min(struct_pack(lo := lo, hi := hi, label := label)).label AS label FROM k JOIN r ON v BETWEEN lo AND hi GROUP BY v)
SELECT o_orderkey, label FROM orders LEFT JOIN w ON CAST(o_orderdate AS DATE) = v""")
def range_dates(spark, d) -> DataFrame:
    """E9 over date keys: one period a line item, the earliest and then shortest that holds the order's day."""
    ship = F.col("l_shipdate").cast("date")
    spans = table(spark, d, "lineitem").select(ship.alias("lo"), F.date_add(ship, F.col("l_quantity").cast("int")).alias("hi"),
                                               F.expr(_LABEL.format("STRING")).alias("label"))
    days = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return J.interval_lookup(days, spans, "day", "lo", "hi", ["label"]).select("o_orderkey", "label")


_NAME = "concat('Customer#', lpad(CAST({0} AS {1}), 9, '0'))"


@query(f"""
WITH r AS (SELECT {_NAME.format("o_custkey", "VARCHAR")} AS lo, {_NAME.format("o_custkey + o_orderkey % 40 - 5", "VARCHAR")} AS hi,
                  o_orderkey, (o_orderkey * 7919) % 10007 AS seq FROM orders),
w AS (SELECT c_custkey, min(struct_pack(seq := seq, lo := lo, hi := hi, o := o_orderkey)).o AS o_orderkey
      FROM customer JOIN r ON c_name BETWEEN lo AND hi GROUP BY c_custkey)
SELECT c_custkey, o_orderkey FROM customer LEFT JOIN w USING (c_custkey)""")
def range_texts(spark, d) -> DataFrame:
    """E9 over text keys that share a long beginning: a span of names an order (some the wrong way round)."""
    spans = table(spark, d, "orders").select(
        F.expr(_NAME.format("o_custkey", "STRING")).alias("lo"), F.expr(_NAME.format("o_custkey + o_orderkey % 40 - 5", "STRING")).alias("hi"),
        "o_orderkey", F.expr("(o_orderkey * 7919) % 10007").alias("seq"))
    return J.interval_lookup(table(spark, d, "customer").select("c_custkey", "c_name"), spans, "c_name", "lo", "hi",
                             ["o_orderkey"], seq="seq").select("c_custkey", "o_orderkey")


# ----------------------------------------------------------- reconciliation

_SOURCES = ["customer", "orders", "supplier", "events", "part"]
_PAIR_KEYS = """
WITH u AS (SELECT DISTINCT 0 AS s, CAST(c_custkey AS VARCHAR) AS k FROM customer UNION SELECT 1, CAST(o_custkey AS VARCHAR) FROM orders
           UNION SELECT 2, CAST(s_suppkey * 3 AS VARCHAR) FROM supplier UNION SELECT 3, CAST(user_id AS VARCHAR) FROM events
           UNION SELECT 4, CASE WHEN p_size > 9 THEN CAST(p_partkey AS VARCHAR) END FROM part)"""


@query(_PAIR_KEYS + " UNION ALL ".join(f"""
SELECT '{a}' AS "left", '{b}' AS "right", COUNT(*) FILTER (n = 3) AS matched, COUNT(*) FILTER (n = 1) AS left_only, COUNT(*) FILTER (n = 2) AS right_only
FROM (SELECT k, SUM(CASE s WHEN {i} THEN 1 ELSE 2 END) AS n FROM u WHERE s IN ({i}, {j}) AND k IS NOT NULL GROUP BY k)"""
    for i, a in enumerate(_SOURCES) for j, b in enumerate(_SOURCES) if i < j))
def reconcile_every_pair(spark, d) -> DataFrame:
    """Keys of five sources compared pair by pair, in one shuffle of the keys."""
    return J.reconcile_pairs({
        "customer": (table(spark, d, "customer"), "c_custkey"), "orders": (table(spark, d, "orders"), "o_custkey"),
        "supplier": (table(spark, d, "supplier").select((F.col("s_suppkey") * 3).alias("k")), "k"),
        "events": (table(spark, d, "events"), "user_id"),
        "part": (table(spark, d, "part").select(F.when(F.col("p_size") > 9, F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit("\t")))
                                                .otherwise(F.lit(" ")).alias("k")), "k")})


# ------------------------------------------------- files with headers of their own

_BALANCE = "CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS {0})"


@query(f"""
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
       CASE WHEN s_nationkey % 3 < 2 THEN {_BALANCE.format("VARCHAR")} END AS balance,
       CASE WHEN s_nationkey % 3 = 2 THEN CAST(s_nationkey AS VARCHAR) END AS "nation, key" FROM supplier""")
def files_of_other_headers(spark, d) -> DataFrame:
    """Three vintages of one CSV source, columns in another order and missing, in one read."""
    s = table(spark, d, "supplier").withColumn("balance", F.expr(_BALANCE.format("STRING")))
    path = _folder(spark)
    layouts = [["s_suppkey", "s_name", "balance"], ["balance", "s_suppkey", "s_name"], [F.col("s_nationkey").alias("nation, key"), "s_name", "s_suppkey"]]
    for i, cols in enumerate(layouts):
        sinks.write_table(s.where(F.col("s_nationkey") % 3 == i).select(*cols), f"{path}/{i}", "csv")
    return readers.read_text_table(spark, [f"{path}/{i}" for i in range(3)]).select("s_suppkey", "s_name", "balance", "nation, key")


@query("""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, CASE WHEN n_chars > 500 THEN '"long", ' || source END AS note FROM documents""")
def gzip_round_trip(spark, d) -> DataFrame:
    """A2, B1: a compressed CSV with quotes, separators and blanks in its cells, there and back."""
    docs = table(spark, d, "documents").select("doc_id", "lang", F.when(F.col("n_chars") > 500, F.concat(
        F.lit('"long", '), "source")).alias("note"))
    path = _folder(spark)
    sinks.write_table(docs, path, "csv", compression="gzip")
    return readers.read_text_table(spark, path, partitions=4)


@query("""
SELECT CAST(n_nationkey AS VARCHAR) AS "clé", n_name || ' – “é€ß”' AS "Name ä" FROM nation""")
def cp1252_round_trip(spark, d) -> DataFrame:
    """A3, B1: a CSV in cp1252, names and cells outside ASCII, there and back."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("clé"),
                                         F.concat("n_name", F.lit(" – “é€ß”")).alias("Name ä"))
    path = _folder(spark)
    sinks.write_table(n, path, "csv", encoding="windows-1252")
    return readers.read_text_table(spark, path, encoding="windows-1252")


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS "ORDER KEY", l_returnflag AS flag, CAST(l_linenumber AS VARCHAR) AS line FROM lineitem""")
def preamble_csv(spark, d) -> DataFrame:
    """A4: files with notes before their header, two layouts, every line item; read in splits."""
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("k"), "l_returnflag", F.col("l_linenumber").cast("string").alias("n"))
    path = _folder(spark)
    top = "Notes, with a comma\n\nKEY words explained below\n"
    for flag, cols, head in ((True, ("k", "l_returnflag", "n"), "'ORDER KEY',flag,line"), (False, ("n", "k", "l_returnflag"), "line,'ORDER KEY',flag")):
        data = li.where((F.col("n").cast("int") <= 2) == flag).select(F.concat_ws(",", *cols).alias("value"))
        # a task writes a file, whose first line (number 0 of the task) has the head before it; one file is a head alone
        first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
        files = data.select(F.when(first, F.concat(F.lit(top + head + "\n"), "value")).otherwise(F.col("value")).alias("value"))
        spark.range(0, 1, 1, 1).select(F.lit(top + head).alias("value")).union(files).write.text(f"{path}/{int(flag)}")
    return readers.read_csv_with_preamble(spark, [f"{path}/0", f"{path}/1"], "ORDER KEY").select("ORDER KEY", "flag", "line")


@query("""
SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS name, CASE WHEN n_regionkey % 2 = 0 THEN CAST(n_regionkey AS VARCHAR) END AS region
FROM nation""")
def array_rows(spark, d) -> DataFrame:
    """Array-of-arrays files, each with its own header row, helper columns dropped."""
    n = table(spark, d, "nation")
    key, name, region = F.col("n_nationkey").cast("string"), F.col("n_name"), F.col("n_regionkey").cast("string")
    even = n.groupBy("n_regionkey").agg(F.collect_list(F.array(key, name, region)).alias("rows"))
    odd = n.groupBy("n_regionkey").agg(F.collect_list(F.array(name, key)).alias("rows"))
    path = _folder(spark)
    for part, head, rest in ((even, ["key", "name", "region"], 0), (odd, ["name", "key"], 1)):
        page = part.where(F.col("n_regionkey") % 2 == rest).select("n_regionkey", F.to_json(F.concat(
            F.array(F.array(*[F.lit(h) for h in head])), "rows")).alias("value"))
        page.write.mode("append").partitionBy("n_regionkey").text(path)  # a page a file
    return C.drop_helpers(readers.read_array_rows(spark, path)).select("key", "name", "region")


# ------------------------------------------------------------- resumable load

@query("""
SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS name, CASE WHEN n_regionkey < 2 THEN 1 ELSE 2 END AS batch,
       CASE WHEN n_regionkey < 2 THEN 2 ELSE 3 END AS pages_added, 0 AS pages_added_again FROM nation""")
def resumed_load(spark, d) -> DataFrame:
    """Pages land in two rounds, the load runs after each, a further run adds nothing."""
    n = table(spark, d, "nation").groupBy("n_regionkey").agg(
        F.count(F.lit(1)).alias("count"), F.collect_list(F.struct(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("name"))).alias("results"))
    path = _folder(spark)
    record = T.StructType([T.StructField("key", T.StringType()), T.StructField("name", T.StringType())])

    def land(round_no, cond):
        (n.where(cond).select(F.concat(F.lit(f"{round_no}-"), "n_regionkey").alias("page"), F.to_json(F.struct("count", "results")).alias("value"))
         .write.mode("append").partitionBy("page").text(f"{path}/landing"))

    def load():
        return ingest_pages_stream(spark, f"{path}/landing", f"{path}/target", f"{path}/checkpoint", record)["pages"]
    added = []
    for round_no, cond in ((1, F.col("n_regionkey") < 2), (2, F.col("n_regionkey") >= 2)):
        land(round_no, cond)
        added.append(load())
    again = load()
    batch = F.regexp_extract("_source_file", r"page=(\d+)-", 1).cast("int")
    return spark.read.parquet(f"{path}/target").select("key", "name", batch.alias("batch"), F.when(batch == 1, added[0]).otherwise(added[1]).alias(
        "pages_added"), F.lit(again).alias("pages_added_again"))


# --------------------------------------------------------- replacement

@query("""
SELECT o_orderkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, CAST(3 AS BIGINT) AS version FROM orders WHERE o_orderstatus <> 'P'""")
def replaced_dataset(spark, d) -> DataFrame:
    """A dataset replaced by rows computed from itself, twice; a replacement that fails on the way and
    one that is refused between them leave the rows as they were."""
    path = _folder(spark)
    versions.publish(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    versions.publish(versions.current(spark, path).where("o_orderstatus <> 'P'"), path)
    for bad in (versions.current(spark, path).withColumn("o_totalprice", F.when(F.col("o_orderkey") % 1000 == 7, F.raise_error(
            F.lit("broken row")).cast("double")).otherwise(F.col("o_totalprice"))), versions.current(spark, path).where("false")):
        try:
            versions.publish(bad, path)
        except Exception:  # noqa: BLE001  the old rows are what counts
            continue
        raise AssertionError("a broken replacement was published")
    versions.publish(versions.current(spark, path).withColumn("o_totalprice", F.col("o_totalprice") * 2), path)
    last = versions.versions(spark, path).agg(F.max("seq")).first()[0]
    return versions.current(spark, path).withColumn("version", F.lit(last).cast("long"))


@query("""
SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_suppkey % 2 = 0""")
def bulk_load(spark, d) -> DataFrame:
    """A10: a CSV with an explicit schema loaded over the rows of an earlier load."""
    s, path = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal"), _folder(spark)
    schema = "s_suppkey long, s_name string, s_acctbal double"
    for i, rows in enumerate((s, s.where("s_suppkey % 2 = 0"))):
        sinks.write_table(rows, f"{path}/{i}", "csv")
        out = readers.load_table(spark, f"{path}/{i}", schema, f"{path}/target")
    return out


# --------------------------------------------------------------- public output

@query("""
SELECT o_custkey AS facility, COUNT(*) AS owners, CAST(COUNT(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS closed,
       'status ' || min(o_orderstatus) AS note FROM orders GROUP BY o_custkey""")
def public_owners(spark, d) -> DataFrame:
    """Owner rows written once, the public aggregate made from them; a public output in whose texts
    a person's name occurs is refused first."""
    owners = table(spark, d, "orders").select(
        F.col("o_custkey").alias("facility"), "o_orderstatus", F.concat(F.lit("Person "), F.hex("o_orderkey"), F.lit(" Smith-"), F.col("o_orderkey").cast(
            "string")).alias("person"), F.lpad(F.col("o_orderkey").cast("string"), 10, "7").alias("person_id"))
    path, held = _folder(spark), ["person", "person_id"]

    def public(df, leak=False):
        note = F.concat(F.lit("status "), F.min("o_orderstatus"))
        if leak:  # one facility's note names an owner, in other case and punctuation
            note = F.when(F.col("facility") == 10, F.concat(F.lit("see: "), F.upper(F.min("person")), F.lit("!"))).otherwise(note)
        return df.groupBy("facility").agg(F.count(F.lit(1)).alias("owners"), F.count_if(F.col("o_orderstatus") == "F").alias("closed"), note.alias("note"))
    try:
        sinks.write_split(owners, f"{path}/restricted", lambda df: public(df, True), f"{path}/public", held)
        raise AssertionError("a planted leak was published")
    except sinks.LeakRefused:
        pass
    sinks.write_split(owners, f"{path}/restricted", public, f"{path}/public", held)
    return spark.read.parquet(f"{path}/public")


# ------------------------------------------------------------------ pages

@query("""
WITH p AS (SELECT o_orderpriority AS dataset, o_orderkey * 3 AS lo, o_orderkey * 3 + 9 + o_custkey % 12 AS hi FROM orders),
b AS (SELECT *, greatest(0, coalesce(max(hi) OVER (PARTITION BY dataset ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS held FROM p)
SELECT dataset, least(lo, held) AS gap_start, CASE WHEN lo > held THEN lo ELSE least(hi, held) END AS gap_end,
       CASE WHEN lo > held THEN 'missing' ELSE 'overlap' END AS kind FROM b WHERE lo <> held
UNION ALL SELECT dataset, max(hi), 50000, 'missing' FROM p GROUP BY dataset HAVING max(hi) < 50000""")
def page_gaps(spark, d) -> DataFrame:
    """Pages of any offset and length per dataset: rows that no page holds, rows held twice."""
    o = table(spark, d, "orders")
    return Q.page_gaps(o.select(F.col("o_orderpriority").alias("dataset"), (F.col("o_orderkey") * 3).alias("offset"),
                                (F.col("o_custkey") % 12 + 9).alias("n_rows"), F.lit(50000).alias("declared")))


# ---------------------------------------------------- runs of the harness

def _runs(spark, d, path):
    p = table(spark, d, "part")
    by_day = {
        "2026-01-05": p.select("p_partkey", "p_name", "p_size", "p_retailprice"),
        "2026-02-09": p.where("p_size > 3").select("p_partkey", F.when(F.col("p_partkey") % 50 == 0, F.col("p_name")).alias("p_name"), "p_size", "p_brand"),
        "2026-03-01": p.where("p_size > 4").select("p_partkey", F.when(F.col("p_partkey") % 50 == 0, F.col("p_name")).alias("p_name"), F.lit(7).alias("p_size"), "p_brand"),
    }
    for day, df in by_day.items():
        sinks.write_snapshot(Q.profile(df, "part"), path, day)


_DRIFT_SQL = """
WITH n AS (SELECT COUNT(*) AS n0, COUNT(*) FILTER (p_size > 3) AS n1, COUNT(*) FILTER (p_size > 4) AS n2,
                  COUNT(*) FILTER (p_size > 3 AND p_partkey % 50 = 0) AS m1 FROM part),
r AS (
  SELECT '2026-02-09' AS run_date, '2026-01-05' AS prev_run, '*' AS field, 'row_count_moved' AS signal, CAST(n0 AS VARCHAR) AS prev_value,
         CAST(n1 AS VARCHAR) AS curr_value FROM n WHERE abs(n1 - n0) > 0.05 * n0
  UNION ALL SELECT '2026-03-01', '2026-02-09', '*', 'row_count_moved', CAST(n1 AS VARCHAR), CAST(n2 AS VARCHAR) FROM n WHERE abs(n2 - n1) > 0.05 * n1
  UNION ALL SELECT '2026-02-09', '2026-01-05', 'p_brand', 'field_new', NULL, NULL
  UNION ALL SELECT '2026-02-09', '2026-01-05', 'p_retailprice', 'field_dropped', NULL, NULL
  UNION ALL SELECT '2026-02-09', '2026-01-05', 'p_name', 'null_rate_crossed', '0.0', CAST(round((n1 - m1) / n1, 6) AS VARCHAR) FROM n
  UNION ALL SELECT '2026-03-01', '2026-02-09', 'p_size', 'constant_flipped', 'false', 'true')
SELECT 'part' AS dataset, * FROM r"""


@query(_DRIFT_SQL)
def drift_of_runs(spark, d) -> DataFrame:
    """Three stored runs, each compared with the one before it."""
    path = _folder(spark)
    _runs(spark, d, path)
    return Q.drift_history(spark.read.parquet(path))


@query(_DRIFT_SQL.replace("SELECT 'part' AS dataset, * FROM r", "SELECT 'part' AS dataset, field, signal, prev_value, curr_value FROM r WHERE run_date = '2026-03-01'"))
def drift_as_of(spark, d) -> DataFrame:
    """The last run before a date, chosen from the partitions, and the run before that one."""
    path = _folder(spark)
    _runs(spark, d, path)
    store = spark.read.parquet(path)
    now = sinks.last_run_before(store, "2026-07-01")
    return Q.drift(sinks.read_run(spark, path, sinks.last_run_before(store, now)), sinks.read_run(spark, path, now))


@query("""
SELECT 'part' AS dataset, 'constant_value' AS "check", 'p_flag' AS field, 'constant value Y' AS message, '2026-07-01' AS run_date
UNION ALL SELECT 'part', 'constant_value', 'p_note', 'constant value x', '2026-07-01'
UNION ALL SELECT 'part', 'null_rate', 'p_note', printf('null rate %.3f', (SELECT AVG(CASE WHEN p_partkey % 40 = 0 THEN 0.0 ELSE 1.0 END) FROM part)), '2026-07-01'""")
def findings_json(spark, d) -> DataFrame:
    """Findings of a profile written as JSON under their run date and read back."""
    p = table(spark, d, "part").select("p_partkey", F.lit("Y").alias("p_flag"), F.when(F.col("p_partkey") % 40 == 0, "x").alias("p_note"))
    path = _folder(spark)
    sinks.write_findings(Q.findings_from_profile(Q.profile(p, "part")), path, "2026-07-01")
    return spark.read.json(path).select("dataset", "check", "field", "message", F.col("run_date").cast("string").alias("run_date"))


# ------------------------------------------------------------------ figures

FIGURES = [
    ("orders", "orders", "count", "true", None, 15000, 0), ("finished_orders", "orders", "pct", "o_orderstatus = 'F'", None, 33.3, 1),
    ("urgent_of_open", "orders", "pct", "o_orderpriority = '1-URGENT'", "o_orderstatus = 'O'", 20.0, 0),
    ("order_value_millions", "orders", "value", "sum(cast(o_totalprice as decimal(18,2))) / 1000000", None, 1000, 0),
    ("customers_ordering", "orders", "value", "count(distinct o_custkey)", None, 1500, 0),
    ("returned_lines", "lineitem", "pct", "l_returnflag = 'R'", None, 33.0, 0), ("full_lines", "lineitem", "count", "l_quantity = 50", None, 1200, -2),
    ("discounted_of_returned", "lineitem", "pct", "l_discount > 0.05", "l_returnflag = 'R'", 45.0, 0),
    ("first_ship_year", "lineitem", "value", "min(year(l_shipdate))", None, 1995, 0), ("no_such_flag", "lineitem", "pct", "l_returnflag = 'Q'", "l_returnflag = 'Z'", 1.0, 0),
    ("english", "documents", "pct", "lang = 'en'", None, 60.6, 1), ("long_english", "documents", "count", "n_chars >= 2000", "lang = 'en'", 100, -2),
]


def _figures_sql() -> str:
    out = []
    for name, t, kind, num, den, stated, digits in FIGURES:
        den = den or "true"
        n = f"CAST({num} AS DOUBLE)" if kind == "value" else f"CAST(COUNT(*) FILTER (({num}) AND ({den})) AS DOUBLE)"
        dd = f"CAST(COUNT(*) FILTER ({den}) AS DOUBLE)" if kind == "pct" else "CAST(NULL AS DOUBLE)"
        v = "n / NULLIF(d, 0) * 100.0" if kind == "pct" else "n"
        out.append(f"""SELECT '{name}' AS figure, '{t}' AS dataset, '{kind}' AS kind, n AS numerator, d AS denominator, round({v}, 4) AS computed,
            CAST({stated} AS DOUBLE) AS stated, COALESCE(abs({v} - {stated}) <= 0.5 * power(10.0, {-digits}), false) AS ok FROM (SELECT {n} AS n, {dd} AS d FROM {t})""")
    return " UNION ALL ".join(out)


@query(_figures_sql())
def figures_registry(spark, d) -> DataFrame:
    """Twelve stated figures as data over three tables, one aggregate a table."""
    names = ("figure", "dataset", "kind", "numerator", "denominator", "stated", "digits")
    return Q.compute_figures({t: table(spark, d, t) for t in ("orders", "lineitem", "documents")}, [dict(zip(names, f, strict=True)) for f in FIGURES])


# ------------------------------------------------------------------ margins

@query("""
WITH c AS (SELECT c_nationkey % 7 AS state, CASE WHEN c_custkey % 13 <> 0 THEN round(c_acctbal / 100 - 30, 2) END AS m FROM customer)
SELECT CAST(state AS VARCHAR) AS state, COUNT(m) AS n, quantile_cont(m, 0.5) AS median, COUNT(*) FILTER (m < -5) AS n_below FROM c GROUP BY state
UNION ALL SELECT 'NATION', COUNT(m), quantile_cont(m, 0.5), COUNT(*) FILTER (m < -5) FROM c""")
def margin_medians(spark, d) -> DataFrame:
    """median operating margin and facilities below -5 %, by state and for the nation."""
    c = table(spark, d, "customer").select((F.col("c_nationkey") % 7).cast("string").alias("state"), F.when(
        F.col("c_custkey") % 13 != 0, F.round(F.col("c_acctbal") / 100 - 30, 2)).alias("operating_margin_pct"))
    scored = c.where("operating_margin_pct is not null")
    cols = ["state", "n", "median", "n_below"]
    return measures.margin_summary(scored, "state").select(*cols).unionByName(
        measures.margin_summary(scored).withColumn("state", F.lit("NATION")).select(*cols))


# ------------------------------------------------------------------ references (P20)

@query("""
WITH t AS (SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'F' ELSE 'K' END AS tag_prefix, CAST(l_partkey % 900 AS VARCHAR) AS tag_number,
                  'Text ' || CAST(l_orderkey AS VARCHAR) AS description, 'Cat ' || CAST(l_partkey % 6 AS VARCHAR) AS category, l_returnflag,
                  l_orderkey * 100000 + l_linenumber * 10000 + l_suppkey AS pos FROM lineitem)
SELECT tag_prefix, tag_number, arg_max(description, (l_returnflag, pos)) AS description, arg_max(category, (l_returnflag, pos)) AS category,
       tag_prefix || '-' || tag_number AS prefix_tag
FROM t GROUP BY tag_prefix, tag_number""")
def tag_reference(spark, d) -> DataFrame:
    """P20: deficiency tags from landed pages; the last record of a tag by file and position wins."""
    li = table(spark, d, "lineitem")
    pages = li.select(
        F.when(F.col("l_linenumber") % 2 == 0, " f").otherwise("k ").alias("deficiency_prefix"), (F.col("l_partkey") % 900).cast("string").alias("deficiency_tag_number"),
        F.concat(F.lit("Text "), F.col("l_orderkey").cast("string")).alias("deficiency_description"),
        F.concat(F.lit("Cat "), (F.col("l_partkey") % 6).cast("string")).alias("deficiency_category"), F.col("l_returnflag").alias("_source_file"),
        (F.col("l_orderkey") * 100000 + F.col("l_linenumber") * 10000 + F.col("l_suppkey")).alias("_pos"))
    return references.ftag_reference(pages)


@query("""
SELECT 'M' || CAST(o_orderkey AS VARCHAR) AS measure_code, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) END AS collection_from_date,
       CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) + 90 END AS collection_through_date, CAST(o_orderdate AS DATE) + 120 AS processing_dt FROM orders""")
def interval_reference(spark, d) -> DataFrame:
    """P20: collection intervals of measures, from text in two date formats; what is no date is null."""
    o = table(spark, d, "orders")
    day = F.col("o_orderdate").cast("date")
    raw = o.select(
        F.concat(F.lit("M"), F.col("o_orderkey").cast("string")).alias("measure_code"),
        F.when(F.col("o_orderkey") % 10 == 0, "Not Available").otherwise(F.date_format(day, "MM/dd/yyyy")).alias("data_collection_period_from_date"),
        F.when(F.col("o_orderkey") % 9 == 0, "13/45/2020").otherwise(F.date_format(F.date_add(day, 90), "MM/dd/yyyy")).alias("data_collection_period_through_date"),
        F.date_format(F.date_add(day, 120), "yyyyMMdd").alias("processing_date"))
    return references.measure_intervals(raw).select("measure_code", "collection_from_date", "collection_through_date", "processing_dt")


def _rbcs(spark, d):
    p = table(spark, d, "part")
    return p.select(F.concat(F.lit(" "), (F.col("p_partkey") + 99000).cast("string")).alias("HCPCS_Cd"), F.col("p_type").alias("RBCS_Cat_Desc"),
                    F.col("p_partkey").alias("_pos"))


@query("""
SELECT CAST(v AS VARCHAR) AS value, v - 99000 IN (SELECT p_partkey FROM part) AS present FROM (VALUES (99307), (99308), (99309), (99310)) t(v)""")
def billing_code_members(spark, d) -> DataFrame:
    """P20, I4: required visit codes in the billing-code classification."""
    return references.rbcs_reference(_rbcs(spark, d))[1]


@query("""SELECT p_type AS "RBCS_Cat_Desc", COUNT(*) AS n FROM part GROUP BY p_type""")
def billing_code_categories(spark, d) -> DataFrame:
    """Billing codes per category."""
    return references.rbcs_reference(_rbcs(spark, d))[2]


@query("""
SELECT v AS value, present FROM (VALUES ('314000000X', true), ('207QG0300X', false), ('207RG0300X', true)) t(v, present) WHERE (SELECT COUNT(*) FROM part) > 0""")
def taxonomy_members(spark, d) -> DataFrame:
    """P20, I4: required codes in the provider taxonomy crosswalk."""
    p = table(spark, d, "part")
    code = F.when(F.col("p_size") % 2 == 0, " 314000000X").when(F.col("p_size") % 3 == 0, "207RG0300X ").otherwise(F.concat("p_brand", F.lit("X")))
    return references.taxonomy_reference(p.select("p_name", code.alias("PROVIDER TAXONOMY CODE")))[1]
