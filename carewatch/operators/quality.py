"""Data-quality and conformance checks.

Every check returns a DataFrame of result rows (never a Python bool computed from a
collect), so a conformance run is itself a Spark job and its findings can be written,
joined with suppressions and compared across runs. Column profiles scan a table once:
one wide aggregate produces null, constancy, type and distinct numbers together, then a
single `explode` turns it into long rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.expr import clean, num
from .ordering import AT, PART, in_order


def numeric_name(col: str, hints: Sequence[str] = K.NUMERIC_NAME_HINTS,
                 suffixes: Sequence[str] = K.NUMERIC_NAME_SUFFIXES) -> bool:
    """Does the column name say the column should be numeric?"""
    low = col.lower()
    return any(h.lower() in low for h in hints) or any(low.endswith(x) for x in suffixes)


def _rows(df: DataFrame, structs: list[Column], alias: str = "_r") -> DataFrame:
    """explode(array(struct...)) over a one-row aggregate -> long rows."""
    return df.select(F.explode(F.array(*structs)).alias(alias)).select(f"{alias}.*")


def _blank(col: str, words: Sequence[str]) -> Column:
    # NaN in a double column casts to the text 'NaN', which is one of the null words
    c = F.col(f"`{col}`")
    return c.isNull() | clean(c).isin(list(words))


# ------------------------------------------------------------------------- J1
def check_counts(df: DataFrame, rules: Sequence[tuple]) -> DataFrame:
    """Row counts (overall or of a sub-population) within registered ranges.
    rules = [(name, cond or None, lo, hi)]; rows (check, value, lo, hi, ok)."""
    aggs = [(F.count_if(c) if c is not None else F.count(F.lit(1))).alias(f"_c{i}")
            for i, (_, c, _, _) in enumerate(rules)]
    one = df.agg(*aggs)
    st = [F.struct(F.lit(n).alias("check"), F.col(f"_c{i}").alias("value"),
                   F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi"),
                   F.col(f"_c{i}").between(F.lit(lo), F.lit(hi)).alias("ok"))
          for i, (n, _, lo, hi) in enumerate(rules)]
    return _rows(one, st)


# ------------------------------------------------------------- J2 / J3 / J4 / J9
def profile(df: DataFrame, dataset: str, cols: Sequence[str] | None = None,
            words: Sequence[str] = K.SENTINELS_HARNESS, distinct: str | None = None,
            numeric_hints: Sequence[str] | None = None, materialize: str = "none") -> DataFrame:
    """One-pass column profile (J9, and the numbers behind J2-J4).

    Rows: (dataset, field, row_count, null_count, null_rate, nunique, min_value,
    max_value, is_constant, parse_rate). Blank words count as NULL (one definition, T32).
    `nunique` is NULL unless asked for: `distinct="exact"` counts in two phases, (field, value)
    then field, so no column's values meet in one task; "approx" is HyperLogLog. Constancy
    never depends on it: a column is constant when its non-blank min equals its max. `parse_rate` (share of
    non-blank values that are strict numbers) is computed for columns named by
    `numeric_hints`. Pass `materialize="checkpoint"` when the profile feeds several
    checks, so the dataset is scanned once rather than once per check."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        blank = _blank(c, words)
        s = F.when(~blank, clean(F.col(f"`{c}`")))
        aggs += [F.count_if(blank).alias(f"_n{i}"),
                 (F.approx_count_distinct(s) if distinct == "approx" else F.max(F.lit(None))).alias(f"_d{i}"),
                 F.min(s).alias(f"_lo{i}"), F.max(s).alias(f"_hi{i}")]
        if numeric_hints is not None and numeric_name(c, numeric_hints):
            aggs.append(F.count_if(num(F.col(f"`{c}`"), sentinels=list(words)).isNotNull()).alias(f"_p{i}"))
    one = df.agg(*aggs)
    st = []
    for i, c in enumerate(cols):
        nonblank = F.col("_rows") - F.col(f"_n{i}")
        parse = (F.col(f"_p{i}") / F.nullif(nonblank, F.lit(0))) if f"_p{i}" in one.columns else F.lit(None)
        st.append(F.struct(
            F.lit(dataset).alias("dataset"), F.lit(c).alias("field"),
            F.col("_rows").alias("row_count"), F.col(f"_n{i}").alias("null_count"),
            F.round(F.col(f"_n{i}") / F.nullif(F.col("_rows"), F.lit(0)), 6).alias("null_rate"),
            F.col(f"_d{i}").cast("long").alias("nunique"),
            F.col(f"_lo{i}").alias("min_value"), F.col(f"_hi{i}").alias("max_value"),
            F.coalesce(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.lit(False)).alias("is_constant"),
            F.round(parse.cast("double"), 6).alias("parse_rate")))
    out = _rows(one, st)
    if distinct == "exact":
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("f"), F.when(~_blank(c, words), clean(F.col(f"`{c}`")))
                                             .alias("v")) for c in cols])).alias("_p")
        per = (df.select(pairs).where("_p.v is not null").groupBy("_p.f", "_p.v").agg(F.lit(1).alias("one"))
               .groupBy(F.col("f").alias("field")).agg(F.count("*").alias("_u")))
        out = out.join(per, "field", "left").withColumn("nunique", F.coalesce("_u", F.lit(0)).cast("long")) \
                 .select(*out.columns)
    from .ranking import materialize as kept
    return kept(out, materialize)


def null_rates(df: DataFrame, dataset: str = "table", threshold: float = K.NULL_RATE_THRESHOLD,
               words: Sequence[str] = K.SENTINELS_HARNESS, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns whose null rate (blank words included) is at least `threshold`.
    Rows (dataset, field, null_rate, flagged) for every column."""
    p = profile(df, dataset, cols, words)
    return p.select("dataset", "field", "null_rate", (F.col("null_rate") >= threshold).alias("flagged"))


def constant_columns(df: DataFrame, dataset: str = "table", min_rows: int = K.CONSTANT_MIN_ROWS,
                     cols: Sequence[str] | None = None, words: Sequence[str] = K.SENTINELS_HARNESS) -> DataFrame:
    """Columns with one distinct non-blank value over at least `min_rows` rows."""
    p = profile(df, dataset, cols, words)
    return p.select("dataset", "field", "row_count", "min_value",
                    (F.col("is_constant") & (F.col("row_count") >= min_rows)).alias("flagged"))


def type_anomalies(df: DataFrame, dataset: str = "table", hints: Sequence[str] = K.NUMERIC_NAME_HINTS,
                   floor: float = K.NUMERIC_PARSE_FLOOR, words: Sequence[str] = K.SENTINELS_HARNESS,
                   null_at: float = K.NULL_RATE_THRESHOLD) -> DataFrame:
    """Columns that should be numeric by name but whose non-blank values parse below
    `floor` (J4); nearly-empty columns (null rate >= `null_at`) are left to the null check."""
    cols = [c for c in df.columns if numeric_name(c, hints)]
    if not cols:
        return df.sparkSession.createDataFrame([], "dataset string, field string, parse_rate double, flagged boolean")
    p = profile(df, dataset, cols, words, numeric_hints=hints)
    return p.select("dataset", "field", "parse_rate",
                    F.coalesce((F.col("parse_rate") < floor) & (F.col("null_rate") < null_at), F.lit(False))
                    .alias("flagged"))


# ----------------------------------------------------------------- J5 / J6 / J17
def check_nonempty(df: DataFrame, name: str = "nonempty") -> DataFrame:
    """Empty-output check (J5): reads at most one row."""
    return df.limit(1).agg(F.count(F.lit(1)).alias("_n")).select(
        F.lit(name).alias("check"), (F.col("_n") > 0).alias("ok"))


def field_set_diff(expected: Sequence[str], df: DataFrame, computed: Sequence[str] = ()) -> DataFrame:
    """Live-vs-output field sets minus computed fields (J6). Rows (field, status)."""
    from .contracts import schema_diff
    return schema_diff(df, [c for c in expected if c not in computed], computed)


def check_singleton(df: DataFrame, cond: Column, name: str = "singleton") -> DataFrame:
    """Exactly one row matches."""
    return df.agg(F.count_if(cond).alias("value")).select(
        F.lit(name).alias("check"), "value", (F.col("value") == 1).alias("ok"))


# ------------------------------------------------------------------ findings
FINDING_SCHEMA = "dataset string, check string, field string, metric double, message string"


def findings_from_profile(p: DataFrame, null_at: float = K.NULL_RATE_THRESHOLD,
                          min_rows: int = K.CONSTANT_MIN_ROWS, floor: float = K.NUMERIC_PARSE_FLOOR) -> DataFrame:
    """Turn profile rows into findings (dataset, check, field, metric, message) in one pass
    over the profile: every row proposes its candidate findings, the hits are kept (J5: an
    empty output is one finding of its dataset)."""
    cand = F.array(
        F.struct(F.lit("null_rate").alias("check"), (F.col("null_rate") >= null_at).alias("hit"),
                 F.col("null_rate").alias("metric"),
                 F.format_string("null rate %.3f", F.col("null_rate")).alias("message")),
        F.struct(F.lit("constant_value").alias("check"),
                 (F.col("is_constant") & (F.col("row_count") >= min_rows)).alias("hit"),
                 F.lit(None).cast("double").alias("metric"),
                 F.concat(F.lit("constant value "), F.col("min_value")).alias("message")),
        F.struct(F.lit("type_anomaly").alias("check"),
                 ((F.col("parse_rate") < floor) & (F.col("null_rate") < null_at)).alias("hit"),
                 F.col("parse_rate").alias("metric"),
                 F.format_string("numeric parse rate %.3f", F.col("parse_rate")).alias("message")),
        # every field of an empty output says so; one finding is kept
        F.struct(F.lit("empty_output").alias("check"), (F.col("row_count") == 0).alias("hit"),
                 F.lit(None).cast("double").alias("metric"), F.lit("no rows").alias("message")))
    return (p.select("dataset", "field", F.explode(cand).alias("_f"))
            .where(F.coalesce(F.col("_f.hit"), F.lit(False)))
            .select("dataset", F.col("_f.check").alias("check"),
                    F.when(F.col("_f.check") == "empty_output", "*").otherwise(F.col("field")).alias("field"),
                    F.col("_f.metric").alias("metric"), F.col("_f.message").alias("message"))
            .dropDuplicates(["dataset", "check", "field"]))


#: An empty output blocks whatever it feeds; a suppression of an absent field only informs.
BLOCKING_CHECKS = ("empty_output",)
INFO_CHECKS = ("ghost_suppression",)


def apply_suppressions(findings: DataFrame, known: DataFrame) -> DataFrame:
    """Drop findings registered as known anomalies (J7). `known`: (dataset, field, check)."""
    return findings.join(known.select("dataset", "field", "check").distinct(), ["dataset", "field", "check"],
                         "left_anti")


def suppressed_findings(findings: DataFrame, known: DataFrame) -> DataFrame:
    return findings.join(known.select("dataset", "field", "check").distinct(), ["dataset", "field", "check"],
                         "left_semi")


def ghost_suppressions(known: DataFrame, fields: DataFrame) -> DataFrame:
    """Registered suppressions whose field is no longer in the dataset's output.
    `fields`: (dataset, field) of the datasets that were checked; a suppression of a dataset
    that was not checked, or without a field, is no ghost."""
    have = fields.select("dataset", "field").distinct()
    return (known.where(F.coalesce(F.col("field") != "", F.lit(False)))
            .join(have.select("dataset").distinct(), "dataset", "left_semi")
            .join(have, ["dataset", "field"], "left_anti"))


def classify(findings: DataFrame, finding_fields: DataFrame) -> DataFrame:
    """Severity tier (J8): BLOCKING when the exact (dataset, field) feeds a published
    finding (exact names, never substring matching, T34) or when an output is empty (J5),
    INFO for suppressions of absent fields, else LATENT."""
    ff = finding_fields.select("dataset", "field").distinct().withColumn("_pub", F.lit(True))
    return (findings.join(ff, ["dataset", "field"], "left")
            .withColumn("severity", F.when(F.col("_pub") | F.col("check").isin(*BLOCKING_CHECKS), "BLOCKING")
                        .when(F.col("check").isin(*INFO_CHECKS), "INFO").otherwise("LATENT")).drop("_pub"))


def dataset_status(classified: DataFrame, datasets: DataFrame | None = None) -> DataFrame:
    """Worst severity per dataset (J8); datasets without findings are OK."""
    rank = F.when(F.col("severity") == "BLOCKING", 2).when(F.col("severity") == "LATENT", 1).otherwise(0)
    s = classified.groupBy("dataset").agg(F.max(rank).alias("_r"))
    if datasets is not None:
        s = datasets.select("dataset").distinct().join(s, "dataset", "left")
    return s.select("dataset", F.when(F.col("_r") == 2, "BLOCKING").when(F.col("_r") == 1, "LATENT")
                    .otherwise("OK").alias("status"))


def findings_summary(classified: DataFrame, suppressed: DataFrame | None = None) -> DataFrame:
    """Totals per severity plus the suppressed count (J12). Rows (severity, n)."""
    s = classified.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
    if suppressed is not None:
        s = s.unionByName(suppressed.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("SUPPRESSED").alias("severity"), "n"))
    return s


# ------------------------------------------------------------------ J10 / J11
def drift(prev: DataFrame, curr: DataFrame, row_pct: float = K.DRIFT_ROW_PCT,
          null_at: float = K.DRIFT_NULL_AT) -> DataFrame:
    """Drift between two profiles (J10): row count moved more than `row_pct`, field new
    or dropped, null rate crossed `null_at` upwards, constancy flipped. Rows (dataset,
    field, signal, prev_value, curr_value). The same snapshot twice yields no rows."""
    p = prev.select("dataset", "field", F.col("row_count").alias("p_rows"),
                    F.col("null_rate").alias("p_null"), F.col("is_constant").alias("p_const"))
    c = curr.select("dataset", "field", F.col("row_count").alias("c_rows"),
                    F.col("null_rate").alias("c_null"), F.col("is_constant").alias("c_const"))
    j = p.join(c, ["dataset", "field"], "full")
    fields = j.select("dataset", "field", F.explode(F.array(
        F.struct(F.lit("field_new").alias("signal"), (F.col("p_null").isNull() & F.col("c_null").isNotNull()
                 & F.col("p_rows").isNull()).alias("hit"), F.lit(None).cast("string").alias("prev_value"),
                 F.lit(None).cast("string").alias("curr_value")),
        F.struct(F.lit("field_dropped").alias("signal"), (F.col("c_rows").isNull()).alias("hit"),
                 F.lit(None).cast("string").alias("prev_value"), F.lit(None).cast("string").alias("curr_value")),
        F.struct(F.lit("null_rate_crossed").alias("signal"),
                 F.coalesce((F.col("p_null") < null_at) & (F.col("c_null") >= null_at), F.lit(False)).alias("hit"),
                 F.col("p_null").cast("string").alias("prev_value"), F.col("c_null").cast("string").alias("curr_value")),
        F.struct(F.lit("constant_flipped").alias("signal"),
                 F.coalesce(F.col("p_const") != F.col("c_const"), F.lit(False)).alias("hit"),
                 F.col("p_const").cast("string").alias("prev_value"), F.col("c_const").cast("string").alias("curr_value")),
    )).alias("_s")).where(F.col("_s.hit")).select("dataset", "field", "_s.signal", "_s.prev_value", "_s.curr_value")
    pr = prev.groupBy("dataset").agg(F.max("row_count").alias("p_rows"))
    cr = curr.groupBy("dataset").agg(F.max("row_count").alias("c_rows"))
    rows = (pr.join(cr, "dataset", "inner")
            .where(F.abs(F.col("c_rows") - F.col("p_rows")) > F.lit(row_pct) * F.col("p_rows"))
            .select("dataset", F.lit("*").alias("field"), F.lit("row_count_moved").alias("signal"),
                    F.col("p_rows").cast("string").alias("prev_value"),
                    F.col("c_rows").cast("string").alias("curr_value")))
    return rows.unionByName(fields)


def drift_history(runs: DataFrame, **limits) -> DataFrame:
    """Drift of every run against the one before it (J10, P22): `runs` are profiles with `run_date`.
    Rows (dataset, run_date, prev_run, field, signal, prev_value, curr_value).

    The run before is chosen per dataset from the few (dataset, run) pairs, and each profile then
    serves twice, as a run and as its successor's predecessor, in one comparison of all runs."""
    pairs = runs.select("dataset", F.col("run_date").cast("string").alias("run_date")).distinct()
    before = F.lag("run_date").over(Window.partitionBy("dataset").orderBy("run_date"))
    pairs = pairs.withColumn("prev_run", before).where("prev_run is not null")
    of = F.to_json(F.struct("dataset", "run_date", "prev_run"))  # one name for drift() to compare by
    named = runs.withColumn("run_date", F.col("run_date").cast("string"))
    curr = named.join(pairs, ["dataset", "run_date"]).withColumn("dataset", of)
    prev = (named.withColumnRenamed("run_date", "prev_run").join(pairs, ["dataset", "prev_run"])
            .withColumn("dataset", of))
    found = drift(prev, curr, **limits)
    parts = F.from_json("dataset", "dataset string, run_date string, prev_run string")
    return found.withColumn("_d", parts).select("_d.*", "field", "signal", "prev_value", "curr_value")


def cross_source(counts: DataFrame, pairs: DataFrame, tolerance: float = K.CROSS_SOURCE_TOLERANCE) -> DataFrame:
    """Paired datasets must agree in row count within `tolerance` of the left one.
    counts: (dataset, rows); pairs: (left, right). Rows (left, right, left_rows, right_rows,
    rel_diff, ok); a pair with a missing side or an empty left side is skipped."""
    a = counts.select(F.col("dataset").alias("left"), F.col("rows").alias("left_rows"))
    b = counts.select(F.col("dataset").alias("right"), F.col("rows").alias("right_rows"))
    j = pairs.join(a.where("left_rows > 0"), "left").join(b.where("right_rows is not null"), "right")
    rel = F.abs(F.col("left_rows") - F.col("right_rows")) / F.col("left_rows").cast("double")
    return j.select("left", "right", "left_rows", "right_rows", F.round(rel, 6).alias("rel_diff"),
                    (rel <= tolerance).alias("ok"))


# --------------------------------------------------------------- J13 - J16
def check_join(before: DataFrame, after: DataFrame, matched: str, floor: float) -> DataFrame:
    """Join quality (J13): the join kept the spine row count exactly and the match rate
    reaches `floor`. Rows (check, value, ok)."""
    b = before.agg(F.count(F.lit(1)).alias("before"))
    a = after.agg(F.count(F.lit(1)).alias("after"), F.avg(F.col(matched).cast("double")).alias("rate"))
    j = b.withColumn("_g", F.lit(0)).join(a.withColumn("_g", F.lit(0)), "_g")
    return _rows(j, [
        F.struct(F.lit("row_count_unchanged").alias("check"), F.col("after").cast("double").alias("value"),
                 (F.col("after") == F.col("before")).alias("ok")),
        F.struct(F.lit("match_rate").alias("check"), F.round(F.col("rate"), 6).alias("value"),
                 F.coalesce(F.col("rate") >= floor, F.lit(False)).alias("ok"))])


def hub_checks(spine: DataFrame, hub: DataFrame, sources: Mapping[str, tuple[str, float]],
               expected: Mapping[str, tuple] | None = None) -> DataFrame:
    """Join quality of a hub (J13, P7) in one pass over it: rows (check, value, ok) for the spine count
    kept, the match rate of each source {check: (flag, floor)}, and the number of rows that meet each
    condition of `expected` {name: (condition, least, most)}."""
    expected = expected or {}
    rates = [F.avg(F.col(flag).cast("double")).alias(f"rate_{n}") for n, (flag, _) in sources.items()]
    rows = [F.count_if(c).alias(f"rows_{n}") for n, (c, _, _) in expected.items()]
    b = spine.agg(F.count(F.lit(1)).alias("before")).withColumn("_g", F.lit(0))
    j = hub.agg(F.count(F.lit(1)).alias("after"), *rates, *rows).withColumn("_g", F.lit(0)).join(b, "_g")

    def row(name, value, ok):
        return F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"), F.coalesce(ok, F.lit(False)).alias("ok"))
    return _rows(j, [
        row("row_count_unchanged", F.col("after"), F.col("after") == F.col("before")),
        *[row(n, F.round(F.col(f"rate_{n}"), 6), F.col(f"rate_{n}") >= floor) for n, (_, floor) in sources.items()],
        *[row(f"{n}_rows", F.col(f"rows_{n}"), F.col(f"rows_{n}").between(least, most)) for n, (_, least, most) in expected.items()]])


def check_unique(df: DataFrame, key) -> DataFrame:
    """Duplicate keys with their counts (J14); empty when the key is unique."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_ranges(df: DataFrame, rules: Sequence[tuple]) -> DataFrame:
    """Value range checks (J15, F21): rules = [(name, col, lo, hi, level)] with level
    'warn' or 'fail'. Rows (check, level, n_outside, min, max, ok)."""
    aggs = []
    for i, (_, col, lo, hi, _) in enumerate(rules):
        c = F.col(col).cast("double")
        c = F.when(c == 0, F.lit(0.0)).otherwise(c)  # one zero: -0.0 and 0.0 report alike
        out = F.lit(False)
        if lo is not None:
            out = out | (c < lo)
        if hi is not None:
            out = out | (c > hi)
        aggs += [F.count_if(F.coalesce(out, F.lit(False))).alias(f"_o{i}"), F.min(c).alias(f"_mn{i}"),
                 F.max(c).alias(f"_mx{i}")]
    one = df.agg(*aggs)
    return _rows(one, [F.struct(F.lit(n).alias("check"), F.lit(lv).alias("level"),
                                F.col(f"_o{i}").alias("n_outside"), F.col(f"_mn{i}").alias("min"),
                                F.col(f"_mx{i}").alias("max"), (F.col(f"_o{i}") == 0).alias("ok"))
                       for i, (n, _, _, _, lv) in enumerate(rules)])


def check_expected(actual: DataFrame, key: str, expected: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Expected-value regression on a small aggregate (J16). `expected` has (key, metric,
    expected, tol_pct); tol_pct 0 means exact. Rows (key, metric, actual, expected, ok)."""
    st = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("actual"))
                             for m in metrics])).alias("_m")
    long = actual.select(key, st).select(key, "_m.metric", "_m.actual")
    j = expected.join(long, [key, "metric"], "left")
    tol = F.abs(F.col("expected")) * F.col("tol_pct") / 100.0
    return j.select(key, "metric", "actual", "expected",
                    F.coalesce(F.abs(F.col("actual") - F.col("expected")) <= tol, F.lit(False)).alias("ok"))


# ------------------------------------------------------------------------ J18
def audit_pages(pages: DataFrame, page_size: int | None = None) -> DataFrame:
    """Page completeness (J18). `pages`: (dataset, offset, declared, n_rows[, page_size]),
    one row per landed page. The number of missing pages is the number of pages the declared
    rows need minus the landed offsets on the grid; the first missing offset follows a landed
    page (or is 0), so it is found by joining each page with the next one. No offset that did
    not land is ever generated. Rows (dataset, declared, landed, missing_rows, missing_pages,
    first_missing_offset, duplicate_pages, short_pages)."""
    size = F.col("page_size") if "page_size" in pages.columns else F.lit(page_size)
    p = pages.withColumn("_size", size)
    per_page = p.groupBy("dataset", "offset").agg(F.count(F.lit(1)).alias("_copies"),
                                                  F.max("n_rows").alias("n_rows"),
                                                  F.max("declared").alias("declared"),
                                                  F.max("_size").alias("_size"))
    ds = per_page.groupBy("dataset").agg(
        F.max("declared").alias("declared"), F.max("_size").alias("_size"),
        F.sum("n_rows").alias("landed"), F.count_if(F.col("_copies") > 1).alias("duplicate_pages"),
        F.count_if(F.col("n_rows") < F.least(F.col("_size"), F.col("declared") - F.col("offset"))).alias("short_pages"))
    grid = per_page.select("dataset", F.col("offset").cast("long").alias("offset")).join(
        ds.select("dataset", "declared", "_size"), "dataset").where(
        (F.col("offset") % F.col("_size") == 0) & (F.col("offset") >= 0) & (F.col("offset") < F.col("declared")))
    here = grid.select("dataset", "offset")
    nexts = (grid.select("dataset", "declared", (F.col("offset") + F.col("_size")).alias("offset"))
             .unionByName(ds.select("dataset", "declared", F.lit(0).cast("long").alias("offset")))
             .where(F.col("offset") < F.col("declared")))
    gaps = nexts.join(here, ["dataset", "offset"], "left_anti").groupBy("dataset").agg(
        F.min("offset").alias("first_missing_offset"))
    found = grid.groupBy("dataset").agg(F.count(F.lit(1)).alias("_found"))
    mstat = (ds.select("dataset", "declared", "_size").join(found, "dataset", "left").join(gaps, "dataset", "left")
             .select("dataset", (F.ceil(F.col("declared") / F.col("_size")) - F.coalesce("_found", F.lit(0)))
                     .alias("missing_pages"), "first_missing_offset"))
    return (ds.join(mstat, "dataset", "left")
            .select("dataset", "declared", F.col("landed").cast("long").alias("landed"),
                    (F.col("declared") - F.col("landed")).cast("long").alias("missing_rows"),
                    F.coalesce(F.col("missing_pages"), F.lit(0)).alias("missing_pages"),
                    "first_missing_offset", "duplicate_pages", "short_pages"))


# ------------------------------------------------------------------ J19 / J20 / J21
def reconcile_totals(detail: DataFrame, summary: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Detail roll-up vs pre-aggregated totals (J19): full join on key, difference per
    column, `agree` when every difference is 0 (missing counts as 0 on either side)."""
    d = detail.select(key, *[F.col(c).alias(f"detail_{c}") for c in cols])
    s = summary.select(key, *[F.col(c).alias(f"summary_{c}") for c in cols])
    j = d.join(s, key, "full")
    diffs = [(F.coalesce(F.col(f"detail_{c}"), F.lit(0)) - F.coalesce(F.col(f"summary_{c}"), F.lit(0))).alias(f"diff_{c}")
             for c in cols]
    j = j.select("*", *diffs)
    agree = None
    for c in cols:
        e = F.col(f"diff_{c}") == 0
        agree = e if agree is None else (agree & e)
    return j.withColumn("agree", agree)


def page_gaps(pages: DataFrame) -> DataFrame:
    """Rows that no page holds, and rows that two pages hold (J18, T30), for pages of any offset and
    length: `pages` has (dataset, offset, n_rows, declared). Rows (dataset, gap_start, gap_end, kind) with
    gap_end outside: `missing` before a page or after the last one up to the declared count, and
    `overlap` for the part of a page that earlier pages already hold.

    Gaps and islands: pages in the order of (dataset, offset) meet the running maximum of the ends
    before them, first inside partitions of that order, then across them, so a dataset of any
    number of pages is no single task."""
    p = pages.select("dataset", F.col("offset").cast("long").alias("offset"), (F.col("offset") + F.col("n_rows")).cast("long").alias("end"),
                     F.col("declared").cast("long").alias("declared"))
    done = in_order(p.where("end > offset"), ["dataset", "offset", "end"])
    upto = Window.partitionBy(PART, "dataset").orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    parts = done.groupBy("dataset", PART).agg(F.max("end").alias("_e"))
    parts = parts.select("dataset", PART, F.max("_e").over(Window.partitionBy("dataset").orderBy(PART).rowsBetween(
        Window.unboundedPreceding, -1)).alias("_carried"))
    j = done.withColumn("_here", F.max("end").over(upto)).join(parts, ["dataset", PART])
    j = j.withColumn("_before", F.greatest(F.coalesce("_here", F.lit(0)), F.coalesce("_carried", F.lit(0))))
    inside = j.where(F.col("offset") != F.col("_before")).select(
        "dataset", F.least("offset", "_before").alias("gap_start"),
        F.when(F.col("offset") > F.col("_before"), F.col("offset")).otherwise(F.least("end", "_before")).alias("gap_end"),
        F.when(F.col("offset") > F.col("_before"), "missing").otherwise("overlap").alias("kind"))
    # a page that begins before the end of earlier ones overlaps from its own offset
    tail = p.groupBy("dataset").agg(F.max(F.when(F.col("end") > F.col("offset"), F.col("end"))).alias("_e"), F.max("declared").alias("gap_end"))
    tail = tail.select("dataset", F.coalesce("_e", F.lit(0)).alias("gap_start"), "gap_end", F.lit("missing").alias("kind"))
    return inside.unionByName(tail.where("gap_end > gap_start"))


def compute_figures(tables: Mapping[str, DataFrame], figures: Sequence[Mapping]) -> DataFrame:
    """Published figures as data (J20, P23): each of `figures` is {figure, dataset, kind, numerator,
    denominator, stated, digits}. `pct`: percent of the rows that meet the condition `denominator` (none:
    all rows) that also meet `numerator`; `count`: rows that meet `numerator`; `value`: the aggregate
    expression `numerator`. All figures of a dataset are compiled to one aggregate, so each table is
    read once and only in the columns that the conditions name. Rows (figure, dataset, kind, numerator,
    denominator, computed, stated, ok), ok at the stated precision."""
    out = None
    for dataset in dict.fromkeys(f["dataset"] for f in figures):
        own = [f for f in figures if f["dataset"] == dataset]
        aggs = []
        for i, f in enumerate(own):
            within = F.coalesce(F.expr(f.get("denominator") or "true"), F.lit(False))
            if f["kind"] == "value":
                aggs += [F.expr(f["numerator"]).cast("double").alias(f"n{i}"), F.lit(None).cast("double").alias(f"d{i}")]
            else:
                hit = F.coalesce(F.expr(f["numerator"]), F.lit(False))
                aggs += [F.count_if(hit & within).cast("double").alias(f"n{i}"),
                         (F.count_if(within) if f["kind"] == "pct" else F.lit(None)).cast("double").alias(f"d{i}")]
        rows = [F.struct(F.lit(f["figure"]).alias("figure"), F.lit(dataset).alias("dataset"), F.lit(f["kind"]).alias("kind"),
                         F.col(f"n{i}").alias("numerator"), F.col(f"d{i}").alias("denominator"), F.lit(float(f["stated"])).alias("stated"),
                         F.lit(int(f["digits"])).alias("digits")) for i, f in enumerate(own)]
        part = tables[dataset].agg(*aggs).select(F.explode(F.array(*rows)).alias("f")).select("f.*")
        out = part if out is None else out.unionByName(part)
    value = F.when(F.col("kind") == "pct", F.col("numerator") / F.nullif(F.col("denominator"), F.lit(0.0)) * 100.0).otherwise(F.col("numerator"))
    near = F.abs(value - F.col("stated")) <= F.lit(0.5) * F.pow(F.lit(10.0), -F.col("digits"))
    return out.select("figure", "dataset", "kind", "numerator", "denominator", F.round(value, 4).alias("computed"), "stated",
                      F.coalesce(near, F.lit(False)).alias("ok"))


def check_figures(computed: DataFrame, figures: DataFrame) -> DataFrame:
    """Published-figure registry (J20). `computed`: (figure, numerator, denominator);
    `figures`: (figure, stated_pct, digits). The percent is recomputed from its declared
    numerator and denominator and compared at the stated precision."""
    j = figures.join(computed, "figure", "left")
    pct = F.col("numerator").cast("double") / F.nullif(F.col("denominator").cast("double"), F.lit(0.0)) * 100.0
    return j.select("figure", "numerator", "denominator", "stated_pct",
                    F.round(pct, 4).alias("computed_pct"),
                    F.coalesce(F.abs(pct - F.col("stated_pct")) <= F.lit(0.5) * F.pow(F.lit(10.0), -F.col("digits")),
                               F.lit(False)).alias("ok"))


def vintage_changes(prev: DataFrame, curr: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Two vintages of one table (J21): rows (key, change, col, old, new) for added and
    removed keys and for each changed column (null-safe comparison)."""
    p = prev.select(key, *[F.col(c).cast("string").alias(f"_p_{c}") for c in cols]).withColumn("_inp", F.lit(True))
    c = curr.select(key, *[F.col(x).cast("string").alias(f"_c_{x}") for x in cols]).withColumn("_inc", F.lit(True))
    j = p.join(c, key, "full")
    added = j.where(F.col("_inp").isNull()).select(key, F.lit("added").alias("change"),
                                                   F.lit(None).cast("string").alias("col"),
                                                   F.lit(None).cast("string").alias("old"),
                                                   F.lit(None).cast("string").alias("new"))
    removed = j.where(F.col("_inc").isNull()).select(key, F.lit("removed").alias("change"),
                                                     F.lit(None).cast("string").alias("col"),
                                                     F.lit(None).cast("string").alias("old"),
                                                     F.lit(None).cast("string").alias("new"))
    both = j.where(F.col("_inp") & F.col("_inc"))
    st = F.explode(F.array(*[F.struct(F.lit(x).alias("col"), F.col(f"_p_{x}").alias("old"),
                                      F.col(f"_c_{x}").alias("new"),
                                      (~F.col(f"_p_{x}").eqNullSafe(F.col(f"_c_{x}"))).alias("chg"))
                             for x in cols])).alias("_s")
    changed = both.select(key, st).where(F.col("_s.chg")).select(
        key, F.lit("changed").alias("change"), "_s.col", "_s.old", "_s.new")
    return added.unionByName(removed).unionByName(changed)
