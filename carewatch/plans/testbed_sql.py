"""DuckDB oracle SQL for the test-table queries in `testbed.py` (same column names).

Conventions: counts are cast to BIGINT (DuckDB returns HUGEINT for COUNT_IF / SUM of
integers); money is summed as DECIMAL(18,2) and cast to DOUBLE; floating results are
rounded in the final projection only; NULL placement is always written out.
"""

from __future__ import annotations

from ..functions import constants as K
from . import testbed as TB

NUM = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _q(s: str) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def _values(rows) -> str:
    out = []
    for r in rows:
        out.append("(" + ", ".join(_q(v) if isinstance(v, str) else repr(v) for v in r) + ")")
    return ", ".join(out)


def _num(expr: str, sentinels=("", "---", "N/A", "Not Available")) -> str:
    """SQL twin of expr.num: trim, sentinel -> NULL, strip $ and ',', strict pattern."""
    raw = f"TRIM({expr})"
    s = f"replace(replace({raw}, '$', ''), ',', '')"
    sl = ", ".join(_q(x) for x in sentinels)
    return (f"(CASE WHEN {raw} IS NULL OR {raw} IN ({sl}) THEN NULL "
            f"WHEN regexp_matches({s}, '{NUM}') THEN TRY_CAST({s} AS DOUBLE) END)")


def _alert(term: str, action: str, as_of: str) -> str:
    a = f"DATE '{as_of}'"
    return (f"(CASE WHEN {term} IS NULL THEN 'MANUAL_CHECK' WHEN ({term} - {a}) < 0 THEN 'OVERDUE' "
            f"WHEN ({term} - {a}) <= {K.CRITICAL_DAYS} THEN 'CRITICAL' WHEN ({action} - {a}) <= 0 THEN 'WARNING' "
            f"WHEN ({action} - {a}) <= {K.UPCOMING_DAYS} THEN 'UPCOMING' ELSE 'OK' END)")


def _priority(x: str) -> str:
    whens = " ".join(f"WHEN {_q(lab)} THEN {p}" for lab, p in K.ALERT_PRIORITY)
    return f"(CASE {x} {whens} ELSE -1 END)"


def _label_of(p: str) -> str:
    whens = " ".join(f"WHEN {p_} THEN {_q(lab)}" for lab, p_ in K.ALERT_PRIORITY)
    return f"(CASE {p} {whens} END)"


def _profile_sql(src: str, dataset: str, cols, words=K.SENTINELS_HARNESS, hints=()) -> str:
    """UNION ALL profile rows: dataset, field, row_count, null_count, null_rate,
    is_constant, parse_rate."""
    wl = ", ".join(_q(w) for w in words)
    parts = []
    for c in cols:
        txt = f"TRIM(CAST({c} AS VARCHAR))"
        blank = f"({c} IS NULL OR {txt} IN ({wl}))"
        val = f"CASE WHEN NOT {blank} THEN {txt} END"
        if any(h in c.lower() for h in hints):
            parse = (f"ROUND(CAST(COUNT_IF({_num(f'CAST({c} AS VARCHAR)', words)} IS NOT NULL) AS DOUBLE) / "
                     f"NULLIF(COUNT(*) - COUNT_IF({blank}), 0), 6)")
        else:
            parse = "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT {_q(dataset)} AS dataset, {_q(c)} AS field, COUNT(*) AS row_count, "
            f"CAST(COUNT_IF({blank}) AS BIGINT) AS null_count, "
            f"ROUND(CAST(COUNT_IF({blank}) AS DOUBLE) / NULLIF(COUNT(*), 0), 6) AS null_rate, "
            f"COALESCE(MIN({val}) = MAX({val}), false) AS is_constant, {parse} AS parse_rate FROM ({src}) s")
    return " UNION ALL ".join(parts)


PROFILED = ("SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 20 = 0 THEN c_name ELSE '' END AS sparse_name, "
            "'x' AS const_col, CASE WHEN c_custkey % 5 < 3 THEN 'n/a-text' ELSE CAST(c_acctbal AS VARCHAR) END "
            "AS balance_rate FROM customer")
PROFILED_COLS = ["c_custkey", "c_mktsegment", "sparse_name", "const_col", "balance_rate"]


def _findings_sql() -> str:
    p = _profile_sql(PROFILED, "customer_x", PROFILED_COLS, hints=("rate",))
    return f"""
      prof AS ({p}),
      findings AS (
        SELECT dataset, 'null_rate' AS "check", field FROM prof WHERE null_rate >= {K.NULL_RATE_THRESHOLD}
        UNION ALL SELECT dataset, 'constant_value', field FROM prof WHERE is_constant AND row_count >= {K.CONSTANT_MIN_ROWS}
        UNION ALL SELECT dataset, 'type_anomaly', field FROM prof
          WHERE parse_rate < {K.NUMERIC_PARSE_FLOOR} AND null_rate < {K.NULL_RATE_THRESHOLD}),
      known AS (SELECT * FROM (VALUES {_values(TB.KNOWN_ANOMALIES)}) t(dataset, field, "check")),
      ff AS (SELECT * FROM (VALUES {_values(TB.FINDING_FIELDS)}) t(dataset, field))"""


def _pbj_sql(as_of: str):
    y = int(as_of[:4])
    cands = []
    for mo, dy, off, q, months in K.PBJ_DEADLINES:
        cands.append((f"DATE '{y + off:04d}-{mo:02d}-{dy:02d}'", f"{q} {y} ({months} {y})"))
    mo, dy, off, q, months = K.PBJ_DEADLINES[0]
    fallback = (f"DATE '{y + 1:04d}-{mo:02d}-{dy:02d}'", f"{q} {y + 1} ({months} {y + 1})")
    dl = "CASE " + " ".join(f"WHEN {d} >= DATE '{as_of}' THEN {d}" for d, _ in cands) + f" ELSE {fallback[0]} END"
    lab = "CASE " + " ".join(f"WHEN {d} >= DATE '{as_of}' THEN {_q(l)}" for d, l in cands) + f" ELSE {_q(fallback[1])} END"
    return dl, lab


def _calendar_sql(as_of: str = str(TB.AS_OF)) -> str:
    y = int(as_of[:4])
    fy_list = "[" + ", ".join(_q(x) for x in TB.FY_SAMPLES) + "]"
    dl, lab = _pbj_sql(as_of)
    lic = _alert("term", f"(term - {K.STATE_LICENSE_ACTION_LEAD})", as_of)
    pbj = _alert("pbj_deadline", f"(pbj_deadline - {K.PBJ_ACTION_LEAD})", as_of)
    cost = _alert("due", f"(due - {K.COST_REPORT_ACTION_LEAD})", as_of)
    blanks = ", ".join(_q(x) for x in K.SENTINELS_FISCAL)
    return f"""
    WITH o AS (SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS odate,
                 CASE WHEN o_orderkey % 10 < {len(TB.FY_SAMPLES)} THEN ({fy_list})[o_orderkey % 10 + 1]
                      ELSE strftime(CAST(o_orderdate AS DATE), '%m-%d') END AS fy_text FROM orders),
    a AS (SELECT *, odate + 365 AS term, o_orderpriority = '1-URGENT' AS is_snf, TRIM(fy_text) AS s,
                 {dl} AS pbj_deadline, {lab} AS pbj_label FROM o),
    b AS (SELECT *, COALESCE(s IS NOT NULL AND s NOT IN ({blanks}) AND regexp_matches(s, '^[0-9]+-[0-9]+$'), false) AS ok FROM a),
    c AS (SELECT *, CASE WHEN ok THEN TRY_CAST(split_part(s, '-', 1) AS INTEGER) END AS m,
                 CASE WHEN ok THEN TRY_CAST(split_part(s, '-', 2) AS INTEGER) END AS dd FROM b),
    d AS (SELECT *, COALESCE(ok AND m BETWEEN 1 AND 12 AND dd >= 1, false) AS valid FROM c),
    e AS (SELECT *, CASE WHEN valid THEN m ELSE 1 END AS mm, CASE WHEN valid THEN dd ELSE 1 END AS d1 FROM d),
    f AS (SELECT *, make_date({y}, mm, least(d1, day(last_day(make_date({y}, mm, 1))))) AS this_end FROM e),
    g AS (SELECT *, CASE WHEN NOT valid THEN NULL WHEN this_end <= DATE '{as_of}'
                      THEN make_date({y + 1}, mm, least(day(this_end), day(last_day(make_date({y + 1}, mm, 1)))))
                      ELSE this_end END AS fy_next FROM f),
    h AS (SELECT *, CAST(last_day(fy_next + INTERVAL {K.COST_REPORT_MONTHS_AFTER_FYE} MONTH) AS DATE) AS due FROM g),
    r AS (SELECT o_orderkey, {lic} AS license_alert,
                 CASE WHEN is_snf THEN {pbj} ELSE 'N_A' END AS pbj_alert,
                 CASE WHEN is_snf THEN pbj_label ELSE '' END AS pbj_quarter,
                 CASE WHEN is_snf THEN fy_next END AS fy_end_next,
                 CASE WHEN is_snf THEN due END AS cost_report_due,
                 CASE WHEN NOT is_snf THEN 'N_A' ELSE {cost} END AS cost_report_alert,
                 CAST(substring(strftime(odate, '%Y-%m-%d'), 1, 4) AS INTEGER) AS order_year FROM h),
    cal AS (SELECT *, {_label_of(f"greatest({_priority('license_alert')}, {_priority('pbj_alert')}, {_priority('cost_report_alert')})")}
                 AS overall_alert FROM r)"""


def _chapters_case(cat: str) -> tuple[str, str]:
    lab = "CASE " + " ".join(f"WHEN {cat} BETWEEN {_q(lo)} AND {_q(hi)} THEN {_q(l)}"
                             for l, lo, hi, _ in K.ICD10_CHAPTERS) + " ELSE 'Unknown' END"
    title = "CASE " + " ".join(f"WHEN {cat} BETWEEN {_q(lo)} AND {_q(hi)} THEN {_q(t)}"
                               for _, lo, hi, t in K.ICD10_CHAPTERS) + " ELSE NULL END"
    return lab, title


def _flags_sql(cat: str) -> str:
    out = []
    for name, kind, a, b in K.ICD10_INCIDENT_FLAGS:
        cond = f"{cat} BETWEEN {_q(a)} AND {_q(b)}" if kind == "range" else f"{cat} IN ({', '.join(_q(x) for x in a)})"
        out.append(f"CASE WHEN {cat} IS NOT NULL THEN COALESCE({cond}, false) END AS {name}")
    return ", ".join(out)


def _grid_values() -> str:
    return _values([(c, lv, sc, ds) for c, lv, sc, ds in K.SCOPE_SEVERITY])


CUST_REV = """
    pc AS (SELECT o_custkey, COUNT(*) AS n_orders, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
           FROM orders GROUP BY o_custkey),
    cr AS (SELECT c.c_nationkey, CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS flag, pc.n_orders, pc.revenue
           FROM customer c LEFT JOIN pc ON c.c_custkey = pc.o_custkey)"""

ORD_NATION = "SELECT o.*, c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"

SENT_TEXT = """CASE WHEN o_orderkey % 7 = 0 THEN '---' WHEN o_orderkey % 11 = 0 THEN 'N/A'
      WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 17 = 0 THEN '$' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
      WHEN o_orderkey % 19 = 0 THEN '5d' WHEN o_orderkey % 23 = 0 THEN '1_000'
      WHEN o_orderkey % 29 = 0 THEN '  ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || ' '
      ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END"""


def build() -> dict[str, str]:
    S: dict[str, str] = {}
    lab, title = _chapters_case("cat3")

    S["star_band"] = """
    WITH l AS (SELECT l_orderkey, COUNT(*) AS n_lines FROM lineitem GROUP BY l_orderkey),
    j AS (SELECT o.o_orderpriority, o.o_totalprice, COALESCE(l.n_lines, 0) AS n_lines
          FROM orders o LEFT JOIN l ON o.o_orderkey = l.l_orderkey)
    SELECT o_orderpriority, COUNT(*) AS n_orders, ROUND(AVG(n_lines), 4) AS avg_n_lines,
           ROUND(AVG(o_totalprice), 4) AS avg_o_totalprice, CAST(COUNT_IF(n_lines = 0) AS BIGINT) AS n_without_lines
    FROM j GROUP BY o_orderpriority"""

    S["predicates"] = """
    WITH c AS (SELECT c_custkey, c_name, UPPER(TRIM(c_mktsegment)) = 'BUILDING' AS in_scope,
                 COALESCE(regexp_matches(CAST(c_custkey AS VARCHAR), '^[0-9]{3}$'), false) AS key3,
                 CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 0.0 ELSE c_acctbal END AS bal
               FROM customer)
    SELECT c_custkey, in_scope, key3, (bal IS NULL OR COALESCE(bal = 0, false)) AS bal_missing FROM c
    WHERE (in_scope OR key3) AND NOT COALESCE(starts_with(c_name, 'Customer#00000000'), false)"""

    S["code_filter_lookup"] = f"""
    WITH p AS (SELECT p_partkey, p_type FROM part WHERE p_size > 10
               AND p_type IN ({', '.join(_q(c) for c, _ in TB.TYPE_GROUPS)})),
    codes AS (SELECT * FROM (VALUES {_values(TB.TYPE_GROUPS)}) t(p_type, type_group)),
    l AS (SELECT l_partkey, l_quantity, l_returnflag FROM lineitem WHERE l_returnflag IS NOT NULL AND TRIM(l_returnflag) <> '')
    SELECT COALESCE(c.type_group, 'other') AS type_group, l.l_returnflag, COUNT(*) AS n_lines, SUM(l.l_quantity) AS sum_qty
    FROM l LEFT JOIN p ON l.l_partkey = p.p_partkey LEFT JOIN codes c ON p.p_type = c.p_type GROUP BY 1, 2"""

    segs = TB.SEGMENT_BUCKETS
    bucket_cols = ", ".join(f"CAST(COUNT_IF(c_mktsegment = {_q(s)}) AS BIGINT) AS {s.lower()}" for s in segs)
    S["bucket_counts"] = f"""
    SELECT c_nationkey, {bucket_cols},
      CAST(COUNT_IF(c_acctbal < 0) AS BIGINT) AS neg_balance, CAST(COUNT_IF(c_acctbal >= 5000) AS BIGINT) AS high_balance,
      COUNT(DISTINCT c_custkey) AS distinct_customers, COUNT(DISTINCT c_mktsegment) AS distinct_segments,
      CAST(COUNT_IF(NOT (c_mktsegment IN ({', '.join(_q(s) for s in segs)}) OR c_acctbal < 0 OR c_acctbal >= 5000)) AS BIGINT) AS other,
      COUNT(*) AS total_rows
    FROM customer GROUP BY c_nationkey"""

    S["weighted_rate_rank"] = f"""
    WITH {CUST_REV},
    r AS (SELECT c_nationkey, CAST(SUM(revenue) AS DOUBLE) AS sum_revenue, CAST(SUM(n_orders) AS BIGINT) AS sum_n_orders,
            ROUND(CAST(SUM(revenue) AS DOUBLE) / NULLIF(CAST(SUM(n_orders) AS DOUBLE), 0) * 1.0, 2) AS revenue_per_order
          FROM cr WHERE flag = 0 AND n_orders IS NOT NULL GROUP BY c_nationkey)
    SELECT c_nationkey, sum_revenue, sum_n_orders, revenue_per_order,
           RANK() OVER (ORDER BY revenue_per_order ASC NULLS LAST) AS access_rank FROM r"""

    S["naive_vs_weighted"] = f"""
    WITH {CUST_REV},
    r AS (SELECT c_nationkey,
            ROUND(CAST(SUM(revenue) AS DOUBLE) / NULLIF(CAST(SUM(n_orders) AS DOUBLE), 0) * 1.0, 2) AS weighted,
            ROUND(AVG(CAST(revenue AS DOUBLE) / n_orders), 2) AS naive
          FROM cr WHERE n_orders IS NOT NULL GROUP BY c_nationkey)
    SELECT *, weighted <> naive AS differs FROM r"""

    S["small_flag_label"] = """
    WITH z AS (SELECT s_nationkey AS nk, COUNT(*) AS providers FROM supplier GROUP BY s_nationkey),
    nat AS (SELECT n_nationkey AS nk, n_name FROM nation),
    pop AS (SELECT c_nationkey AS nk, COUNT(*) AS population FROM customer GROUP BY c_nationkey),
    mil AS (SELECT DISTINCT n_nationkey AS nk FROM nation WHERE n_regionkey = 4),
    e AS (SELECT z.nk, nat.n_name, z.providers, pop.population,
                 CASE WHEN mil.nk IS NOT NULL THEN 1 ELSE 0 END AS military_flag
          FROM z LEFT JOIN nat ON z.nk = nat.nk LEFT JOIN pop ON z.nk = pop.nk LEFT JOIN mil ON z.nk = mil.nk)
    SELECT nk, n_name, providers, population, military_flag,
      CASE WHEN population IS NULL OR population < 60 THEN 1 ELSE 0 END AS small_denominator_flag,
      CASE WHEN military_flag = 1 THEN n_name || ' **' WHEN population IS NULL THEN n_name || ' ***'
           WHEN population < 60 THEN n_name || ' *' ELSE n_name END AS label,
      CASE WHEN population > 0 THEN ROUND(CAST(providers AS DOUBLE) / NULLIF(CAST(population AS DOUBLE), 0) * 1000.0, 2)
      END AS providers_per_thousand
    FROM e"""

    price = _num("price_text")
    S["sentinel_numbers"] = f"""
    WITH o AS (SELECT o_orderkey, {SENT_TEXT} AS price_text FROM orders)
    SELECT o_orderkey, price_text, {price} AS price,
      CASE WHEN TRIM(price_text) IS NULL OR TRIM(price_text) IN ('', '---', 'N/A', 'Not Available') THEN 0.0
           ELSE {price} END AS price_or_zero,
      {price} AS price_finite, COALESCE({price} > 300000, false) AS is_big
    FROM o"""

    S["pad_keys"] = """
    WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN ''
                 WHEN c_custkey % 3 = 0 THEN '  ' || CAST(c_custkey * 997 AS VARCHAR) || ' '
                 ELSE CAST(c_custkey * 997 AS VARCHAR) END AS raw_key FROM customer),
    k AS (SELECT c_custkey, TRIM(raw_key) AS s FROM c)
    SELECT c_custkey,
      CASE WHEN s IS NULL OR s = '' THEN NULL WHEN length(s) < 6 THEN lpad(s, 6, '0') ELSE s END AS padded,
      CASE WHEN s IS NULL OR s = '' THEN '000000' WHEN length(s) < 6 THEN lpad(s, 6, '0') ELSE s END AS padded_parity,
      substring(s, 1, 5) AS zip5, s AS cleaned FROM k"""

    S["hub_build"] = """
    SELECT d.doc_id, d.lang, l.quality, l.toxic, (l.doc_id IS NOT NULL) AS label_matched, p.url,
           (p.page_id IS NOT NULL) AS page_matched
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN pages p ON d.doc_id = p.page_id"""

    S["match_rates"] = """
    SELECT d.lang, COUNT(*) AS rows, CAST(COUNT_IF(l.doc_id IS NOT NULL) AS BIGINT) AS matched,
           ROUND(AVG(CASE WHEN l.doc_id IS NOT NULL THEN 1.0 ELSE 0.0 END::DOUBLE), 4) AS match_rate
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang"""

    S["lookup_or_self"] = """
    WITH ref AS (SELECT s_suppkey AS p_partkey, s_name AS p_name FROM supplier)
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey,
      CASE WHEN ref.p_partkey IS NOT NULL THEN ref.p_name ELSE 'part-' || CAST(l.l_partkey AS VARCHAR) END AS part_name,
      (ref.p_partkey IS NOT NULL) AS ref_matched
    FROM lineitem l LEFT JOIN ref ON l.l_partkey = ref.p_partkey"""

    S["override_lookup"] = """
    WITH m AS (SELECT CAST(o_custkey AS VARCHAR) AS k,
                 CASE WHEN o_orderkey % 9 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS term_date,
                 o_orderpriority AS source, o_orderkey AS seq FROM orders),
    v AS (SELECT k, TRY_CAST(term_date AS DATE) AS d, source, seq FROM m
          WHERE regexp_matches(term_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')),
    lst AS (SELECT k, arg_max(d, seq) AS manual_term_date, arg_max(source, seq) AS manual_source FROM v
            WHERE d IS NOT NULL GROUP BY k)
    SELECT c.c_custkey, lst.manual_term_date, lst.manual_source
    FROM customer c LEFT JOIN lst ON CAST(c.c_custkey AS VARCHAR) = lst.k"""

    S["outer_merge"] = """
    WITH cust AS (SELECT CAST(c_custkey AS BIGINT) AS k, c_acctbal FROM customer),
    supp AS (SELECT CAST(s_suppkey * 31 AS BIGINT) AS k, s_name FROM supplier),
    nat AS (SELECT CAST(n_nationkey * -3 AS BIGINT) AS k, n_name FROM nation)
    SELECT COALESCE(cust.k, supp.k, nat.k) AS k, c_acctbal, s_name, n_name
    FROM cust FULL OUTER JOIN supp ON cust.k = supp.k FULL OUTER JOIN nat ON COALESCE(cust.k, supp.k) = nat.k"""

    S["interval_lookup"] = f"""
    WITH p AS (SELECT p_partkey, upper(substring(p_name, 1, 1)) || lpad(CAST(p_size AS VARCHAR), 2, '0')
                 || CAST(p_partkey % 10 AS VARCHAR) AS code FROM part),
    q AS (SELECT *, CASE WHEN length(TRIM(code)) <= 3 THEN TRIM(code)
                         ELSE substring(TRIM(code), 1, 3) || '.' || substring(TRIM(code), 4) END AS dotted,
                 upper(replace(TRIM(code), '.', '')) AS c FROM p),
    r AS (SELECT *, CASE WHEN length(c) >= 3 THEN substring(c, 1, 3) END AS cat3 FROM q)
    SELECT p_partkey, code, dotted, upper(replace(TRIM(dotted), '.', '')) AS undotted,
      {lab} AS chapter, CASE WHEN ({lab}) = 'Unknown' THEN '' ELSE {title} END AS chapter_title, {_flags_sql('cat3')}
    FROM r"""

    S["reconcile_universes"] = """
    WITH u AS (SELECT 'spine' AS source, CAST(c_custkey AS VARCHAR) AS k FROM customer
               UNION ALL SELECT 'orders', CAST(o_custkey AS VARCHAR) FROM orders
               UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR) FROM supplier),
    pk AS (SELECT source, k, COUNT(*) AS n FROM u WHERE k IS NOT NULL GROUP BY source, k),
    sk AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS k FROM customer WHERE c_custkey IS NOT NULL),
    a AS (SELECT source, CAST(SUM(n) AS BIGINT) AS rows, COUNT(*) AS keys, CAST(COUNT_IF(sk.k IS NOT NULL) AS BIGINT) AS matched
          FROM pk LEFT JOIN sk ON pk.k = sk.k GROUP BY source)
    SELECT source, rows, keys, matched, (SELECT keys FROM a WHERE source = 'spine') - matched AS spine_only,
           keys - matched AS source_only FROM a"""

    S["missing_by_group"] = """
    SELECT c_nationkey, COUNT(*) AS missing FROM customer c
    WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = c.c_custkey) GROUP BY c_nationkey"""

    S["event_rollup"] = """
    SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus, COUNT(*) AS total_events,
      CAST(COUNT_IF(contains(lower(o_orderpriority), 'urgent')) AS BIGINT) AS fine_count,
      COALESCE(CAST(SUM(CASE WHEN contains(lower(o_orderpriority), 'urgent') THEN CAST(o_totalprice AS DECIMAL(18,2)) END)
               AS DOUBLE), 0.0) AS fine_total,
      CAST(COUNT_IF(contains(lower(o_orderpriority), 'high') OR contains(lower(o_orderpriority), 'low')) AS BIGINT)
        AS payment_denial_count,
      MAX(CAST(o_orderdate AS DATE)) AS most_recent
    FROM orders GROUP BY o_custkey"""

    S["any_flags"] = """
    WITH l AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS returned,
                 CASE WHEN l_linestatus = 'O' THEN ' y' ELSE 'N' END AS open,
                 CASE WHEN l_linenumber = 1 THEN 'I' ELSE 'O' END AS owner_type FROM lineitem)
    SELECT l_orderkey, bool_or(COALESCE(upper(TRIM(returned)) = 'Y', false)) AS returned_any,
      bool_or(COALESCE(upper(TRIM(open)) = 'Y', false)) AS open_any, COUNT(*) AS n_rows,
      CAST(COUNT_IF(upper(TRIM(owner_type)) = 'I') AS BIGINT) AS n_individual FROM l GROUP BY l_orderkey"""

    S["score_summary"] = f"""
    WITH o AS (SELECT c_nationkey, o_totalprice / 1000 AS score,
                 CASE WHEN o_totalprice / 200000 > 1.0 THEN 'BONUS' WHEN o_totalprice / 200000 < 1.0 THEN 'PENALTY'
                      ELSE 'NEUTRAL' END AS direction FROM ({ORD_NATION}) x)
    SELECT c_nationkey, COUNT(score) AS n_scored, round_even(AVG(score), 1) AS mean_score,
      round_even(MIN(score), 1) AS min_score, round_even(MAX(score), 1) AS max_score,
      CAST(COUNT_IF(direction = 'BONUS') AS BIGINT) AS n_bonus, CAST(COUNT_IF(direction = 'PENALTY') AS BIGINT) AS n_penalty,
      CAST(COUNT_IF(direction = 'NEUTRAL') AS BIGINT) AS n_neutral
    FROM o GROUP BY c_nationkey"""

    S["quartiles_by_group"] = """
    SELECT o_orderpriority, COUNT(o_totalprice) AS n, ROUND(quantile_cont(o_totalprice, 0.25), 4) AS q25,
      ROUND(quantile_cont(o_totalprice, 0.5), 4) AS median, ROUND(quantile_cont(o_totalprice, 0.75), 4) AS q75,
      CAST(COUNT_IF(o_totalprice < 50000) AS BIGINT) AS n_below
    FROM orders GROUP BY o_orderpriority"""

    S["pct_rank_national"] = """
    WITH s AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_discount END AS score
               FROM lineitem),
    sc AS (SELECT l_orderkey, l_linenumber, score,
             round_even((RANK() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2.0)
                        / COUNT(*) OVER (), 3) AS national_pct_rank FROM s WHERE score IS NOT NULL)
    SELECT * FROM sc UNION ALL SELECT l_orderkey, l_linenumber, score, NULL FROM s WHERE score IS NULL"""

    S["pct_rank_state"] = """
    WITH s AS (SELECT l.l_orderkey, l.l_linenumber, CASE WHEN l.l_orderkey % 13 = 0 THEN NULL ELSE l.l_discount END AS score,
                 su.s_nationkey FROM lineitem l LEFT JOIN supplier su ON l.l_suppkey = su.s_suppkey),
    sc AS (SELECT l_orderkey, l_linenumber, score, s_nationkey,
             round_even((RANK() OVER (PARTITION BY s_nationkey ORDER BY score)
                         + (COUNT(*) OVER (PARTITION BY s_nationkey, score) - 1) / 2.0)
                        / COUNT(*) OVER (PARTITION BY s_nationkey), 3) AS state_pct_rank FROM s WHERE score IS NOT NULL)
    SELECT * FROM sc UNION ALL SELECT l_orderkey, l_linenumber, score, s_nationkey, NULL FROM s WHERE score IS NULL"""

    def tier(q):
        return (f"CASE WHEN s.score IS NULL THEN NULL WHEN s.score <= {q}.q1 THEN 'BOTTOM_QUARTILE' "
                f"WHEN s.score <= {q}.q2 THEN 'BELOW_MEDIAN' WHEN s.score <= {q}.q3 THEN 'ABOVE_MEDIAN' "
                f"ELSE 'TOP_QUARTILE' END")
    qs = ("quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS q2, quantile_cont(score, 0.75) AS q3")
    S["quartile_tiers"] = f"""
    WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS score, c_nationkey
               FROM ({ORD_NATION}) x),
    nq AS (SELECT {qs} FROM s), sq AS (SELECT c_nationkey, {qs} FROM s GROUP BY c_nationkey)
    SELECT s.o_orderkey, s.score, s.c_nationkey, {tier('nq')} AS national_tier, {tier('sq')} AS nation_tier
    FROM s CROSS JOIN nq LEFT JOIN sq ON s.c_nationkey = sq.c_nationkey"""

    S["position_of"] = f"""
    WITH r AS (SELECT c_nationkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
               FROM ({ORD_NATION}) x GROUP BY c_nationkey),
    p AS (SELECT c_nationkey, revenue, ROW_NUMBER() OVER (ORDER BY revenue DESC, c_nationkey ASC) AS position,
                 COUNT(*) OVER () AS of_n FROM r WHERE revenue IS NOT NULL)
    SELECT c_nationkey, revenue, position, of_n FROM p WHERE c_nationkey = 7"""

    S["top_n_per_scope"] = f"""
    WITH o AS (SELECT o_orderkey, o_totalprice, c_nationkey FROM ({ORD_NATION}) x),
    t AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn FROM o),
    b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY o_totalprice ASC NULLS LAST, o_orderkey) AS rn FROM o)
    SELECT o_orderkey, o_totalprice, c_nationkey, rn, 'top' AS which FROM t WHERE rn <= 5
    UNION ALL SELECT o_orderkey, o_totalprice, c_nationkey, rn, 'bottom' FROM b WHERE rn <= 5"""

    S["dedupe_keep"] = """
    SELECT user_id, event_id, ts, event_type, value FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) x WHERE rn = 1"""

    S["value_counts_top"] = """
    SELECT p_name, COUNT(*) AS n FROM part GROUP BY p_name ORDER BY n DESC, p_name ASC LIMIT 10"""

    S["sort_nulls"] = f"""
    WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL
                 ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price_text FROM orders)
    SELECT o_orderkey, price_text, {_num('price_text')} AS price_num FROM o
    ORDER BY price_num DESC NULLS LAST, o_orderkey ASC NULLS LAST LIMIT 20"""

    bench = """
      c AS (SELECT 'NATION_' || CAST(c_nationkey AS VARCHAR) AS state, c_acctbal, c_mktsegment FROM customer),
      b AS (SELECT state, ROUND(AVG(c_acctbal), 4) AS avg_balance, CAST(COUNT(*) AS DOUBLE) AS n_customers,
                   ROUND(AVG(CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END::DOUBLE), 4) AS share_building
            FROM c GROUP BY state
            UNION ALL SELECT 'NATION', ROUND(AVG(c_acctbal), 4), CAST(COUNT(*) AS DOUBLE),
                   ROUND(AVG(CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END::DOUBLE), 4) FROM c),
      lng AS (SELECT state, 'avg_balance' AS metric, avg_balance AS v FROM b
              UNION ALL SELECT state, 'n_customers', n_customers FROM b
              UNION ALL SELECT state, 'share_building', share_building FROM b)"""
    S["benchmark_compare"] = f"""
    WITH {bench},
    f AS (SELECT metric, v AS focus_value FROM lng WHERE state = 'NATION_3'),
    bl AS (SELECT metric, v AS baseline_value FROM lng WHERE state = 'NATION'),
    j AS (SELECT COALESCE(f.metric, bl.metric) AS metric, focus_value, baseline_value,
                 ROUND(focus_value - baseline_value, 4) AS diff FROM f FULL OUTER JOIN bl ON f.metric = bl.metric)
    SELECT metric, focus_value, baseline_value, diff,
      CASE WHEN diff > 0 THEN 'HIGHER' WHEN diff < -0.1 THEN 'LOWER' ELSE '' END AS flag FROM j"""

    S["union_sources"] = """
    SELECT CAST(c_custkey AS BIGINT) AS key, c_name AS name, CAST(c_nationkey AS INTEGER) AS nationkey,
           CAST(c_acctbal AS DOUBLE) AS acctbal, c_mktsegment AS segment, 'customer' AS source, '2024' AS vintage
    FROM customer
    UNION ALL SELECT CAST(s_suppkey AS BIGINT), s_name, CAST(s_nationkey AS INTEGER), CAST(s_acctbal AS DOUBLE),
           CAST(NULL AS VARCHAR), 'supplier', '2024' FROM supplier"""

    S["required_members"] = """
    WITH req AS (SELECT * FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('6-NONE')) t(value))
    SELECT value, EXISTS (SELECT 1 FROM orders WHERE o_orderpriority = req.value) AS present FROM req"""

    S["row_sum_flags"] = """
    WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_quantity END AS a,
                 CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_tax * 100 END AS b FROM lineitem)
    SELECT l_orderkey, l_linenumber, a, b,
      CASE WHEN COALESCE(a, b) IS NULL THEN NULL ELSE COALESCE(a, 0) + COALESCE(b, 0) END AS total,
      CASE WHEN a IS NULL AND b IS NULL THEN NULL ELSE COALESCE(a + b > 30, false) END AS pair_flag,
      COALESCE(a > 25, false) AS gt_false, a > 25 AS gt_null FROM l"""

    mins = TB.FOUR_PART_MINIMUMS
    parts = ", ".join(f"{c} >= {float(m)!r} AS meets_{c}" for c, m in mins.items())
    allc = " AND ".join(f"{c} >= {float(m)!r}" for c, m in mins.items())
    nmiss = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in mins)
    S["four_part_test"] = f"""
    WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity, l_tax, l_extendedprice,
                 CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_discount END AS discount FROM lineitem)
    SELECT l_orderkey, l_linenumber, {parts}, COALESCE({allc}, false) AS meets_all, {nmiss} AS n_missing_parts FROM l"""

    S["severity_grid"] = f"""
    WITH l AS (SELECT l_orderkey, l_linenumber,
                 substring('ABCDEFGHIJKLM', CAST((l_orderkey + l_linenumber) % 13 + 1 AS INTEGER), 1) AS code FROM lineitem),
    g AS (SELECT * FROM (VALUES {_grid_values()}) t(k, lvl, sc, ds))
    SELECT l.l_orderkey, l.l_linenumber, l.code, CAST(g.lvl AS INTEGER) AS severity_level,
      COALESCE(g.sc, '') AS scope, COALESCE(g.ds, '') AS severity_desc,
      COALESCE(upper(TRIM(l.code)) IN ('J', 'K', 'L'), false) AS is_immediate_jeopardy,
      COALESCE(g.lvl >= {K.ACTUAL_HARM_MIN_LEVEL}, false) AS is_actual_harm
    FROM l LEFT JOIN g ON upper(TRIM(l.code)) = g.k"""

    codes = "[" + ", ".join(_q(x) for x in TB.EXCLUSION_SAMPLES) + "]"
    notes = "[" + ", ".join(_q(x) for x in TB.FOOTNOTES) + "]"
    S["code_tiers"] = f"""
    WITH p AS (SELECT p_partkey, ({codes})[p_partkey % {len(TB.EXCLUSION_SAMPLES)} + 1] AS code,
                 ({notes})[p_partkey % {len(TB.FOOTNOTES)} + 1] AS footnote FROM part),
    t AS (SELECT * FROM (VALUES {_values(K.EXCLUSION_TIERS.items())}) t(k, tier))
    SELECT p.p_partkey, p.code, COALESCE(t.tier, {_q(K.EXCLUSION_DEFAULT_TIER)}) AS tier,
      CASE WHEN COALESCE(TRIM(footnote), '') IN ('', '---') THEN ''
           WHEN contains(lower(TRIM(footnote)), {_q(K.CASE_MINIMUM_PHRASE)}) THEN 'VOL_SUPPRESSED' ELSE 'SUPPRESSED' END
        AS suppression
    FROM p LEFT JOIN t ON upper(replace(TRIM(p.code), ' ', '')) = t.k"""

    S["ratios_rounding"] = """
    WITH l AS (SELECT l_orderkey, l_linenumber, l_tax, l_discount,
                 CAST(l_tax AS DOUBLE) / NULLIF(CAST(l_discount AS DOUBLE), 0.0) * 100.0 AS r FROM lineitem)
    SELECT l_orderkey, l_linenumber, ROUND(r, 2) AS tax_per_discount, ROUND(r, 0) AS half_up,
      round_even(r, 0) AS half_even, round_even(l_tax - l_discount, 4) AS delta FROM l"""

    S["text_codes"] = """
    WITH p AS (SELECT p_partkey, p_brand, p_type,
                 CASE WHEN p_partkey % 6 = 0 THEN 'N/A' WHEN p_partkey % 9 = 0 THEN ' ' ELSE p_name END AS name,
                 CASE WHEN p_partkey % 8 = 0 THEN '0000000000' WHEN p_partkey % 15 = 0 THEN ''
                      ELSE lpad(CAST(p_partkey AS VARCHAR), 10, '1') END AS npi,
                 CASE WHEN p_size % 2 = 0 THEN 'I' ELSE 'O' END AS owner_type,
                 lpad(CAST(p_size % 10 AS VARCHAR), 5, '0') AS practice_zip,
                 CASE WHEN p_partkey % 4 = 0 THEN '' ELSE lpad(CAST(p_partkey % 10 AS VARCHAR), 5, '0') END AS mailing_zip
               FROM part)
    SELECT p_partkey,
      CASE WHEN TRIM(npi) IS NOT NULL AND TRIM(npi) <> '' THEN 'https://example.org/part/' || TRIM(npi) ELSE '' END AS npi_uri,
      CASE WHEN COALESCE(TRIM(p_brand), '') <> '' AND COALESCE(TRIM(p_type), '') <> '' THEN TRIM(p_brand) || '-' || TRIM(p_type)
           ELSE '' END AS brand_type,
      CASE WHEN TRIM(name) IS NOT NULL AND TRIM(name) NOT IN ('', 'N/A', 'Not Available') THEN 'Y' ELSE 'N' END AS has_name,
      COALESCE(upper(TRIM(owner_type)) = 'I', false) AS is_individual,
      COALESCE(TRIM(npi) IS NOT NULL AND TRIM(npi) <> '' AND TRIM(npi) <> '0000000000', false) AS has_real_id,
      COALESCE(mailing_zip <> practice_zip AND mailing_zip <> '', false) AS multi_location
    FROM p"""

    cal = _calendar_sql()
    S["calendar_alerts"] = f"""{cal}
    SELECT o_orderkey, license_alert, pbj_alert, pbj_quarter, fy_end_next, cost_report_due, cost_report_alert,
           order_year, overall_alert FROM cal"""
    S["hotlist"] = f"""{cal}
    SELECT o_orderkey, overall_alert, {_priority('overall_alert')} AS priority, cost_report_due FROM cal
    WHERE overall_alert IN ('OVERDUE', 'CRITICAL', 'WARNING')
    ORDER BY priority DESC NULLS LAST, cost_report_due ASC NULLS LAST, o_orderkey ASC NULLS LAST"""

    S["check_counts"] = """
    SELECT 'all_rows' AS "check", COUNT(*) AS value, CAST(1 AS BIGINT) AS lo, CAST(1000000000000 AS BIGINT) AS hi,
           COUNT(*) BETWEEN 1 AND 1000000000000 AS ok FROM lineitem
    UNION ALL SELECT 'returned', CAST(COUNT_IF(l_returnflag = 'R') AS BIGINT), 1, 1000000000000,
           COUNT_IF(l_returnflag = 'R') BETWEEN 1 AND 1000000000000 FROM lineitem
    UNION ALL SELECT 'big_qty', CAST(COUNT_IF(l_quantity > 45) AS BIGINT), 0, 100,
           COUNT_IF(l_quantity > 45) BETWEEN 0 AND 100 FROM lineitem"""

    def rng(name, col, lo, hi, level):
        v = f"(CASE WHEN {col} = 0 THEN 0.0 ELSE CAST({col} AS DOUBLE) END)"
        conds = []
        if lo is not None:
            conds.append(f"{v} < {lo!r}")
        if hi is not None:
            conds.append(f"{v} > {hi!r}")
        out = " OR ".join(conds) or "false"
        return (f"SELECT {_q(name)} AS \"check\", {_q(level)} AS level, CAST(COUNT_IF(COALESCE({out}, false)) AS BIGINT) "
                f"AS n_outside, MIN({v}) AS min, MAX({v}) AS max, COUNT_IF(COALESCE({out}, false)) = 0 AS ok FROM lineitem")
    S["check_ranges"] = " UNION ALL ".join([rng("discount", "l_discount", 0.0, 0.1, "fail"),
                                           rng("tax", "l_tax", 0.0, 0.05, "warn"),
                                           rng("quantity", "l_quantity", 1.0, None, "fail")])

    S["singleton_nonempty"] = """
    SELECT 'nation_3_singleton' AS "check", CAST(COUNT_IF(n_name = 'NATION_3') AS BIGINT) AS value,
           COUNT_IF(n_name = 'NATION_3') = 1 AS ok FROM nation
    UNION ALL SELECT 'nation_nonempty', CAST(NULL AS BIGINT), COUNT(*) > 0 FROM nation"""

    prof = _profile_sql(PROFILED, "customer_x", PROFILED_COLS)
    S["null_rates"] = f"""WITH p AS ({prof})
    SELECT dataset, field, null_rate, null_rate >= {K.NULL_RATE_THRESHOLD} AS flagged FROM p"""
    S["constant_columns"] = f"""WITH p AS ({prof})
    SELECT dataset, field, row_count, is_constant AND row_count >= {K.CONSTANT_MIN_ROWS} AS flagged FROM p"""
    from ..operators.quality import numeric_name
    tcols = [c for c in PROFILED_COLS if numeric_name(c)]
    S["type_anomalies"] = f"""WITH p AS ({_profile_sql(PROFILED, 'customer_x', tcols, hints=("",))})
    SELECT dataset, field, parse_rate,
      COALESCE(parse_rate < {K.NUMERIC_PARSE_FLOOR} AND null_rate < {K.NULL_RATE_THRESHOLD}, false) AS flagged FROM p"""

    S["suppress_and_tier"] = f"""
    WITH {_findings_sql()},
    expected AS (SELECT * FROM (VALUES ('c_custkey'), ('c_mktsegment'), ('sparse_name'), ('const_col'), ('c_phone')) t(field)),
    actual AS (SELECT * FROM (VALUES {_values([(c,) for c in PROFILED_COLS])}) t(field)),
    diff AS (SELECT 'customer_x' AS dataset, 'field_missing' AS "check", field FROM expected
             WHERE field NOT IN (SELECT field FROM actual)
             UNION ALL SELECT 'customer_x', 'field_unexpected', field FROM actual
             WHERE field NOT IN (SELECT field FROM expected) AND field <> 'balance_rate'),
    allf AS (SELECT * FROM findings UNION ALL SELECT * FROM diff),
    kept AS (SELECT * FROM allf a WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.dataset = a.dataset
             AND k.field = a.field AND k."check" = a."check"))
    SELECT kept.dataset, kept."check", kept.field,
      CASE WHEN EXISTS (SELECT 1 FROM ff WHERE ff.dataset = kept.dataset AND ff.field = kept.field)
           THEN 'BLOCKING' ELSE 'LATENT' END AS severity FROM kept"""

    S["findings_summary"] = f"""
    WITH {_findings_sql()},
    kept AS (SELECT * FROM findings a WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.dataset = a.dataset
             AND k.field = a.field AND k."check" = a."check")),
    cls AS (SELECT CASE WHEN EXISTS (SELECT 1 FROM ff WHERE ff.dataset = kept.dataset AND ff.field = kept.field)
                   THEN 'BLOCKING' ELSE 'LATENT' END AS severity FROM kept)
    SELECT severity, COUNT(*) AS n FROM cls GROUP BY severity
    UNION ALL SELECT 'SUPPRESSED', COUNT(*) FROM findings a WHERE EXISTS (SELECT 1 FROM known k
              WHERE k.dataset = a.dataset AND k.field = a.field AND k."check" = a."check")
    UNION ALL SELECT 'GHOST', COUNT(*) FROM known k
    WHERE k.field NOT IN ({", ".join(f"'{c}'" for c in PROFILED_COLS)})"""

    prev_src = "SELECT s_suppkey AS key, s_acctbal AS balance, 'x' AS segment, s_name, s_name AS note FROM supplier"
    curr_src = "SELECT c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment, c_name, '' AS note FROM customer"
    S["drift"] = f"""
    WITH p AS ({_profile_sql(prev_src, 'party', ['key', 'balance', 'segment', 's_name', 'note'])}),
    c AS ({_profile_sql(curr_src, 'party', ['key', 'balance', 'segment', 'c_name', 'note'])}),
    j AS (SELECT COALESCE(p.dataset, c.dataset) AS dataset, COALESCE(p.field, c.field) AS field,
                 p.row_count AS p_rows, c.row_count AS c_rows, p.null_rate AS p_null, c.null_rate AS c_null,
                 p.is_constant AS p_const, c.is_constant AS c_const
          FROM p FULL OUTER JOIN c ON p.dataset = c.dataset AND p.field = c.field),
    pr AS (SELECT dataset, MAX(row_count) AS p_rows FROM p GROUP BY dataset),
    cr AS (SELECT dataset, MAX(row_count) AS c_rows FROM c GROUP BY dataset)
    SELECT pr.dataset, '*' AS field, 'row_count_moved' AS signal FROM pr JOIN cr ON pr.dataset = cr.dataset
      WHERE ABS(c_rows - p_rows) > 0.05 * p_rows
    UNION ALL SELECT dataset, field, 'field_new' FROM j WHERE p_null IS NULL AND c_null IS NOT NULL AND p_rows IS NULL
    UNION ALL SELECT dataset, field, 'field_dropped' FROM j WHERE c_rows IS NULL
    UNION ALL SELECT dataset, field, 'null_rate_crossed' FROM j WHERE COALESCE(p_null < 0.96 AND c_null >= 0.96, false)
    UNION ALL SELECT dataset, field, 'constant_flipped' FROM j WHERE COALESCE(p_const <> c_const, false)"""

    S["cross_source"] = """
    WITH counts AS (SELECT 'customer' AS dataset, COUNT(*) AS rows FROM customer
                    UNION ALL SELECT 'ordering_customers', COUNT(DISTINCT o_custkey) FROM orders
                    UNION ALL SELECT 'orders', COUNT(*) FROM orders
                    UNION ALL SELECT 'ordered_lines', COUNT(DISTINCT l_orderkey) FROM lineitem),
    pairs AS (SELECT * FROM (VALUES ('customer', 'ordering_customers'), ('orders', 'ordered_lines')) t("left", "right")),
    j AS (SELECT pairs."left", pairs."right", a.rows AS left_rows, b.rows AS right_rows,
                 ABS(a.rows - b.rows) / CAST(a.rows AS DOUBLE) AS rel
          FROM pairs JOIN counts a ON pairs."left" = a.dataset AND a.rows > 0 JOIN counts b ON pairs."right" = b.dataset)
    SELECT "left", "right", left_rows, right_rows, ROUND(rel, 6) AS rel_diff, rel <= 0.001 AS ok FROM j"""

    S["vintage_changes"] = """
    WITH p AS (SELECT CAST(c_custkey AS BIGINT) AS k, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer),
    c AS (SELECT CAST(s_suppkey * 31 AS BIGINT) AS k, s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier),
    j AS (SELECT COALESCE(p.k, c.k) AS k, p.k IS NOT NULL AS inp, c.k IS NOT NULL AS inc, p.name AS pn, c.name AS cn,
                 p.nation AS ps, c.nation AS cs FROM p FULL OUTER JOIN c ON p.k = c.k)
    SELECT k, 'added' AS change, CAST(NULL AS VARCHAR) AS col, CAST(NULL AS VARCHAR) AS "old",
           CAST(NULL AS VARCHAR) AS "new" FROM j WHERE NOT inp
    UNION ALL SELECT k, 'removed', NULL, NULL, NULL FROM j WHERE NOT inc
    UNION ALL SELECT k, 'changed', 'name', pn, cn FROM j WHERE inp AND inc AND pn IS DISTINCT FROM cn
    UNION ALL SELECT k, 'changed', 'nation', ps, cs FROM j WHERE inp AND inc AND ps IS DISTINCT FROM cs"""

    S["unique_keys"] = """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"""

    S["expected_bands"] = f"""
    WITH sb AS (SELECT o_orderpriority, COUNT(*) AS n_orders FROM orders GROUP BY o_orderpriority),
    ex AS (SELECT o_orderpriority, metric, CAST(expected AS DOUBLE) AS expected, CAST(tol_pct AS DOUBLE) AS tol_pct
           FROM (VALUES {_values(TB.EXPECTED_BANDS)}) t(o_orderpriority, metric, expected, tol_pct))
    SELECT ex.o_orderpriority, ex.metric, CAST(sb.n_orders AS DOUBLE) AS actual, ex.expected,
      COALESCE(ABS(CAST(sb.n_orders AS DOUBLE) - ex.expected) <= ABS(ex.expected) * ex.tol_pct / 100.0, false) AS ok
    FROM ex LEFT JOIN sb ON ex.o_orderpriority = sb.o_orderpriority"""

    ps = TB.PAGE_SIZE
    S["page_audit"] = f"""
    WITH e AS (SELECT doc_id, CAST(floor(doc_id / {ps}) * {ps} AS BIGINT) AS "offset" FROM labels),
    tot AS (SELECT COUNT(*) AS declared FROM documents),
    pages AS (SELECT "offset", COUNT(*) AS n_rows FROM e GROUP BY "offset"),
    ds AS (SELECT MAX(tot.declared) AS declared, CAST(SUM(n_rows) AS BIGINT) AS landed,
                  CAST(COUNT_IF(n_rows < LEAST({ps}, tot.declared - "offset")) AS BIGINT) AS short_pages
           FROM pages, tot),
    ex AS (SELECT CAST(generate_series AS BIGINT) AS "offset" FROM generate_series(0, (SELECT declared FROM tot) - 1, {ps})),
    missing AS (SELECT "offset" FROM ex WHERE "offset" NOT IN (SELECT "offset" FROM pages))
    SELECT 'labels' AS dataset, ds.declared, ds.landed, ds.declared - ds.landed AS missing_rows,
      (SELECT COUNT(*) FROM missing) AS missing_pages, (SELECT MIN("offset") FROM missing) AS first_missing_offset,
      (SELECT COUNT(*) FROM (SELECT "offset" FROM pages GROUP BY "offset" HAVING COUNT(*) > 1) d) AS duplicate_pages,
      ds.short_pages FROM ds"""

    S["json_props"] = """
    SELECT event_type, ROUND(AVG(CAST(json_extract(props, '$.k') AS BIGINT)), 4) AS mean_k,
           COUNT(CAST(json_extract(props, '$.k') AS BIGINT)) AS n FROM events GROUP BY event_type"""

    S["reconcile_totals"] = """
    WITH d AS (SELECT l_orderkey, COUNT(*) AS n_lines FROM lineitem GROUP BY l_orderkey),
    s AS (SELECT l_orderkey, CAST(MAX(l_linenumber) AS BIGINT) AS n_lines FROM lineitem GROUP BY l_orderkey),
    j AS (SELECT COALESCE(d.l_orderkey, s.l_orderkey) AS l_orderkey, d.n_lines AS detail_n_lines, s.n_lines AS summary_n_lines,
                 COALESCE(d.n_lines, 0) - COALESCE(s.n_lines, 0) AS diff_n_lines
          FROM d FULL OUTER JOIN s ON d.l_orderkey = s.l_orderkey)
    SELECT *, diff_n_lines = 0 AS agree FROM j"""

    S["published_figures"] = """
    WITH urg AS (SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_orderpriority = '1-URGENT'),
    u AS (SELECT CAST(COUNT_IF(urg.c_custkey IS NOT NULL) AS BIGINT) AS numerator, COUNT(*) AS denominator
          FROM customer c LEFT JOIN urg ON c.c_custkey = urg.c_custkey),
    r AS (SELECT CAST(COUNT_IF(COALESCE(l_returnflag = 'R', false)) AS BIGINT) AS numerator, COUNT(*) AS denominator FROM lineitem),
    comp AS (SELECT 'customers_with_urgent' AS figure, numerator, denominator FROM u
             UNION ALL SELECT 'returned_lines', numerator, denominator FROM r),
    fig AS (SELECT * FROM (VALUES ('customers_with_urgent', 60.0, 1), ('returned_lines', 25.0, 1), ('not_computed', 1.0, 1))
            t(figure, stated_pct, digits)),
    j AS (SELECT fig.figure, comp.numerator, comp.denominator, CAST(fig.stated_pct AS DOUBLE) AS stated_pct, fig.digits,
                 CAST(comp.numerator AS DOUBLE) / NULLIF(CAST(comp.denominator AS DOUBLE), 0) * 100.0 AS pct
          FROM fig LEFT JOIN comp ON fig.figure = comp.figure)
    SELECT figure, numerator, denominator, stated_pct, ROUND(pct, 4) AS computed_pct,
      COALESCE(ABS(pct - stated_pct) <= 0.5 * POW(10.0, -digits), false) AS ok FROM j"""

    S["league_table"] = """
    WITH per AS (SELECT o_custkey AS c_custkey, COUNT(*) AS n_orders,
                   SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS urgent_dollars
                 FROM orders GROUP BY o_custkey),
    j AS (SELECT c.c_nationkey, c.c_acctbal, COALESCE(per.n_orders, 0) AS n_orders, per.urgent_dollars
          FROM customer c LEFT JOIN per ON c.c_custkey = per.c_custkey)
    SELECT c_nationkey, COUNT(*) AS facilities, ROUND(CAST(SUM(n_orders) AS DOUBLE) / COUNT(*), 4) AS orders_per_facility,
      CAST(COALESCE(SUM(urgent_dollars), 0) AS DOUBLE) AS urgent_dollars,
      ROUND(AVG(CASE WHEN c_acctbal < 0 THEN 1.0 ELSE 0.0 END::DOUBLE) * 100, 2) AS pct_negative_balance
    FROM j GROUP BY c_nationkey"""

    S["rows_per_key"] = """
    SELECT l_returnflag, COUNT(*) AS rows, COUNT(DISTINCT l_orderkey) AS keys,
      ROUND(CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT l_orderkey), 4) AS rows_per_key FROM lineitem GROUP BY l_returnflag"""

    S["crosstab"] = """
    WITH ct AS (SELECT o_orderpriority, CAST(COUNT_IF(o_orderstatus = 'F') AS BIGINT) AS "F",
                  CAST(COUNT_IF(o_orderstatus = 'O') AS BIGINT) AS "O", CAST(COUNT_IF(o_orderstatus = 'P') AS BIGINT) AS "P",
                  ROUND(AVG(o_totalprice), 4) AS mean_price, MAX(CAST(o_orderdate AS DATE)) AS latest_order
                FROM orders GROUP BY o_orderpriority)
    SELECT o_orderpriority, "F", "O", "P", "F" + "O" + "P" AS total, mean_price, latest_order FROM ct"""
    return S


SQL = build()
