"""Column builders (no Python UDFs: every function returns a native Catalyst expression).

Survey ids K1-K24 and K30-K33. Date/alert builders K25-K29 live in `calendar.py`.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

ColumnOrName = Column | str

# Characters stripped at both ends by `clean` (Python str.strip's ASCII set; Spark's
# plain `trim` removes spaces only, trap T10).
WHITESPACE = " \t\n\r\x0b\x0c"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _any(conds: Iterable[Column]) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def _all(conds: Iterable[Column]) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


# ----------------------------------------------------------------- K5 cleaning
def clean(col: ColumnOrName, case: str | None = None, strip_quotes: bool = False) -> Column:
    """Trim all leading/trailing whitespace (tabs and newlines too, unlike `trim`),
    optionally strip surrounding quotes and change case (K5, trap T10)."""
    s = F.btrim(_c(col).cast("string"), F.lit(WHITESPACE))
    if strip_quotes:
        s = F.regexp_replace(s, r"^[\"']+|[\"']+$", "")
    if case == "upper":
        s = F.upper(s)
    elif case == "lower":
        s = F.lower(s)
    return s


def blank_to_null(col: ColumnOrName, blanks: Sequence[str] = ("",)) -> Column:
    """Cleaned text, with blank or listed null words turned into a real NULL."""
    s = clean(col)
    return F.when(s.isin(list(blanks)), F.lit(None).cast("string")).otherwise(s)


def is_present(col: ColumnOrName, blanks: Sequence[str] = ("",)) -> Column:
    """True when the cleaned text is neither NULL nor a blank word (never NULL itself)."""
    s = clean(col)
    return F.coalesce(s.isNotNull() & ~s.isin(list(blanks)), F.lit(False))


# --------------------------------------------------------- K1 / K2 number text
def num(col: ColumnOrName, sentinels: Sequence[str] = K.SENTINELS_COMMON, strip: str = "$,",
        on_missing: float | int | None = None, on_bad: float | int | None = None) -> Column:
    """Sentinel-aware number (K1).

    Cleans the text, treats listed sentinels as missing (-> `on_missing`, default NULL;
    0 for census counts, trap T8), removes `strip` characters, and parses only text that
    matches a strict decimal pattern (trap T2) so that `5d`, `1_000`, `nan` and `inf`
    never become numbers. Unparsable text -> `on_bad` (default NULL).
    """
    raw = clean(col)
    s = F.translate(raw, strip, "") if strip else raw
    missing = raw.isNull() | raw.isin(list(sentinels))
    parsed = F.when(s.rlike(K.NUMBER_PATTERN), s.try_cast("double"))
    if on_bad is not None:
        parsed = F.coalesce(parsed, F.lit(float(on_bad)))
    miss_val = F.lit(None).cast("double") if on_missing is None else F.lit(float(on_missing))
    return F.when(missing, miss_val).otherwise(parsed)


def is_sentinel(col: ColumnOrName, sentinels: Sequence[str] = K.SENTINELS_CENSUS) -> Column:
    """Companion flag for `num(..., on_missing=0)`: the value was suppressed, not zero."""
    raw = clean(col)
    return F.coalesce(raw.isNull() | raw.isin(list(sentinels)), F.lit(True))


def finite(col: ColumnOrName) -> Column:
    """NULL for NaN and +/-infinity (K2)."""
    c = _c(col).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


# ----------------------------------------------------------------- K3 / K4 keys
def pad_key(col: ColumnOrName, n: int, blank: str | None = None) -> Column:
    """Left-pad with zeros to `n` without ever truncating longer values (K3, trap T9).

    Blank keys become NULL so they cannot match each other; pass `blank="000000"` for the
    parity behaviour of zero-filling an empty string."""
    s = clean(col)
    blank_val = F.lit(blank) if blank is not None else F.lit(None).cast("string")
    return (F.when(s.isNull() | (s == ""), blank_val)
             .when(F.length(s) < n, F.lpad(s, n, "0"))
             .otherwise(s))


def left(col: ColumnOrName, n: int) -> Column:
    """First n characters of the cleaned text (K4)."""
    return F.substring(clean(col), 1, n)


def zip5(col: ColumnOrName) -> Column:
    """Five-digit ZIP from a ZIP or ZIP+4 text (K4)."""
    return left(col, 5)


# ------------------------------------------------------------------ K6-K9 text
def uri(base: str, col: ColumnOrName) -> Column:
    """Identifier URI; blank stays blank (K6)."""
    s = clean(col)
    return F.when(is_present(s), F.concat(F.lit(base), s)).otherwise(F.lit(""))


def join_code(a: ColumnOrName, b: ColumnOrName, sep: str = "-") -> Column:
    """`a-b`, or blank when either part is blank (K7)."""
    sa, sb = clean(a), clean(b)
    return F.when(is_present(sa) & is_present(sb), F.concat_ws(sep, sa, sb)).otherwise(F.lit(""))


def dot_code(col: ColumnOrName) -> Column:
    """Insert a dot after the third character: E1165 -> E11.65 (K8)."""
    s = clean(col)
    return F.when(F.length(s) <= 3, s).otherwise(
        F.concat(F.substring(s, 1, 3), F.lit("."), s.substr(F.lit(4), F.length(s))))


def undot_code(col: ColumnOrName) -> Column:
    """Remove dots and upper-case: e11.65 -> E1165 (K8)."""
    return F.upper(F.replace(clean(col), F.lit("."), F.lit("")))


def has_any(col: ColumnOrName, words: Sequence[str]) -> Column:
    """Case-insensitive contains-any; NULL text is False (K9)."""
    s = F.lower(F.coalesce(_c(col).cast("string"), F.lit("")))
    return _any(s.contains(w.lower()) for w in words)


# ---------------------------------------------------------------- K10-K12 codes
def _map_literal(pairs: Iterable[tuple]) -> Column:
    flat = []
    for k, v in pairs:
        flat += [F.lit(k), F.lit(v)]
    return F.create_map(*flat)


def severity_grid(col: ColumnOrName) -> dict[str, Column]:
    """Scope/severity letter -> level (nullable int), scope and description."""
    code = clean(col, case="upper")
    lvl = _map_literal((c, lv) for c, lv, _, _ in K.SCOPE_SEVERITY)
    scope = _map_literal((c, sc) for c, _, sc, _ in K.SCOPE_SEVERITY)
    desc = _map_literal((c, d) for c, _, _, d in K.SCOPE_SEVERITY)
    return {
        "severity_level": F.try_element_at(lvl, code).cast("int"),
        "scope": F.coalesce(F.try_element_at(scope, code), F.lit("")),
        "severity_desc": F.coalesce(F.try_element_at(desc, code), F.lit("")),
    }


def code_tier(col: ColumnOrName, mapping: Mapping[str, str] = K.EXCLUSION_TIERS,
              default: str = K.EXCLUSION_DEFAULT_TIER) -> Column:
    """Code -> tier with default; code normalised by trim/upper/space removal."""
    code = F.upper(F.replace(clean(col), F.lit(" "), F.lit("")))
    return F.coalesce(F.try_element_at(_map_literal(mapping.items()), code), F.lit(default))


def level_flags(code: ColumnOrName, level: ColumnOrName) -> dict[str, Column]:
    """Immediate-jeopardy (J/K/L) and actual-harm (level >= 3) flags, never NULL."""
    c = clean(code, case="upper")
    return {
        "is_immediate_jeopardy": F.coalesce(c.isin(K.IMMEDIATE_JEOPARDY_CODES), F.lit(False)),
        "is_actual_harm": F.coalesce(_c(level) >= K.ACTUAL_HARM_MIN_LEVEL, F.lit(False)),
    }


# ----------------------------------------------------------- K13-K18 thresholds
def meets_all(minimums: Mapping[str, float], prefix: str = "meets_") -> dict[str, Column]:
    """Multi-part minimum test.

    Each part is tri-state (`col >= min`, NULL when the value is missing); the overall
    flag is False whenever any part is missing or fails; `n_missing_parts` counts NULLs."""
    parts = {f"{prefix}{c}": (_c(c) >= F.lit(m)) for c, m in minimums.items()}
    overall = F.coalesce(_all(parts.values()), F.lit(False))
    n_missing = reduce(lambda a, b: a + b,
                       [_c(c).isNull().cast("int") for c in minimums])
    return {**parts, f"{prefix}all": overall, "n_missing_parts": n_missing}


def yn_present(col: ColumnOrName, blanks: Sequence[str] = K.SENTINELS_COMMON) -> Column:
    """'Y' when the value is present, else 'N' (K14)."""
    return F.when(is_present(col, blanks), F.lit("Y")).otherwise(F.lit("N"))


def ratio(n: ColumnOrName, d: ColumnOrName, scale: float = 1.0, digits: int | None = None,
          mode: str = "half_up", guard: Column | None = None) -> Column:
    """`n / d * scale`, NULL when d is 0 or NULL (or `guard` is false), rounded."""
    den = _c(d).cast("double")
    r = _c(n).cast("double") / F.nullif(den, F.lit(0.0)) * F.lit(float(scale))
    if guard is not None:
        r = F.when(guard, r)
    return round_to(r, digits, mode) if digits is not None else r


def gt_flag(col: ColumnOrName, x: float, missing: bool | None = False) -> Column:
    """`col > x`; missing -> `missing` (False: K16, None keeps NULL: K17)."""
    cmp = _c(col) > F.lit(x)
    return cmp if missing is None else F.coalesce(cmp, F.lit(missing))


def pair_sum_flag(a: ColumnOrName, b: ColumnOrName, x: float) -> Column:
    """NULL if both missing, False if one missing, else a + b > x."""
    ca, cb = _c(a), _c(b)
    return (F.when(ca.isNull() & cb.isNull(), F.lit(None).cast("boolean"))
             .otherwise(F.coalesce((ca + cb) > F.lit(x), F.lit(False))))


# ------------------------------------------------------- K19-K23 scoring labels
def direction(col: ColumnOrName, pivot: float = 1.0, above: str = "BONUS",
              below: str = "PENALTY", neutral: str = "NEUTRAL") -> Column:
    """Three-way label around a pivot; NULL is neutral."""
    c = _c(col)
    return F.when(c > pivot, above).when(c < pivot, below).otherwise(neutral)


def delta(perf: ColumnOrName, base: ColumnOrName, digits: int = 4) -> Column:
    """Change between two periods, half-even rounded like the pandas source."""
    return F.bround(_c(perf) - _c(base), digits)


def suppression(col: ColumnOrName, null_sentinel: str = "---",
                phrase: str = K.CASE_MINIMUM_PHRASE) -> Column:
    """Footnote text -> '', VOL_SUPPRESSED or SUPPRESSED."""
    v = F.coalesce(clean(col), F.lit(""))
    return (F.when(v.isin("", null_sentinel), F.lit(""))
             .when(F.lower(v).contains(phrase), F.lit("VOL_SUPPRESSED"))
             .otherwise(F.lit("SUPPRESSED")))


def small_flag(col: ColumnOrName, threshold: float) -> Column:
    """Small-denominator flag: NULL or below threshold."""
    return F.coalesce(_c(col) < F.lit(threshold), F.lit(True))


def reliability_label(key: ColumnOrName, military: ColumnOrName, population: ColumnOrName,
                      threshold: float) -> Column:
    """Label with precedence military > unmatched > small > clean."""
    k, p = _c(key), _c(population)
    return (F.when(_c(military), F.concat(k, F.lit(" **")))
             .when(p.isNull(), F.concat(k, F.lit(" ***")))
             .when(p < F.lit(threshold), F.concat(k, F.lit(" *")))
             .otherwise(k))


# ---------------------------------------------------------------- K24 prefixes
def category3(col: ColumnOrName) -> Column:
    """Upper-cased, dot-free 3-character category (NULL when shorter than 3)."""
    c = undot_code(col)
    return F.when(F.length(c) >= 3, F.substring(c, 1, 3))


def prefix_flags(col: ColumnOrName, spec=K.ICD10_INCIDENT_FLAGS) -> dict[str, Column]:
    """Lexicographic range / membership flags on the 3-character prefix."""
    p3 = category3(col)
    out = {}
    for name, kind, a, b in spec:
        cond = p3.between(a, b) if kind == "range" else p3.isin(list(a))
        out[name] = F.when(p3.isNotNull(), F.coalesce(cond, F.lit(False)))
    return out


# ------------------------------------------------------------- K30-K33 misc
def year4(col: ColumnOrName) -> Column:
    """Year from a date or from the first four characters of date text."""
    s = F.substring(clean(col), 1, 4)
    return F.when(s.rlike(r"^[0-9]{4}$"), s.try_cast("int"))


def round_to(col: ColumnOrName, digits: int, mode: str = "half_up") -> Column:
    """Decimal rounding family (K31): 'half_up' (SQL ROUND) or 'half_even' (pandas/numpy)."""
    c = _c(col)
    return F.round(c, digits) if mode == "half_up" else F.bround(c, digits)


def round_half_up(col: ColumnOrName, digits: int) -> Column:
    return round_to(col, digits, "half_up")


def round_half_even(col: ColumnOrName, digits: int) -> Column:
    return round_to(col, digits, "half_even")


def is_individual(type_col: ColumnOrName, individual_code: str = "I") -> Column:
    """Owner/entity type is an individual person."""
    return F.coalesce(clean(type_col, case="upper") == individual_code, F.lit(False))


def has_real_id(col: ColumnOrName, blank_id: str = K.BLANK_NPI) -> Column:
    """Identifier present and not the all-zero placeholder."""
    s = clean(col)
    return F.coalesce(is_present(s) & (s != blank_id), F.lit(False))


def differs(a: ColumnOrName, b: ColumnOrName) -> Column:
    """`a` present and different from `b`; missing -> False."""
    ca, cb = _c(a), _c(b)
    return F.coalesce((ca != cb) & (ca != F.lit("")), F.lit(False))


def row_sum(cols: Sequence[ColumnOrName]) -> Column:
    """Horizontal sum treating NULL as 0, but NULL when every input is NULL."""
    cs = [_c(c) for c in cols]
    if not cs:
        return F.lit(None).cast("long")
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cs])
    return F.when(F.coalesce(*cs).isNull(), F.lit(None)).otherwise(total)
