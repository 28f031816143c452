"""Date and compliance-alert builders (K25-K29). All take an explicit `as_of`."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .expr import ColumnOrName, _c, clean


def _as_of(as_of) -> Column:
    if isinstance(as_of, (_dt.date, str)):
        return F.lit(str(as_of)).cast("date")
    return _c(as_of).cast("date")


def add_months_clamped(d: ColumnOrName, n: int) -> Column:
    """Add months, clamping the day to the end of the result month.
    Spark's `add_months` already clamps and does not snap month-ends forward."""
    return F.add_months(_c(d), n)


def month_end_after(d: ColumnOrName, months: int = K.COST_REPORT_MONTHS_AFTER_FYE) -> Column:
    """Last day of the month `months` after `d` (cost-report due date, K25)."""
    return F.last_day(F.add_months(_c(d), months))


def _date_clamped(year: Column, month: Column, day: Column) -> Column:
    first = F.make_date(year, month, F.lit(1))
    return F.make_date(year, month, F.least(day, F.dayofmonth(F.last_day(first))))


def fy_bounds(md: ColumnOrName, as_of, blanks: Sequence[str] = K.SENTINELS_FISCAL) -> dict[str, Column]:
    """Most recent and next occurrence of a 'MM-DD' fiscal year end around `as_of`.

    Invalid text (blank words, not two numeric parts, month outside 1-12, day < 1) gives
    NULLs instead of raising (T28). The day is clamped to the month's length in the
    as-of year first, and that clamped day is carried to the adjacent year."""
    a = _as_of(as_of)
    s = clean(md)
    ok = s.isNotNull() & ~s.isin(list(blanks)) & s.rlike(r"^[0-9]+-[0-9]+$")
    parts = F.split(s, "-")
    m = F.when(ok, parts.getItem(0).try_cast("int"))
    d = F.when(ok, parts.getItem(1).try_cast("int"))
    valid = F.coalesce(ok & m.between(1, 12) & (d >= 1), F.lit(False))
    # invalid rows build a harmless date (never shown) so make_date cannot raise
    m = F.when(valid, m).otherwise(F.lit(1))
    d = F.when(valid, d).otherwise(F.lit(1))
    y = F.year(a)
    this_end = _date_clamped(y, m, d)
    day_c = F.dayofmonth(this_end)
    past = this_end <= a
    most_recent = F.when(valid, F.when(past, this_end).otherwise(_date_clamped(y - 1, m, day_c)))
    nxt = F.when(valid, F.when(past, _date_clamped(y + 1, m, day_c)).otherwise(this_end))
    return {"fy_end_most_recent": most_recent, "fy_end_next": nxt}


def with_fy_bounds(df, md: str, as_of, prefix: str = "fy_", blanks: Sequence[str] = K.SENTINELS_FISCAL):
    """DataFrame form of `fy_bounds` that materialises each step as a column, so the
    month, day and clamped dates are computed once per row instead of being inlined into
    every expression that uses them. Adds `{prefix}end_most_recent`, `{prefix}end_next`."""
    a = _as_of(as_of)
    s = clean(md)
    ok = s.isNotNull() & ~s.isin(list(blanks)) & s.rlike(r"^[0-9]+-[0-9]+$")
    parts = F.split(s, "-")
    t = df.withColumns({f"_{prefix}m": F.when(ok, parts.getItem(0).try_cast("int")),
                        f"_{prefix}d": F.when(ok, parts.getItem(1).try_cast("int"))})
    m, d = F.col(f"_{prefix}m"), F.col(f"_{prefix}d")
    t = t.withColumn(f"_{prefix}ok", F.coalesce(m.between(1, 12) & (d >= 1), F.lit(False)))
    valid = F.col(f"_{prefix}ok")
    t = t.withColumns({f"_{prefix}m": F.when(valid, m).otherwise(F.lit(1)),
                       f"_{prefix}d": F.when(valid, d).otherwise(F.lit(1))})
    y = F.year(a)
    t = t.withColumn(f"_{prefix}this", _date_clamped(y, m, d))
    this_end = F.col(f"_{prefix}this")
    t = t.withColumn(f"_{prefix}day", F.dayofmonth(this_end))
    day_c = F.col(f"_{prefix}day")
    past = this_end <= a
    t = t.withColumns({
        f"{prefix}end_most_recent": F.when(valid, F.when(past, this_end).otherwise(_date_clamped(y - 1, m, day_c))),
        f"{prefix}end_next": F.when(valid, F.when(past, _date_clamped(y + 1, m, day_c)).otherwise(this_end))})
    return t.drop(*[f"_{prefix}{x}" for x in ("m", "d", "ok", "this", "day")])


def next_deadline(as_of, deadlines=K.PBJ_DEADLINES, lead_days: int = K.PBJ_ACTION_LEAD,
                  include_prior_q4: bool = False) -> dict[str, Column]:
    """Next of a fixed set of yearly deadlines on or after `as_of`, with its label and the
    action date `lead_days` earlier (K27).

    Parity default: candidates start with the current year's first-quarter deadline, so the
    prior year's Q4 deadline (due early in the year) is skipped (T26); `include_prior_q4`
    adds it."""
    a = _as_of(as_of)
    y = F.year(a)

    def cand(year: Column, spec):
        mo, dy, off, q, months = spec
        qy = year
        return F.struct(
            F.make_date(qy + off, F.lit(mo), F.lit(dy)).alias("deadline"),
            F.format_string(f"{q} %d ({months} %d)", qy, qy).alias("label"))

    cands = [cand(y, s) for s in deadlines]
    if include_prior_q4:
        cands = [cand(y - 1, s) for s in deadlines if s[2] == 1] + cands
    fallback = cand(y + 1, deadlines[0])
    arr = F.filter(F.array(*cands), lambda s: s["deadline"] >= a)
    pick = F.coalesce(F.try_element_at(arr, F.lit(1)), fallback)
    return {
        "deadline": pick["deadline"],
        "deadline_label": pick["label"],
        "action_date": F.date_sub(pick["deadline"], lead_days),
    }


def alert(term: ColumnOrName, action: ColumnOrName, as_of, critical: int = K.CRITICAL_DAYS,
          upcoming: int = K.UPCOMING_DAYS) -> Column:
    """Alert ladder from a term date and an action date."""
    a = _as_of(as_of)
    t, act = _c(term), _c(action)
    dt, da = F.datediff(t, a), F.datediff(act, a)
    return (F.when(t.isNull(), F.lit("MANUAL_CHECK"))
             .when(dt < 0, F.lit("OVERDUE"))
             .when(dt <= critical, F.lit("CRITICAL"))
             .when(da <= 0, F.lit("WARNING"))
             .when(da <= upcoming, F.lit("UPCOMING"))
             .otherwise(F.lit("OK")))


def alert_priority(al: ColumnOrName, priority=K.ALERT_PRIORITY) -> Column:
    """Numeric priority of an alert label (unknown labels -1)."""
    pmap = F.create_map(*[x for lab, p in priority for x in (F.lit(lab), F.lit(p))])
    return F.coalesce(F.try_element_at(pmap, _c(al)), F.lit(-1))


def worst(*alerts: ColumnOrName, priority=K.ALERT_PRIORITY) -> Column:
    """Highest-priority alert among several (K29). Each input is referenced once: the
    greatest priority is mapped back to its label (labels and priorities are 1:1)."""
    back = F.create_map(*[x for lab, p in priority for x in (F.lit(p), F.lit(lab))])
    return F.try_element_at(back, F.greatest(*[alert_priority(a, priority) for a in alerts]))


def days_until(d: ColumnOrName, as_of) -> Column:
    return F.datediff(_c(d), _as_of(as_of))
