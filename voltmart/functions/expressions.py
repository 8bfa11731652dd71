"""Column -> Column helpers. All are native Catalyst expressions (codegen-able)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(v)


# ---------------------------------------------------------------- units

def kw_to_mwh(kw: str | Column, factor: Decimal = C.KW_HALF_HOUR_TO_MWH, scale: int = 6) -> Column:
    """Half-hour kW reading to MWh: round(kw * 0.5 / 1000, 6), exact decimal arithmetic."""
    return F.round(_col(kw) * F.lit(factor), scale)


def mw_to_mwh(mw: str | Column, hours: Decimal = C.HALF_HOUR) -> Column:
    """Average MW over a trading period to MWh; null stays null."""
    return _col(mw) * F.lit(hours)


# ---------------------------------------------------------------- flags

def flag_above(c: str | Column, limit, strict: bool = True) -> Column:
    """Threshold flag; a null input gives false (CASE ... ELSE false)."""
    cond = _col(c) > _lit(limit) if strict else _col(c) >= _lit(limit)
    return F.coalesce(cond, F.lit(False))


def flag_at_least(c: str | Column, limit) -> Column:
    return flag_above(c, limit, strict=False)


def is_in_flag(c: str | Column, values: Iterable) -> Column:
    """IN-list membership as a non-null boolean."""
    return F.coalesce(_col(c).isin(list(values)), F.lit(False))


def map_codes(c: str | Column, rules: Sequence[tuple[Sequence, object]], default=None) -> Column:
    """Ordered CASE mapping: first rule whose value list contains the code wins."""
    c = _col(c)
    out = None
    for values, label in rules:
        cond = c.isin(list(values))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


def label_periods(date_col: str | Column,
                  ranges: Sequence[tuple[_dt.date, _dt.date, str]] = C.COVID_PERIODS) -> Column:
    """Inclusive date-range labels, first match wins, else null."""
    d = _col(date_col)
    out = None
    for start, end, label in ranges:
        cond = d.between(F.lit(start), F.lit(end))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(None).cast("string"))


def classify(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Ordered multi-condition classification; a null condition falls through."""
    out = None
    for cond, label in rules:
        cond = F.coalesce(cond, F.lit(False))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def volatility_class(p95: str | Column, spike_periods: str | Column,
                     rules=C.VOLATILITY_RULES, default: str = C.VOLATILITY_DEFAULT) -> Column:
    """Extreme / Stressed / Elevated / Calm from the p95 price and distinct spike periods."""
    p95, periods = _col(p95), _col(spike_periods)
    conds = []
    for label, p95_limit, period_limit in rules:
        cond = periods >= F.lit(period_limit)
        if p95_limit is not None:
            cond = (p95 > F.lit(p95_limit)) | cond
        conds.append((cond, label))
    return classify(conds, default)


# ---------------------------------------------------------------- arithmetic guards

def safe_div(a: str | Column, b: str | Column) -> Column:
    """a / b with b = 0 -> null (ANSI mode would raise)."""
    return _col(a) / F.nullif(_col(b), F.lit(0))


def ratio(a: str | Column, b: str | Column, scale: int | None = None, times: int = 1) -> Column:
    """(a / b) * times computed in double, fixed at decimal(38,10), optionally rounded.

    Decimal / decimal in Spark silently drops scale (H4); going through double and
    back to a wide decimal keeps 15+ significant digits and rounds half-up exactly.
    """
    r = _col(a).cast("double") / F.nullif(_col(b).cast("double"), F.lit(0.0))
    if times != 1:
        r = r * F.lit(float(times))
    r = r.cast("decimal(38,10)")
    return F.round(r, scale) if scale is not None else r


def round_money(c: str | Column, scale: int = 2) -> Column:
    """Round a numeric to `scale` places half away from zero, on decimal."""
    return F.round(_col(c).cast("decimal(38,10)"), scale)


# ---------------------------------------------------------------- time

def period_start(date_col: str | Column, period_col: str | Column, minutes: int = 30,
                 zone: str | None = None) -> Column:
    """Start of a trading period.

    Default: naive wall-clock ``date + (tp - 1) * 30 minutes`` (periods 49/50
    roll into the next day), as in the source. With `zone` (e.g.
    'Pacific/Auckland'), the UTC instant instead: periods are consecutive
    half-hours from local midnight, so a 46- or 50-period DST day maps to the
    right instants.
    """
    offset = (_col(period_col).cast("int") - F.lit(1)) * F.lit(minutes)
    if zone is None:
        return F.timestamp_add("MINUTE", offset, _col(date_col).cast("timestamp_ntz"))
    midnight_utc = F.to_utc_timestamp(_col(date_col).cast("timestamp_ntz"), zone).cast("timestamp_ntz")
    return F.timestamp_add("MINUTE", offset, midnight_utc)


def season(date_col: str | Column, case: str = "title") -> Column:
    """Southern-hemisphere season from the month; case 'title' or 'lower'."""
    m = F.month(_col(date_col))
    rules = [(months, label if case == "title" else label.lower()) for months, label in C.SEASON_MONTHS]
    out = None
    for months, label in rules:
        cond = m.isin(list(months))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def day_of_week0(date_col: str | Column) -> Column:
    """Day of week with 0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(_col(date_col)) - F.lit(1)


def is_weekend(date_col: str | Column) -> Column:
    return F.dayofweek(_col(date_col)).isin(1, 7)


def days_between(later: str | Column, earlier: str | Column) -> Column:
    """Integer day difference (date - date); null if either side is null."""
    return F.datediff(_col(later), _col(earlier))
