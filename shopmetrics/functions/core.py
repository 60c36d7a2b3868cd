"""Scalar helpers (SURVEY H-rows) built from JVM-side Spark functions only.

All of these return Column expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: as-of instant for recency on the driver data (day after the
# last driver order).  Reports take ``as_of`` as a parameter; this is only
# the default used by the registered queries.
AS_OF = _dt.datetime(2001, 8, 2, 0, 0, 0)

MONEY = "decimal(12,2)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_of_lit(as_of: _dt.datetime | None = None) -> Column:
    """The as-of instant as a TIMESTAMP_NTZ literal (never current_timestamp
    in oracled queries)."""
    ts = as_of or AS_OF
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def money(x) -> Column:
    return _c(x).cast(MONEY)


def half_up(x, n: int) -> Column:
    """SQL ``ROUND(x::NUMERIC, n)``: half away from zero, returned as DOUBLE.

    Going through DECIMAL(38,6) first makes double inputs round the same way
    as exact decimals (1.005 -> 1.01)."""
    return F.round(_c(x).cast("decimal(38,6)"), n).cast("double")


def half_even(x, n: int) -> Column:
    """numpy ``.round(n)`` on float64: ``rint(x * 10**n) / 10**n``
    (half-to-even on the scaled binary value), as DOUBLE."""
    scale = float(10 ** n)
    return F.rint(_c(x).cast("double") * F.lit(scale)) / F.lit(scale)


def _time_of_day(ts: Column) -> Column:
    """Seconds since midnight (with microseconds) of a wall-clock value."""
    return (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("decimal(12,6)") + F.date_part(F.lit("SECOND"), ts)


def whole_days(later, earlier) -> Column:
    """``EXTRACT(DAY FROM later - earlier)``: whole elapsed days, truncated
    toward zero, on wall-clock (zone-less) values.

    Built from the calendar-day difference plus the time-of-day difference,
    so no session time zone is involved: ``timestamp_diff`` evaluates even
    TIMESTAMP_NTZ operands in the session zone, where a 23-hour DST day
    would lose a whole day."""
    a = _c(later).cast("timestamp_ntz")
    b = _c(earlier).cast("timestamp_ntz")
    seconds = F.datediff(a.cast("date"), b.cast("date")).cast("decimal(20,6)") * 86400 \
        + (_time_of_day(a) - _time_of_day(b))
    return (seconds / 86400).cast("bigint")


def ntz_text(x, iso_t: bool = False) -> Column:
    """Wall-clock text of a TIMESTAMP_NTZ without any time-zone round trip
    (``date_format`` would pass through the session zone and could shift a
    wall time that falls in a DST gap).  Seconds fraction only when non-zero;
    ``iso_t`` puts ISO-8601's ``T`` between date and time."""
    text = _c(x).cast("timestamp_ntz").cast("string")
    return F.regexp_replace(text, " ", "T") if iso_t else text


def month_start(x) -> Column:
    """``DATE_TRUNC('month', ts)::DATE``."""
    return F.trunc(_c(x).cast("date"), "MM")


def month_diff(later, earlier) -> Column:
    """``years*12 + months`` of ``AGE(later, earlier)`` for month starts."""
    a, b = _c(later), _c(earlier)
    return (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))


def pct(num, den, n: int = 1) -> Column:
    """``ROUND(num * 100.0 / den, n)``; NULL when den is 0 (NULLIF guard)."""
    d = _c(den)
    return half_up(_c(num) * F.lit(100.0).cast("decimal(4,1)") / F.nullif(d, F.lit(0)), n)
