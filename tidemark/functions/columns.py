"""Column helpers: every scalar rule of the warehouse as a built-in Spark expression.

All of these stay inside whole-stage codegen (no Python UDF). Names follow the rule they
implement, not the engine they mimic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- dates --------------------------------------------------------------------------------

def as_date(d: str | _dt.date) -> _dt.date:
    """Parameter dates arrive as 'yyyy-MM-dd' strings or dates; convert once on the driver."""
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    y, m, dd = str(d)[:10].split("-")
    return _dt.date(int(y), int(m), int(dd))


def date_lit(d: str | _dt.date) -> Column:
    return F.lit(as_date(d))


def ts_floor_lit(d: str | _dt.date) -> Column:
    """Midnight of ``d`` as a TIMESTAMP_NTZ literal (for pushable range filters on raw ts)."""
    return F.lit(as_date(d).isoformat() + " 00:00:00").cast("timestamp_ntz")


def ymd_date(c: ColumnOrName) -> Column:
    """'yyyyMMdd' text → DATE; anything unparsable (20240230, '', junk) → NULL."""
    return F.try_to_date(_c(c).cast("string"), "yyyyMMdd")


def iso_prefix_date(c: ColumnOrName) -> Column:
    """First 10 characters as a 'yyyy-MM-dd' date; NULL when they do not parse."""
    return F.try_to_date(F.substring(_c(c).cast("string"), 1, 10), "yyyy-MM-dd")


def week_w(d: ColumnOrName) -> Column:
    """Monday-based week of the year, weeks before the first Monday are week 0 (C ``%W``).

    Not ISO: 2023-01-01 (a Sunday) is week 0.
    """
    d = _c(d)
    return F.floor((F.dayofyear(d) - 1 + 7 - F.weekday(d)) / 7).cast("int")


def year_week_w(d: ColumnOrName) -> Column:
    """'YYYY-WW' text with the ``%W`` week, e.g. '2024-03'."""
    d = _c(d)
    return F.format_string("%04d-%02d", F.year(d), week_w(d))


def weekday_w(d: ColumnOrName) -> Column:
    """Day of week as text with Sunday = '0' … Saturday = '6' (C ``%w``)."""
    return (F.dayofweek(_c(d)) - 1).cast("string")


def week_start(d: ColumnOrName) -> Column:
    """Monday of the week containing ``d``, as DATE."""
    return F.to_date(F.date_trunc("week", _c(d)))


# --- numbers ------------------------------------------------------------------------------

def safe_double(c: ColumnOrName) -> Column:
    """Text → DOUBLE, NULL when not a number."""
    return _c(c).cast("string").try_cast("double")


def safe_long(c: ColumnOrName) -> Column:
    """Text or number → BIGINT through DOUBLE, truncating ('12.7' → 12); bad → NULL."""
    return safe_double(c).try_cast("bigint")


def sum0(c: ColumnOrName) -> Column:
    """SUM that yields 0 instead of NULL over no rows."""
    return F.coalesce(F.sum(_c(c)), F.lit(0))


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den as DOUBLE; NULL when den is 0 or NULL."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def pct_change(cur: ColumnOrName, prev: ColumnOrName) -> Column:
    """(cur - prev) / prev × 100; when prev is 0: 0 if cur is 0 too, else 100."""
    cur, prev = _c(cur).cast("double"), _c(prev).cast("double")
    return (F.when(prev == 0, F.when(cur == 0, F.lit(0.0)).otherwise(F.lit(100.0)))
             .otherwise((cur - prev) / prev * F.lit(100.0)))


def first_truthy(*cols: ColumnOrName, numeric: bool = False) -> Column:
    """First alternative that is neither NULL nor empty ('' for text, 0 for numbers)."""
    empty = F.lit(0) if numeric else F.lit("")
    return F.coalesce(*[F.nullif(_c(c), empty) for c in cols])


# --- text ---------------------------------------------------------------------------------

def norm_key(c: ColumnOrName) -> Column:
    """lower(trim(x)): the UTM key normalisation."""
    return F.lower(F.trim(_c(c)))


def is_total_row(c: ColumnOrName) -> Column:
    """Export footer rows ('Total', 'Total geral', any case, padded)."""
    return norm_key(c).isin(*TOTAL_ROW_LABELS)


def thousands_dot(c: ColumnOrName) -> Column:
    """Integer part with '.' as thousands separator: 1234567.9 → '1.234.567'."""
    whole = F.coalesce(_c(c).cast("double"), F.lit(0.0)).try_cast("bigint")  # truncates toward 0
    return F.replace(F.format_number(whole, 0), F.lit(","), F.lit("."))


def column_type_name(dtype) -> str:
    """SQL type name of a Spark type, as written in the field catalog ('BIGINT', 'DATE', …)."""
    from pyspark.sql import types as T
    table = {
        T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE",
        T.StringType: "VARCHAR", T.DateType: "DATE", T.BooleanType: "BOOLEAN",
        T.TimestampType: "TIMESTAMP WITH TIME ZONE", T.TimestampNTZType: "TIMESTAMP",
        T.ShortType: "SMALLINT", T.FloatType: "FLOAT",
    }
    for k, v in table.items():
        if isinstance(dtype, k):
            return v
    return dtype.simpleString().upper()


# Labels of the footer row that page exports append (compared after lower/trim).
TOTAL_ROW_LABELS = ("total geral", "total")


def in_range(c: ColumnOrName, start, end) -> Column:
    """Inclusive date range on a DATE column."""
    return _c(c).between(date_lit(start), date_lit(end))
