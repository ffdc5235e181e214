"""Date functions (D1-D7) for bulletin calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edicto.constants import CALENDAR_EPOCH, MONTHS, WS
from edicto.functions.text import ColumnOrName, col, t6_strip

# FIXED VALUES: the source's date and calendar-code patterns (Java regex,
# `WS` for `\s`).
RX_DAY = "([0-9]{1,2})" + WS + "de"
RX_YEAR = "([0-9]{4})"
RX_MONTH = "(?d)(de.*)[0-9]{4}"
# Source patterns '([0-9].*)' / '(V[0-9].*)', extended with an optional
# minus sign so that days before the calendar epoch decode too (the source
# fails on them).
RX_DAY_CODE = "(?d)'(-?[0-9].*)'"
RX_MONTH_CODE = "(?d)'(V-?[0-9].*)'"


def _months_map() -> Column:
    kv = []
    for k, v in MONTHS.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def parse_spanish_date(raw: ColumnOrName) -> Column:
    """D1: '29 de noviembre 2022' (lower-cased) -> '2022/11/29'.  Any part
    missing -> null."""
    raw = col(raw)
    day = F.regexp_extract(raw, RX_DAY, 1)
    year = F.regexp_extract(raw, RX_YEAR, 1)
    month_key = t6_strip(F.regexp_extract(raw, RX_MONTH, 1))
    month = F.try_element_at(_months_map(), month_key)
    return F.when(
        (day != F.lit("")) & (year != F.lit("")) & month.isNotNull(),
        F.concat_ws("/", year, month, F.lpad(day, 2, "0")),
    )


def spanish_date_text(d: ColumnOrName) -> Column:
    """Render a date as the calendar's lower-cased title + year,
    '29 de noviembre 2022' (inverse of D1, used to build inputs)."""
    d = col(d)
    names = []
    for k, v in MONTHS.items():
        names += [F.lit(int(v)), F.lit(k)]
    return F.concat_ws(
        " ",
        F.dayofmonth(d).cast("string"),
        F.try_element_at(F.create_map(*names), F.month(d)),
        F.year(d).cast("string"),
    )


def technical_ts(fecha: ColumnOrName) -> Column:
    """D2: 'yyyy/MM/dd' -> midnight timestamp (no time zone); invalid -> null."""
    return F.try_to_timestamp(col(fecha), F.lit("yyyy/MM/dd")).cast("timestamp_ntz")


def insertion_ts() -> Column:
    """D3: insert clock, one value per query."""
    return F.current_timestamp().cast("timestamp_ntz")


def day_code(href: ColumnOrName) -> Column:
    """Numeric day argument inside the quotes of a calendar link."""
    return F.regexp_extract(col(href), RX_DAY_CODE, 1)


def month_code(href: ColumnOrName) -> Column:
    """D4: 'V....' month argument inside the quotes of a nav link."""
    return F.regexp_extract(col(href), RX_MONTH_CODE, 1)


def code_to_date(code: ColumnOrName) -> Column:
    """Calendar code (days since the epoch, optional 'V' prefix) -> date."""
    n = F.regexp_extract(col(code), "^V?(-?[0-9]+)$", 1)
    return F.when(
        n != F.lit(""),
        F.date_add(F.lit(CALENDAR_EPOCH).cast("date"), n.cast("int")),
    )


def date_to_code(d: ColumnOrName) -> Column:
    """Inverse of `code_to_date` (day argument)."""
    return F.datediff(col(d), F.lit(CALENDAR_EPOCH).cast("date")).cast("string")


def month_range(start: ColumnOrName, end: ColumnOrName) -> Column:
    """First days of the months from `start` (included) to `end`
    (excluded); empty when start >= end.  Explode it for one row per month."""
    s = F.trunc(col(start).cast("date"), "MM")
    e = F.trunc(col(end).cast("date"), "MM")
    return F.when(
        s < e,
        F.sequence(s, F.add_months(e, -1), F.expr("INTERVAL 1 MONTH")),
    ).otherwise(F.array().cast("array<date>"))


def window_bounds(as_of: ColumnOrName) -> tuple[Column, Column]:
    """D6 bounds: first day of the previous month, first day of next month."""
    a = col(as_of).cast("date")
    return F.trunc(F.add_months(a, -1), "MM"), F.trunc(F.add_months(a, 1), "MM")


def rolling_window(df: DataFrame, date_col: str, as_of) -> DataFrame:
    """Keep rows of the previous and the current month of `as_of`.
    A plain range predicate, so it reaches the Parquet scan."""
    lo, hi = window_bounds(F.lit(as_of) if isinstance(as_of, str) else as_of)
    d = F.col(date_col)
    return df.filter((d >= lo) & (d < hi))


def current_month_only(df: DataFrame, date_col: str, as_of) -> DataFrame:
    """The 'daily' switch: rows of the displayed month only."""
    a = (F.lit(as_of) if isinstance(as_of, str) else as_of).cast("date")
    lo = F.trunc(a, "MM")
    hi = F.add_months(lo, 1)
    d = F.col(date_col)
    return df.filter((d >= lo) & (d < hi))
