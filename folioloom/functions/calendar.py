"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column | str) -> Column:
    """Integer yyyymmdd."""
    d = F.col(d) if isinstance(d, str) else d
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def quarter_end(d: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))


def year_end(d: Column) -> Column:
    return F.make_date(F.year(d), F.lit(12), F.lit(31))


def day_name(d: Column) -> Column:
    """Full English name, e.g. Sunday."""
    return F.date_format(d, "EEEE")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def iso_week_label(d: Column) -> Column:
    """ISO year and week, e.g. 2020-W53."""
    return F.format_string("%04d-W%02d", F.extract(F.lit("YEAROFWEEK"), d), F.weekofyear(d))
