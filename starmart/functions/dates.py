"""Calendar expressions with PostgreSQL's output conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """``to_char(d, 'YYYYMMDD')::integer``: 2001-08-02 -> 20010802."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def day_of_week0(d: Column) -> Column:
    """``extract(dow)``: 0 = Sunday ... 6 = Saturday (Spark's dayofweek is 1-based)."""
    return F.dayofweek(d) - 1


def month_name_padded(d: Column) -> Column:
    """``to_char(d, 'MONTH')``: upper case, blank-padded to 9 characters."""
    return F.rpad(F.upper(F.date_format(d, "MMMM")), 9, " ")


def day_name_padded(d: Column) -> Column:
    """``to_char(d, 'Day')``: capitalised, blank-padded to 9 characters."""
    return F.rpad(F.date_format(d, "EEEE"), 9, " ")


def month_start(d: Column) -> Column:
    """``date_trunc('month', d)::date``."""
    return F.trunc(d, "month")


def days_between(later: Column, earlier: Column) -> Column:
    """``later - earlier`` on dates, in whole days (PostgreSQL's date - date)."""
    return F.datediff(later, earlier)
