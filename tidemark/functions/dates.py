"""Readings of date texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO, LATE_YEAR = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})$", r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})$"


def candidates(c: Column) -> Column:
    """All valid readings of a date text, as an array of dates.

    Year first has one reading. Year last is day first, month first, or both in this order where neither of the
    numbers exceeds 12; readings that are no dates go, and equal ones count once.
    """
    v = F.regexp_replace(c, r"^\s+|\s+$", "")
    part = lambda pattern, i: F.nullif(F.regexp_extract(v, pattern, i), F.lit("")).cast("int")
    date = lambda y, m, d: F.try_make_timestamp(y, m, d, F.lit(0), F.lit(0), F.lit(0)).cast("date")
    y, m, d = (part(ISO, i) for i in (1, 2, 3))
    a, b, late = (part(LATE_YEAR, i) for i in (1, 2, 3))
    readings = F.array(date(y, m, d), F.when(~((b > 12) & (a <= 12)), date(late, b, a)), F.when(~((a > 12) & (b <= 12)), date(late, a, b)))
    return F.coalesce(F.array_distinct(F.array_compact(readings)), F.array().cast("array<date>"))


def first(c: Column) -> Column:
    """The first reading, null without one."""
    return F.get(candidates(c), F.lit(0))


def strict_timestamp(c: Column) -> Column:
    """yyyy-MM-dd HH:mm:ss or null."""
    v = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.when(v.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"), v.try_cast("timestamp_ntz"))
