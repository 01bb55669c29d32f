"""Lenient casts and date helpers.

Staging holds text.  Hive turned bad text into NULL at insert; under ANSI mode
a plain ``cast`` raises, so every staging column goes through ``try_cast``.
All timestamps are ``timestamp_ntz`` (Hive timestamps carry no zone), so no
result depends on the session time zone.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F



def _epoch() -> Column:
    return F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz")


def lenient(col: str | Column, spark_type: str) -> Column:
    """``try_cast``: text that does not parse becomes NULL instead of failing the job."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(spark_type)


def epoch_ms_to_ts(col: str | Column) -> Column:
    """``from_unixtime(floor(ms / 1000))`` as a timestamp: whole seconds, millis dropped."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("MILLISECOND", c - F.pmod(c, F.lit(1000)), _epoch())  # integers only


def ts_to_epoch_ms(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MILLISECOND", _epoch(), c.cast("timestamp_ntz"))


def year_bounds_ms(year: int) -> tuple[int, int]:
    """[start, end) of a calendar year in epoch milliseconds (UTC)."""
    lo = calendar.timegm(dt.date(year, 1, 1).timetuple()) * 1000
    hi = calendar.timegm(dt.date(year + 1, 1, 1).timetuple()) * 1000
    return lo, hi


def year_of(col: str | Column) -> Column:
    """``year(x)`` / ``extract(year from x)`` as int."""
    c = F.col(col) if isinstance(col, str) else col
    return F.year(c)


def period_year(col: str | Column) -> Column:
    """``extract(year from to_date(period, 'YYYY-MM'))`` with lenient parsing; four digits and a month need no date parser."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.rlike("^[1-9][0-9]{3}-(0[1-9]|1[0-2])\\z"), F.substring(c, 1, 4).try_cast("int")).otherwise(F.year(F.try_to_date(c, "yyyy-MM")))


def as_text(col: str | Column, spark_type: str) -> Column:
    """Fixed text form of a value, the same in every engine (input of the hashes)."""
    c = F.col(col) if isinstance(col, str) else col
    t = spark_type.lower()
    if t == "date":
        return F.date_format(c, "yyyy-MM-dd")
    if t.startswith("timestamp"):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return c.cast("string")
