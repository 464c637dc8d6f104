"""Date-key and calendar expressions (UTC session)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_KEY_FORMAT = "yyyyMMdd"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_key_string(d) -> Column:
    """``FORMAT_DATE('%Y%m%d', d)``: STRING key used by the date dimension."""
    return F.date_format(_c(d), DATE_KEY_FORMAT)


def date_key_int(ts) -> Column:
    """``CAST(FORMAT_DATE('%Y%m%d', DATE(ts)) AS INT)``: INT key used by the
    fact. Computed arithmetically (no string round trip)."""
    d = F.to_date(_c(ts))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def ntz_lit(ts) -> Column:
    """A TIMESTAMP_NTZ literal from a naive ``datetime`` (UTC wall clock).
    Built from its ISO text: ``F.lit(datetime)`` goes through the driver's
    OS time zone, which would shift the value on a non-UTC machine."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def day_of_week_sunday_first(d) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(d))
