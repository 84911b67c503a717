"""Date and timestamp parameters as literals that do not depend on any time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_lit(d) -> Column:
    if isinstance(d, Column):
        return d.cast("date")
    if isinstance(d, dt.datetime):
        d = d.date()
    if isinstance(d, dt.date):
        return F.lit(d)
    return F.to_date(F.lit(str(d)))


def ts_lit(t) -> Column:
    """timestamp_ntz literal; datetimes pass through their text form."""
    if isinstance(t, Column):
        return t.cast("timestamp_ntz")
    if isinstance(t, dt.datetime):
        return F.lit(t.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(t, dt.date):
        return F.lit(t.isoformat()).cast("timestamp_ntz")
    return F.to_timestamp_ntz(F.lit(str(t)))
