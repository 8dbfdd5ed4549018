"""Moments given by the caller, so that runs can be repeated."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def moment(value: datetime | None) -> Column:
    """A timestamp column; without an offset the session's time zone holds, and
    without a value it is now."""
    if value is None:
        return F.current_timestamp()
    return F.lit(value.isoformat(sep=" ")).cast("timestamp")


def iso(time: Column) -> Column:
    return F.date_format(time, ISO_TIME)
