"""Tolerant date and timestamp parsing: bad text becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text shapes of dates and timestamps in the raw files.
DAY_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
STAMP_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{1,6}Z$"
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
STAMP_ZONE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSX"

# A shape test followed by a cast reads text many times faster than a date pattern, and
# bad text costs no exception. The shape makes the cast strict.


def guarded_date(c: Column | str) -> Column:
    """Date only where the whole text has the shape of one; impossible days give NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(DAY_SHAPE), c).try_cast("date")


def leading_date(c: Column | str) -> Column:
    """Date in the first ten characters; anything after them is ignored."""
    return guarded_date(F.substring(c, 1, 10))


def utc_stamp(c: Column | str) -> Column:
    """Timestamp of UTC with one to six digits of a second, whatever the session's zone is."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(STAMP_SHAPE), c).try_cast("timestamp")


def stamp_date(c: Column | str) -> Column:
    """Date part of an ISO-8601 timestamp text that carries a zone."""
    c = F.col(c) if isinstance(c, str) else c
    common = F.when(c.rlike(STAMP_SHAPE), c).try_cast("timestamp")
    return F.to_date(F.coalesce(common, F.try_to_timestamp(c, F.lit(STAMP_ZONE_FORMAT))))


def day_parts(c: Column | str) -> dict[str, Column]:
    return {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)}
