"""Time handling.  Order timestamps are wall-clock ``timestamp_ntz`` values.

App feeds carry unix seconds (shown as UTC wall clock); web feeds carry ISO text
with an offset suffix that is stripped, not applied.  All conversions below are
independent of the session time zone except the one documented case: an offset
left in the text after stripping is applied (instant -> session-zone wall clock),
as the reference's parser did.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
POSITIVE_OFFSET_OR_Z = r"(\+\d{2}:\d{2}|Z)$"
ANY_OFFSET_OR_Z = r"([+-]\d{2}:\d{2}|Z)$"


def epoch_seconds_to_ntz(c: Column) -> Column:
    return F.timestamp_add("SECOND", c.cast("bigint"), F.expr(EPOCH_NTZ))


def ntz_to_epoch_seconds(c: Column) -> Column:
    return F.timestamp_diff("SECOND", F.expr(EPOCH_NTZ), c)


def strip_tz_suffix(c: Column, all_offsets: bool = False) -> Column:
    return F.regexp_replace(c, ANY_OFFSET_OR_Z if all_offsets else POSITIVE_OFFSET_OR_Z, "")


def parse_wall_clock(text: Column) -> Column:
    """ISO-ish text -> timestamp_ntz; malformed -> NULL (the reference's Spark 3 behaviour)."""
    has_offset = text.rlike(r"[+-]\d{2}:?\d{2}$")
    return (F.when(has_offset, F.try_to_timestamp(text).cast("timestamp_ntz"))
            .otherwise(text.try_cast("timestamp_ntz")))


def year_month(date_col: Column) -> Column:
    return F.date_format(date_col, "yyyy-MM")


def year_of(date_col: Column) -> Column:
    return F.year(date_col).cast("int")


def month_of(date_col: Column) -> Column:
    return F.month(date_col).cast("int")


def year_from_ym(ym: Column) -> Column:
    return F.substring(ym, 1, 4).cast("int")


def month_from_ym(ym: Column) -> Column:
    return F.substring(ym, 6, 2).cast("int")
