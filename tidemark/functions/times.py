"""Date keys, clock texts and epoch columns."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STORE_ZONE = "America/Los_Angeles"


def clock(now: Column | datetime | str | None = None) -> Column:
    """``now`` as a timestamp column; the query's own start time when not given."""
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    return F.lit(str(now) if isinstance(now, str) else now).cast("timestamp")


def date_key(ts: Column) -> Column:
    """yyyyMMdd as an int, by arithmetic: no formatter and no text per row."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def time_key_minutes(ts: Column) -> Column:
    """HHmm as an int."""
    return F.hour(ts) * 100 + F.minute(ts)


def time_key_seconds(ts: Column) -> Column:
    """HHmmss as an int."""
    return time_key_minutes(ts) * 100 + F.second(ts)


def epoch_millis(column: Column) -> Column:
    """Milliseconds since 1970 as a timestamp of whole seconds."""
    return F.timestamp_seconds(F.floor(column.cast("bigint") / 1000))


def epoch_to_timestamp(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: epoch_millis(F.col(c)) for c in columns})


TWELVE_HOUR = "(?i)^(0[1-9]|1[0-2]):[0-5][0-9] [ap]m$"


def twelve_hour(day: Column, text: Column) -> Column:
    """A date and a ``hh:mm am`` text as a local timestamp; null when malformed.

    12 am is midnight and 12 pm is noon.  The time is added to the date as
    seconds, which costs a tenth of parsing the joined text with a pattern.
    """
    clean = F.trim(text)
    afternoon = F.lower(F.substring(clean, 7, 1)) == "p"
    hour = F.substring(clean, 1, 2).cast("int") % 12 + F.when(afternoon, 12).otherwise(0)
    minute = F.substring(clean, 4, 2).cast("int")
    seconds = F.unix_date(day.cast("date")).cast("bigint") * 86400 + hour * 3600 + minute * 60
    return F.when(clean.rlike(TWELVE_HOUR), F.timestamp_seconds(seconds))


def to_utc(local: Column, zone: str = STORE_ZONE) -> Column:
    return F.to_utc_timestamp(local, zone)


def load_stamp(now: Column, user: str) -> dict[str, Column]:
    """The six load columns of a silver or gold row."""
    return {
        "rec_create_timestamp": now,
        "rec_create_user_name": F.lit(user),
        "rec_update_timestamp": now,
        "rec_update_user_name": F.lit(user),
        "rec_create_date_key": date_key(now),
        "rec_create_time_key": time_key_minutes(now),
    }
