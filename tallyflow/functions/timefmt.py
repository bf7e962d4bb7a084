"""Dates and times.  All text uses the session time zone, the one zone setting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAMP = "yyyy-MM-dd HH:mm:ss"
DAY = "yyyy-MM-dd"


def at(ms: Column | str) -> Column:
    """Epoch milliseconds to timestamp."""
    return F.timestamp_millis(F.col(ms) if isinstance(ms, str) else ms)


def parse_stamp(text: Column | str) -> Column:
    """`yyyy-MM-dd HH:mm:ss` (or any ISO form) to timestamp; bad text is NULL."""
    return (F.col(text) if isinstance(text, str) else text).try_cast("timestamp")


def to_ms(text: Column | str) -> Column:
    return F.unix_millis(parse_stamp(text))


def stamp_text(ts: Column | str) -> Column:
    return F.date_format(ts, STAMP)


def day_text(ts: Column | str) -> Column:
    return F.date_format(ts, DAY)


def date_id(text: Column | str) -> Column:
    """Day of a date-time text."""
    return F.date_format(parse_stamp(text), DAY)


def leading_day(text: Column | str) -> Column:
    """The part of a date-time text before the blank, taken as the day."""
    return F.substring_index(text, " ", 1)


def compact_day(day: int | str) -> tuple[str, str]:
    """`yyyyMMdd` to the first and the first-not-included date-time text of the day."""
    import datetime as dt

    start = dt.datetime.strptime(str(day), "%Y%m%d")
    end = start + dt.timedelta(days=1)
    return start.strftime("%Y-%m-%d 00:00:00"), end.strftime("%Y-%m-%d 00:00:00")


def today() -> int:
    import datetime as dt

    return int(dt.date.today().strftime("%Y%m%d"))


def seconds(duration: str) -> int:
    """`'10 seconds'`, `'6 hours'`, ... to seconds."""
    number, unit = duration.split()
    sizes = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(number) * sizes[unit.rstrip("s")]


def watermarked(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """A watermark for streams, unless an operator before has set one already."""
    known = "spark.watermarkDelayMs" in df.schema[ts].metadata
    return df.withWatermark(ts, delay) if df.isStreaming and not known else df
