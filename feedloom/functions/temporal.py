"""Time parsing and time features."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The timestamp layouts of the inputs.
STAMP = "yyyy-MM-dd HH:mm:ss"
ISO_STAMP = "yyyy-MM-dd'T'HH:mm:ss"
DAY_HOURS = (6, 18)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ingest_time(as_of: Column | None = None) -> Column:
    """The time a row is taken in: now, or a given time so that a run can be repeated."""
    return F.current_timestamp() if as_of is None else as_of


def parse_stamp(text: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to timestamp; anything else is NULL."""
    return F.try_to_timestamp(_col(text), F.lit(STAMP))


def parse_iso(text: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` text to timestamp; anything else is NULL."""
    return F.try_to_timestamp(_col(text), F.lit(ISO_STAMP))


def parse_free_iso(text: Column | str) -> Column:
    """ISO text with optional fraction and zone to timestamp; anything else is NULL."""
    return F.try_to_timestamp(_col(text))


def utc_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), STAMP)


def epoch_to_text(seconds: Column | str) -> Column:
    """Epoch seconds to UTC text; NULL and 0 both mean "no time"."""
    c = _col(seconds)
    return F.when(c != 0, utc_text(F.timestamp_seconds(c)))


def calendar_parts(ts: Column | str, prefix: str = "post_") -> dict[str, Column]:
    """Date, time, year, month, day and hour columns."""
    c = _col(ts)
    return {
        f"{prefix}date": F.to_date(c),
        f"{prefix}time": F.date_format(c, "HH:mm:ss"),
        f"{prefix}year": F.year(c),
        f"{prefix}month": F.month(c),
        f"{prefix}day": F.dayofmonth(c),
        f"{prefix}hour": F.hour(c),
    }


def weekday_sunday_one(ts: Column | str) -> Column:
    return F.dayofweek(_col(ts))


def weekday_monday_zero(ts: Column | str) -> Column:
    return F.weekday(_col(ts))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds between two times, in hours."""
    return (_seconds(end) - _seconds(start)) / 3600


def _seconds(ts: Column | str) -> Column:
    return F.unix_timestamp(_col(ts).cast("timestamp"))


def age_minutes(created: Column | str, as_of: Column) -> Column:
    """Minutes from ``created`` to ``as_of``, fractions kept."""
    return (F.unix_micros(as_of) - F.unix_micros(_col(created).cast("timestamp"))) / 60000000


def time_of_day(ts: Column | str) -> Column:
    """``day`` from 06:00 to before 18:00, else ``night``; NULL without a time."""
    hour = F.hour(_col(ts))
    return F.when((hour >= DAY_HOURS[0]) & (hour < DAY_HOURS[1]), "day").when(hour.isNotNull(), "night")


def closing_time(opening: Column | str, hours: Column) -> Column:
    """``HH:MM`` plus whole hours, wrapping at midnight."""
    c = _col(opening)
    minutes = (
        F.split_part(c, F.lit(":"), F.lit(1)).try_cast("int") * 60
        + F.split_part(c, F.lit(":"), F.lit(2)).try_cast("int")
        + hours * 60
    )
    wrapped = F.pmod(minutes, F.lit(1440))
    clock = F.format_string("%02d:%02d", F.floor(wrapped / 60), F.pmod(wrapped, F.lit(60)))
    return F.when(wrapped.isNotNull(), clock)


def iso_duration_minutes(text: Column | str) -> Column:
    """Minutes of a ``PT#H#M`` duration; either part may be absent. NULL without both, or if a part is too large."""
    pattern = r"^PT(?:([0-9]+)H)?(?:([0-9]+)M)?$"
    parts = [F.nullif(F.regexp_extract(_col(text), pattern, k), F.lit("")) for k in (1, 2)]
    hours, minutes = [F.when(p.isNull(), F.lit(0)).otherwise(p.try_cast("bigint")) for p in parts]
    return F.when(
        parts[0].isNotNull() | parts[1].isNotNull(), F.try_add(F.try_multiply(hours, F.lit(60)), minutes)
    )
