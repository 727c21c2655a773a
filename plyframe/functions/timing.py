"""Clock texts, calendar ages, time zones and durations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

CLOCK = r"\d+:\d+:\d+(\.\d+)?"
DAY = 86400
MONTH = 30 * DAY
YEAR = 31557600  # 365.25 days


def clock_seconds(text: Column) -> Column:
    """Seconds of the first ``H:MM:SS(.f)`` in ``text`` (hours may pass 24); NULL if none."""
    clock = F.split(F.nullif(F.regexp_extract(text, CLOCK, 0), F.lit("")), ":")
    return (
        clock[0].cast("double") * 3600 + clock[1].cast("double") * 60 + clock[2].cast("double")
    )


def clocks_seconds(texts: Column) -> Column:
    """``clock_seconds`` of every text of a list.

    The functions of a list are interpreted, without shared parts: each step is a list of its own, so that a
    text is searched and cut once.
    """
    found = F.transform(texts, lambda x: F.regexp_extract(x, CLOCK, 0))
    parts = F.transform(found, lambda x: F.split(x, ":"))
    seconds = lambda p: p[0].cast("double") * 3600 + p[1].cast("double") * 60 + p[2].cast("double")
    return F.transform(parts, lambda p: F.when(F.size(p) == 3, seconds(p)))


@dataclass(frozen=True)
class Age:
    """Field-wise difference of two timestamps, each field with the sign of the whole."""

    plain: Column  # ordinary difference in seconds
    months: Column
    days: Column
    seconds: Column

    def _short(self) -> Column:
        """Under 28 days no month passes; most ages end here and skip the calendar."""
        return F.abs(self.plain) < 28 * DAY

    def total_seconds(self) -> Column:
        """A month counts 30 days, twelve of them 365.25 days."""
        months = F.abs(self.months)
        length = F.floor(months / 12) * YEAR + (months % 12) * MONTH + F.abs(self.days) * DAY
        calendar = F.signum(self.plain) * (length + F.abs(self.seconds))
        return F.when(self._short(), self.plain).otherwise(calendar)


def calendar_age(end: Column, start: Column) -> Age:
    """Months, days and seconds between two timestamps.

    A negative time of day borrows a day, a negative day borrows the length of the
    earlier timestamp's month.
    """

    def of_day(ts: Column) -> Column:
        return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts).cast("double")

    late, early = F.greatest(end, start), F.least(end, start)
    sign = F.when(end < start, -1).when(end >= start, 1)
    seconds = of_day(late) - of_day(early)
    borrow_day = (seconds < 0).cast("int")
    days = F.day(late) - F.day(early) - borrow_day
    borrow_month = (days < 0).cast("int")
    months = (F.year(late) - F.year(early)) * 12 + F.month(late) - F.month(early) - borrow_month
    return Age(
        F.datediff(end, start) * float(DAY) + of_day(end) - of_day(start),
        sign * months,
        sign * (days + borrow_month * F.day(F.last_day(early))),
        sign * (seconds + borrow_day * DAY),
    )


def dotted_date(text: Column, strict: bool = True) -> Column:
    """Date from ``YYYY.MM.DD``; malformed text fails the query, or is NULL if not strict."""
    dashed = F.replace(text, F.lit("."), F.lit("-"))
    return dashed.cast("date") if strict else dashed.try_cast("date")


def timestamp_from(date: Column, time: Column, strict: bool = True) -> Column:
    text = F.concat_ws(" ", date.cast("string"), time)
    return text.cast("timestamp_ntz") if strict else text.try_cast("timestamp_ntz")


def in_zone(naive_utc: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` (daylight saving included) of a naive UTC timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), naive_utc)


def weekday_number(ts: Column) -> Column:
    """0 = Sunday."""
    return F.dayofweek(ts) - 1


def weekday_name(number: Column) -> Column:
    name = F.when(number == 0, WEEKDAYS[0])
    for day in range(1, 7):
        name = name.when(number == day, WEEKDAYS[day])
    return name.otherwise("Unknown")


def duration_text(seconds: Column) -> Column:
    """``[D day(s), ]H:MM:SS`` of a number of seconds, fraction cut off."""
    whole = F.floor(seconds)
    days = F.floor(whole / DAY)
    rest = whole - days * DAY
    clock = F.format_string(
        "%d:%02d:%02d", F.floor(rest / 3600), F.floor(rest % 3600 / 60), rest % 60
    )
    return F.when(days == 0, clock).otherwise(
        F.concat(
            days.cast("string"),
            F.when(F.abs(days) == 1, F.lit(" day, ")).otherwise(F.lit(" days, ")),
            clock,
        )
    )
