"""Lead times, forecast days, local-solar offsets and calendar days."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hours of the four samples that complete one forecast day.
SAMPLE_HOURS = (6, 12, 18, 24)
# Fixed value: local-solar products use forecast days 0 to 14.
MAX_LOCAL_DAYS = 15
DAYS_IN_CALENDAR = 366

# Years that a store name may begin a date with.
CENTURIES = ("19", "20")


def day_list(days: int | Iterable[int]) -> list[int]:
    """Completed forecast days, counted from 1: whole, positive, at least one, each once."""
    listed = [days] if isinstance(days, int) else [*days]
    good = {d for d in listed if type(d) is int and d > 0}
    if not listed or len(good) < len(listed):
        raise ValueError(f"forecast days must be different whole numbers from 1 on, not {listed}")
    return listed


def hours(count: Column | int) -> Column:
    """A day-time interval of whole hours."""
    column = F.lit(count) if isinstance(count, int) else count
    return F.make_dt_interval(F.lit(0), column.cast("int"))


def valid_time(init: Column, lead_hours: Column) -> Column:
    return init + hours(lead_hours)


def utc_forecast_day(lead_hours: Column) -> Column:
    """1-based completed day: leads 6-24 h are day 1, 30-48 h day 2."""
    return F.ceil(lead_hours / 24).cast("int")


def sample_leads(day: Column) -> Column:
    """The four leads, in hours, of a completed forecast day."""
    return F.transform(F.array(*[F.lit(h) for h in SAMPLE_HOURS]), lambda h: (day - 1) * 24 + h)


def daily_lead(day: Column) -> Column:
    """End-of-day lead, in hours, of a daily total."""
    return day * 24


def lead_window(day: Column, first_hour: int) -> tuple[Column, Column]:
    """First and last lead hour covered by a completed forecast day."""
    return (day - 1) * 24 + F.lit(first_hour), day * 24


def utc_offset_hours(longitude: Column) -> Column:
    """Six-hour local-solar offset of a longitude in either convention; bands are half-open.

    From -180: -12 up to -135, then steps of six hours every 90 degrees, +12 from 135.
    """
    east = F.pmod(longitude + 180.0, F.lit(360.0))
    return (6 * (F.floor((east + 45.0) / 90.0) - 2)).cast("int")


def first_local_date(init: Column, first_lead: Column | int, offset: Column) -> Column:
    """Date of the first local midnight on the lead axis."""
    start = init + hours(offset + first_lead)
    return F.to_date(start + hours(F.pmod(24 - F.hour(start), F.lit(24))))


def bucket_end(ts: Column, width_hours: int = 6) -> Column:
    """End of the right-closed bucket (T - width, T] that holds a timestamp."""
    before = ts - F.expr("interval 1 microsecond")
    into = F.make_dt_interval(
        F.lit(0), (F.hour(before) % width_hours).cast("int"), F.minute(before), F.date_part(F.lit("SECOND"), before)
    )
    return before - into + hours(width_hours)


def bucket_start(ts: Column, width_hours: int = 6) -> Column:
    """Start of the left-closed bucket [T, T + width) that holds a timestamp."""
    return ts - F.make_dt_interval(
        F.lit(0), (F.hour(ts) % width_hours).cast("int"), F.minute(ts), F.date_part(F.lit("SECOND"), ts)
    )


def utc_instant(wall: Column) -> Column:
    """The instant at which UTC clocks show a wall time, whatever the session's zone."""
    days = F.datediff(F.to_date(wall), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = days * 86400 + F.hour(wall) * 3600 + F.minute(wall) * 60
    return F.timestamp_micros(seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), wall) * 1_000_000).cast("long"))


def utc_wall_time(instant: Column) -> Column:
    """UTC wall time of an instant, to the second."""
    seconds = F.unix_seconds(instant).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def circular_day_distance(a: Column, b: Column) -> Column:
    """Days between two calendar days on a 366-day circle."""
    return F.abs(F.pmod(a - b + 183, F.lit(DAYS_IN_CALENDAR)) - 183)


def window_offsets(radius: int) -> Column:
    """One row per day offset of a centred window.

    The array is constant and the target day is computed after the explode: an exploded
    expression of the row would be turned into a filter and evaluated again down at the scan.
    """
    return F.explode(F.array(*[F.lit(k) for k in range(-radius, radius + 1)]))


def circular_day(doy: Column, offset: Column) -> Column:
    """Calendar day ``offset`` days on, on the 366-day circle."""
    return (F.pmod(doy - 1 + offset, F.lit(DAYS_IN_CALENDAR)) + 1).cast("int")


def is_leap(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def store_year_month(name: Column) -> Column:
    """``struct(year, month)`` of the date in a store name; NULL without one.

    Dates are YYYY-MM-DD or YYYY_MM_DD, YYYYMMDD, YYYY-MM or YYYY_MM, YYYYMM; a form earlier in this list
    wins wherever it stands. One expression takes the name apart for all of them: the separator and the
    day of each form may or may not be there.
    """
    digits = f"((?:{'|'.join(CENTURIES)})\\d\\d)"

    def form(separator: str, day: str) -> Column:
        found = F.regexp_extract_all(name, F.lit(f"{digits}{separator}(0[1-9]|1[0-2]){day}"), F.lit(0))
        numbers = F.regexp_replace(F.try_element_at(found, F.lit(1)), "\\D", "")
        year, month = (F.substring(numbers, *part).cast("int") for part in ((1, 4), (5, 2)))
        return F.when(F.size(found) > 0, F.struct(year.alias("year"), month.alias("month")))

    return F.coalesce(form("[-_]", "[-_]\\d\\d"), form("", "\\d\\d"), form("[-_]", ""), form("", ""))


def celsius_threshold(value: float, unit: str) -> float:
    """A Celsius threshold in the unit of the data."""
    return value + 273.15 if unit == "K" else value


def millimetre_threshold(value: float, unit: str) -> float:
    return value / 1000.0 if unit == "m" else value


def kelvin_to_celsius(value: Column) -> Column:
    return value - 273.15
