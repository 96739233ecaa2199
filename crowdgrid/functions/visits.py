"""Masking, time, coordinate and text expressions on one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layout of date_visit, and the calendar range that layout can hold.
DATE_VISIT_FORMAT = "yyyy-MM-dd HH:mm:ss"
FIRST_EPOCH = -62135596800  # 0001-01-01 00:00:00
LAST_EPOCH = 253402300799  # 9999-12-31 23:59:59

# Marker colours and popup texts shown to the user.
RED_WAVE_COLOR = "red"
NORMAL_COLOR = "blue"
RED_WAVE_POPUP = "ALERT! Red Wave - %d pings at this location, Date: %s, Hour: %d"
NORMAL_POPUP = "Ping Count: %d, Date: %s, Hour: %d"
JOURNEY_POPUP = "<b>Device ID:</b> %s<br><b>Date:</b> %s<br>"


def mask_device_id(device_id: Column, substitution: tuple[str, str] | None = None) -> Column:
    """SHA-256 as lowercase hex; NULL stays NULL.

    ``substitution`` is an optional (from, to) alphabet applied before hashing.
    """
    if substitution is not None:
        device_id = F.translate(device_id, *substitution)
    return F.sha2(device_id, 256)


def number(value: Column) -> Column:
    """Text to double; malformed text becomes NULL, also under ANSI."""
    return value.try_cast("double")


def epoch_to_text(epoch: Column) -> Column:
    """Epoch seconds, floored, as text in UTC; NULL for anything outside years 1 to 9999.

    The session's time zone plays no part.
    """
    seconds = number(epoch)
    in_calendar = (seconds >= float(FIRST_EPOCH)) & (seconds < float(LAST_EPOCH + 1))
    days = F.floor(seconds / 86400)
    rest = F.floor(seconds) - days * 86400
    since = F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), rest.cast("decimal(18,6)"))
    return F.when(in_calendar, (F.lit("1970-01-01").cast("timestamp_ntz") + since).cast("string"))


def valid_position(lat: Column, lon: Column) -> Column:
    """Both coordinates present and on the globe; NaN is greater than any bound in Spark."""
    return (F.abs(lat) <= 90.0) & (F.abs(lon) <= 180.0)


def visit_time(date_visit: Column) -> Column:
    return date_visit.try_cast("timestamp_ntz")


def marker_color(red_wave: Column) -> Column:
    return F.when(red_wave, F.lit(RED_WAVE_COLOR)).otherwise(F.lit(NORMAL_COLOR))


def heat_popup(red_wave: Column, pings: Column, date: Column, hour: Column) -> Column:
    day = date.cast("string")
    return F.when(red_wave, F.format_string(RED_WAVE_POPUP, pings, day, hour)).otherwise(
        F.format_string(NORMAL_POPUP, pings, day, hour)
    )


def journey_popup(device_id: Column, date_visit: Column) -> Column:
    shown = (F.coalesce(c, F.lit("None")) for c in (device_id, date_visit))
    return F.format_string(JOURNEY_POPUP, *shown)
