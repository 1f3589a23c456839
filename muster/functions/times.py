"""Times of day, durations and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from muster.functions.numbers import whole_div

# Fixed value: the zone in which run times are shown.
ZONE = "Africa/Dar_es_Salaam"


def local_time(utc: Column, zone: str = ZONE) -> Column:
    """A zone-less UTC timestamp as ``yyyy-MM-dd HH:mm:ss`` in ``zone``."""
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc), "yyyy-MM-dd HH:mm:ss")


def hms(seconds: Column) -> Column:
    """Whole seconds as ``HH:MM:SS``; a day or more wraps round."""
    return F.format_string(
        "%02d:%02d:%02d",
        whole_div(seconds, 3600) % 24,
        whole_div(seconds, 60) % 60,
        seconds % 60,
    )


def duration_hundredths(duration_us: Column) -> Column:
    """Microseconds as seconds rounded to two places, in hundredths of a second."""
    return whole_div(duration_us + 5_000, 10_000)


def rate_hundredths(count: Column, duration_x100: Column, unit_seconds: int = 1) -> Column:
    """Count per unit in hundredths, from hundredths of a second, rounded half up in exact arithmetic."""
    doubled = count.cast("decimal(18,0)") * F.lit(20_000 * unit_seconds).cast("decimal(18,0)")
    width = duration_x100.cast("decimal(18,0)")
    exact = whole_div(doubled + width, F.lit(2).cast("decimal(1,0)") * width)
    return F.when(duration_x100 > 0, exact).otherwise(F.lit(0).cast("long"))
