"""Scan clock: GPS seconds / UTC to New Zealand local time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NZ_ZONE = "Pacific/Auckland"
TEXT_FORMAT = "dd-MM-yyyy HH:mm:ss"


def gps_to_utc(seconds: Column) -> Column:
    """Seconds since 1970 to a zone-free UTC timestamp."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def nz_local(utc: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(NZ_ZONE), utc.cast("timestamp_ntz"))


def last_sunday_of_september(year: Column) -> Column:
    return F.next_day(F.make_date(year, F.lit(9), F.lit(23)), "Sun")


def nz_local_reference(utc: Column) -> Column:
    """Rule that adds 13 h only from the last September Sunday to the year's end."""
    utc = utc.cast("timestamp_ntz")
    start = last_sunday_of_september(F.year(utc)).cast("timestamp_ntz") + F.expr("INTERVAL '2' HOUR")
    return F.when(utc >= start, utc + F.expr("INTERVAL '13' HOUR")).otherwise(utc + F.expr("INTERVAL '12' HOUR"))


def clock_text(local: Column) -> Column:
    return F.date_format(local, TEXT_FORMAT)
