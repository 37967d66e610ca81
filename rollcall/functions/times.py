"""Instants and dates at the edges: how they are written out, and read from documents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_instant(c: Column) -> Column:
    """A timestamp as ISO text in UTC without fractions of a second."""
    return F.concat(F.substring(F.to_utc_timestamp(c, F.current_timezone()).cast("string"), 1, 10), F.lit("T"), F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "HH:mm:ss"), F.lit("+00:00"))


def localised(local: Column, zone: Column) -> Column:
    """A local time (timestamp without zone) with its zone's offset as ISO text, fractions dropped."""
    utc = F.convert_timezone(zone, F.lit("UTC"), local)
    minutes = (F.unix_seconds(local.cast("string").cast("timestamp")) - F.unix_seconds(utc.cast("string").cast("timestamp"))) / 60
    size = F.abs(minutes).cast("int")
    offset = F.format_string("%s%02d:%02d", F.when(minutes < 0, "-").otherwise("+"), F.floor(size / 60), size % 60)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), offset)


def iso_day(c: Column) -> Column:
    """``YYYY-MM-DD`` of an ISO date or time; null if it is none."""
    day = F.substring(c, 1, 10)
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{3}(?:\d{3})?)?)?(?:[+-]\d{2}:\d{2}|Z)?)?\z") & day.try_cast("date").isNotNull(), day)
