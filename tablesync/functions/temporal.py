"""Temporal values of a source database as text."""

from __future__ import annotations

import re
from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# fixed values: default text formats and zone
FORMATS = {
    "date": "yyyy-MM-dd",
    "time": "HH:mm:ss",
    "datetime": "yyyy-MM-dd HH:mm:ss",
    "timestamp": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}
ZONE = "UTC+8"


def date_text(col: Column, fmt: str = FORMATS["date"]) -> Column:
    """DATE value or day number since 1970-01-01."""
    return F.date_format(col, fmt)


def wall_clock_text(col: Column, fmt: str) -> Column:
    """A time without zone as text.

    ``date_format`` goes through the session zone, which moves times inside a clock change; with a zone that has clock
    changes the (slower) CSV writer formats them as they are.
    """
    if re.fullmatch(r"(?i)(etc/)?(utc|gmt|z)|(utc|gmt)?[+-]\d{1,2}(:?\d\d)?", SparkSession.active().conf.get("spark.sql.session.timeZone")):
        return F.date_format(col, fmt)
    text = F.to_csv(F.struct(col.alias("t")), {"timestampNTZFormat": fmt, "sep": "\x01", "quote": ""})
    return F.when(col.isNotNull(), text)


def utc_clock(micros: Column) -> Column:
    """Microseconds since the epoch as UTC time without zone, independent of the session zone."""
    day = F.floor(micros / F.lit(86400000000)).cast("int")
    rest = (F.pmod(micros, F.lit(86400000000)).cast("decimal(18,0)") / F.lit(1000000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(day, zero, zero, rest)


def temporal_text(col: Column, kind: str, dtype: str, fmt: str | None = None, zone: str = ZONE) -> Column:
    """One temporal column as text. ``kind`` is the source type: date, time, datetime, timestamp.

    Integers are days for ``date``, microseconds of the day for ``time`` and microseconds since the epoch otherwise.
    ``timestamp`` values are instants and are shown in ``zone``; ``datetime`` values have no zone.
    """
    fmt = fmt or FORMATS[kind]
    number = dtype in ("int", "bigint", "smallint", "tinyint")
    if kind == "date":
        return F.date_format(F.date_from_unix_date(col.cast("int")) if number else col, fmt)
    if kind == "time":
        if not number:
            raise ValueError("a time column holds microseconds of the day")
        return wall_clock_text(utc_clock(col.cast("bigint")), fmt)
    if kind == "datetime":
        return wall_clock_text(utc_clock(col.cast("bigint")) if number else col.cast("timestamp_ntz"), fmt)
    if number:
        wall = utc_clock(col.cast("bigint"))
    elif dtype == "timestamp_ntz":
        wall = col
    else:
        # an instant, or text with an offset such as 2024-01-01T00:00:00Z
        wall = utc_clock(F.unix_micros(col if dtype == "timestamp" else F.to_timestamp(col)))
    return wall_clock_text(F.convert_timezone(F.lit("UTC"), F.lit(_zone(zone)), wall), fmt)


# fixed values: encodings of temporal values in a change feed, and what one unit is in microseconds
ENCODINGS = {"date": None, "time": 1, "time_ms": 1000, "datetime": 1, "datetime_ms": 1000, "timestamp": 1, "timestamp_ms": 1000}


def encoded_text(col: Column, encoding: str, zone: str = ZONE) -> Column:
    """Text of a change feed's temporal value as text of the table.

    Whole numbers are days (``date``) or microseconds, with ``_ms`` milliseconds: of the day (``time``), or since the epoch
    (``datetime``, ``timestamp``). Text of a ``timestamp`` with an offset is an instant, shown in ``zone`` like its numbers; other text
    stays as it is. A number that names no time in the years 1 to 9999 stays a number, which no temporal column accepts.
    """
    if encoding not in ENCODINGS:
        raise ValueError(f"unknown encoding {encoding}")
    kind, unit = encoding.removesuffix("_ms"), ENCODINGS[encoding]
    number = col.try_cast("bigint")
    whole = col.rlike(r"\A[+-]?[0-9]{1,18}\z")
    if kind == "date":
        fits = whole & number.between(-719162, 2932896)
        return F.when(fits, temporal_text(F.when(fits, number), "date", "bigint")).otherwise(col)
    last = 86_399_999_999 if kind == "time" else 253_402_300_799_999_999
    first = 0 if kind == "time" else -62_135_596_800_000_000
    fits = whole & number.between(-(-first // unit), last // unit)
    fmt = FORMATS["time"] if kind == "time" else FORMATS["timestamp"]
    shown = temporal_text(F.when(fits, number * unit), kind, "bigint", fmt, zone)
    if kind == "timestamp":
        offset = col.rlike(r"(?i)[0-9](?:z|[+-][0-9]{2}(?::?[0-9]{2})?)\z") & ~whole & col.contains(":")
        instant = F.unix_micros(F.try_to_timestamp(F.when(offset, col)))
        return F.when(fits, shown).when(instant.isNotNull(), temporal_text(instant, kind, "bigint", fmt, zone)).otherwise(col)
    return F.when(fits, shown).otherwise(col)


def _zone(zone: str) -> str:
    """``UTC+8`` -> ``+08:00``; region names stay."""
    for prefix in ("UTC", "GMT"):
        if zone.startswith(prefix) and len(zone) > 3:
            sign, hours, _, minutes = zone[3], *zone[4:].partition(":")
            return f"{sign}{int(hours):02d}:{int(minutes or 0):02d}"
    return zone


def format_temporals(
    df: DataFrame, kinds: Mapping[str, str], formats: Mapping[str, str] | None = None, zone: str = ZONE
) -> DataFrame:
    """Replace the named columns by text; ``kinds`` maps column to source type, ``formats`` overrides :data:`FORMATS`."""
    chosen = {**FORMATS, **(formats or {})}
    types = dict(df.dtypes)
    return df.withColumns(
        {c: temporal_text(F.col(c), kind, types[c], chosen[kind], zone) for c, kind in kinds.items()}
    )
