"""Parsing and formatting of points in time. Everything is UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from syncspark.functions.paths import path_type, put_path, struct_path
from syncspark.functions.text import is_blank

# Fixed format names of the configuration.
MILLISECOND_EPOCH = "{millisecondEpoch}"
UNIX_EPOCH = "{unixEpoch}"

_WHOLE_NUMBER = r"^[+-]?[0-9]+\z"
_ISO_SHAPE = r"^[0-9]{4,}(-[0-9]{1,2}){0,2}(T\S*)?\z"


def _epoch_number(value: Column) -> Column:
    return F.when(value.rlike(_WHOLE_NUMBER), value.try_cast("bigint"))


def parse_iso(value: Column) -> Column:
    """ISO date or date-time to a timestamp; blank or unreadable text is null."""
    return F.when(value.rlike(_ISO_SHAPE), value.try_cast("timestamp"))


def _spark_pattern(pattern: str) -> str:
    """Year-of-era letters of the configuration's patterns as Spark spells them."""
    pieces = pattern.split("'")
    pieces[::2] = [piece.replace("Y", "y") for piece in pieces[::2]]
    return "'".join(pieces)


def parse_datetime(value: Column, fmt: str | None = None, strict: bool = False) -> Column:
    """Text to timestamp by a named or pattern format; without one, epoch millis or ISO."""
    if fmt is None or not fmt.strip():
        parsed = F.coalesce(F.timestamp_millis(_epoch_number(value)), parse_iso(value))
    elif fmt == MILLISECOND_EPOCH:
        parsed = F.timestamp_millis(_epoch_number(value))
    elif fmt == UNIX_EPOCH:
        parsed = F.timestamp_seconds(_epoch_number(value))
    else:
        parsed = F.try_to_timestamp(value, F.lit(_spark_pattern(fmt)))
    if not strict:
        return parsed
    bad = value.isNotNull() & ~is_blank(value) & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("date not recognized: "), value))).otherwise(parsed)


def format_iso(ts: Column) -> Column:
    """ISO text with unpadded milliseconds, e.g. ``2012-08-14T12:00:00.0+0000``."""
    ts = ts.cast("timestamp")
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss."),
        F.pmod(F.unix_millis(ts), F.lit(1000)).cast("string"),
        F.date_format(ts, "xx"),
    )


def format_datetime(ts: Column, fmt: str | None = None) -> Column:
    ts = ts.cast("timestamp")
    if fmt is None or not fmt.strip():
        return format_iso(ts)
    if fmt == MILLISECOND_EPOCH:
        return F.unix_millis(ts).cast("string")
    if fmt == UNIX_EPOCH:
        return (F.unix_millis(ts) / 1000).cast("bigint").cast("string")
    return F.date_format(ts, _spark_pattern(fmt))


def round_to_minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def parse_iso_minute(value: Column) -> Column:
    return round_to_minute(parse_iso(value))


# English month names and zone offsets of mail-style dates, in hours.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
ZONE_HOURS = {
    "gmt": 0, "utc": 0, "ut": 0, "z": 0,
    "est": -5, "edt": -4, "cst": -6, "cdt": -5,
    "mst": -7, "mdt": -6, "pst": -8, "pdt": -7,
}

_W3C = (
    r"^\s*([0-9]+)-([0-9]+)-([0-9]+)"
    r"(?:T\s*([0-9]+):\s*([0-9]+)(?::\s*([0-9]+))?[+-][0-9]+:00)?"
)
_MAIL = (
    r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*, *([0-9]+) (jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]* +"
    r"([0-9]+) +([0-9]+):([0-9]+):([0-9]+) +(?:(?:gmt)?([+-])([0-9]{1,2}):?([0-9]{2})|([a-z]{1,3}))"
)


def _calendar(year: Column, month: Column, day: Column, seconds: Column) -> Column:
    """Lenient calendar arithmetic: month 13 is January of the next year."""
    first = F.make_date(year, F.lit(1), F.lit(1))
    date = F.date_add(F.add_months(first, month - 1), day - 1)
    return F.timestamp_seconds(F.unix_seconds(date.cast("timestamp")) + seconds)


def sitemap_lastmod(value: Column) -> Column:
    """First date format that matches the start of the text, else null.

    A W3C zone is read only when it has whole hours and then ignored; any other
    time part leaves the plain date. Mail-style dates honour their zone.
    """

    def part(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(value, pattern, group), F.lit("")).try_cast("int")

    w3c = _calendar(
        part(_W3C, 1),
        part(_W3C, 2),
        part(_W3C, 3),
        F.coalesce(part(_W3C, 4), F.lit(0)) * 3600
        + F.coalesce(part(_W3C, 5), F.lit(0)) * 60
        + F.coalesce(part(_W3C, 6), F.lit(0)),
    )
    month = F.array_position(
        F.array(*[F.lit(name) for name in MONTHS]), F.lower(F.regexp_extract(value, _MAIL, 2))
    ).cast("int")
    zone_name = F.lower(F.regexp_extract(value, _MAIL, 10))
    named = F.create_map(*[F.lit(item) for pair in ZONE_HOURS.items() for item in pair])[zone_name] * 3600
    sign = F.when(F.regexp_extract(value, _MAIL, 7) == "-", -1).otherwise(1)
    numeric = sign * (part(_MAIL, 8) * 3600 + part(_MAIL, 9) * 60)
    mail = _calendar(
        part(_MAIL, 3),
        month,
        part(_MAIL, 1),
        part(_MAIL, 4) * 3600
        + part(_MAIL, 5) * 60
        + part(_MAIL, 6)
        - F.coalesce(numeric, named),
    )
    return F.when(value.rlike(_MAIL), mail).when(value.rlike(_W3C), w3c)


def long_to_iso(df: DataFrame, source_field: str, target_field: str | None = None) -> DataFrame:
    """Preprocessor: epoch milliseconds of one field as ISO text in the same or another field."""
    if path_type(df.schema, source_field) is None:
        return df
    number = struct_path(df.schema, source_field).try_cast("bigint")
    return put_path(df, target_field or source_field, format_iso(F.timestamp_millis(number)))
