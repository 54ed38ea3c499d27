"""Instants, wall-clock times and hour numbers.

An instant is a TIMESTAMP; a wall time is a TIMESTAMP_NTZ. None of the helpers
depends on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
_USUAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?"
_OFFSET = r"(?:Z|[+-]\d{2}:\d{2})$"
_DATE = r"^(\d{4})-?(\d{2})-?(\d{2})"
_CLOCK = r"(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?)?"
_ZONE = r"\s*(?:([Zz]|UTC|GMT)|([+-])(\d{2}):?(\d{2})?)?$"
_ISO = _DATE + _CLOCK + _ZONE
_YEAR = r"^[+-]?\d{4,6}(?:-|$)"


def parse_instant(text: Column) -> Column:
    """ISO-8601 text to an instant; no offset means UTC; unparsable means null.

    Extended and basic forms, with or without seconds, fractions cut to microseconds, offsets with
    or without minutes, and the zone names Z, UTC and GMT. Other texts that begin with a year are tried as they
    stand; a clock time alone is no instant, it would be one of the day of the run.
    """
    text = F.trim(text)
    part = lambda i: F.regexp_extract(text, _ISO, i)
    or_zero = lambda c: F.when(c == "", F.lit("00")).otherwise(c)
    fraction = F.rpad(F.substring(part(7), 1, 6), 6, "0")
    zone = F.when(part(9) == "", F.lit("+00:00")).otherwise(F.concat(part(9), part(10), F.lit(":"), or_zero(part(11))))
    spelled = F.concat(
        part(1), F.lit("-"), part(2), F.lit("-"), part(3), F.lit("T"), or_zero(part(4)), F.lit(":"),
        or_zero(part(5)), F.lit(":"), or_zero(part(6)), F.lit("."), fraction, zone,
    )
    # The usual spellings cost one match each; only others are taken apart.
    usual = F.when(text.rlike(_USUAL + _OFFSET), text).when(text.rlike(_USUAL + "$"), F.concat(text, F.lit("Z")))
    return F.try_to_timestamp(usual.when(text.rlike(_ISO), spelled).when(text.rlike(_YEAR), text))


def instant_of(col: Column, dtype: T.DataType) -> Column:
    """Any accepted timestamp representation as an instant."""
    if isinstance(dtype, T.TimestampType):
        return col
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), col))
    if isinstance(dtype, T.DateType):
        return instant_of(col.cast("timestamp_ntz"), T.TimestampNTZType())
    return parse_instant(col.cast("string"))


def wall_time(instant: Column, zone: str) -> Column:
    """The wall-clock time of an instant in ``zone``.

    The shift is done on the instant, where a literal zone is resolved once rather than per row.
    """
    shifted = instant if zone == "UTC" else F.from_utc_timestamp(instant, zone)
    return F.timestamp_add("MICROSECOND", F.unix_micros(shifted), F.expr(_EPOCH))


def iso_in_zone(instant: Column, zone: str) -> Column:
    """ISO-8601 text in ``zone`` with its offset; microseconds only when present."""
    wall = wall_time(instant, zone)
    utc = wall_time(instant, "UTC")
    minutes = F.timestamp_diff("MINUTE", utc, wall)
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    size = F.abs(minutes)
    offset = F.concat(
        sign,
        F.lpad(F.floor(size / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((size % 60).cast("string"), 2, "0"),
    )
    fraction = F.date_format(wall, ".SSSSSS")
    return F.concat(
        F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == ".000000", F.lit("")).otherwise(fraction),
        offset,
    )


def hour_index(wall: Column) -> Column:
    """Whole hours since 1970 of a wall time; plain integers, so gaps are arithmetic."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), wall)
    hour = F.lit(3_600_000_000)
    return F.call_function("div", micros - F.pmod(micros, hour), hour)


def hour_start(index: Column) -> Column:
    """The wall time at which an hour number begins."""
    return F.timestamp_add("HOUR", index, F.expr(_EPOCH))


def day_of_hour(index: Column) -> Column:
    """The day number an hour number falls in."""
    return F.call_function("div", index - F.pmod(index, F.lit(24)), F.lit(24))
