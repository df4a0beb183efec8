"""Expressions for market payloads: lenient numbers, exchange clocks, stable JSON, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The exchange clock, its "never traded" marker and its two formats.
EXCHANGE_ZONE = "Asia/Kolkata"
NEVER = "01/01/1980 00:00:00"
CLOCK_FORMATS = ("d/M/yyyy H:m:s", "yyyy-M-d H:m:s")
CLOCK_FORMS = (r"^\d{1,2}/\d{1,2}/\d+ ", r"^[+-]?\d+-\d{1,2}-\d{1,2} ")


def fields(document: Column | str, path: str, types: str) -> Column:
    """The part at a JSON path as a typed value, e.g. a struct, read in one go.

    Lenient: what is absent or does not fit its type is null, down to single fields. A
    fractional number is truncated for a bigint, fractional text is null.
    """
    return F.try_variant_get(document, path, types)


def stable_json(part: Column) -> Column:
    """Compact JSON with sorted keys of a VARIANT; null when absent or null."""
    # The text is used once: inside a lambda each use would write it again.
    return F.to_json(F.when(~F.is_variant_null(part), part))


def normalise_json(document: Column | str) -> Column:
    """A JSON text with sorted keys and without blanks."""
    return F.to_json(F.parse_json(document))


def exchange_time(value: Column, received_at: Column, local: bool) -> Column:
    """Exchange time as a UTC instant.

    A full date and time is on the exchange clock when ``local``, else UTC. A bare time
    belongs to the UTC day of receipt. Unreadable values and the marker are null.
    """
    raw = F.trim(value)
    raw = F.when((value != NEVER) & (raw != ""), raw)
    # A format is tried only on texts of its form: a failed attempt costs an exception.
    stamp = F.coalesce(*(
        F.when(raw.rlike(form), F.try_to_timestamp(raw, F.lit(f))) for f, form in zip(CLOCK_FORMATS, CLOCK_FORMS)))
    if local:
        stamp = F.to_utc_timestamp(stamp, EXCHANGE_ZONE)
    clock = F.when(raw.rlike(r"^\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?$"), F.translate(raw, ",", "."))
    # try_cast: 99:99 has the form of a time but is none.
    today = F.concat_ws(" ", F.date_format(received_at, "yyyy-MM-dd"), clock).try_cast("timestamp")
    return F.coalesce(stamp, F.when(clock.isNotNull(), today))


def trading_date(exchange: Column, received_at: Column) -> Column:
    """Calendar day at the exchange, by exchange time or else by time of receipt."""
    return F.to_date(F.from_utc_timestamp(F.coalesce(exchange, received_at), EXCHANGE_ZONE))


def run_date(instant: Column, zone: str) -> Column:
    """Calendar day of an instant in a time zone."""
    return F.to_date(F.from_utc_timestamp(instant, zone))


def event_id(*parts: Column) -> Column:
    """An id that is the same whenever the same record is read again."""
    return F.sha2(F.concat_ws(":", *(part.cast("string") for part in parts)), 256)


def iso_utc(instant: Column) -> Column:
    """ISO text with a Z, and with a fraction only when there is one."""
    whole_second = F.date_trunc("second", instant) == instant
    return F.when(whole_second, F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
        F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
