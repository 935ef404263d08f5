"""Time conversions. The session time zone must be UTC."""

from pyspark.sql import Column, functions as F

# Fixed value: the text form of every event time.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def to_iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def iso_from_millis(ms: Column) -> Column:
    """Epoch milliseconds to ISO text, cut to whole seconds."""
    return to_iso(F.timestamp_millis(ms))


def iso_utc(text: Column) -> Column:
    """ISO-8601 text with any offset to UTC ISO text; unreadable or empty gives NULL."""
    return to_iso(F.try_to_timestamp(text))


def parse_iso(text: Column) -> Column:
    """ISO text in the one fixed format to a timestamp; anything else gives NULL."""
    return F.try_to_timestamp(text, F.lit(ISO_FORMAT))
