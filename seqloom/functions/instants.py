"""ISO-8601 instants kept in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(text: Column) -> Column:
    """Timestamp of an ISO-8601 text; a text without zone means UTC.

    Works alike in every session time zone. Null for null and unreadable texts.
    """
    text = F.trim(text)
    zoned = F.upper(F.right(text, F.lit(1))).eqNullSafe("Z") | F.substring(text, -6, 1).isin("+", "-") | (
        F.substring(text, -5, 1).isin("+", "-") & (F.length(text) > 19)
    )
    # a bare date ends in -MM-DD, which looks like a zone, and means midnight
    whole = F.when(F.length(text) > 10, F.when(zoned, text).otherwise(F.concat(text, F.lit("Z")))).when(F.length(text) == 10, F.concat(text, F.lit(" 00:00:00Z")))
    return whole.try_cast("timestamp")


def instant_micros(text: Column) -> Column:
    """The instant as microseconds since 1970, as a long."""
    return F.unix_micros(instant(text))
