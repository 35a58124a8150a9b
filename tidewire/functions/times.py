"""Message clocks: epoch strings, chat export stamps and ISO text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_text_instant(value: Column) -> Column:
    """'1704067200.000100' to a timestamp, exact to the microsecond; other text to NULL."""
    micros = value.try_cast("decimal(20,6)") * F.lit(1_000_000)
    return F.timestamp_micros(micros.try_cast("bigint"))


def chat_instant(value: Column) -> Column:
    """'1/5/24, 9:05 AM' or the four-digit-year form to a timestamp; other text to NULL."""
    return F.coalesce(
        F.try_to_timestamp(value, F.lit("M/d/yy, h:mm a")),
        F.try_to_timestamp(value, F.lit("M/d/yyyy, h:mm a")),
    )


def message_instant(value: Column) -> Column:
    """Clock text of any channel to a timestamp: epoch seconds, a chat stamp, or ISO text, which
    starts with a four-digit year; other text to NULL."""
    iso = F.when(value.rlike(r"^\s*[0-9]{4}-"), F.try_to_timestamp(F.trim(value)))
    return F.coalesce(epoch_text_instant(value), chat_instant(value), iso)
