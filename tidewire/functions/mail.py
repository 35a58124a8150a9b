"""RFC 822 text to columns with built-in expressions only."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.text import SPACE_CLASS, strip

# The headers a raw message is read into.
HEADERS = (
    "Message-ID", "Date", "From", "To", "Subject", "Mime-Version", "Content-Type",
    "Content-Transfer-Encoding", "X-From", "X-To", "X-cc", "X-bcc", "X-Folder", "X-Origin",
    "X-FileName",
)

_EDGE = rf"[{SPACE_CLASS}&&[^\n]]*"


def header_block(message: Column) -> Column:
    """Everything before the first blank line; NULL for an empty message."""
    return F.substring_index(F.when(message != "", message), "\n\n", 1)


def raw_header(block: Column, name: str) -> Column:
    """Colon and value of the last line whose text before its first colon is ``name``.

    The colon is kept, so a present but empty header (':') is told apart from none ('').
    """
    line = rf"(?sU)^(?:.*\n)?{_EDGE}{re.escape(name)}{_EDGE}(:[^\n]*)"
    return F.regexp_extract(block, line, 1)


def header_value(raw: Column) -> Column:
    """Stripped value of a raw header, NULL when the header is missing."""
    return F.when(raw != "", strip(F.substr(raw, F.lit(2))))


def message_body(message: Column) -> Column:
    """Stripped text after the first blank line, '' without one, NULL for no message."""
    at = F.instr(message, "\n\n")
    return F.when(at > 0, strip(F.substr(message, at + 2))).when(message != "", "")


def mail_instant(value: Column) -> Column:
    """Timestamp of an RFC 2822 date, or of any text the plain cast reads; else NULL."""
    bare = F.regexp_replace(value, r"^[A-Za-z]{3},\s*|\s*\([^)]*\)\s*$", "")
    return F.coalesce(
        F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(value)
    )
