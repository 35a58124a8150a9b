"""Row predicates as filters."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.columns import named
from tidewire.functions.text import matches_email

# Words that mark a system line wherever they occur, join and leave events, and
# bookkeeping columns that do not make a row worth keeping.
SYSTEM_PATTERN = r"left|joined|added|removed"
SYSTEM_SUBTYPES = ("channel_join", "channel_leave")
BOOKKEEPING = ("id", "created_at", "updated_at")


def _if_present(df: DataFrame, column: str, keep: Column) -> DataFrame:
    return df.filter(named(column).isNull() | keep) if column in df.columns else df


def valid_email(df: DataFrame, column: str = "email") -> DataFrame:
    return _if_present(df, column, matches_email(named(column)))


def valid_phone(df: DataFrame, column: str = "phone", min_length: int = 10) -> DataFrame:
    return _if_present(df, column, F.length(named(column)) >= min_length)


def not_all_null(df: DataFrame) -> DataFrame:
    checked = [named(c).isNotNull() for c in df.columns if c not in BOOKKEEPING]
    return df.filter(reduce(or_, checked)) if checked else df


def slack_keep(df: DataFrame) -> DataFrame:
    return df.filter(
        named("sender").isNotNull()
        & named("recipient").isNotNull()
        & (named("body") != "")
        & ~named("message_subtype").isin(*SYSTEM_SUBTYPES)
    )


def whatsapp_keep(df: DataFrame, system_pattern: str | None = None) -> DataFrame:
    """Messages with a sender and a body that is no system line.

    By default a body with a system word anywhere in it counts as a system line, "I left my
    keys" too; an anchored ``system_pattern`` is more careful.
    """
    # One predicate on the body: pushed below a projection, it computes the body once.
    unwanted = rf"^\z|(?:{system_pattern or SYSTEM_PATTERN})"
    return df.filter(named("sender").isNotNull() & ~named("body").rlike(unwanted))


def chat_line_ok(df: DataFrame) -> DataFrame:
    return df.filter(
        (named("timestamp") != "") & (named("sender") != "") & (named("message") != "")
    )
