"""Channels to one scored table and its daily summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.columns import named
from tidewire.operators.conform import (
    chat_ts,
    conform_email,
    conform_slack,
    conform_whatsapp,
    slack_ts,
    to_communication,
)
from tidewire.operators.sentiment import sentiment_full
from tidewire.operators.transform import select_contract
from tidewire.schemas import COMMUNICATION

CHAT_ID = ["sender", "recipient", "timestamp", "body"]


def union_channels(*frames: DataFrame | None) -> DataFrame:
    """Available channel frames stacked by column name; absent columns become NULL."""
    there = [f for f in frames if f is not None]
    if not there:
        raise ValueError("no channel frame given")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), there)


def email_messages(raw: DataFrame) -> DataFrame:
    return select_contract(conform_email(raw), COMMUNICATION)


def slack_messages(raw: DataFrame) -> DataFrame:
    return to_communication(slack_ts(conform_slack(raw)), "slack", CHAT_ID)


def whatsapp_messages(raw: DataFrame, system_pattern: str | None = None) -> DataFrame:
    return to_communication(chat_ts(conform_whatsapp(raw, system_pattern)), "whatsapp", CHAT_ID)


def communications(
    email: DataFrame | None = None,
    slack: DataFrame | None = None,
    whatsapp: DataFrame | None = None,
) -> DataFrame:
    """Raw channel frames to one communication table; narrow apart from the union."""
    return union_channels(
        email_messages(email) if email is not None else None,
        slack_messages(slack) if slack is not None else None,
        whatsapp_messages(whatsapp) if whatsapp is not None else None,
    )


def daily_channel_summary(scored: DataFrame) -> DataFrame:
    """Messages, distinct senders and mean score per day and channel.

    Both aggregations combine on the map side, so a channel with most of the rows sends
    only its distinct senders through the shuffle.
    """
    day = F.to_date(named("timestamp"))
    return scored.groupBy(day.alias("day"), named("channel")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_distinct(named("sender")).alias("senders"),
        F.avg("sentiment_score").alias("mean_score"),
        F.count_if(named("sentiment_label") == "positive").alias("positive_messages"),
        F.count_if(named("sentiment_label") == "negative").alias("negative_messages"),
    )


def scored_daily(messages: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Sentiment of every message, summarised per day and channel."""
    return daily_channel_summary(sentiment_full(messages, as_of=as_of))
