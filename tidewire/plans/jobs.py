"""Batch jobs: read a zone, apply the operators, write the next zone.

Each job runs its plan once, in its write, and returns the rows that write saw.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.operators.conform import (
    chat_ts,
    conform_slack,
    conform_whatsapp,
    route_source,
    slack_ts,
)
from tidewire.operators.contract import contract_strict
from tidewire.operators.enrich import ai_enrich
from tidewire.operators.sentiment import sentiment_full
from tidewire.operators.transform import (
    add_base_fields,
    communication_features,
    profile_features,
    record_ids,
    select_contract,
    standard_transform,
    temporal_buckets,
    transform_communication,
    transform_temporal,
    transform_user_profile,
)
from tidewire.plans.cleaning import cleaned
from tidewire.plans.communications import union_channels
from tidewire.schemas import COMMUNICATION
from tidewire.sinks.writers import write_zone, zone_path
from tidewire.sources.readers import (
    PARQUET_FIRST,
    UnreadableError,
    read_auto,
    read_chat,
    read_first_path,
    read_optional,
    read_parquet,
)

Schema = T.StructType | str | None


def email_job(
    spark: SparkSession,
    path: str,
    root: str,
    source: str,
    dataset_name: str,
    key_columns: list[str] | None = None,
) -> int:
    """Raw mail parquet to the e-mail zone, in contract columns.

    ``key_columns`` makes record ids repeatable; the contract is checked before the write.
    """
    raw = add_base_fields(read_parquet(spark, path), source, dataset_name)
    mapped = route_source(record_ids(raw, key_columns=key_columns), source)
    return write_zone(
        select_contract(contract_strict(mapped, COMMUNICATION), COMMUNICATION), root, "email"
    )


def slack_job(spark: SparkSession, path: str, root: str, schema: Schema = None) -> int:
    return write_zone(conform_slack(read_auto(spark, path, schema=schema)), root, "slack")


def whatsapp_job(
    spark: SparkSession,
    path: str,
    root: str,
    schema: Schema = None,
    system_pattern: str | None = None,
) -> int:
    rows = conform_whatsapp(read_chat(spark, path, schema), system_pattern)
    return write_zone(rows, root, "whatsapp")


def cleaning_job(
    spark: SparkSession, path: str, root: str, schema: Schema = None, as_of: Column | None = None
) -> int:
    return write_zone(cleaned(read_auto(spark, path, schema=schema), as_of), root, "cleaned")


def transform(df: DataFrame, kind: str, as_of: Column | None = None) -> DataFrame:
    """Reshape by kind: communication, user_profile, temporal; anything else is standard."""
    if kind == "communication":
        return communication_features(transform_communication(df))
    if kind == "user_profile":
        return profile_features(transform_user_profile(df))
    if kind == "temporal":
        return temporal_buckets(transform_temporal(df))
    return standard_transform(df, as_of)


def transform_job(
    spark: SparkSession, path: str, root: str, kind: str = "standard", schema: Schema = None
) -> int:
    rows = read_auto(spark, path, PARQUET_FIRST, schema)
    return write_zone(transform(rows, kind), root, "transformed")


def channel_frames(spark: SparkSession, root: str) -> list[DataFrame]:
    """Channel zones that hold rows, with their clocks as timestamps and a channel name."""
    clocks: dict[str, Callable[[DataFrame], DataFrame]] = {
        "email": lambda df: df,
        "slack": slack_ts,
        "whatsapp": chat_ts,
    }
    frames = []
    for channel, clock in clocks.items():
        df = read_optional(spark, zone_path(root, channel))
        if df is not None:
            frames.append(clock(df).withColumn("channel", F.lit(channel)))
    return frames


def sentiment_job(spark: SparkSession, root: str, as_of: Column | None = None) -> int:
    """Sentiment of all channel zones there are, to the sentiment zone."""
    frames = channel_frames(spark, root)
    if not frames:
        raise UnreadableError(f"no channel zone below {root} holds rows")
    return write_zone(sentiment_full(union_channels(*frames), as_of=as_of), root, "sentiment")


def ai_job(
    spark: SparkSession,
    root: str,
    model_id: str,
    make_client: Callable[[], Callable[[str], str]] | None = None,
) -> int:
    """Text analysis of the channel zones, else the cleaned zone, else the root itself."""
    frames = channel_frames(spark, root)
    rows = union_channels(*frames) if frames else read_first_path(spark, root, ("cleaned", ""))
    return write_zone(ai_enrich(rows, model_id, make_client), root, "ai")
