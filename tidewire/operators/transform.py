"""Reshapes: communication, user profile, temporal, standard, sensor, lineage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions import text as X
from tidewire.functions.columns import (
    as_instant,
    coalesce_present,
    field_type,
    framed,
    instant_present,
    named,
    present,
    with_all,
)

# Fixed values.
ATTACHMENT_MARK = "[attachment]"
PUBLIC_MAIL = r"gmail|yahoo|hotmail|outlook"
SCHEMA_VERSION = "2.0"


def _clock(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


def transform_communication(df: DataFrame) -> DataFrame:
    return df.select(
        coalesce_present(df, ["sender", "from", "user"]).alias("sender"),
        coalesce_present(df, ["recipient", "to", "channel"]).alias("recipient"),
        coalesce_present(df, ["subject"], F.lit("No Subject")).alias("subject"),
        coalesce_present(df, ["body", "message", "text"]).alias("body"),
        instant_present(df, ["timestamp", "date", "sent_at"]).alias("timestamp"),
        coalesce_present(df, ["communication_type"], F.lit("unknown")).alias("type"),
    )


def communication_features(df: DataFrame) -> DataFrame:
    body, subject = named("body"), named("subject")
    return df.select(
        "*",
        X.split_parts(body).alias("word_count"),
        X.flag(body.contains(ATTACHMENT_MARK)).alias("has_attachments"),
        X.flag(subject.startswith("Re:") | subject.startswith("RE:")).alias("is_reply"),
    )


def transform_user_profile(df: DataFrame) -> DataFrame:
    names = present(df, ["first_name", "last_name"])
    joined = F.concat_ws(" ", *[named(n) for n in names]) if names else None
    return df.select(
        coalesce_present(df, ["user_id", "id"]).alias("user_id"),
        coalesce_present(df, ["username", "handle"]).alias("username"),
        coalesce_present(df, ["email", "email_address"]).alias("email"),
        coalesce_present(df, ["full_name"], joined).alias("full_name"),
        coalesce_present(df, ["department", "team"]).alias("department"),
        coalesce_present(df, ["role", "position", "title"]).alias("role"),
    )


def profile_features(df: DataFrame) -> DataFrame:
    domain = F.regexp_extract(named("email"), r"@(.+)", 1)
    outside = X.flag(domain.rlike(PUBLIC_MAIL))
    return df.select(
        "*",
        domain.alias("email_domain"),
        F.when(outside, "external").otherwise("internal").alias("user_category"),
    )


def transform_temporal(df: DataFrame) -> DataFrame:
    """Calendar parts of ``timestamp`` in the session time zone."""
    if "timestamp" not in df.columns:
        raise ValueError("Temporal transformation requires 'timestamp' column")
    at = as_instant(named("timestamp"), field_type(df, "timestamp"))
    ts = named("timestamp")
    return with_all(df, {"timestamp": at}).select(
        "*",
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofweek(ts).alias("day_of_week"),
        F.hour(ts).alias("hour"),
        F.weekofyear(ts).alias("week_of_year"),
        F.date_format(ts, "EEEE").alias("day_name"),
        F.date_format(ts, "MMMM").alias("month_name"),
    )


def temporal_buckets(df: DataFrame) -> DataFrame:
    """Part of day, weekend and office-hours flags of a frame with calendar parts."""
    hour, weekend = named("hour"), X.flag(named("day_of_week").isin(1, 7))
    part = (
        F.when(hour.between(6, 11), "morning")
        .when(hour.between(12, 17), "afternoon")
        .when(hour.between(18, 22), "evening")
        .otherwise("night")
    )
    return df.select(
        "*",
        part.alias("time_of_day"),
        weekend.alias("is_weekend"),
        X.flag(hour.between(9, 17) & ~weekend).alias("is_business_hours"),
    )


def dedupe_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row of every distinct key, all columns by default.

    The whole-row form is a partial aggregation before its one shuffle, so a row copied
    into every partition crosses the network once per task, not once per copy.
    """
    return df.dropDuplicates(list(keys) if keys else df.columns)


def standard_transform(
    df: DataFrame, as_of: Column | None = None, hasher: str = "murmur3"
) -> DataFrame:
    """Exact-row dedupe, then ``processed_at`` and ``record_hash`` on the survivors."""
    hash_of = {"murmur3": F.hash, "xxhash64": F.xxhash64}[hasher]
    columns = [named(c) for c in df.columns]
    return dedupe_rows(df).select(
        "*", _clock(as_of).alias("processed_at"), hash_of(*columns).alias("record_hash")
    )


def add_base_fields(
    df: DataFrame, data_source: str, dataset_name: str, as_of: Column | None = None
) -> DataFrame:
    at = _clock(as_of)
    return with_all(
        df,
        {
            "data_source": F.lit(data_source),
            "dataset_name": F.lit(dataset_name),
            "ingestion_timestamp": at,
            "processing_date": F.to_date(at),
            "schema_version": F.lit(SCHEMA_VERSION),
        },
    )


def _key_part(df: DataFrame, name: str) -> Column:
    if isinstance(field_type(df, name), T.TimestampType):
        return F.unix_micros(named(name)).cast("string")
    return named(name).cast("string")


def record_ids(
    df: DataFrame, prefix: str = "REC", key_columns: Sequence[str] | None = None
) -> DataFrame:
    """Adds ``record_id``.

    With ``key_columns`` the id is a digest of their framed text (timestamps as microseconds),
    the same after every rerun or repartitioning and in every session time zone. Without, it is the engine's running id: unique, but not repeatable.
    """
    if key_columns:
        tail = F.sha2(framed([_key_part(df, c) for c in key_columns]), 256)
    else:
        tail = F.monotonically_increasing_id().cast("string")
    return df.withColumn("record_id", F.concat(F.lit(f"{prefix}-"), tail))


def select_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Contract fields the frame has, in contract order."""
    return df.select(*[named(n) for n in present(df, contract.fieldNames())])


def add_partitions(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Partition values as literal text columns."""
    return with_all(df, {k: F.lit(v) for k, v in values.items()})


def sensor_transform(df: DataFrame) -> DataFrame:
    """Nested readings to flat rows; readings without a temperature are dropped."""
    reading, place = named("sensor_data"), named("location")
    celsius = reading["temperature"]
    quality = F.coalesce(named("quality_score"), F.lit(0.0))

    def or_zero(value: Column) -> Column:
        return F.coalesce(value, F.lit(0.0))

    return df.filter(celsius.isNotNull()).select(
        named("id"),
        named("timestamp"),
        celsius.alias("temperature_celsius"),
        F.round(celsius * 9 / 5 + 32, 1).alias("temperature_fahrenheit"),
        or_zero(reading["humidity"]).alias("humidity_percent"),
        or_zero(reading["pressure"]).alias("pressure_hpa"),
        quality.alias("quality_score"),
        F.when(quality > 0.9, "high").otherwise("medium").alias("data_quality"),
        named("timestamp").alias("processed_timestamp"),
        F.when(place.isNotNull(), F.coalesce(place["city"], F.lit(""))).alias("location_city"),
        F.when(place.isNotNull(), F.array(or_zero(place["lat"]), or_zero(place["lon"]))).alias(
            "location_coordinates"
        ),
    )


def sensor_flat(df: DataFrame) -> DataFrame:
    """Flat text readings typed; ``processed_at`` repeats the reading time."""
    return df.select(
        named("id").cast("string").alias("id"),
        named("timestamp").cast("string").alias("timestamp"),
        named("sensor_type").cast("string").alias("sensor_type"),
        named("value").try_cast("double").alias("value"),
        named("location").cast("string").alias("location"),
        named("quality_score").try_cast("double").alias("quality_score"),
        named("timestamp").cast("string").alias("processed_at"),
    )
