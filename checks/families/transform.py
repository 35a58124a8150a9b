"""Reshapes, lineage, ids, path values and sensor rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import as_of, query, table, twin, view
from tidewire.functions.columns import named
from tidewire.operators import transform as R
from tidewire.schemas import COMMUNICATION
from tidewire.sources.paths import path_partitions, zone_route

_FEATURES = r"""CASE WHEN body IS NULL THEN 0 ELSE CAST(len(regexp_split_to_array(body, '[\s\x0b]+')) AS INTEGER) END AS word_count,
  coalesce(contains(body, '[attachment]'), FALSE) AS has_attachments,
  coalesce(starts_with(subject, 'Re:') OR starts_with(subject, 'RE:'), FALSE) AS is_reply"""
_COMM = """SELECT sender, recipient, coalesce(subject, 'No Subject') AS subject, body, timestamp, 'unknown' AS type FROM v_comm"""


@query("transform_communication", twin("v_comm", _COMM))
def _(spark, sf):
    return R.transform_communication(view(spark, sf, "v_comm"))


@query(
    "communication_features",
    twin("v_comm", f"SELECT id, {_FEATURES} FROM v_comm"),
)
def _(spark, sf):
    featured = R.communication_features(view(spark, sf, "v_comm"))
    return featured.select("id", "word_count", "has_attachments", "is_reply")


_PROFILE = """SELECT user_id, handle AS username, email,
  coalesce(full_name, concat_ws(' ', first_name, last_name)) AS full_name, team AS department, title AS role FROM v_profile"""


@query("transform_user_profile", twin("v_profile", _PROFILE))
def _(spark, sf):
    return R.transform_user_profile(view(spark, sf, "v_profile"))


@query(
    "profile_features",
    twin(
        "v_profile",
        f"""SELECT *, CASE WHEN regexp_matches(email_domain, 'gmail|yahoo|hotmail|outlook') THEN 'external' ELSE 'internal' END AS user_category
        FROM (SELECT *, CASE WHEN email IS NULL THEN NULL ELSE regexp_extract(email, '@(.+)', 1) END AS email_domain FROM ({_PROFILE}))""",
    ),
)
def _(spark, sf):
    return R.profile_features(R.transform_user_profile(view(spark, sf, "v_profile")))


_PARTS = """SELECT event_id, ts AS timestamp, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
  CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, CAST(hour(ts) AS INTEGER) AS hour,
  CAST(weekofyear(ts) AS INTEGER) AS week_of_year, dayname(ts) AS day_name, monthname(ts) AS month_name FROM events"""


def _temporal(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.col("ts").alias("timestamp"))
    return R.transform_temporal(events)


@query("transform_temporal", _PARTS)
def _(spark, sf):
    return _temporal(spark, sf)


@query(
    "temporal_buckets",
    f"""SELECT event_id, hour, day_of_week,
      CASE WHEN hour BETWEEN 6 AND 11 THEN 'morning' WHEN hour BETWEEN 12 AND 17 THEN 'afternoon'
        WHEN hour BETWEEN 18 AND 22 THEN 'evening' ELSE 'night' END AS time_of_day,
      day_of_week IN (1, 7) AS is_weekend,
      hour BETWEEN 9 AND 17 AND day_of_week NOT IN (1, 7) AS is_business_hours FROM ({_PARTS})""",
)
def _(spark, sf):
    return R.temporal_buckets(_temporal(spark, sf)).select(
        "event_id", "hour", "day_of_week", "time_of_day", "is_weekend", "is_business_hours"
    )


@query(
    "add_base_fields",
    """SELECT doc_id, lang, 'enron' AS data_source, 'mail' AS dataset_name,
      TIMESTAMP '2024-01-31 00:00:00' AS ingestion_timestamp, DATE '2024-01-31' AS processing_date, '2.0' AS schema_version FROM documents""",
)
def _(spark, sf):
    return R.add_base_fields(table(spark, sf, "documents").select("doc_id", "lang"), "enron", "mail", as_of())


@query(
    "record_ids",
    """SELECT doc_id, concat('DOC-', sha256(CAST(strlen(CAST(doc_id AS VARCHAR)) AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR)
      || coalesce(CAST(strlen(text) AS VARCHAR) || ':' || text, '-'))) AS record_id FROM documents""",
)
def _(spark, sf):
    return R.record_ids(table(spark, sf, "documents"), "DOC", ["doc_id", "text"]).select("doc_id", "record_id")


@query(
    "select_contract",
    twin("v_comm", "SELECT id, sender, recipient, timestamp, body, subject, channel FROM v_comm"),
)
def _(spark, sf):
    wide = view(spark, sf, "v_comm").withColumn("extra", F.lit(1))
    return R.select_contract(wide, COMMUNICATION)


@query("add_partitions", "SELECT event_id, '2024' AS year, 'us-east-1' AS region FROM events")
def _(spark, sf):
    return R.add_partitions(
        table(spark, sf, "events").select("event_id"), {"year": "2024", "region": "us-east-1"}
    )


_KEYS = ("year", "month", "region", "env", "config", "other")


@query(
    "path_partitions",
    twin(
        "v_paths",
        r"WITH p AS (SELECT event_id, path, list_reverse(regexp_extract_all(path, '(\w+)=([^/]+)', 1)) AS ks, "
        r"list_reverse(regexp_extract_all(path, '(\w+)=([^/]+)', 2)) AS vs FROM v_paths) "
        "SELECT event_id, path, CAST(len(list_distinct(ks)) AS INTEGER) AS pairs, "
        + ", ".join(
            f"CASE WHEN list_contains(ks, '{k}') THEN vs[list_position(ks, '{k}')] END AS {k}" for k in _KEYS
        )
        + " FROM p",
    ),
)
def _(spark, sf):
    mapped = view(spark, sf, "v_paths").withColumn("m", path_partitions(named("path")))
    found = [F.try_element_at("m", F.lit(k)).alias(k) for k in _KEYS]
    return mapped.select("event_id", "path", F.size("m").alias("pairs"), *found)


@query(
    "zone_route",
    twin(
        "v_paths",
        """SELECT event_id, path, CASE split_part(lower(path), '/', 1) WHEN 'raw' THEN 'etl' WHEN 'etl' THEN 'cleaned'
        WHEN 'cleaned' THEN 'sentiment' WHEN 'sentiment' THEN 'nlp' WHEN 'nlp' THEN 'analytics' END AS job_type FROM v_paths""",
    ),
)
def _(spark, sf):
    return view(spark, sf, "v_paths").select("event_id", "path", zone_route(named("path")).alias("job_type"))


def nested_sensor(spark, sf):
    return view(spark, sf, "v_sensor").select(
        "id",
        "timestamp",
        F.struct("temperature", "humidity", "pressure").alias("sensor_data"),
        F.struct("lat", "lon", "city").alias("location"),
        "quality_score",
    )


@query(
    "sensor_transform",
    twin(
        "v_sensor",
        """SELECT id, timestamp, temperature AS temperature_celsius, round(temperature * 9 / 5 + 32, 1) AS temperature_fahrenheit,
        coalesce(humidity, 0) AS humidity_percent, coalesce(pressure, 0) AS pressure_hpa, quality_score,
        CASE WHEN quality_score > 0.9 THEN 'high' ELSE 'medium' END AS data_quality, timestamp AS processed_timestamp,
        city AS location_city, coalesce(lat, 0) AS lat, coalesce(lon, 0) AS lon FROM v_sensor WHERE temperature IS NOT NULL""",
    ),
)
def _(spark, sf):
    flat = R.sensor_transform(nested_sensor(spark, sf))
    place = named("location_coordinates")
    return flat.select("*", place[0].alias("lat"), place[1].alias("lon")).drop("location_coordinates")


@query(
    "sensor_flat",
    """SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, event_type AS sensor_type,
      CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value, concat('sensor_', CAST(user_id AS VARCHAR)) AS location,
      CAST(70 + event_id % 31 AS DOUBLE) / 100 AS quality_score, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS processed_at FROM events""",
)
def _(spark, sf):
    readings = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.col("event_type").alias("sensor_type"),
        F.when(F.col("event_id") % 9 == 0, "bad").otherwise(F.col("value").cast("string")).alias("value"),
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("location"),
        ((F.col("event_id") % 31 + 70) / 100).cast("string").alias("quality_score"),
    )
    return R.sensor_flat(readings)
