"""Table contracts."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the shared communication table.
COMMUNICATION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("sender", T.StringType()),
        T.StructField("recipient", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("body", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("attachments", T.ArrayType(T.StringType())),
        T.StructField("sentiment", T.StringType()),
        T.StructField("language", T.StringType()),
    ]
)
COMMUNICATION_FIELDS = {f.name: f.dataType.simpleString() for f in COMMUNICATION.fields}


def contract(fields: dict[str, str]) -> T.StructType:
    """Name -> DDL type map to a schema of nullable fields; needs a running session."""
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields.items()))


# Closed sets used by rules.
RUN_STATES = ("pending", "running", "completed", "failed", "cancelled", "retrying")
FINAL_STATES = ("completed", "failed", "cancelled")
SEVERITIES = ("info", "warning", "error", "critical")
DIMENSIONS = (
    "completeness", "accuracy", "consistency", "validity", "uniqueness", "timeliness",
    "integrity",
)
PARTITION_KEYS = ("year", "month", "day", "data_source", "dataset_name")
