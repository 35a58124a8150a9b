"""Writers: one action per written table, row counts from observed metrics."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.columns import named, with_all
from tidewire.schemas import PARTITION_KEYS

logger = logging.getLogger(__name__)

# Folder of each processing step.
ZONES = {
    "cleaned": "cleaned",
    "transformed": "transformed",
    "sentiment": "sentiment_analysis",
    "ai": "ai_processed",
    "email": "communications/email",
    "slack": "communications/slack",
    "whatsapp": "communications/whatsapp",
}


def zone_path(root: str, zone: str) -> str:
    return f"{root.rstrip('/')}/{ZONES[zone]}"


def write_counted(df: DataFrame, path: str, fmt: str = "parquet", keys: Sequence[str] = ()) -> int:
    """Overwrites ``path`` and returns the row count seen by that same write."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if keys:
        writer = writer.partitionBy(*keys)
    writer.format(fmt).save(path)
    return seen.get["rows"]


def write_zone(df: DataFrame, root: str, zone: str, keys: Sequence[str] = ()) -> int:
    """Overwrites the parquet folder of a zone; returns the rows written."""
    return write_counted(df, zone_path(root, zone), keys=keys)


def with_partition_keys(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Text year, month and day of a timestamp column, next to the lineage columns."""
    at = named(timestamp)
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    return with_all(df, {k: F.date_format(at, p) for k, p in parts.items()})


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = PARTITION_KEYS,
    timestamp: str = "timestamp",
    rebalance: bool = True,
) -> int:
    """Parquet partitioned by date parts and lineage.

    The rebalance hint groups rows by partition to keep files few; adaptive execution
    splits a partition that holds far more than the others over several tasks. Data that
    arrives grouped by day can go without that shuffle.
    """
    keyed = with_partition_keys(df, timestamp)
    spread = keyed.hint("rebalance", *[named(k) for k in keys]) if rebalance else keyed
    return write_counted(spread, path, keys=keys)


def register_partitioned(
    spark: SparkSession, table: str, path: str, columns: str, keys: Sequence[str] = PARTITION_KEYS
) -> None:
    """External parquet table over a partitioned folder; ``columns`` is DDL without keys."""
    key_ddl = ", ".join(f"{k} STRING" for k in keys)
    location = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {table} ({columns}, {key_ddl}) USING parquet "
        f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{location}'"
    )
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def write_results(spark: SparkSession, written: str, root: str, job: str) -> str | None:
    """Second copy of a written table under ``results/<job>``. A failure only warns."""
    target = f"{root.rstrip('/')}/results/{job}"
    try:
        spark.read.parquet(written).write.mode("overwrite").parquet(target)
    except Exception as error:  # noqa: BLE001 - the first copy is the one that counts
        logger.warning("results copy of %s failed: %s", job, error)
        return None
    return target


def write_compact(
    df: DataFrame, path: str, files: int | None = None, max_records: int | None = None
) -> int:
    """Parquet in few files: an even spread over ``files``, or sized by the engine.

    A file is written by one task. For a set number of them every task first deals its own
    rows out to that many folders beside ``path``, which go at the end; each file's task
    then reads its share as parquet, so no row is shuffled.
    """
    if not files:
        return _write_sized(df.hint("rebalance"), path, max_records)
    spark, part, staged = df.sparkSession, "part", f"{path.rstrip('/')}-parts-{uuid.uuid4().hex}"
    while part in {c.lower() for c in df.columns}:
        part += "_"
    # Rows of a task are counted on from its own number, so that small ones fill all folders too.
    place_in_task = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    turn = F.pmod(place_in_task + F.spark_partition_id(), F.lit(files))
    try:
        dealt = df.withColumn(part, turn.cast("int"))
        dealt.write.partitionBy(part).option("compression", "zstd").parquet(staged)
        # Spark would run a union of single partitions as one; a clone of the session has settings of its own.
        apart = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
        apart.conf.set("spark.sql.unionOutputPartitioning", "false")
        dealt = apart.read.schema(dealt.schema).parquet(staged)
        shares = [dealt.where(named(part) == i).drop(part).coalesce(1) for i in range(files)]
        return _write_sized(reduce(DataFrame.union, shares), path, max_records)
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(staged)
        place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def _write_sized(df: DataFrame, path: str, max_records: int | None) -> int:
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)
    return seen.get["rows"]


def write_dual(df: DataFrame, root: str) -> tuple[str, str]:
    """The same rows as parquet and as JSON.

    The JSON copy is read from the finished parquet: the plan runs once, nothing has to
    stay cached, and a lost executor costs only its own tasks.
    """
    parquet, json = f"{root.rstrip('/')}/parquet", f"{root.rstrip('/')}/json"
    df.write.mode("overwrite").parquet(parquet)
    df.sparkSession.read.parquet(parquet).write.mode("overwrite").json(json)
    return parquet, json
