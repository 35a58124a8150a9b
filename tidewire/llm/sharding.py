"""Sharding by jump consistent hashing: no ring table, and a new shard only takes rows into itself.

Lamping and Veach, "A Fast, Minimal Memory, Consistent Hash Algorithm" (2014).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import numbered, ship


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key, all keys at once: each key jumps ahead until it passes the last shard."""
    key = keys.astype(np.uint64)
    at, ahead = np.full(len(key), -1, np.int64), np.zeros(len(key), np.float64)
    active = np.arange(len(key))
    while len(active):
        at[active] = ahead[active].astype(np.int64)
        key[active] = key[active] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (key[active] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[active] = (at[active] + 1) * (float(1 << 31) / draw)
        active = active[ahead[active] < shards]
    return at.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards`` - 1 of an integer key; a null key counts as 0."""
    if shards < 1:
        raise ValueError("at least one shard")

    ship(SparkSession.active())

    @F.pandas_udf("int")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(jump(keys.to_numpy(np.int64), shards))

    return place(F.coalesce(key.cast("long"), F.lit(0)))


def assign_shards(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 8) -> DataFrame:
    """Shard, slot and size of each row, one row out for each row in.

    The key alone decides (law ``key``): ``grown_shard`` is the place once a shard is appended, the same or the new one.
    Nulls: a null key counts as 0, a null text has size 1 and checksum 0. Repeated rows share a shard and get slots of
    their own; ties are numbered in any order. An empty table gives no rows; other columns are not carried.
    """
    rows = docs.select(
        F.col(key).cast("long").alias(key),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = rows.withColumns({"shard": shard_of(F.col(key), shards), "grown_shard": shard_of(F.col(key), shards + 1)})
    return numbered(placed, ["shard"], [key, "text_crc32", "size"], "slot").select(
        key, "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", shards: int = 8) -> None:
    """All columns of ``docs`` below ``path``/shard=N; a large shard is written by several tasks."""
    docs.withColumn("shard", shard_of(F.col(key), shards)).hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
