"""Landing folders read as streams. Conforming and cleaning are stateless, so the batch
functions apply unchanged; the only state is the optional dedupe within a watermark."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def dedupe_stream(
    df: DataFrame, keys: Sequence[str], event_time: str = "timestamp", delay: str = "1 hour"
) -> DataFrame:
    """First row of every key within the watermark delay; state ends with the delay.

    A row that lands later than ``delay`` behind the newest one is dropped: choose a delay
    that covers how far landing runs behind, and count with :class:`LateRows`. ``keys`` must
    tell messages apart, as the id of a source does: rows without an event time keep no state.
    """
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_conform(
    source: DataFrame,
    conform: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    keys: Sequence[str] | None = None,
    event_time: str = "timestamp",
    delay: str = "1 hour",
) -> StreamingQuery:
    """Starts one pass over the files that are there: conform, dedupe, append parquet.

    ``checkpoint`` must be on shared storage; a restarted query goes on from it.
    """
    rows = conform(source)
    if keys:
        rows = dedupe_stream(rows, keys, event_time, delay)
    return (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


class LateRows(StreamingQueryListener):
    """Running totals of the rows that watermarks dropped, over all batches of every query.

    Attach it before the query starts. A query keeps its latest progress reports only, so a long
    catch-up cannot be counted from them.
    """

    def __init__(self, spark: SparkSession):
        self._totals: dict[str, int] = {}
        self._ended: set[str] = set()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        self._totals[str(event.runId)] = 0

    def onQueryProgress(self, event) -> None:
        report = event.progress
        dropped = sum(s.numRowsDroppedByWatermark for s in report.stateOperators)
        run = str(report.runId)
        self._totals[run] = self._totals.get(run, 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.add(str(event.runId))

    def of(self, query: StreamingQuery, wait_seconds: float = 30) -> int:
        """Rows dropped so far; for an ended query, once all its reports have come in."""
        until = time.monotonic() + wait_seconds
        while not query.isActive and str(query.runId) not in self._ended and time.monotonic() < until:
            time.sleep(0.05)
        return self._totals.get(str(query.runId), 0)
