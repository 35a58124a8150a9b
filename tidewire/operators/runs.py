"""Analytics over a run-log table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.columns import named
from tidewire.functions.text import flag
from tidewire.operators.quality import custom_rule, dq_results
from tidewire.schemas import FINAL_STATES

# What makes a run row valid.
RUN_RULES = (
    custom_rule("run_id_present", "coalesce(cast(run_id AS string), '') <> ''", "error",
                "completeness", "run_id", failed_message="job_id is required"),
    custom_rule("job_name_present", "coalesce(job_name, '') <> ''", "error", "completeness",
                "job_name", failed_message="job_name is required"),
    custom_rule("attempt_positive", "attempt_number >= 1", "error", "validity", "attempt_number",
                failed_message="attempt_number must be positive"),
    custom_rule("max_attempts_positive", "max_attempts >= 1", "error", "validity", "max_attempts",
                failed_message="max_attempts must be positive"),
    custom_rule("attempt_within_max", "attempt_number <= max_attempts", "error", "consistency",
                "attempt_number", failed_message="attempt_number cannot exceed max_attempts"),
)


def _success_rate(ok: Column, processed: Column) -> Column:
    return F.coalesce(F.try_divide(ok.cast("double"), processed) * 100, F.lit(0.0))


def run_rates(df: DataFrame, by: str = "job_name") -> DataFrame:
    """Records and success and failure rates per job."""
    summed = df.groupBy(named(by)).agg(
        F.sum(named("records_processed")).alias("records_processed"),
        F.sum(named("records_successful")).alias("records_successful"),
    )
    rate = _success_rate(named("records_successful"), named("records_processed"))
    return summed.select(
        "*", rate.alias("success_rate"), (F.lit(100.0) - rate).alias("failure_rate")
    )


def run_duration(df: DataFrame) -> DataFrame:
    """Adds ``duration_seconds`` (NULL when a side is missing) and ``is_running``."""
    start, end = named("started_at"), named("completed_at")
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return df.select(
        "*",
        (micros / 1_000_000).alias("duration_seconds"),
        (start.isNotNull() & end.isNull()).alias("is_running"),
    )


def run_final_state(df: DataFrame) -> DataFrame:
    return df.withColumn("is_final_state", flag(named("status").isin(*FINAL_STATES)))


def run_retry(df: DataFrame, default_max: int = 3) -> DataFrame:
    """Adds ``can_retry``: attempts are left."""
    limit = F.coalesce(named("max_attempts"), F.lit(default_max))
    return df.withColumn("can_retry", flag(named("attempt_number") < limit))


def run_validate(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per run and rule of :data:`RUN_RULES`; ``as_of`` replaces the clock."""
    return dq_results(df, RUN_RULES, record_id="run_id", as_of=as_of)


def run_summary(runs: DataFrame, log: DataFrame) -> DataFrame:
    """One row per run with counts of its log entries and its latest quality score.

    ``log`` has run_id, kind ('output', 'error', 'warning'), logged_at, quality_score. It is
    reduced to one row per run before the join, so a chatty run cannot skew it.
    """
    kind = named("kind")
    counts = log.groupBy("run_id").agg(
        F.count_if(kind == "output").alias("output_files_count"),
        F.count_if(kind == "error").alias("error_count"),
        F.count_if(kind == "warning").alias("warning_count"),
        F.max_by(named("quality_score"), named("logged_at")).alias("quality_score"),
    )
    tallies = ["output_files_count", "error_count", "warning_count"]
    return runs.join(counts, "run_id", "left").select(
        "run_id",
        "job_name",
        "status",
        flag(named("status") == "completed").alias("success"),
        "records_processed",
        *[F.coalesce(named(c), F.lit(0)).cast("bigint").alias(c) for c in tallies],
        "quality_score",
    )
