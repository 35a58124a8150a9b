"""Run-log analytics."""

from __future__ import annotations

from checks.base import as_of, query, rounded, twin, view
from tidewire.operators import runs as R


def _runs(spark, sf):
    return view(spark, sf, "v_runs")


@query(
    "run_rates",
    twin(
        "v_runs",
        """SELECT job_name, p AS records_processed, s AS records_successful, round(CASE WHEN p = 0 THEN 0 ELSE 100.0 * s / p END, 6) AS success_rate,
        round(100.0 - CASE WHEN p = 0 THEN 0 ELSE 100.0 * s / p END, 6) AS failure_rate
        FROM (SELECT job_name, CAST(sum(records_processed) AS BIGINT) AS p, CAST(sum(records_successful) AS BIGINT) AS s FROM v_runs GROUP BY 1)""",
    ),
)
def _(spark, sf):
    return rounded(R.run_rates(_runs(spark, sf)), "success_rate", "failure_rate")


@query(
    "run_duration",
    twin(
        "v_runs",
        """SELECT run_id, date_diff('microsecond', started_at, completed_at) / 1000000.0 AS duration_seconds,
        started_at IS NOT NULL AND completed_at IS NULL AS is_running FROM v_runs""",
    ),
)
def _(spark, sf):
    return R.run_duration(_runs(spark, sf)).select("run_id", "duration_seconds", "is_running")


@query(
    "run_final_state",
    twin("v_runs", "SELECT run_id, status, status IN ('completed', 'failed', 'cancelled') AS is_final_state FROM v_runs"),
)
def _(spark, sf):
    return R.run_final_state(_runs(spark, sf)).select("run_id", "status", "is_final_state")


@query("run_retry", twin("v_runs", "SELECT run_id, attempt_number, attempt_number < max_attempts AS can_retry FROM v_runs"))
def _(spark, sf):
    return R.run_retry(_runs(spark, sf)).select("run_id", "attempt_number", "can_retry")


_RULES = (
    ("run_id_present", "run_id IS NOT NULL", "job_id is required", "completeness", "run_id"),
    ("job_name_present", "coalesce(job_name, '') <> ''", "job_name is required", "completeness", "job_name"),
    ("attempt_positive", "attempt_number >= 1", "attempt_number must be positive", "validity", "attempt_number"),
    ("max_attempts_positive", "max_attempts >= 1", "max_attempts must be positive", "validity", "max_attempts"),
    ("attempt_within_max", "attempt_number <= max_attempts", "attempt_number cannot exceed max_attempts", "consistency", "attempt_number"),
)


@query(
    "run_validate",
    twin(
        "v_runs",
        " UNION ALL ".join(
            f"SELECT '{n}' AS rule_name, {p} AS passed, CASE WHEN {p} THEN 'Rule passed' ELSE '{m}' END AS message, 'error' AS severity, "
            f"'{d}' AS dimension, CAST(run_id AS VARCHAR) AS record_id, '{f}' AS field_name, TIMESTAMP '2024-01-31 00:00:00' AS checked_at FROM v_runs"
            for n, p, m, d, f in _RULES
        ),
    ),
)
def _(spark, sf):
    return R.run_validate(_runs(spark, sf), as_of())


@query(
    "run_summary",
    twin(
        "v_runs v_log",
        """SELECT run_id, job_name, status, status = 'completed' AS success, records_processed, coalesce(o, 0) AS output_files_count,
          coalesce(e, 0) AS error_count, coalesce(w, 0) AS warning_count, round(q, 6) AS quality_score
        FROM v_runs LEFT JOIN (SELECT run_id, CAST(sum(CASE WHEN kind = 'output' THEN 1 ELSE 0 END) AS BIGINT) AS o,
          CAST(sum(CASE WHEN kind = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS e, CAST(sum(CASE WHEN kind = 'warning' THEN 1 ELSE 0 END) AS BIGINT) AS w,
          arg_max(quality_score, logged_at) AS q FROM v_log GROUP BY 1) USING (run_id)""",
    ),
)
def _(spark, sf):
    return rounded(R.run_summary(_runs(spark, sf), view(spark, sf, "v_log")), "quality_score")
