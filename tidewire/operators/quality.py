"""Data quality: rules as predicates, and scores as aggregations."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import add, and_

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.columns import (
    countable,
    distinct_counts,
    field_type,
    is_number,
    is_text,
    named,
    null_count,
    present,
    report_rows,
)
from tidewire.functions.text import flag, is_blank, matches_email
from tidewire.schemas import DIMENSIONS

# Score taken per failed result, and the default gate limits.
PENALTY = 5.0
MAX_NULL_FRACTION = 0.05
MIN_QUALITY_SCORE = 0.8

# A check binds to a frame: its pass predicate, and the message given that predicate's value.
Message = Callable[[Column], Column]
Check = Callable[[DataFrame], tuple[Column, Message]]


class QualityError(ValueError):
    """Data broke a requirement that was checked strictly."""


@dataclass(frozen=True)
class Rule:
    """A named check on a frame; without ``check`` every record passes.

    Where ``answers`` is set the check's column is a struct of ``passed`` and its own ``message``.
    """

    name: str
    severity: str = "info"
    dimension: str = "validity"
    field: str | None = None
    description: str = ""
    check: Check | None = None
    answers: bool = False


def _always(message: str) -> Message:
    return lambda _passed: F.lit(message)


# The rule messages from here to the end of rule_positive, and in _verdict.
def rule_email(field: str = "email") -> Rule:
    def check(df: DataFrame) -> tuple[Column, Message]:
        absent = "Email field not found"
        if field not in df.columns:
            return F.lit(False), _always(absent)
        value = named(field)
        if not is_text(field_type(df, field)):
            wrong = F.when(value.isNull(), absent).otherwise("Email value must be a string")
            return F.lit(False), lambda _passed: wrong
        return flag(matches_email(value)), lambda passed: (
            F.when(value.isNull(), absent)
            .when(passed, "Valid email format")
            .otherwise("Invalid email format")
        )

    return Rule("email_format", "error", "validity", field, "Validate email address format", check)


def rule_non_empty(field: str) -> Rule:
    def check(df: DataFrame) -> tuple[Column, Message]:
        if field not in df.columns:
            return F.lit(False), _always("Value cannot be null")
        value = named(field)
        ok = ~is_blank(value) if is_text(field_type(df, field)) else value.isNotNull()
        return flag(ok), lambda passed: (
            F.when(value.isNull(), "Value cannot be null")
            .when(passed, "Value is not empty")
            .otherwise("Value cannot be empty")
        )

    return Rule(
        "non_empty", "warning", "completeness", field, "Validate that value is not empty", check
    )


def rule_positive(field: str) -> Rule:
    def check(df: DataFrame) -> tuple[Column, Message]:
        if field not in df.columns or not is_number(field_type(df, field)):
            return F.lit(False), _always("Value must be a number")
        value = named(field)
        return flag(value > 0), lambda passed: (
            F.when(value.isNull(), "Value must be a number")
            .when(passed, "Value is a positive number")
            .otherwise("Value must be positive")
        )

    return Rule(
        "positive_number", "error", "validity", field, "Validate that number is positive", check
    )


def _literal(value: object) -> str:
    """A bound value as a SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, (bool, int, float, Decimal)):
        return f"DOUBLE('{value}')" if isinstance(value, float) else str(value)
    kind = "TIMESTAMP " if isinstance(value, dt.datetime) else "DATE " if isinstance(value, dt.date) else ""
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"{kind}'{text}'"


def _bound(predicate: str, parameters: Mapping[str, object]) -> str:
    """``{name}`` of a parameter as its literal; all other braces stay."""
    return re.sub(r"\{(\w+)\}", lambda m: _literal(parameters[m[1]]) if m[1] in parameters else m[0], predicate)


def _by_batch(function: Callable[[pd.DataFrame], pd.Series], fields: Sequence[str]) -> Column:
    """Boolean of a vectorized function; where a batch fails its rows are tried one by one, and a failing row is NULL."""

    def verdict(value: object) -> bool | None:
        return None if pd.isna(value) else bool(value)

    @F.pandas_udf("boolean")
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for rows in batches:
            try:
                yield pd.Series([verdict(v) for v in function(rows)], dtype=object)
            except Exception:  # noqa: BLE001 - any error of a user's rule fails its record
                out = []
                for i in range(len(rows)):
                    try:
                        out.append(verdict(next(iter(function(rows.iloc[i : i + 1])))))
                    except Exception:  # noqa: BLE001
                        out.append(None)
                yield pd.Series(out, dtype=object)

    return run(F.struct(*[named(f) for f in fields]))


def _lenient(df: DataFrame, tested: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``tested`` of the frame, its expressions giving NULL where strict SQL would end the job, as for a division by zero.

    They are resolved in a clone of the session, which has settings of its own and is active in
    this thread alone; the resolved plan comes back to the session of ``df``, which stays as strict as it is.
    """
    spark = df.sparkSession
    sessions, frames = spark._jvm.org.apache.spark.sql.classic.SparkSession, spark._jvm.org.apache.spark.sql.classic.Dataset
    own = spark._jsparkSession
    apart = own.cloneSession()
    apart.conf().set("spark.sql.ansi.enabled", "false")
    sessions.setActiveSession(apart)
    try:
        loose = DataFrame(frames.ofRows(apart, df._jdf.queryExecution().analyzed()), SparkSession(spark.sparkContext, apart))
        plan = tested(loose)._jdf.queryExecution().analyzed()
    finally:
        sessions.setActiveSession(own)
    return DataFrame(frames.ofRows(own, plan), spark)


def _resolves(df: DataFrame, predicate: Column) -> bool:
    try:
        df.select(predicate)
    except AnalysisException as error:
        if (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            return False
        raise
    return True


def custom_rule(
    name: str,
    predicate: str | Column | Callable[[pd.DataFrame], pd.Series] | None,
    severity: str = "error",
    dimension: str = "validity",
    field: str | None = None,
    description: str = "",
    passed_message: str = "Rule passed",
    failed_message: str = "Rule failed",
    parameters: Mapping[str, object] | None = None,
    inputs: Sequence[str] | None = None,
) -> Rule:
    """Rule from a SQL predicate, in which ``{name}`` of a parameter stands for its value as a
    literal, from a boolean column, or from a vectorized function of the ``inputs`` columns.

    No predicate passes. One that cannot be decided for a record (NULL, a division by zero, an
    error of the function, a column the frame lacks) fails it with severity error.
    """
    if predicate is None:
        return Rule(name, severity, dimension, field, description)

    def check(df: DataFrame) -> tuple[Column, Message]:
        if isinstance(predicate, str):
            raw = F.expr(_bound(predicate, parameters or {}))
        elif isinstance(predicate, Column):
            raw = predicate
        else:
            fields = list(inputs or df.columns)
            raw = _by_batch(predicate, fields) if set(fields) <= set(df.columns) else F.lit(None).cast("boolean")
        if not _resolves(df, raw):
            raw = F.lit(None).cast("boolean")
        return raw, lambda passed: (
            F.when(passed.isNull(), "Validation rule execution failed")
            .when(passed, passed_message)
            .otherwise(failed_message)
        )

    return Rule(name, severity, dimension, field, description, check)


def value_rule(
    name: str,
    function: Callable[[object, Mapping[str, object], Mapping[str, object]], tuple[bool, str]],
    field: str,
    severity: str = "error",
    dimension: str = "validity",
    description: str = "",
    parameters: Mapping[str, object] | None = None,
    context: Sequence[str] | None = None,
) -> Rule:
    """Rule from a function of one value, ``function(value, parameters, context)``, that says
    whether it passes and why.

    The value is that of ``field``, NULL where the frame lacks it; ``context`` has the record's other
    columns by name, all of them unless some are chosen. An error of the function fails its record
    with severity error and the error in the message. It runs once for each record, in Arrow
    batches: state a rule as a predicate where one can say it.
    """
    given = dict(parameters or {})

    def check(df: DataFrame) -> tuple[Column, Message]:
        others = [c for c in (df.columns if context is None else context) if c != field and c in df.columns]

        def answer(value: object, around: Mapping[str, object]) -> tuple[bool | None, str]:
            try:
                passed, message = function(value, given, around)
                return bool(passed), str(message)
            except Exception as error:  # noqa: BLE001 - any error of a user's rule fails its record
                return None, f"Validation rule execution failed: {error}"

        @F.arrow_udf("struct<passed: boolean, message: string>")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                rows = batch.to_pylist()
                found = [answer(r["value"], dict(zip(others, r["others"].values(), strict=True)) if others else {}) for r in rows]
                yield pa.StructArray.from_arrays(
                    [pa.array([f[0] for f in found], pa.bool_()), pa.array([f[1] for f in found], pa.string())], names=["passed", "message"]
                )

        value = named(field) if field in df.columns else F.lit(None).cast("string")
        around = F.struct(*[named(c).alias(f"c{i}") for i, c in enumerate(others)] or [F.lit(0).alias("none")])
        return run(F.struct(value.alias("value"), around.alias("others"))), lambda answered: answered["message"]

    return Rule(name, severity, dimension, field, description, check, answers=True)


def passes(df: DataFrame, rule: Rule) -> Column:
    """Two-valued pass predicate of a rule on a frame; errors in it follow the session's SQL mode."""
    if rule.check is None:
        return F.lit(True)
    found = rule.check(df)[0]
    return flag(found["passed"] if rule.answers else found)


def _verdict(rule: Rule, message_of: Message | None, raw: Column, record_id: Column, at: Column) -> dict[str, Column]:
    if rule.check is None:
        passed, message = F.lit(True), F.lit("No validation function defined")
        severity, dimension = F.lit("info"), F.lit("validity")
    else:
        message, dimension = message_of(raw), F.lit(rule.dimension)
        raw = raw["passed"] if rule.answers else raw
        passed, severity = flag(raw), F.when(raw.isNull(), "error").otherwise(rule.severity)
    return {
        "rule_name": F.lit(rule.name),
        "passed": passed,
        "message": message,
        "severity": severity,
        "dimension": dimension,
        "record_id": record_id,
        "field_name": F.lit(rule.field).cast("string"),
        "checked_at": at,
    }


def dq_results(
    df: DataFrame,
    rules: Sequence[Rule],
    record_id: str = "record_id",
    only: Sequence[str] | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """One row per record and rule, from one narrow pass; ``only`` picks rules by name and
    ``as_of`` replaces the clock.

    Predicates are a projection below the explode, so each is evaluated once per record.
    """
    chosen = [r for r in rules if not only or r.name in only]
    key = named(record_id).cast("string") if record_id in df.columns else F.lit(None).cast("string")
    at = F.current_timestamp() if as_of is None else as_of
    checks: dict[int, tuple[Column, Message]] = {}

    def test(loose: DataFrame) -> DataFrame:
        checks.update({i: r.check(loose) for i, r in enumerate(chosen) if r.check})
        return loose.select("*", *[c[0].alias(f"_p{i}") for i, c in checks.items()])

    tested = _lenient(df, test)
    rows = [
        _verdict(r, checks[i][1] if i in checks else None, F.col(f"_p{i}"), key, at)
        for i, r in enumerate(chosen)
    ]
    return report_rows(tested, rows)


def _with_passes(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, list[Column]]:
    """The frame with one pass column per rule, and those columns in the order of the rules."""
    tested = _lenient(df, lambda loose: loose.select("*", *[passes(loose, r).alias(f"_p{i}") for i, r in enumerate(rules)]))
    return tested, [F.col(f"_p{i}") for i in range(len(rules))]


def _labels(rules: Sequence[Rule]) -> list[str]:
    """Names of the rules, with their field where a name repeats."""
    names = [r.name for r in rules]
    return [f"{r.name}:{r.field}" if names.count(r.name) > 1 and r.field else r.name for r in rules]


def dq_flags(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Adds ``data_quality_score`` and ``quality_flags``.

    With rules: the percentage passed, truncated, and the failed rules' names (as name:field
    where several share a name) or 'VALID'.
    Without: the constants 100 and 'VALID'.
    """
    if not rules:
        return df.withColumns(
            {"data_quality_score": F.lit(100), "quality_flags": F.lit("VALID")}
        )
    tested, passed = _with_passes(df, rules)
    count = reduce(add, [p.cast("int") for p in passed])
    failed_names = F.concat_ws(",", *[F.when(~p, n) for n, p in zip(_labels(rules), passed, strict=True)])
    named_failures = tested.select("*", failed_names.alias("_failed"))
    return named_failures.select(
        *[named(c) for c in df.columns],
        (count * 100 / len(rules)).cast("int").alias("data_quality_score"),
        F.when(F.col("_failed") == "", "VALID").otherwise(F.col("_failed")).alias("quality_flags"),
    )


def _percent(part: Column, whole: Column, empty: float = 0.0) -> Column:
    share = part.cast("double") / F.nullif(whole, F.lit(0)) * 100
    return F.coalesce(share, F.lit(empty))


def _distinct_keys(df: DataFrame, key_columns: Sequence[str]) -> Column:
    parts = [countable(named(k), field_type(df, k)) for k in key_columns]
    return F.count_distinct(F.struct(*parts))


def _comparable(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.MapType, T.VariantType))


def dq_field_profile(
    df: DataFrame,
    fields: Sequence[str] | None = None,
    formats: Mapping[str, Column] | None = None,
    exact: bool = True,
) -> DataFrame:
    """One row per field: counts, completeness, uniqueness, format and overall score.

    Counts come from one aggregation. Exact distinct counts group (field, key) pairs beside it;
    ``exact=False`` uses fixed-size sketches in the same aggregation.
    """
    chosen = list(fields or [f.name for f in df.schema.fields if _comparable(f.dataType)])
    formats = formats or {}
    parts = [F.count(F.lit(1)).alias("total")]
    for i, name in enumerate(chosen):
        value = named(name)
        ok = flag(formats[name]) if name in formats else F.lit(True)
        parts += [
            F.count(value).alias(f"n{i}"),
            (F.lit(None).cast("bigint") if exact else F.approx_count_distinct(value)).alias(f"u{i}"),
            F.count_if(value.isNotNull() & ok).alias(f"f{i}"),
        ]
    counted = report_rows(
        df.agg(*parts),
        [
            {
                "field_name": F.lit(name),
                "total_records": F.col("total"),
                "non_null_count": F.col(f"n{i}"),
                "_unique": F.col(f"u{i}"),
                "_formed": F.col(f"f{i}"),
            }
            for i, name in enumerate(chosen)
        ],
    )
    if exact:
        counted = counted.drop("_unique").join(
            distinct_counts(df, chosen).withColumnRenamed("unique_count", "_unique"), "field_name", "left"
        )
    total, filled = named("total_records"), named("non_null_count")
    unique = F.coalesce("_unique", F.lit(0).cast("bigint"))
    scores = {
        "completeness_score": _percent(filled, total),
        "uniqueness_score": _percent(unique, filled),
        "format_compliance_score": _percent(F.col("_formed"), filled),
    }
    return counted.select(
        "field_name",
        total,
        filled,
        unique.alias("unique_count"),
        (total - filled).alias("null_count"),
        (filled - unique).alias("duplicate_count"),
        *[v.alias(k) for k, v in scores.items()],
        (reduce(add, scores.values()) / 3).alias("overall_quality_score"),
    )


def dq_penalty(results: DataFrame, base: Mapping[str, float] | float = 100.0) -> DataFrame:
    """One row per dimension: its start score less the penalty per failed result."""
    start = base if isinstance(base, Mapping) else dict.fromkeys(DIMENSIONS, base)
    failed = [
        F.count_if(~named("passed") & (named("dimension") == d)).alias(d) for d in DIMENSIONS
    ]
    rows = [
        {
            "dimension": F.lit(d),
            "failed_count": named(d),
            "score": _penalised(start.get(d, 0.0), named(d)),
        }
        for d in DIMENSIONS
    ]
    return report_rows(results.agg(*failed), rows)


def _penalised(start: float, failures: Column) -> Column:
    return F.greatest(F.lit(0.0), F.lit(float(start)) - failures * PENALTY)


def dq_overall(scores: DataFrame, column: str = "score") -> DataFrame:
    """Mean of the scores above zero, 0 when there is none."""
    above = F.when(named(column) > 0, named(column))
    return scores.agg(F.coalesce(F.avg(above), F.lit(0.0)).alias("overall_quality_score"))


def dq_summary(
    df: DataFrame,
    dataset_name: str,
    rules: Sequence[Rule],
    key_columns: Sequence[str],
    base: Mapping[str, float] | float = 100.0,
) -> DataFrame:
    """One row about the dataset: record counts, dimension scores, overall score, issues."""
    start = base if isinstance(base, Mapping) else dict.fromkeys(DIMENSIONS, base)
    tested, passed = _with_passes(df, rules)
    valid = reduce(and_, passed, F.lit(True))

    def failures(chosen: Callable[[Rule], bool]) -> Column:
        counts = [F.count_if(~p) for r, p in zip(rules, passed, strict=True) if chosen(r)]
        return reduce(add, counts, F.lit(0).cast("bigint"))

    counted = tested.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(valid).alias("valid_records"),
        _distinct_keys(df, key_columns).alias("distinct_keys"),
        failures(lambda r: True).alias("validation_issues"),
        failures(lambda r: r.severity == "critical").alias("critical_issues"),
        *[failures(lambda r, d=d: r.dimension == d).alias(f"f_{d}") for d in DIMENSIONS],
    )
    total, ok = named("total_records"), named("valid_records")
    scores = {d: _penalised(start.get(d, 0.0), named(f"f_{d}")) for d in DIMENSIONS}
    scored = counted.select("*", *[s.alias(f"{d}_score") for d, s in scores.items()])
    columns = [named(f"{d}_score") for d in DIMENSIONS]
    above_sum = reduce(add, columns)
    above_n = reduce(add, [(c > 0).cast("int") for c in columns])
    overall = F.when(above_n > 0, F.try_divide(above_sum, above_n)).otherwise(0.0)
    return scored.select(
        F.lit(dataset_name).alias("dataset_name"),
        total,
        ok,
        (total - ok).alias("invalid_records"),
        (total - named("distinct_keys")).alias("duplicate_records"),
        _percent(ok, total).alias("success_rate"),
        *columns,
        overall.alias("overall_quality_score"),
        named("validation_issues"),
        named("critical_issues"),
    )


def dq_sanity(summary: DataFrame) -> DataFrame:
    """Checks on a summary table: name present, counts consistent, scores within 0..100."""
    checks = {
        "dataset_name is required": flag(named("dataset_name") != ""),
        "total_records cannot be negative": named("total_records") >= 0,
        "valid_records + invalid_records cannot exceed total_records": (
            named("valid_records") + named("invalid_records") <= named("total_records")
        ),
    }
    for score in [*(f"{d}_score" for d in DIMENSIONS), "overall_quality_score"]:
        checks[f"{score} must be between 0.0 and 100.0"] = named(score).between(0, 100)
    return report_rows(
        summary,
        [
            {"dataset_name": named("dataset_name"), "check": F.lit(m), "passed": flag(p)}
            for m, p in checks.items()
        ],
    )


def dq_gate(
    df: DataFrame,
    required: Sequence[str],
    failed: Column,
    quality: Column,
    max_failure_rate: float,
    max_null_fraction: float = MAX_NULL_FRACTION,
    min_quality_score: float = MIN_QUALITY_SCORE,
) -> DataFrame:
    """Pass/fail rows: failure rate, NULL fraction of each required field, mean quality.

    A required field the frame lacks counts as all NULL. An empty frame has rate 0.
    """
    have = present(df, required)
    total = named("total_records")
    counted = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(flag(failed)).alias("failed_records"),
        F.avg(quality).alias("mean_quality"),
        *[null_count(named(c)).alias(f"null_{c}") for c in have],
    )

    def share(part: Column) -> Column:
        return F.coalesce(part.cast("double") / F.nullif(total, F.lit(0)), F.lit(0.0))

    def row(check: str, observed: Column, limit: float, passed: Column) -> dict[str, Column]:
        return {
            "check": F.lit(check),
            "observed": observed.cast("double"),
            "threshold": F.lit(float(limit)),
            "total_records": total,
            "passed": flag(passed),
        }

    rate = share(named("failed_records"))
    rows = [row("failure_rate", rate, max_failure_rate, rate <= max_failure_rate)]
    for c in required:
        nulls = share(named(f"null_{c}")) if c in have else F.lit(1.0)
        rows.append(row(f"null_fraction:{c}", nulls, max_null_fraction, nulls <= max_null_fraction))
    mean = named("mean_quality")
    rows.append(row("min_quality_score", mean, min_quality_score, mean >= min_quality_score))
    return report_rows(counted, rows)


def require_gate(report: DataFrame) -> DataFrame:
    """The rows of a gate report, computed once, or an error naming the checks that failed."""
    rows = report.collect()
    broken = [r for r in rows if not r.passed]
    if broken:
        detail = "; ".join(
            f"Data quality check '{r.check}' failed: {r.observed} (threshold: {r.threshold})"
            for r in broken
        )
        raise QualityError(detail)
    return report.sparkSession.createDataFrame(rows, report.schema)


def dq_required_fields(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required field: missing or not, NULL count, verdict on all of them."""
    have = present(df, required)
    counted = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[null_count(named(c)).alias(f"null_{c}") for c in have],
    )
    clean = reduce(and_, [named(f"null_{c}") == 0 for c in have], F.lit(True))
    valid = clean & F.lit(len(have) == len(required))
    return report_rows(
        counted,
        [
            {
                "field_name": F.lit(c),
                "is_missing": F.lit(c not in have),
                "null_count": named(f"null_{c}") if c in have else F.lit(None).cast("bigint"),
                "total_records": named("total_records"),
                "is_valid": valid,
            }
            for c in required
        ],
    )


def require_fields(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The frame itself, or an error naming missing fields or fields with NULLs."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise QualityError(f"Missing required fields: {', '.join(missing)}")
    rows = dq_required_fields(df, required).filter("null_count > 0").collect()
    if rows:
        detail = "; ".join(f"{r.field_name}: {r.null_count} nulls" for r in rows)
        raise QualityError(f"Required fields contain null values: {detail}")
    return df


def _dimension(df: DataFrame, dimension: str, checked: Column, passed: Column) -> DataFrame:
    counted = df.agg(checked.cast("bigint").alias("checked"), passed.cast("bigint").alias("passed"))
    score = _percent(named("passed"), named("checked"))
    name = F.lit(dimension).alias("dimension")
    return counted.select(name, "checked", "passed", score.alias("score"))


def _rule_share(df: DataFrame, dimension: str, rules: Sequence[Rule]) -> DataFrame:
    tested, passed = _with_passes(df, rules)
    checked = F.count(F.lit(1)) * len(rules)
    return _dimension(tested, dimension, checked, reduce(add, [F.count_if(p) for p in passed]))


def dq_completeness(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Share of cells that hold a value."""
    chosen = list(fields or df.columns)
    filled = reduce(add, [F.count(named(c)) for c in chosen])
    return _dimension(df, "completeness", F.count(F.lit(1)) * len(chosen), filled)


def dq_validity(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Share of format-rule checks that pass."""
    return _rule_share(df, "validity", rules)


def dq_accuracy(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Share of range-rule checks that pass."""
    return _rule_share(df, "accuracy", rules)


def dq_consistency(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Share of cross-column-rule checks that pass."""
    return _rule_share(df, "consistency", rules)


def dq_uniqueness(df: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """Distinct keys among rows. Copies of a hot key are merged before the shuffle."""
    distinct = _distinct_keys(df, key_columns)
    return _dimension(df, "uniqueness", F.count(F.lit(1)), distinct)


def dq_timeliness(df: DataFrame, column: str, as_of: Column, max_age: str) -> DataFrame:
    """Share of rows no older than ``max_age`` (an interval text) at ``as_of``."""
    fresh = flag(named(column) >= as_of - F.expr(f"INTERVAL {max_age}"))
    return _dimension(df, "timeliness", F.count(F.lit(1)), F.count_if(fresh))


def dq_integrity(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Share of non-null child keys that exist in the parent.

    Child rows are counted per key first, so the join sees each key once on either side
    and one key holding most of the rows costs no more than a rare one.
    """
    counted = (
        child.filter(named(key).isNotNull())
        .groupBy(named(key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    known = parent.select(named(parent_key).alias("_key")).distinct()
    joined = counted.join(known.withColumn("_known", F.lit(True)), "_key", "left")
    found = F.sum(F.when(named("_known"), named("_rows")).otherwise(0))
    total = F.coalesce(F.sum("_rows"), F.lit(0))
    return _dimension(joined, "integrity", total, F.coalesce(found, F.lit(0)))
