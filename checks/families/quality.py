"""Rules, profiles, scores and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import as_of, query, rounded, table, twin, view
from tidewire.functions.text import UNICODE_SPACE
from tidewire.operators import quality as D
from tidewire.schemas import DIMENSIONS

_EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
_WS = f"'{UNICODE_SPACE}'"

RULES = (
    D.rule_email("email"),
    D.rule_non_empty("name"),
    D.rule_positive("balance"),
    D.custom_rule("balance_range", "balance BETWEEN -500 AND {top}", "critical", "accuracy", "balance",
                  parameters={"top": 9000}),
    D.custom_rule("age_is_number", "TRY_CAST(age AS INT) >= 0", "warning", "consistency", "age"),
    D.custom_rule("nothing", None),
    D.rule_non_empty("phone"),
    D.custom_rule("share", "1000 / (id % 3) > 400", "warning", "validity", "id"),
    D.custom_rule("absent", "no_such_column > 1", "warning", "validity", "no_such_column"),
    D.custom_rule("bound_text", "name <> {word} AND name NOT RLIKE '^.{2}$'", "warning", "validity", "name",
                  parameters={"word": "it's {2} \\ 'odd'"}),
)

# Per rule: pass predicate (two-valued), message, severity, dimension, field.
_OK = {
    "email_format": f"coalesce(regexp_matches(email, '{_EMAIL}'), FALSE)",
    "non_empty": f"coalesce(trim(name, {_WS}) <> '', FALSE)",
    "positive_number": "coalesce(balance > 0, FALSE)",
    "balance_range": "coalesce(balance BETWEEN -500 AND 9000, FALSE)",
    "age_is_number": "coalesce(TRY_CAST(age AS INTEGER) >= 0, FALSE)",
    "nothing": "TRUE",
    "non_empty:phone": f"coalesce(trim(phone, {_WS}) <> '', FALSE)",
    "share": "coalesce(1000.0 / nullif(id % 3, 0) > 400, FALSE)",
    "absent": "FALSE",
    "bound_text": "coalesce(name <> 'x' AND length(name) <> 2, FALSE)",
}
_REST = {
    "email_format": (
        "CASE WHEN email IS NULL THEN 'Email field not found' WHEN {ok} THEN 'Valid email format' ELSE 'Invalid email format' END",
        "'error'", "validity", "'email'",
    ),
    "non_empty": (
        "CASE WHEN name IS NULL THEN 'Value cannot be null' WHEN {ok} THEN 'Value is not empty' ELSE 'Value cannot be empty' END",
        "'warning'", "completeness", "'name'",
    ),
    "positive_number": (
        "CASE WHEN balance IS NULL THEN 'Value must be a number' WHEN {ok} THEN 'Value is a positive number' ELSE 'Value must be positive' END",
        "'error'", "validity", "'balance'",
    ),
    "balance_range": (
        "CASE WHEN balance IS NULL THEN 'Validation rule execution failed' WHEN {ok} THEN 'Rule passed' ELSE 'Rule failed' END",
        "CASE WHEN balance IS NULL THEN 'error' ELSE 'critical' END", "accuracy", "'balance'",
    ),
    "age_is_number": (
        "CASE WHEN TRY_CAST(age AS INTEGER) IS NULL THEN 'Validation rule execution failed' WHEN {ok} THEN 'Rule passed' ELSE 'Rule failed' END",
        "CASE WHEN TRY_CAST(age AS INTEGER) IS NULL THEN 'error' ELSE 'warning' END", "consistency", "'age'",
    ),
    "non_empty:phone": (
        "CASE WHEN phone IS NULL THEN 'Value cannot be null' WHEN {ok} THEN 'Value is not empty' ELSE 'Value cannot be empty' END",
        "'warning'", "completeness", "'phone'",
    ),
    "share": (
        "CASE WHEN id % 3 = 0 THEN 'Validation rule execution failed' WHEN {ok} THEN 'Rule passed' ELSE 'Rule failed' END",
        "CASE WHEN id % 3 = 0 THEN 'error' ELSE 'warning' END", "validity", "'id'",
    ),
    "absent": ("'Validation rule execution failed'", "'error'", "validity", "'no_such_column'"),
    "bound_text": (
        "CASE WHEN name IS NULL THEN 'Validation rule execution failed' WHEN {ok} THEN 'Rule passed' ELSE 'Rule failed' END",
        "CASE WHEN name IS NULL THEN 'error' ELSE 'warning' END", "validity", "'name'",
    ),
    "nothing": ("'No validation function defined'", "'info'", "validity", "CAST(NULL AS VARCHAR)"),
}
_DIMENSION = {n: r[2] for n, r in _REST.items()}
_SEVERITY = {r.name: r.severity for r in RULES}


def _results(*names: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n.split(':')[0]}' AS rule_name, {_OK[n]} AS passed, {_REST[n][0].format(ok=_OK[n])} AS message, {_REST[n][1]} AS severity, "
        f"'{_REST[n][2]}' AS dimension, CAST(id AS VARCHAR) AS record_id, {_REST[n][3]} AS field_name, TIMESTAMP '2024-01-31 00:00:00' AS checked_at FROM v_dirty"
        for n in (names or _OK)
    )


def _dirty(spark, sf):
    return view(spark, sf, "v_dirty")


def _run(spark, sf, *names):
    return D.dq_results(_dirty(spark, sf), RULES, "id", names, as_of())


def _add(parts) -> str:
    return "(" + (" + ".join(parts) or "0") + ")"


def _fails(names) -> str:
    return f"CAST(coalesce(sum({_add(f'CASE WHEN {_OK[n]} THEN 0 ELSE 1 END' for n in names)}), 0) AS BIGINT)"


@query("dq_rule_email", twin("v_dirty", _results("email_format")))
def _(spark, sf):
    return _run(spark, sf, "email_format")


@query("dq_rule_non_empty", twin("v_dirty", _results("non_empty", "non_empty:phone")))
def _(spark, sf):
    return _run(spark, sf, "non_empty")


@query("dq_rule_positive", twin("v_dirty", _results("positive_number")))
def _(spark, sf):
    return _run(spark, sf, "positive_number")


_CUSTOM = ("balance_range", "age_is_number", "nothing", "share", "absent", "bound_text")


@query("dq_custom_rule", twin("v_dirty", _results(*_CUSTOM)))
def _(spark, sf):
    return _run(spark, sf, *_CUSTOM)


@query("dq_results", twin("v_dirty", _results()))
def _(spark, sf):
    return _run(spark, sf)


_FIELDS = {
    "o_orderkey": None,
    "o_custkey": None,
    "o_orderdate": "o_orderdate >= TIMESTAMP '1995-01-01 00:00:00'",
    "o_orderstatus": "o_orderstatus IN ('F', 'O')",
    "o_orderpriority": "o_orderpriority LIKE '%-%'",
    "o_totalprice": "o_totalprice > 1000",
}


@query(
    "dq_field_profile",
    "SELECT *, round((completeness_score + uniqueness_score + format_compliance_score) / 3, 6) AS overall_quality_score FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS field_name, count(*) AS total_records, count({c}) AS non_null_count, count(DISTINCT {c}) AS unique_count,
        count(*) - count({c}) AS null_count, count({c}) - count(DISTINCT {c}) AS duplicate_count,
        round(100.0 * count({c}) / count(*), 6) AS completeness_score, round(100.0 * count(DISTINCT {c}) / count({c}), 6) AS uniqueness_score,
        round(100.0 * sum(CASE WHEN {ok or 'TRUE'} THEN 1 ELSE 0 END) / count({c}), 6) AS format_compliance_score FROM orders"""
        for c, ok in _FIELDS.items()
    )
    + ")",
)
def _(spark, sf):
    formats = {c: F.expr(ok) for c, ok in _FIELDS.items() if ok}
    profile = D.dq_field_profile(table(spark, sf, "orders"), list(_FIELDS), formats)
    return rounded(
        profile, "completeness_score", "uniqueness_score", "format_compliance_score", "overall_quality_score"
    )


_BASE = {"completeness": 100.0, "accuracy": 50.0, "consistency": 90.0, "validity": 5000.0}
_PENALTY = " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, {_fails([n for n in _OK if _DIMENSION[n] == d])} AS failed_count, "
    f"CAST(greatest(0, {_BASE.get(d, 0.0)} - 5.0 * {_fails([n for n in _OK if _DIMENSION[n] == d])}) AS DOUBLE) AS score FROM v_dirty"
    for d in DIMENSIONS
)


@query("dq_penalty", twin("v_dirty", _PENALTY))
def _(spark, sf):
    return D.dq_penalty(_run(spark, sf), _BASE)


@query(
    "dq_overall",
    twin("v_dirty", f"SELECT coalesce(round(avg(CASE WHEN score > 0 THEN score END), 6), 0) AS overall_quality_score FROM ({_PENALTY})"),
)
def _(spark, sf):
    scores = D.dq_penalty(_run(spark, sf), _BASE)
    return rounded(D.dq_overall(scores), "overall_quality_score")


# Two rules of one name, on two columns.
_SUM_RULES = ("email_format", "non_empty", "non_empty:phone", "positive_number", "balance_range")
_ALL_OK = " AND ".join(_OK[n] for n in _SUM_RULES)
_SUM_BASE = {"completeness": 10000.0, "accuracy": 1000000.0, "validity": 1000000.0, "uniqueness": 100.0}


def _sum_score(d: str) -> str:
    n = _fails([r for r in _SUM_RULES if _DIMENSION[r] == d])
    return f"CAST(greatest(0, {_SUM_BASE.get(d, 0.0)} - 5.0 * {n}) AS DOUBLE)"


_SUMMARY = f"""SELECT *, coalesce(round(list_avg(list_filter([{', '.join(f'{d}_score' for d in DIMENSIONS)}], lambda x: x > 0)), 6), 0) AS overall_quality_score FROM (
SELECT 'customers' AS dataset_name, count(*) AS total_records, CAST(sum(CASE WHEN {_ALL_OK} THEN 1 ELSE 0 END) AS BIGINT) AS valid_records,
  CAST(sum(CASE WHEN {_ALL_OK} THEN 0 ELSE 1 END) AS BIGINT) AS invalid_records,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT email, phone FROM v_dirty)) AS duplicate_records,
  round(100.0 * sum(CASE WHEN {_ALL_OK} THEN 1 ELSE 0 END) / count(*), 6) AS success_rate,
  {', '.join(f'{_sum_score(d)} AS {d}_score' for d in DIMENSIONS)},
  {_fails(_SUM_RULES)} AS validation_issues, {_fails(['balance_range'])} AS critical_issues FROM v_dirty)"""


def _ruled(names):
    """Rules by SQL name, in the order of the names."""
    by_name = {f"{r.name}:{r.field}": r for r in RULES}
    plain = {r.name: r for r in reversed(RULES)}
    return [by_name.get(n) or plain[n] for n in names]


def _summary(spark, sf):
    return D.dq_summary(_dirty(spark, sf), "customers", _ruled(_SUM_RULES), ["email", "phone"], _SUM_BASE)


@query("dq_summary", twin("v_dirty", _SUMMARY))
def _(spark, sf):
    return rounded(_summary(spark, sf), "success_rate", "overall_quality_score")


_CHECKS = {
    "dataset_name is required": "dataset_name <> ''",
    "total_records cannot be negative": "total_records >= 0",
    "valid_records + invalid_records cannot exceed total_records": "valid_records + invalid_records <= total_records",
    **{
        f"{s} must be between 0.0 and 100.0": f"{s} BETWEEN 0 AND 100"
        for s in [*(f"{d}_score" for d in DIMENSIONS), "overall_quality_score"]
    },
}


@query(
    "dq_sanity",
    twin(
        "v_dirty",
        " UNION ALL ".join(
            f"SELECT dataset_name, '{m}' AS \"check\", {p} AS passed FROM ({_SUMMARY})" for m, p in _CHECKS.items()
        ),
    ),
)
def _(spark, sf):
    return D.dq_sanity(_summary(spark, sf))


_GATE_NULLS = ("id", "email", "age")


@query(
    "dq_gate",
    twin(
        "v_dirty",
        f"""SELECT 'failure_rate' AS "check", round(avg(CASE WHEN {_OK['email_format']} THEN 0.0 ELSE 1.0 END), 6) AS observed,
          CAST(0.5 AS DOUBLE) AS threshold, count(*) AS total_records, avg(CASE WHEN {_OK['email_format']} THEN 0.0 ELSE 1.0 END) <= 0.5 AS passed FROM v_dirty UNION ALL """
        + " UNION ALL ".join(
            f"SELECT 'null_fraction:{c}', round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6), 0.05, count(*), "
            f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) <= 0.05 FROM v_dirty"
            for c in _GATE_NULLS
        )
        + """ UNION ALL SELECT 'null_fraction:absent', 1.0, 0.05, count(*), FALSE FROM v_dirty
        UNION ALL SELECT 'min_quality_score', round(avg(CASE WHEN phone IS NULL THEN 0.0 ELSE 1.0 END), 6), 0.8, count(*),
          avg(CASE WHEN phone IS NULL THEN 0.0 ELSE 1.0 END) >= 0.8 FROM v_dirty""",
    ),
)
def _(spark, sf):
    df = _dirty(spark, sf)
    failed = ~D.passes(df, D.rule_email("email"))
    quality = F.col("phone").isNotNull().cast("double")
    return rounded(D.dq_gate(df, [*_GATE_NULLS, "absent"], failed, quality, 0.5), "observed")


@query(
    "dq_required_fields",
    twin(
        "v_dirty",
        " UNION ALL ".join(
            f"SELECT '{c}' AS field_name, FALSE AS is_missing, count(*) - count({c}) AS null_count, count(*) AS total_records, FALSE AS is_valid FROM v_dirty"
            for c in _GATE_NULLS
        )
        + " UNION ALL SELECT 'absent', TRUE, NULL, count(*), FALSE FROM v_dirty",
    ),
)
def _(spark, sf):
    return D.dq_required_fields(_dirty(spark, sf), [*_GATE_NULLS, "absent"])


_FLAG_RULES = _SUM_RULES
_FLAG_NAMES = {"non_empty": "non_empty:name"}


@query(
    "dq_flags",
    twin(
        "v_dirty",
        "SELECT id, CAST(trunc("
        + _add(f"CASE WHEN {_OK[n]} THEN 1 ELSE 0 END" for n in _FLAG_RULES)
        + f" * 100 / {len(_FLAG_RULES)}.0) AS INTEGER) AS data_quality_score, CASE WHEN flags = '' THEN 'VALID' ELSE flags END AS quality_flags FROM (SELECT *, concat_ws(',', "
        + ", ".join(f"CASE WHEN NOT {_OK[n]} THEN '{_FLAG_NAMES.get(n, n)}' END" for n in _FLAG_RULES)
        + ") AS flags FROM v_dirty)",
    ),
)
def _(spark, sf):
    return D.dq_flags(_dirty(spark, sf), _ruled(_FLAG_RULES)).select("id", "data_quality_score", "quality_flags")


def _score(dimension: str, checked: str, passed: str, source: str) -> str:
    return f"""SELECT '{dimension}' AS dimension, checked, passed, round(100.0 * passed / checked, 6) AS score
    FROM (SELECT CAST({checked} AS BIGINT) AS checked, CAST({passed} AS BIGINT) AS passed FROM {source})"""


def _count(condition: str) -> str:
    return f"sum(CASE WHEN {condition} THEN 1 ELSE 0 END)"


@query(
    "dq_completeness",
    twin("v_dirty", _score("completeness", "count(*) * 4", "count(name) + count(email) + count(phone) + count(age)", "v_dirty")),
)
def _(spark, sf):
    return rounded(D.dq_completeness(_dirty(spark, sf), ["name", "email", "phone", "age"]), "score")


@query(
    "dq_validity",
    twin("v_dirty", _score("validity", "count(*) * 2", f"{_count(_OK['email_format'])} + {_count(_OK['positive_number'])}", "v_dirty")),
)
def _(spark, sf):
    return rounded(D.dq_validity(_dirty(spark, sf), [RULES[0], RULES[2]]), "score")


@query("dq_uniqueness", _score("uniqueness", "count(*)", "count(DISTINCT text)", "documents"))
def _(spark, sf):
    return rounded(D.dq_uniqueness(table(spark, sf, "documents"), ["text"]), "score")


@query(
    "dq_accuracy",
    _score(
        "accuracy",
        "count(*) * 2",
        f"{_count('l_discount BETWEEN 0 AND 0.05')} + {_count('l_quantity BETWEEN 1 AND 40')}",
        "lineitem",
    ),
)
def _(spark, sf):
    ranges = [
        D.custom_rule("discount_range", "l_discount BETWEEN 0 AND 0.05", dimension="accuracy"),
        D.custom_rule("quantity_range", "l_quantity BETWEEN 1 AND 40", dimension="accuracy"),
    ]
    return rounded(D.dq_accuracy(table(spark, sf, "lineitem"), ranges), "score")


@query(
    "dq_consistency",
    _score("consistency", "count(*)", _count("(l_linestatus = 'O') = (l_returnflag = 'N')"), "lineitem"),
)
def _(spark, sf):
    rule = D.custom_rule("status_agrees", "(l_linestatus = 'O') = (l_returnflag = 'N')", dimension="consistency")
    return rounded(D.dq_consistency(table(spark, sf, "lineitem"), [rule]), "score")


@query(
    "dq_timeliness",
    _score("timeliness", "count(*)", _count("ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL '7' DAY"), "events"),
)
def _(spark, sf):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return rounded(D.dq_timeliness(table(spark, sf, "events"), "ts", now, "7 DAYS"), "score")


@query(
    "dq_integrity",
    _score(
        "integrity",
        "count(*)",
        _count("EXISTS (SELECT 1 FROM customer WHERE c_custkey * 2 = o_custkey)"),
        "orders",
    ),
)
def _(spark, sf):
    parents = table(spark, sf, "customer").selectExpr("c_custkey * 2 AS c_custkey")
    return rounded(D.dq_integrity(table(spark, sf, "orders"), "o_custkey", parents, "c_custkey"), "score")
