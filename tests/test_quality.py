from __future__ import annotations

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.operators import contract as C
from tidewire.operators import quality as D
from tidewire.operators import runs as R
from tidewire.schemas import COMMUNICATION, DIMENSIONS, contract


def verdicts(df, *rules, **options):
    got = D.dq_results(df, rules, **options).orderBy("record_id", "rule_name").collect()
    return [(r.record_id, r.rule_name, r.passed, r.message) for r in got]


def test_email_rule(rows):
    df = rows([("1", "test@example.com"), ("2", "bad"), ("3", None)], "record_id string, email string")
    assert verdicts(df, D.rule_email()) == [
        ("1", "email_format", True, "Valid email format"),
        ("2", "email_format", False, "Invalid email format"),
        ("3", "email_format", False, "Email field not found"),
    ]
    number = rows([("1", 5), ("2", None)], "record_id string, email int")
    assert [v[3] for v in verdicts(number, D.rule_email())] == ["Email value must be a string", "Email field not found"]
    assert [v[3] for v in verdicts(number.drop("email"), D.rule_email())] == ["Email field not found"] * 2


def test_non_empty_rule(rows):
    df = rows([("1", "x"), ("2", " \xa0"), ("3", None)], "record_id string, v string")
    assert [v[2:] for v in verdicts(df, D.rule_non_empty("v"))] == [
        (True, "Value is not empty"), (False, "Value cannot be empty"), (False, "Value cannot be null"),
    ]
    assert verdicts(rows([("1", 0)], "record_id string, v int"), D.rule_non_empty("v"))[0][2] is True


def test_positive_rule(rows):
    df = rows([("1", 0.5), ("2", 0.0), ("3", -1.0), ("4", None)], "record_id string, v double")
    assert [v[3] for v in verdicts(df, D.rule_positive("v"))] == [
        "Value is a positive number", "Value must be positive", "Value must be positive", "Value must be a number",
    ]
    assert verdicts(rows([("1", "9")], "record_id string, v string"), D.rule_positive("v"))[0][3] == "Value must be a number"


def test_custom_rules(rows):
    df = rows([("1", "7"), ("2", "x")], "record_id string, v string")
    over = D.custom_rule("over", "try_cast(v AS int) > {low}", "warning", "accuracy", "v", parameters={"low": 5})
    got = D.dq_results(df, [over, D.custom_rule("free", None, "critical")]).orderBy("record_id", "rule_name").collect()
    assert [(r.rule_name, r.passed, r.severity, r.dimension) for r in got] == [
        ("free", True, "info", "validity"), ("over", True, "warning", "accuracy"),
        ("free", True, "info", "validity"), ("over", False, "error", "accuracy"),
    ]
    assert got[3].message == "Validation rule execution failed" and got[0].message == "No validation function defined"


def test_rule_subset_and_missing_id(rows):
    df = rows([(1, "a@b.com")], "k int, email string")
    assert verdicts(df, D.rule_email(), D.rule_non_empty("email"), only=["non_empty"]) == [(None, "non_empty", True, "Value is not empty")]
    assert len(verdicts(df, D.rule_email(), D.rule_non_empty("email"), record_id="k")) == 2


def test_field_profile(rows):
    df = rows([("a", 1), ("a", None), ("b", 2), (None, 2)], "s string, n int")
    got = {r.field_name: r for r in D.dq_field_profile(df, formats={"s": F.col("s") == "a"}).collect()}
    s = got["s"]
    assert (s.total_records, s.non_null_count, s.unique_count, s.null_count, s.duplicate_count) == (4, 3, 2, 1, 1)
    assert s.completeness_score == 75.0 and s.uniqueness_score == pytest.approx(200 / 3) and s.format_compliance_score == pytest.approx(200 / 3)
    assert s.overall_quality_score == pytest.approx((75 + 400 / 3) / 3) and got["n"].format_compliance_score == 100.0
    sketched = {r.field_name: r.unique_count for r in D.dq_field_profile(df, exact=False).collect()}
    assert sketched == {"s": 2, "n": 2}
    empty = D.dq_field_profile(df.limit(0)).first()
    assert (empty.total_records, empty.completeness_score) == (0, 0.0)


def test_penalty_and_overall(rows):
    data = [("completeness", False)] * 1 + [("validity", False)] * 30 + [("accuracy", True)] * 5
    results = rows(data, "dimension string, passed boolean")
    got = {r.dimension: (r.failed_count, r.score) for r in D.dq_penalty(results).collect()}
    assert set(got) == set(DIMENSIONS)
    assert got["completeness"] == (1, 95.0) and got["validity"] == (30, 0.0) and got["accuracy"] == (0, 100.0)
    assert D.dq_overall(D.dq_penalty(results)).first()[0] == pytest.approx((95 + 500) / 6)
    assert D.dq_overall(D.dq_penalty(results, 0.0)).first()[0] == 0.0
    assert D.dq_overall(D.dq_penalty(results, {"accuracy": 80.0})).first()[0] == 80.0


def test_summary_and_sanity(rows):
    df = rows([(1, "a@b.com", 5), (1, "bad", -1), (2, None, 3), (2, "c@d.org", 4)], "k int, email string, n int")
    critical = D.custom_rule("n_positive", "n > 0", "critical", "accuracy", "n")
    got = D.dq_summary(df, "people", [D.rule_email(), critical], ["k"])
    row = got.first()
    assert (row.total_records, row.valid_records, row.invalid_records, row.duplicate_records, row.success_rate) == (4, 2, 2, 2, 50.0)
    assert (row.validity_score, row.accuracy_score, row.completeness_score) == (90.0, 95.0, 100.0)
    assert row.overall_quality_score == pytest.approx(685 / 7) and (row.validation_issues, row.critical_issues) == (3, 1)
    assert all(r.passed for r in D.dq_sanity(got).collect())
    broken = got.withColumn("dataset_name", F.lit("")).withColumn("valid_records", F.lit(9)).withColumn("validity_score", F.lit(120.0))
    failed = [r.check for r in D.dq_sanity(broken).collect() if not r.passed]
    assert failed == [
        "dataset_name is required",
        "valid_records + invalid_records cannot exceed total_records",
        "validity_score must be between 0.0 and 100.0",
    ]
    empty = D.dq_summary(df.limit(0), "none", [D.rule_email()], ["k"]).first()
    assert (empty.total_records, empty.success_rate, empty.validation_issues) == (0, 0.0, 0)


def test_gate(rows):
    df = rows([(1, None, 0.9), (2, "x", 0.9)], "id int, v string, q double")
    got = {r.check: (r.observed, r.passed) for r in D.dq_gate(df, ["id", "v", "gone"], F.col("v").isNull(), F.col("q"), 0.4).collect()}
    assert got == {
        "failure_rate": (0.5, False), "null_fraction:id": (0.0, True), "null_fraction:v": (0.5, False),
        "null_fraction:gone": (1.0, False), "min_quality_score": (0.9, True),
    }
    assert D.dq_gate(df.limit(0), [], F.lit(True), F.col("q"), 0.1).first().passed is True


def test_strict_gate(rows):
    df = rows([(1, 0.9)], "id int, q double")
    good = D.dq_gate(df, ["id"], F.lit(False), F.col("q"), 0.4)
    assert D.require_gate(good).collect() == good.collect()
    with pytest.raises(D.QualityError, match="'failure_rate' failed: 1.0 .threshold: 0.4"):
        D.require_gate(D.dq_gate(df, ["id"], F.lit(True), F.col("q"), 0.4))


def test_rule_from_a_column(rows):
    df = rows([("1", "ab"), ("2", "b")], "record_id string, v string")
    long = D.custom_rule("long", F.length("v") > 1, field="v")
    assert [v[2] for v in verdicts(df, long)] == [True, False]


def test_required_fields(rows):
    df = rows([(1, None), (2, "x")], "id int, v string")
    got = {r.field_name: (r.is_missing, r.null_count, r.total_records, r.is_valid) for r in D.dq_required_fields(df, ["id", "v", "w"]).collect()}
    assert got == {"id": (False, 0, 2, False), "v": (False, 1, 2, False), "w": (True, None, 2, False)}
    assert D.dq_required_fields(df, ["id"]).first().is_valid is True
    assert D.require_fields(df, ["id"]) is df
    with pytest.raises(D.QualityError, match="Missing required fields: w"):
        D.require_fields(df, ["v", "w"])
    with pytest.raises(D.QualityError, match="v: 1 nulls"):
        D.require_fields(df, ["id", "v"])


def test_flags(rows):
    df = rows([("a@b.com", 1), ("bad", 0), (None, 2)], "email string, n int")
    got = [(r.data_quality_score, r.quality_flags) for r in D.dq_flags(df, [D.rule_email(), D.rule_positive("n"), D.rule_non_empty("email")]).collect()]
    assert got == [(100, "VALID"), (33, "email_format,positive_number"), (33, "email_format,non_empty")]
    assert [(r.data_quality_score, r.quality_flags) for r in D.dq_flags(df).collect()] == [(100, "VALID")] * 3


def test_dimensions(rows):
    df = rows([(1, "a", dt.datetime(2024, 1, 30)), (1, None, dt.datetime(2024, 1, 1)), (3, "c", None)], "k int, v string, at timestamp")
    now = F.lit("2024-01-31").cast("timestamp")
    assert D.dq_completeness(df, ["k", "v"]).first().score == pytest.approx(500 / 6)
    assert tuple(D.dq_uniqueness(df, ["k"]).first()) == ("uniqueness", 3, 2, pytest.approx(200 / 3))
    assert D.dq_timeliness(df, "at", now, "7 DAYS").first().passed == 1
    assert D.dq_validity(df, [D.rule_non_empty("v")]).first().passed == 2
    assert D.dq_accuracy(df, [D.custom_rule("r", "k BETWEEN 2 AND 5")]).first().passed == 1
    assert D.dq_consistency(df, [D.custom_rule("r", "(v IS NULL) = (k = 1)")]).first().passed == 2
    assert D.dq_completeness(df.limit(0)).first().score == 0.0


def test_integrity_with_a_hot_key(spark, rows):
    child = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id")).alias("fk"))
    parent = rows([(1,), (1,), (4,), (None,)], "pk bigint")
    got = D.dq_integrity(child, "fk", parent, "pk").first()
    assert (got.checked, got.passed) == (2000, 1002)  # 1000 hot rows, and the keys 1 and 4
    assert D.dq_integrity(child.limit(0), "fk", parent, "pk").first().score == 0.0


def test_long_text_counts_by_digest(rows):
    long = "é" * 200
    df = rows([(long,), (long,), (long + "x",), ("short",), (None,)], "t string")
    assert D.dq_uniqueness(df.na.drop(), ["t"]).first().passed == 3
    assert D.dq_field_profile(df).first().unique_count == 3
    assert C.table_diff(df, df, "exact").first().left_distinct == 3


def test_types_match():
    from pyspark.sql import types as T

    a = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.ArrayType(T.StringType()))])
    b = T.StructType([T.StructField("y", T.ArrayType(T.StringType(), False)), T.StructField("x", T.LongType(), False)])
    assert C.types_match(a, b) and not C.types_match(a, b, check_nullable=True)
    assert not C.types_match(T.LongType(), T.IntegerType())
    assert not C.types_match(T.MapType(T.StringType(), T.LongType()), T.MapType(T.StringType(), T.IntegerType()))
    assert C.types_match(T.MapType(T.StringType(), a), T.MapType(T.StringType(), b))
    assert not C.types_match(a, T.StructType(a.fields[:1]))
    assert not C.types_match(T.ArrayType(T.NullType()), T.ArrayType(T.StringType()))


def test_contract_check(rows):
    df = rows([("1", "5", 1.0), ("2", "x", None)], "id string, age string, extra double")
    want = contract({"id": "string", "age": "int", "born": "date"})
    got = {r.field_name: (r.status, r.null_count, r.uncastable_count, r.is_valid) for r in C.contract_check(df, want).collect()}
    assert list(got) == ["age", "born", "extra", "id"]
    assert got == {
        "age": ("type_mismatch", 0, 1, False), "born": ("missing", None, 0, False),
        "extra": ("extra", 1, 0, False), "id": ("ok", 0, 0, False),
    }
    assert all(r.is_valid for r in C.contract_check(df, contract({"id": "string"})).collect())
    strict = C.contract_check(df.select(F.coalesce("id", F.lit("")).alias("id")), contract({"id": "string"}), check_nullable=True)
    assert strict.first().status == "nullability_mismatch"


def test_contract_strict(rows):
    df = rows([("1", "a")], "id string, sender string")
    with pytest.raises(C.ContractError, match="missing fields: recipient"):
        C.contract_strict(df, COMMUNICATION)
    with pytest.raises(C.ContractError, match="field 'id': expected bigint, got string"):
        C.contract_strict(df, contract({"id": "bigint"}))
    assert C.contract_strict(df, contract({"id": "string"})) is df


def test_cast_to_contract(rows):
    df = rows([("1", "2024-01-01 00:00:00", "a", ["p"]), ("x", "bad", None, None)], "n string, at string, tags string, list array<string>")
    want = contract({"n": "int", "at": "timestamp", "tags": "array<string>", "list": "array<int>", "gone": "bigint"})
    got = C.cast_to_contract(df, want)
    assert got.drop("lost_cells").schema.simpleString() == want.simpleString()
    first, second = got.collect()
    assert (first.n, first.at, first.tags, first.gone, first.lost_cells) == (1, dt.datetime(2024, 1, 1), None, None, 2)
    assert (second.n, second.at, second.lost_cells) == (None, None, 2)


def test_table_diff_and_summary(rows):
    left = rows([(1, "a", 1.0), (2, None, 1.0)], "id int, v string, gone double")
    right = rows([(1, 5)], "id int, v int")
    got = {r.field_name: r for r in C.table_diff(left, right).collect()}
    assert (got["gone"].presence, got["id"].type_differs, got["v"].type_differs) == ("only_left", False, True)
    assert (got["v"].left_nulls, got["v"].right_rows, got["id"].left_distinct) == (1, 1, 2)
    assert not got["id"].schemas_identical
    assert C.table_diff(left, left, None).first().schemas_identical and C.table_diff(left, left, None).first().left_distinct is None
    summary = {r.field_name: r for r in C.table_summary(left).collect()}
    assert (summary["v"].field_type, summary["v"].null_fraction, summary["v"].total_fields, summary["v"].fields_of_type) == ("string", 0.5, 3, 1)


RUNS = "run_id bigint, job_name string, attempt_number int, max_attempts int, status string, started_at timestamp, completed_at timestamp, records_processed int, records_successful int"


def test_runs(rows):
    t = dt.datetime(2024, 1, 1)
    df = rows(
        [
            (1, "a", 1, 3, "completed", t, t + dt.timedelta(seconds=90, microseconds=500000), 100, 90),
            (2, "a", 3, 3, "running", t, None, 0, 0),
            (3, "b", 4, 3, "failed", None, t, 0, 0),
            (4, "", 0, 0, None, None, None, 0, 0),
        ],
        RUNS,
    )
    rates = {r.job_name: (r.success_rate, r.failure_rate) for r in R.run_rates(df).collect()}
    assert rates == {"a": (90.0, 10.0), "b": (0.0, 100.0), "": (0.0, 100.0)}
    assert [(r.duration_seconds, r.is_running) for r in R.run_duration(df).collect()] == [(90.5, False), (None, True), (None, False), (None, False)]
    assert [r.is_final_state for r in R.run_final_state(df).collect()] == [True, False, True, False]
    assert [r.can_retry for r in R.run_retry(df).collect()] == [True, False, False, False]
    broken = {(r.record_id, r.message) for r in R.run_validate(df).collect() if not r.passed}
    assert broken == {
        ("3", "attempt_number cannot exceed max_attempts"), ("4", "job_name is required"),
        ("4", "attempt_number must be positive"), ("4", "max_attempts must be positive"),
    }
    log = rows([(1, "error", 1, 0.5), (1, "error", 3, 0.7), (1, "output", 2, 0.6), (9, "error", 1, 0.1)], "run_id bigint, kind string, logged_at int, quality_score double")
    got = {r.run_id: (r.output_files_count, r.error_count, r.warning_count, r.quality_score, r.success) for r in R.run_summary(df, log).collect()}
    assert got[1] == (1, 2, 0, 0.7, True) and got[2] == (0, 0, 0, None, False) and set(got) == {1, 2, 3, 4}


def test_rules_of_one_name_count_each(rows):
    df = rows([(1, "x", "y"), (2, None, "y"), (3, "x", None)], "k int, a string, b string")
    both = [D.rule_non_empty("a"), D.rule_non_empty("b")]
    got = [(r.data_quality_score, r.quality_flags) for r in D.dq_flags(df, both).orderBy("k").collect()]
    assert got == [(100, "VALID"), (50, "non_empty:a"), (50, "non_empty:b")]
    row = D.dq_summary(df, "t", both, ["k"]).first()
    assert (row.valid_records, row.invalid_records, row.validation_issues, row.completeness_score) == (1, 2, 2, 90.0)


def test_errors_in_a_rule_fail_the_record(rows):
    df = rows([("1", 0, "a'b"), ("2", 5, "c"), ("3", 100, None)], "record_id string, n int, v string")

    def picky(batch):
        if (batch["n"] == 0).any():
            raise ValueError("zero")
        return batch["n"] > 10

    rules = [
        D.custom_rule("divides", "10 / n > 1", "warning"),
        D.custom_rule("gone", "nothing_here = 1", "warning"),
        D.custom_rule("bound", "v = {text} AND v RLIKE '^.{3}$'", "warning", parameters={"text": "a'b"}),
        D.custom_rule("picky", picky, "warning", inputs=["n"]),
        D.custom_rule("lost", picky, "warning", inputs=["absent"]),
    ]
    got = {(r.rule_name, r.record_id): (r.passed, r.severity) for r in D.dq_results(df, rules).collect()}
    error, failed, passed = (False, "error"), (False, "warning"), (True, "warning")
    assert [got["divides", k] for k in "123"] == [error, passed, failed]
    assert [got["gone", k] for k in "123"] == [error] * 3 == [got["lost", k] for k in "123"]
    assert [got["bound", k] for k in "123"] == [passed, failed, error]
    assert [got["picky", k] for k in "123"] == [error, failed, passed]
    at = F.lit("2024-01-31 00:00:00").cast("timestamp")
    assert str(D.dq_results(df, rules[:1], as_of=at).first().checked_at) == "2024-01-31 00:00:00"


def test_nested_casts(rows):
    from pyspark.sql import types as T

    inner = "struct<b:string,a:int>"
    df = rows(
        [((("x", 1)), [("2", 3), ("y", None)], {"k": "4", "l": "z"}), (None, None, None)],
        f"s {inner}, l array<{inner}>, m map<string,string>",
    )
    want = contract({"s": "struct<a:bigint,b:int>", "l": "array<struct<a:bigint,b:int>>", "m": "map<string,bigint>"})
    got = C.cast_to_contract(df, want)
    assert got.drop("lost_cells").schema.simpleString() == want.simpleString()
    first, second = got.collect()
    assert tuple(first.s) == (1, None) and [tuple(x) for x in first.l] == [(3, 2), (None, None)] and first.m == {"k": 4, "l": None}
    assert first.lost_cells == 3 and tuple(second) == (None, None, None, 0)
    checked = {r.field_name: r.uncastable_count for r in C.contract_check(df, want).collect()}
    assert checked == {"s": 1, "l": 1, "m": 1}
    found = C.type_differences(want["l"].dataType, df.schema["l"].dataType)
    assert found == [("[].a", "bigint", "int"), ("[].b", "int", "string")]
    assert C.type_differences(T.ArrayType(T.LongType()), T.LongType())[0] == ("", "array", "bigint")


def test_exact_counts_of_every_type(rows):
    df = rows(
        [(0.0, b"a", [1], dt.datetime(2024, 1, 1)), (-0.0, b"a", [1], dt.datetime(2024, 1, 1)), (float("nan"), b"b", [None], None), (None, None, None, None)],
        "d double, b binary, l array<int>, t timestamp",
    )
    got = {r.field_name: r.unique_count for r in D.dq_field_profile(df).collect()}
    assert got == {"d": 2, "b": 2, "l": 2, "t": 1}


def test_map_keys_are_cast(rows):
    df = rows([(1, {1: 10, 2: None}), (2, {}), (3, None)], "id int, m map<int,int>")
    contract = T.StructType([T.StructField("m", T.MapType(T.LongType(), T.IntegerType()))])
    out = C.cast_to_contract(df, contract)
    assert out.schema["m"].dataType.simpleString() == "map<bigint,int>"
    assert [(r.m, r.lost_cells) for r in out.collect()] == [({1: 10, 2: None}, 0), ({}, 0), (None, 0)]
    assert C.contract_check(df, contract).where("field_name = 'm'").first().uncastable_count == 0


def test_map_entries_lost_by_their_keys(spark, rows):
    df = spark.sql("SELECT map('1', '5', '01', '6', 'x', '7', '2', 'y') AS m")
    contract = T.StructType([T.StructField("m", T.MapType(T.IntegerType(), T.IntegerType()))])
    out = C.cast_to_contract(df, contract).first()
    # "01" meets the key of "1", "x" is no number, and the value "y" is none.
    assert out.m == {1: 5, 2: None} and out.lost_cells == 3
    nested = rows([([{"a": {1: "1", 2: "z"}}],)], "m array<map<string,map<int,string>>>")
    to = T.StructType([T.StructField("m", T.ArrayType(T.MapType(T.StringType(), T.MapType(T.LongType(), T.IntegerType()))))])
    found = C.cast_to_contract(nested, to).first()
    assert found.m == [{"a": {1: 1, 2: None}}] and found.lost_cells == 1


def test_lenient_rules_leave_the_session_strict(spark, rows):
    df = rows([("a", 0), ("b", 2)], "record_id string, n int")
    rule = D.custom_rule("ratio", "10 / n > 1")
    seen, stop = set(), threading.Event()

    def strict():
        while not stop.is_set():
            seen.add(spark.conf.get("spark.sql.ansi.enabled"))
            with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
                df.select(F.expr("10 / n")).collect()

    thread = threading.Thread(target=strict)
    thread.start()
    for _ in range(3):
        got = {r.record_id: (r.passed, r.severity) for r in D.dq_results(df, [rule]).collect()}
        assert got["a"] == (False, "error") and got["b"][0]
    stop.set()
    thread.join()
    assert seen == {"true"}
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_value_rule_gets_parameters_and_context(rows):
    def limit(value, parameters, context):
        if context["kind"] == "broken":
            raise ValueError("Rule execution error")
        top = parameters["limits"][context["kind"]]
        return value is not None and value <= top, f"{value} against {top}"

    df = rows([("1", 5, "a"), ("2", 50, "a"), ("3", 50, "b"), ("4", None, "b"), ("5", 1, "broken")], "record_id string, n int, kind string")
    rule = D.value_rule("limit", limit, "n", severity="warning", dimension="accuracy", parameters={"limits": {"a": 9, "b": 99}})
    got = {r.record_id: (r.passed, r.message, r.severity) for r in D.dq_results(df, [rule, D.rule_positive("n")]).collect() if r.rule_name == "limit"}
    assert got == {
        "1": (True, "5 against 9", "warning"), "2": (False, "50 against 9", "warning"), "3": (True, "50 against 99", "warning"),
        "4": (False, "None against 99", "warning"), "5": (False, "Validation rule execution failed: Rule execution error", "error"),
    }
    assert [r.data_quality_score for r in D.dq_flags(df, [rule]).orderBy("record_id").collect()] == [100, 0, 100, 0, 0]
    lone = D.value_rule("seen", lambda value, _p, context: (value is None and not context, "none"), "absent", context=[])
    assert {(r.passed, r.message) for r in D.dq_results(df, [lone]).collect()} == {(True, "none")}
