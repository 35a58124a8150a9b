"""Schema contracts as reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import query, rounded, table, twin, view
from checks.families.conform import _EMAIL, _LINES
from tidewire.operators import contract as C
from tidewire.operators.conform import conform_email
from tidewire.operators.transform import select_contract
from tidewire.schemas import COMMUNICATION, contract

# The dirty table against a contract that it breaks in every way.
_DIRTY = {"id": "bigint", "balance": "string", "name": "string", "age": "int", "email": "string", "joined": "timestamp"}
# Nested fields that castable, reordered and uncastable values stand in.
_NESTED = {"who": "struct<id:bigint,age:int>", "parts": "array<struct<id:bigint,age:int>>", "by_name": "map<string,int>"}
_LOST = "sum(CASE WHEN age IS NOT NULL AND TRY_CAST(age AS INTEGER) IS NULL THEN 1 ELSE 0 END)"


def _nested(df):
    number = F.col("id").cast("int").alias("id")
    return df.select(
        "*",
        F.struct("age", number).alias("who"),
        F.array(F.struct(number, "age"), F.struct(number, F.lit(None).cast("string").alias("age"))).alias("parts"),
        F.create_map(F.lit("age"), "age").alias("by_name"),
    )


def _row(name, status, expected, actual, nulls, lost="0") -> str:
    def text(x):
        return f"'{x}'" if x else "CAST(NULL AS VARCHAR)"

    return (
        f"SELECT '{name}' AS field_name, '{status}' AS status, {text(expected)} AS expected_type, {text(actual)} AS actual_type, "
        f"CAST({nulls} AS BIGINT) AS null_count, CAST({lost} AS BIGINT) AS uncastable_count, count(*) AS rows, FALSE AS is_valid FROM v_dirty"
    )


def _nulls(c: str) -> str:
    return f"count(*) - count({c})"


@query(
    "contract_check",
    twin(
        "v_dirty",
        " UNION ALL ".join(
            [
                _row("id", "ok", "bigint", "bigint", _nulls("id")),
                _row("balance", "type_mismatch", "string", "double", _nulls("balance")),
                _row("name", "ok", "string", "string", _nulls("name")),
                _row("age", "type_mismatch", "int", "string", _nulls("age"), _LOST),
                _row("email", "ok", "string", "string", _nulls("email")),
                _row("joined", "missing", "timestamp", None, "NULL"),
                _row("phone", "extra", None, "string", _nulls("phone")),
                _row("note", "extra", None, "string", _nulls("note")),
                _row("who", "type_mismatch", _NESTED["who"], "struct<age:string,id:int>", "0", _LOST),
                _row("parts", "type_mismatch", _NESTED["parts"], "array<struct<id:int,age:string>>", "0", _LOST),
                _row("by_name", "type_mismatch", _NESTED["by_name"], "map<string,string>", "0", _LOST),
            ]
        ),
    ),
)
def _(spark, sf):
    return C.contract_check(_nested(view(spark, sf, "v_dirty")), contract({**_DIRTY, **_NESTED}))


@query(
    "contract_strict",
    twin("v_email_raw", f"{_LINES} SELECT id, sender, recipient, timestamp, body, subject, channel FROM ({_EMAIL})"),
)
def _(spark, sf):
    rows = select_contract(conform_email(view(spark, sf, "v_email_raw")), COMMUNICATION)
    held = C.contract_strict(rows, COMMUNICATION, "communication")
    return held.select("id", "sender", "recipient", "timestamp", "body", "subject", "channel")


@query(
    "cast_to_contract",
    twin(
        "v_dirty",
        """SELECT id, CAST(balance AS VARCHAR) AS balance, name, TRY_CAST(age AS INTEGER) AS age, email, CAST(NULL AS TIMESTAMP) AS joined,
        id AS inner_id, TRY_CAST(age AS INTEGER) AS inner_age, TRY_CAST(age AS INTEGER) AS first_age, id AS second_id,
        TRY_CAST(age AS INTEGER) AS map_age,
        CASE WHEN age IS NOT NULL AND TRY_CAST(age AS INTEGER) IS NULL THEN 4 ELSE 0 END AS lost_cells FROM v_dirty""",
    ),
)
def _(spark, sf):
    wide = _nested(view(spark, sf, "v_dirty"))
    cast = C.cast_to_contract(wide, contract({**_DIRTY, **_NESTED}))
    # The struct came with its fields the other way round.
    assert cast.schema["who"].dataType.fieldNames() == ["id", "age"]
    return cast.selectExpr(
        "id", "balance", "name", "age", "email", "joined", "who.id AS inner_id", "who.age AS inner_age",
        "parts[0].age AS first_age", "parts[1].id AS second_id", "by_name['age'] AS map_age", "lost_cells",
    )


def _diff_row(name, presence, left, right) -> str:
    def side(s, spec):
        if spec is None:
            return f"CAST(NULL AS VARCHAR) AS {s}_type, CAST(NULL AS BOOLEAN) AS {s}_nullable, CAST(NULL AS BIGINT) AS {s}_rows, CAST(NULL AS BIGINT) AS {s}_nulls, CAST(NULL AS BIGINT) AS {s}_distinct"
        t, tab, col = spec
        return f"'{t}' AS {s}_type, TRUE AS {s}_nullable, (SELECT count(*) FROM {tab}) AS {s}_rows, (SELECT count(*) - count({col}) FROM {tab}) AS {s}_nulls, (SELECT count(DISTINCT {col}) FROM {tab}) AS {s}_distinct"

    return f"SELECT '{name}' AS field_name, {side('left', left)}, {side('right', right)}, '{presence}' AS presence, FALSE AS type_differs, FALSE AS schemas_identical"


@query(
    "table_diff",
    " UNION ALL ".join(
        [
            _diff_row("quantity", "only_left", ("double", "lineitem", "l_quantity"), None),
            _diff_row("orderkey", "both", ("bigint", "lineitem", "l_orderkey"), ("bigint", "orders", "o_orderkey")),
            _diff_row("status", "both", ("string", "lineitem", "l_linestatus"), ("string", "orders", "o_orderstatus")),
            _diff_row("priority", "only_right", None, ("string", "orders", "o_orderpriority")),
        ]
    ),
)
def _(spark, sf):
    left = table(spark, sf, "lineitem").selectExpr("l_orderkey AS orderkey", "l_quantity AS quantity", "l_linestatus AS status")
    right = table(spark, sf, "orders").selectExpr("o_orderkey AS orderkey", "o_orderstatus AS status", "o_orderpriority AS priority")
    return C.table_diff(left, right, distinct="exact")


_SUMMARY = {"id": "bigint", "balance": "double", "name": "string", "email": "string", "phone": "string", "age": "string", "note": "string"}


@query(
    "table_summary",
    twin(
        "v_dirty",
        " UNION ALL ".join(
            f"SELECT '{c}' AS field_name, '{t}' AS field_type, {list(_SUMMARY.values()).count(t)} AS fields_of_type, "
            f"{len(_SUMMARY)} AS total_fields, round(1.0 - count({c}) / count(*), 6) AS null_fraction FROM v_dirty"
            for c, t in _SUMMARY.items()
        ),
    ),
)
def _(spark, sf):
    return rounded(C.table_summary(view(spark, sf, "v_dirty")).drop("is_nullable"), "null_fraction")
