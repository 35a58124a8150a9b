"""Schema contracts as table reports: schema verdict plus counts from one aggregation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.columns import (
    distinct_counts,
    field_type,
    named,
    null_count,
    report_rows,
    typed_null,
)


class ContractError(ValueError):
    """A frame does not fit its contract."""


def _leaves(data_type: T.DataType, path: str = "", nullable: bool = True) -> dict[str, tuple[str, bool]]:
    """Every level of a type by its path: the kind found there, and whether it may be NULL."""
    out: dict[str, tuple[str, bool]] = {}
    todo = [(path, data_type, nullable)]
    while todo:
        at, kind, may_be_null = todo.pop()
        below = []
        if isinstance(kind, T.StructType):
            below = [(f"{at}.{f.name}", f.dataType, f.nullable) for f in kind.fields]
        elif isinstance(kind, T.ArrayType):
            below = [(f"{at}[]", kind.elementType, kind.containsNull)]
        elif isinstance(kind, T.MapType):
            below = [(f"{at}{{key}}", kind.keyType, False), (f"{at}{{value}}", kind.valueType, kind.valueContainsNull)]
        nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
        out[at] = (kind.typeName() if nested else kind.simpleString(), may_be_null)
        todo += below
    return out


def type_differences(
    expected: T.DataType, actual: T.DataType, check_nullable: bool = False
) -> list[tuple[str, str | None, str | None]]:
    """(path, expected, actual) of every level that differs; None where a side has no such path.

    Struct fields match by name. ``check_nullable`` also compares which levels may be NULL.
    """
    left, right = _leaves(expected), _leaves(actual)

    def shown(found: tuple[str, bool] | None) -> str | None:
        if found is None:
            return None
        return found[0] + ("" if found[1] else " not null") if check_nullable else found[0]

    pairs = [(path, shown(left.get(path)), shown(right.get(path))) for path in sorted({*left, *right})]
    return [p for p in pairs if p[1] != p[2]]


def types_match(expected: T.DataType, actual: T.DataType, check_nullable: bool = False) -> bool:
    """Whether no level of the two types differs."""
    return not type_differences(expected, actual, check_nullable)


def _status(expected: T.StructType, df: DataFrame, name: str, check_nullable: bool) -> str:
    if name not in df.columns:
        return "missing"
    if name not in expected.fieldNames():
        return "extra"
    if not types_match(expected[name].dataType, field_type(df, name), check_nullable):
        return "type_mismatch"
    if check_nullable and expected[name].nullable != df.schema[name].nullable:
        return "nullability_mismatch"
    return "ok"


def _nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StructType, T.ArrayType, T.MapType))


def _convert(value: Column, have: T.DataType, to: T.DataType) -> tuple[Column, Column]:
    """The value in the contract's type, and how many non-null values inside it the casts lose.

    Struct fields go by name into the contract's order, elements, map keys and values one by one.
    """
    if have.simpleString() == to.simpleString():
        return value, F.lit(0)
    if isinstance(have, T.StructType) and isinstance(to, T.StructType):
        inner = {f.name: f.dataType for f in have.fields}
        cells, lost = [], F.lit(0)
        for f in to.fields:
            if f.name not in inner:
                cells.append(typed_null(f.dataType).alias(f.name))
                continue
            cell, gone = _convert(value.getField(f.name), inner[f.name], f.dataType)
            cells.append(cell.alias(f.name))
            lost = lost + gone
        return F.when(value.isNotNull(), F.struct(*cells)), F.when(value.isNotNull(), lost).otherwise(0)
    if isinstance(have, T.ArrayType) and isinstance(to, T.ArrayType):
        made = F.transform(value, lambda x: _convert(x, have.elementType, to.elementType)[0])
        return made, _sum_of(value, lambda x: _convert(x, have.elementType, to.elementType)[1])
    if isinstance(have, T.MapType) and isinstance(to, T.MapType) and have.keyType != to.keyType:
        return _convert_map(value, have, to)
    if isinstance(have, T.MapType) and isinstance(to, T.MapType):
        made = F.transform_values(value, lambda _k, x: _convert(x, have.valueType, to.valueType)[0])
        return made, _sum_of(F.map_values(value), lambda x: _convert(x, have.valueType, to.valueType)[1])
    numeric_to_date = isinstance(to, (T.DateType, T.TimestampNTZType)) and isinstance(
        have, (T.NumericType, T.BooleanType)
    )
    castable = isinstance(to, T.StringType) or not (_nested(to) or _nested(have))
    made = value.try_cast(to) if castable and not numeric_to_date else typed_null(to)
    return made, (value.isNotNull() & made.isNull()).cast("int")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, whatever the number of uses."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _convert_map(value: Column, have: T.MapType, to: T.MapType) -> tuple[Column, Column]:
    """A map with its keys cast too.

    An entry is lost if no cast keeps its key, or if its key is then that of an entry before it;
    it counts as one value. Maps stay as they are ordered.
    """

    def cast_entry(entry: Column) -> Column:
        key, lost_key = _convert(entry["key"], have.keyType, to.keyType)
        cell, lost = _convert(entry["value"], have.valueType, to.valueType)
        return F.struct(key.alias("key"), cell.alias("value"), (lost_key + lost).alias("lost"))

    def first_of_key(entries: Column) -> Column:
        keys = F.transform(entries, lambda e: e["key"])
        kept = lambda k: F.filter(
            entries, lambda e, i: e["key"].isNotNull() & (F.array_position(k, e["key"]) == i + 1)
        )
        return _let(keys, kept)

    def made(entries: Column) -> Column:
        return _let(
            first_of_key(entries),
            lambda kept: F.struct(
                F.map_from_entries(F.transform(kept, lambda e: F.struct(e["key"], e["value"]))).alias("map"),
                (F.size(entries) - F.size(kept) + _sum_of(kept, lambda e: e["lost"])).alias("lost"),
            ),
        )

    out = _let(F.transform(F.map_entries(value), cast_entry), made)
    return F.when(value.isNotNull(), out["map"]), F.when(value.isNotNull(), out["lost"]).otherwise(0)


def _sum_of(values: Column, count: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.aggregate(values, F.lit(0), lambda n, x: n + count(x)), F.lit(0))


def contract_check(
    df: DataFrame, contract: T.StructType, check_nullable: bool = False
) -> DataFrame:
    """One row per field of the frame or the contract, sorted by name.

    Extra fields are warnings only. Counts come from one aggregation over the data; inside
    nested fields ``uncastable_count`` counts the single values that no cast can keep.
    :func:`type_differences` names the levels of a field that differ.
    """
    names = sorted({*df.columns, *contract.fieldNames()})
    status = {n: _status(contract, df, n, check_nullable) for n in names}
    valid = all(s in ("ok", "extra") for s in status.values())
    parts = [F.count(F.lit(1)).alias("rows")]
    for i, n in enumerate(names):
        if status[n] == "missing":
            continue
        parts.append(null_count(named(n)).alias(f"null_{i}"))
        if status[n] == "type_mismatch":
            lost = _convert(named(n), field_type(df, n), contract[n].dataType)[1]
            parts.append(F.coalesce(F.sum(lost.cast("bigint")), F.lit(0).cast("bigint")).alias(f"lost_{i}"))
    rows = []
    for i, n in enumerate(names):
        in_contract, in_frame = n in contract.fieldNames(), n in df.columns
        expected = contract[n].dataType.simpleString() if in_contract else None
        actual = field_type(df, n).simpleString() if in_frame else None
        nulls = named(f"null_{i}") if in_frame else typed_null("bigint")
        lost = named(f"lost_{i}") if status[n] == "type_mismatch" else F.lit(0).cast("bigint")
        rows.append(
            {
                "field_name": F.lit(n),
                "status": F.lit(status[n]),
                "expected_type": F.lit(expected).cast("string"),
                "actual_type": F.lit(actual).cast("string"),
                "null_count": nulls,
                "uncastable_count": lost,
                "rows": named("rows"),
                "is_valid": F.lit(valid),
            }
        )
    return report_rows(df.agg(*parts), rows)


def contract_strict(df: DataFrame, contract: T.StructType, name: str = "contract") -> DataFrame:
    """The frame itself, or an error: missing fields first, else the first mismatch."""
    missing = [n for n in contract.fieldNames() if n not in df.columns]
    if missing:
        raise ContractError(f"{name}: missing fields: {', '.join(missing)}")
    for f in contract.fields:
        if not types_match(f.dataType, field_type(df, f.name)):
            actual = field_type(df, f.name).simpleString()
            expected = f.dataType.simpleString()
            raise ContractError(f"{name}: field '{f.name}': expected {expected}, got {actual}")
    return df


def cast_to_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Contract columns by ``try_cast``, absent ones as typed NULL, and ``lost_cells``:
    how many values of the row, nested ones included, the casts could not keep."""
    cells, lost = [], F.lit(0)
    for f in contract.fields:
        if f.name not in df.columns:
            cells.append(typed_null(f.dataType).alias(f.name))
            continue
        cell, gone = _convert(named(f.name), field_type(df, f.name), f.dataType)
        cells.append(cell.alias(f.name))
        lost = lost + gone
    return df.select(*cells, lost.alias("lost_cells"))


def _side(df: DataFrame, side: str, distinct: str | None) -> DataFrame:
    """Per-field facts of one table from one aggregation; exact distinct counts beside it."""
    usable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    parts = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(df.schema.fields):
        sketched = distinct == "approx" and f.name in usable
        unique = F.approx_count_distinct(named(f.name)) if sketched else typed_null("bigint")
        parts += [null_count(named(f.name)).alias(f"n{i}"), unique.alias(f"u{i}")]
    rows = [
        {
            "field_name": F.lit(f.name),
            f"{side}_type": F.lit(f.dataType.simpleString()),
            f"{side}_nullable": F.lit(f.nullable),
            f"{side}_rows": named("rows"),
            f"{side}_nulls": named(f"n{i}"),
            f"{side}_distinct": named(f"u{i}"),
        }
        for i, f in enumerate(df.schema.fields)
    ]
    facts = report_rows(df.agg(*parts), rows)
    if distinct != "exact" or not usable:
        return facts
    counts = distinct_counts(df, usable).withColumnRenamed("unique_count", "_u")
    none = F.when(F.col("field_name").isin(usable), F.lit(0).cast("bigint"))
    exact = facts.join(counts, "field_name", "left").withColumn(f"{side}_distinct", F.coalesce("_u", none))
    return exact.select(facts.columns)


def table_diff(left: DataFrame, right: DataFrame, distinct: str | None = "approx") -> DataFrame:
    """Fields of two tables side by side: presence, type and nullability, data drift.

    ``distinct`` is 'approx' (fixed-size sketches), 'exact' or None.
    """
    lf = {f.name: f for f in left.schema.fields}
    rf = {f.name: f for f in right.schema.fields}
    same = lf.keys() == rf.keys() and all(
        f.dataType == rf[n].dataType and f.nullable == rf[n].nullable for n, f in lf.items()
    )
    joined = _side(left, "left", distinct).join(
        _side(right, "right", distinct), "field_name", "full"
    )
    lt, rt = named("left_type"), named("right_type")
    differs = (lt != rt) | (named("left_nullable") != named("right_nullable"))
    presence = (
        F.when(rt.isNull(), "only_left").when(lt.isNull(), "only_right").otherwise("both")
    )
    return joined.select(
        "*",
        presence.alias("presence"),
        F.coalesce(differs, F.lit(False)).alias("type_differs"),
        F.lit(same).alias("schemas_identical"),
    )


def table_summary(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """One row per field: type, nullability, fields of that type, NULL fraction."""
    chosen = [f for f in df.schema.fields if not fields or f.name in fields]
    kinds = [f.dataType.simpleString() for f in chosen]
    total = F.count(F.lit(1)).alias("rows")
    nulls = [null_count(named(f.name)).alias(f"n{i}") for i, f in enumerate(chosen)]
    rows = [
        {
            "field_name": F.lit(f.name),
            "field_type": F.lit(kinds[i]),
            "is_nullable": F.lit(f.nullable),
            "fields_of_type": F.lit(kinds.count(kinds[i])),
            "total_fields": F.lit(len(chosen)),
            "null_fraction": F.coalesce(
                named(f"n{i}").cast("double") / F.nullif(named("rows"), F.lit(0)), F.lit(0.0)
            ),
        }
        for i, f in enumerate(chosen)
    ]
    return report_rows(df.agg(total, *nulls), rows)
