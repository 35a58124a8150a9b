"""Schema-aware column helpers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def named(name: str) -> Column:
    """Column by exact top-level name, safe for dots, dashes and reserved words."""
    return F.col("`" + name.replace("`", "``") + "`")


def typed_null(data_type: str | T.DataType) -> Column:
    return F.lit(None).cast(data_type)


def field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_text(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.StringType)


def is_number(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType)


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_text(f.dataType)]


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [n for n in names if n in have]


def coalesce_present(
    df: DataFrame,
    names: Sequence[str],
    default: Column | None = None,
    data_type: str | T.DataType = "string",
) -> Column:
    """First non-null among the aliases the frame really has, else a typed default.

    Aliases of differing types are compared as text, so a union of sources never raises.
    """
    found = present(df, names)
    types = {field_type(df, n).simpleString() for n in found}
    parts = [named(n) if len(types) == 1 else named(n).cast("string") for n in found]
    if default is not None:
        parts.append(default)
    if not parts:
        return typed_null(data_type)
    return F.coalesce(*parts)


def as_instant(value: Column, data_type: T.DataType) -> Column:
    """Timestamp of a text, date or timestamp column; unreadable text becomes NULL."""
    if isinstance(data_type, T.TimestampType):
        return value
    if isinstance(data_type, (T.TimestampNTZType, T.DateType)):
        return value.cast("timestamp")
    return F.try_to_timestamp(value.cast("string"))


def instant_present(df: DataFrame, names: Sequence[str]) -> Column:
    """First non-null among the present time aliases, read as a timestamp."""
    found = present(df, names)
    types = {field_type(df, n).simpleString(): field_type(df, n) for n in found}
    read_as = next(iter(types.values())) if len(types) == 1 else T.StringType()
    return as_instant(coalesce_present(df, names), read_as)


#: Text of more bytes than this is counted by digest, so that a shuffle moves some 70 bytes for it.
DIGEST_BYTES = 128


def countable(value: Column, data_type: T.DataType, digest_bytes: int = DIGEST_BYTES) -> Column:
    """The value as it takes part in an exact distinct count.

    Text of more than ``digest_bytes`` stands as its digest; a leading NUL keeps digests apart
    from short text. The counts are the same for any limit.
    """
    if not is_text(data_type):
        return value
    digest = F.concat(F.lit("\0"), F.sha2(value, 256))
    return F.when(F.octet_length(value) > digest_bytes, digest).otherwise(value)


def _as_key(value: Column, data_type: T.DataType) -> Column:
    """Text that is equal for equal values of the type, and only for those."""
    if is_text(data_type):
        return countable(value, data_type)
    if isinstance(data_type, T.BinaryType):
        return countable(F.hex(value), T.StringType())
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return F.when(value == 0, F.lit("0")).otherwise(value.cast("string"))  # 0.0 is -0.0
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(data_type, (T.StructType, T.ArrayType)):
        whole = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
        return F.when(value.isNotNull(), countable(whole, T.StringType()))
    return value.cast("string")


def distinct_counts(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field_name, unique_count) of exact distinct non-null values, for fields that have any.

    Rows are turned into (field number, key) pairs and grouped twice: two narrow columns cross
    the network, once for each distinct pair and task, however wide the rows are.
    """
    pairs = [
        F.struct(F.lit(i).alias("i"), _as_key(named(f), field_type(df, f)).alias("key"))
        for i, f in enumerate(fields)
    ]
    names = F.array(*[F.lit(f) for f in fields])
    keys = df.select(F.inline(F.array(*pairs))).where("key IS NOT NULL").groupBy("i", "key").agg(F.lit(1).alias("one"))
    return keys.groupBy("i").agg(F.count(F.lit(1)).alias("unique_count")).select(F.get(names, F.col("i")).alias("field_name"), "unique_count")


def framed(parts: Sequence[Column]) -> Column:
    """One text of several, each with its length in bytes before it: no two lists give the same.

    NULL is '-', and so differs from every text.
    """
    size = [F.octet_length(p).cast("string") for p in parts]
    return F.concat(*[F.coalesce(F.concat(n, F.lit(":"), p), F.lit("-")) for n, p in zip(size, parts, strict=True)])


def null_count(value: Column) -> Column:
    """NULLs as the difference of two plain counts, which a source can answer from metadata
    where it takes aggregates."""
    return F.count(F.lit(1)) - F.count(value)


def report_rows(df: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """One output row per dict, for every input row; dict keys become the columns."""
    structs = [F.struct(*[v.alias(k) for k, v in r.items()]) for r in rows]
    return df.select(F.inline(F.array(*structs)))


def with_all(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Add or replace columns in one projection, keeping the position of replaced ones."""
    kept = [new[c].alias(c) if c in new else named(c) for c in df.columns]
    added = [v.alias(k) for k, v in new.items() if k not in df.columns]
    return df.select(*kept, *added)
