"""Dirty tables to clean, scored rows. Each operator is one projection."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import text as X
from tidewire.functions.columns import field_type, is_text, named, present, text_columns, with_all
from tidewire.operators.filters import not_all_null, valid_email, valid_phone

# Columns cleaned as names, and columns the row score leaves out.
NAME_COLUMNS = ("name", "first_name", "last_name", "full_name")
SCORE_OUTPUTS = ("data_quality_score", "cleaned_at")


def null_tokens(df: DataFrame) -> DataFrame:
    """'', 'null', 'n/a' and 'none' of text columns to NULL, before any trimming."""
    return with_all(df, {c: X.null_token(named(c)) for c in text_columns(df)})


def squash_controls(df: DataFrame) -> DataFrame:
    return with_all(df, {c: X.squash_controls(named(c)) for c in text_columns(df)})


def clean_email(df: DataFrame) -> DataFrame:
    return with_all(df, {c: X.tidy_email(named(c)) for c in present(df, ["email"])})


def clean_phone(df: DataFrame) -> DataFrame:
    return with_all(df, {c: X.tidy_phone(named(c)) for c in present(df, ["phone"])})


def clean_names(df: DataFrame) -> DataFrame:
    return with_all(df, {c: X.tidy_name(named(c)) for c in present(df, NAME_COLUMNS)})


def clean_all(df: DataFrame) -> DataFrame:
    """The five cleaners in order, as one expression per column."""
    out: dict[str, Column] = {}
    for c in text_columns(df):
        value = X.squash_controls(X.null_token(named(c)))
        if c == "email":
            value = X.tidy_email(value)
        elif c == "phone":
            value = X.tidy_phone(value)
        elif c in NAME_COLUMNS:
            value = X.tidy_name(value)
        out[c] = value
    return with_all(df, out)


def validate_rows(df: DataFrame) -> DataFrame:
    """Rows with a usable e-mail, a long enough phone and at least one value."""
    return df.transform(valid_email).transform(valid_phone).transform(not_all_null)


def _filled(df: DataFrame, name: str) -> Column:
    value = named(name)
    return value != "" if is_text(field_type(df, name)) else value.isNotNull()


def row_quality_score(df: DataFrame) -> DataFrame:
    """Adds ``data_quality_score``: filled share of the row in percent, truncated."""
    scored = [c for c in df.columns if c not in SCORE_OUTPUTS]
    filled = reduce(add, [F.when(_filled(df, c), 1).otherwise(0) for c in scored])
    score = (filled.cast("double") / F.lit(len(scored)) * 100).cast("int")
    return df.withColumn("data_quality_score", score)


def stamp_cleaned(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Row score and ``cleaned_at``."""
    at = F.current_timestamp() if as_of is None else as_of
    return row_quality_score(df).withColumn("cleaned_at", at)


def local_clean(df: DataFrame) -> DataFrame:
    """Rows with id, name and valid e-mail; ``age_numeric`` where age is all digits."""
    age = named("age")
    return df.filter(
        named("id").isNotNull() & (named("name") != "") & X.matches_email(named("email"))
    ).withColumn("age_numeric", F.when(age.rlike(r"^\d+$"), age.try_cast("int")))


def sanitize_text(df: DataFrame, max_length: int = 1000) -> DataFrame:
    """Text columns made safe for one log line; other columns are unchanged."""
    return with_all(df, {c: X.escape_for_log(named(c), max_length) for c in text_columns(df)})
