"""Dirty table to a cleaned, validated, scored table."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame

from tidewire.functions.columns import field_type, is_text, named
from tidewire.functions.text import null_token
from tidewire.operators.cleaning import clean_all, stamp_cleaned
from tidewire.operators.filters import BOOKKEEPING, valid_email, valid_phone


def _keeps_a_value(df: DataFrame, name: str) -> Column:
    raw = named(name)
    return (null_token(raw) if is_text(field_type(df, name)) else raw).isNotNull()


def cleaned(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Clean, drop rows that are empty or fail their e-mail or phone, score, stamp.

    Only null tokens make a value NULL, so empty rows are found on the raw columns; the
    same test on cleaned columns would repeat every clean-up expression in the filter.
    """
    checked = [_keeps_a_value(df, c) for c in df.columns if c not in BOOKKEEPING]
    filled = df.filter(reduce(or_, checked)) if checked else df
    valid = filled.transform(clean_all).transform(valid_email).transform(valid_phone)
    return stamp_cleaned(valid, as_of)
