"""Text expressions and predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points that count as white space in Python's str.strip / str.split.
UNICODE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Tokens that stand for "no value", and the accepted e-mail shape.
NULL_TOKENS = ("", "null", "n/a", "none")
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# The same set as a regex class. Java scans the predefined class far faster than a listed one.
SPACE_CLASS = r"[\s\x1c-\x1f]"
_SPACE_RUN = rf"(?U){SPACE_CLASS}+"


def strip(value: Column) -> Column:
    """Both ends stripped of every Unicode space; linear in the text, unlike a regex."""
    return F.btrim(value, F.lit(UNICODE_SPACE))


def is_blank(value: Column) -> Column:
    return strip(value) == ""


def word_runs(value: Column) -> Column:
    """Number of white-space separated words, 0 for blank text, NULL for NULL."""
    bare = strip(value)
    return F.when(bare == "", 0).when(bare.isNotNull(), F.size(F.split(bare, _SPACE_RUN)))


def split_parts(value: Column) -> Column:
    """Parts of a split on white space, outer empties included; NULL counts 0, '' counts 1."""
    return F.when(value.isNotNull(), F.size(F.split(value, r"\s+"))).otherwise(0)


def null_token(value: Column) -> Column:
    return F.when(~F.lower(value).isin(*NULL_TOKENS), value)


def squash_controls(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, r"[\r\n\t]+", " "))


def tidy_email(value: Column) -> Column:
    return F.lower(F.trim(value))


def tidy_phone(value: Column) -> Column:
    return F.regexp_replace(value, r"[^\d+]", "")


def tidy_name(value: Column) -> Column:
    return F.regexp_replace(F.trim(value), r"\s+", " ")


def matches_email(value: Column) -> Column:
    return value.rlike(EMAIL_PATTERN)


def escape_for_log(value: Column, max_length: int = 1000) -> Column:
    """Line breaks and tabs as two-character escapes; longer text is cut and marked."""
    flat = F.replace(
        F.replace(F.replace(value, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")),
        F.lit("\t"),
        F.lit("\\t"),
    )
    return F.when(
        F.length(flat) > max_length,
        F.concat(F.substring(flat, 1, max_length), F.lit("... (truncated)")),
    ).otherwise(flat)


def spaced_words(value: Column) -> Column:
    """Lower-case ASCII words with one blank for whatever lies between them."""
    return F.lower(F.regexp_replace(value, r"\W+", " "))


def without_short(spaced: Column) -> Column:
    """Spaced words without those of one or two letters, whose gaps stay."""
    return F.regexp_replace(spaced, r"\b\w{1,2}\b", "")


def plain_words(value: Column) -> Column:
    """Lower-case ASCII words of three letters or more; the gaps of removed words stay."""
    return without_short(spaced_words(value))


def flag(predicate: Column) -> Column:
    """Two-valued boolean: an unknown predicate counts as false."""
    return F.coalesce(predicate, F.lit(False))
