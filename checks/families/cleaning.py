"""Cleaning and row filters over the dirty customer table."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import as_of, query, table, twin, view
from tidewire.operators import cleaning as C
from tidewire.operators import filters as P
from tidewire.plans.cleaning import cleaned

_EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
_TEXT = ("name", "email", "phone", "age", "note")


def _nulled(c: str) -> str:
    return f"CASE WHEN lower({c}) IN ('', 'null', 'n/a', 'none') THEN NULL ELSE {c} END"


def _squashed(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[\r\n\t]+', ' ', 'g'))"


def _each(fn) -> str:
    return ", ".join(f"{fn(c)} AS {c}" for c in _TEXT)


def _cleaned(c: str) -> str:
    x = _squashed(_nulled(c))
    if c == "email":
        return f"lower(trim({x}))"
    if c == "phone":
        return rf"regexp_replace({x}, '[^\d+]', '', 'g')"
    if c == "name":
        return rf"regexp_replace(trim({x}), '\s+', ' ', 'g')"
    return x


_CLEAN = f"SELECT id, balance, {_each(_cleaned)} FROM v_dirty"
_VALID = rf"""SELECT * FROM ({_CLEAN}) WHERE (email IS NULL OR regexp_matches(email, '{_EMAIL}'))
  AND (phone IS NULL OR length(phone) >= 10)
  AND (balance IS NOT NULL OR name IS NOT NULL OR email IS NOT NULL OR phone IS NOT NULL OR age IS NOT NULL OR note IS NOT NULL)"""


def _score(columns=("id", "balance"), texts=_TEXT) -> str:
    filled = [f"(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END)" for c in columns]
    filled += [f"(CASE WHEN {c} <> '' THEN 1 ELSE 0 END)" for c in texts]
    total = len(columns) + len(texts)
    return f"CAST(trunc(CAST({' + '.join(filled)} AS DOUBLE) / {total} * 100) AS INTEGER)"


def _dirty(spark, sf):
    return view(spark, sf, "v_dirty")


@query("null_tokens", twin("v_dirty", f"SELECT id, balance, {_each(_nulled)} FROM v_dirty"))
def _(spark, sf):
    return C.null_tokens(_dirty(spark, sf))


@query("squash_controls", twin("v_dirty", f"SELECT id, balance, {_each(_squashed)} FROM v_dirty"))
def _(spark, sf):
    return C.squash_controls(_dirty(spark, sf))


@query("clean_email", twin("v_dirty", "SELECT id, lower(trim(email)) AS email FROM v_dirty"))
def _(spark, sf):
    return C.clean_email(_dirty(spark, sf)).select("id", "email")


@query("clean_phone", twin("v_dirty", r"SELECT id, regexp_replace(phone, '[^\d+]', '', 'g') AS phone FROM v_dirty"))
def _(spark, sf):
    return C.clean_phone(_dirty(spark, sf)).select("id", "phone")


@query("clean_names", twin("v_dirty", r"SELECT id, regexp_replace(trim(name), '\s+', ' ', 'g') AS name FROM v_dirty"))
def _(spark, sf):
    return C.clean_names(_dirty(spark, sf)).select("id", "name")


@query("clean_all", twin("v_dirty", _CLEAN))
def _(spark, sf):
    return C.clean_all(_dirty(spark, sf))


@query("row_quality_score", twin("v_dirty", f"SELECT *, {_score()} AS data_quality_score FROM v_dirty"))
def _(spark, sf):
    return C.row_quality_score(_dirty(spark, sf))


@query(
    "stamp_cleaned",
    twin("v_dirty", f"SELECT *, {_score()} AS data_quality_score, TIMESTAMP '2024-01-31 00:00:00' AS cleaned_at FROM ({_VALID})"),
)
def _(spark, sf):
    return cleaned(_dirty(spark, sf), as_of())


@query(
    "local_clean",
    twin(
        "v_dirty",
        rf"""SELECT *, CASE WHEN regexp_matches(age, '^\d+$') THEN TRY_CAST(age AS INTEGER) END AS age_numeric
        FROM v_dirty WHERE id IS NOT NULL AND name <> '' AND regexp_matches(email, '{_EMAIL}')""",
    ),
)
def _(spark, sf):
    return C.local_clean(_dirty(spark, sf))


@query(
    "sanitize_text",
    """SELECT doc_id, n_chars, CASE WHEN length(t) > 1000 THEN concat(substr(t, 1, 1000), '... (truncated)') ELSE t END AS text
    FROM (SELECT doc_id, n_chars, replace(replace(replace(text, chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t') AS t FROM documents)""".replace(
        "\\\\", "\\"
    ),
)
def _(spark, sf):
    return C.sanitize_text(table(spark, sf, "documents").select("doc_id", "n_chars", "text"))


@query(
    "valid_email",
    twin("v_dirty", rf"SELECT id, email FROM v_dirty WHERE email IS NULL OR regexp_matches(email, '{_EMAIL}')"),
)
def _(spark, sf):
    return P.valid_email(_dirty(spark, sf)).select("id", "email")


@query("valid_phone", twin("v_dirty", "SELECT id, phone FROM v_dirty WHERE phone IS NULL OR length(phone) >= 10"))
def _(spark, sf):
    return P.valid_phone(_dirty(spark, sf)).select("id", "phone")


@query(
    "not_all_null",
    twin("v_dirty", "SELECT id, email, phone, age FROM v_dirty WHERE email IS NOT NULL OR phone IS NOT NULL OR age IS NOT NULL"),
)
def _(spark, sf):
    return P.not_all_null(_dirty(spark, sf).select("id", "email", "phone", "age"))


@query(
    "dedupe_rows",
    "SELECT DISTINCT text, lang, source, n_chars FROM documents",
)
def _(spark, sf):
    from tidewire.operators.transform import dedupe_rows

    return dedupe_rows(table(spark, sf, "documents").drop("doc_id"))


@query(
    "standard_transform",
    "SELECT DISTINCT text, lang, TIMESTAMP '2024-01-31 00:00:00' AS processed_at, TRUE AS has_hash FROM documents",
)
def _(spark, sf):
    from tidewire.operators.transform import standard_transform

    rows = standard_transform(table(spark, sf, "documents").select("text", "lang"), as_of())
    return rows.select("text", "lang", "processed_at", F.col("record_hash").isNotNull().alias("has_hash"))
