from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from tidewire.operators import cleaning as C
from tidewire.operators import filters as P
from tidewire.plans.cleaning import cleaned



def now():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


DDL = "id bigint, name string, email string, phone string, balance double"


def test_clean_all_equals_the_five_steps(rows):
    df = rows(
        [
            (1, "  Ann \n Lee ", " A@B.COM ", "+1 (555) 010-2030", 1.0),
            (2, "N/A", "none", "", None),
            (3, " N/A ", None, "x", 0.0),
        ],
        DDL,
    )
    steps = df
    for step in (C.null_tokens, C.squash_controls, C.clean_email, C.clean_phone, C.clean_names):
        steps = step(steps)
    whole = C.clean_all(df)
    assert whole.columns == df.columns
    assert whole.collect() == steps.collect()
    assert [tuple(r) for r in whole.collect()] == [
        (1, "Ann Lee", "a@b.com", "+15550102030", 1.0),
        (2, None, None, None, None),
        (3, "N/A", None, "", 0.0),
    ]


def test_numbers_pass_null_tokens(rows):
    df = rows([(5, None, None, None, 1.5)], DDL)
    assert C.null_tokens(df).first().id == 5


def test_row_score_truncates_and_skips_its_outputs(rows):
    df = rows([("a", "", 1, 7, None)], "a string, b string, c int, data_quality_score int, cleaned_at string")
    assert C.row_quality_score(df.drop("data_quality_score")).first().data_quality_score == 66
    assert C.row_quality_score(rows([(None, "")], "a string, b string")).first().data_quality_score == 0


def test_filters(rows):
    df = rows(
        [(1, None, "5550102030"), (2, "bad", None), (3, "a@b.com", "+123456789"), (4, "a@b.com", "123456789")],
        "id int, email string, phone string",
    )
    assert [r.id for r in P.valid_email(df).collect()] == [1, 3, 4]
    assert [r.id for r in P.valid_phone(df).collect()] == [1, 2, 3]
    assert P.valid_email(df.select("id")).count() == 4
    sparse = rows([(1, None, "x"), (2, None, None), (3, "v", None)], "id int, a string, created_at string")
    assert [r.id for r in P.not_all_null(sparse).collect()] == [3]
    assert P.not_all_null(sparse.select("id")).count() == 3


def test_cleaned_plan(rows):
    df = rows(
        [(1, "Ann", "A@b.com", "5550102030", 1.0), (2, "Bob", "bad", None, 1.0), (3, "null", "N/A", "", None)], DDL
    )
    got = cleaned(df, now()).collect()
    assert [(r.id, r.data_quality_score, r.cleaned_at) for r in got] == [(1, 100, dt.datetime(2024, 1, 31))]


def test_local_clean(rows):
    df = rows(
        [
            ("k1", "Ines", "ines@mail.test", "41"),
            ("k2", "", "no address", "old"),
            ("k3", "Uwe", "uwe@mail.test", "19y"),
            (None, "Zoe", "zoe@mail.test", "77"),
        ],
        "id string, name string, email string, age string",
    )
    got = [(r.id, r.age_numeric) for r in C.local_clean(df).collect()]
    assert got == [("k1", 41), ("k3", None)]
    huge = rows([("1", "n", "a@b.com", "99999999999")], "id string, name string, email string, age string")
    assert C.local_clean(huge).first().age_numeric is None


def test_sanitize_leaves_other_types(rows):
    got = C.sanitize_text(rows([(1, True, "a\nb")], "n int, ok boolean, t string")).first()
    assert tuple(got) == (1, True, "a\\nb")


def test_awkward_column_names(rows):
    df = rows([(" N/A", "none")], "`a.b` string, `from` string")
    assert tuple(C.clean_all(df).first()) == ("N/A", None)


def test_cleaned_equals_cleaning_then_validating(rows):
    rng = random.Random(9)
    pool = [None, "", "null", "N/A", " none ", "a@b.com", "bad", "5550102030", "x y"]
    data = [(i, *rng.choices(pool, k=3)) for i in range(300)]
    df = rows(data, "id int, email string, phone string, note string")
    steps = C.stamp_cleaned(C.validate_rows(C.clean_all(df)), now())
    got = cleaned(df, now())
    assert got.columns == steps.columns
    assert sorted(got.collect(), key=str) == sorted(steps.collect(), key=str)
    assert 0 < got.count() < 300
