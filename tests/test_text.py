"""Text expressions against plain statements of their rules."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from tidewire.functions import text as X



def noise(seed: int, n: int, alphabet: str, longest: int = 30) -> list[str | None]:
    rng = random.Random(seed)
    made = ["".join(rng.choices(alphabet, k=rng.randrange(longest))) for _ in range(n)]
    return [None, "", *made]


def test_space_set_is_pythons():
    assert sorted(X.UNICODE_SPACE) == sorted(c for c in map(chr, range(0x110000)) if c.isspace())


def test_space_class_matches_the_set(column):
    marks = [*X.UNICODE_SPACE, "a", "é", "​", "᠎", "\x00", "\x1b", "_", "﻿"]
    found = column(marks, F.col("x").rlike(rf"(?U)^{X.SPACE_CLASS}\z"))
    assert found == [m.isspace() for m in marks]


def test_strip_and_word_runs_follow_python(column):
    texts = noise(1, 300, " \t\n\x0b\x1c\xa0 ab　é")
    assert column(texts, X.strip(F.col("x"))) == [t if t is None else t.strip() for t in texts]
    assert column(texts, X.word_runs(F.col("x"))) == [t if t is None else len(t.split()) for t in texts]
    assert column(texts, X.is_blank(F.col("x"))) == [t if t is None else not t.strip() for t in texts]


def test_split_parts_keeps_outer_empties(column):
    assert column([None, "", "  a ", "a b", " "], X.split_parts(F.col("x"))) == [0, 1, 3, 2, 2]


def test_null_tokens_are_tested_before_trimming(column):
    given = ["NULL", "n/A", "None", "", " N/A ", "nil", None]
    assert column(given, X.null_token(F.col("x"))) == [None, None, None, None, " N/A ", "nil", None]


def test_tidy_expressions(column):
    assert column(["a\r\n\tb\n", None], X.squash_controls(F.col("x"))) == ["a b", None]
    assert column([" A@B.Com ", None], X.tidy_email(F.col("x"))) == ["a@b.com", None]
    assert column(["+1 (555) 010-2030", "x"], X.tidy_phone(F.col("x"))) == ["+15550102030", ""]
    assert column(["  Ann   Lee ", "é\tb"], X.tidy_name(F.col("x"))) == ["Ann Lee", "é b"]


def test_email_shape(column):
    good = ["john@example.com", "a.b+c_d%e-f@x-y.co.uk"]
    bad = ["invalid-email", "@x.com", "a@b", "a@b.c", "a b@c.com", "", "é@x.com"]
    assert column(good + bad, X.matches_email(F.col("x"))) == [True] * 2 + [False] * 7


def test_escape_for_log(column):
    long = "é" * 1000
    given = ["a\nb\rc\td", long, long + "x", "\n" * 501, None]
    assert column(given, X.escape_for_log(F.col("x"))) == [
        "a\\nb\\rc\\td",
        long,
        long + "... (truncated)",
        "\\n" * 500 + "... (truncated)",
        None,
    ]


def test_plain_words_example(column):
    got = column(["I am happy, it's great!", None, "", "  "], X.plain_words(F.col("x")))
    assert got == ["  happy   great ", None, "", " "]


def test_plain_words_is_the_three_step_rule(column):
    texts = noise(2, 400, "abcXYZ_019 ,.'!\té\n")

    def three_steps(t):
        if t is None:
            return None
        t = re.sub(r"[^A-Za-z0-9_\s]", " ", t, flags=re.ASCII)
        t = re.sub(r"\s+", " ", t, flags=re.ASCII)
        return re.sub(r"\b\w{1,2}\b", "", t, flags=re.ASCII).lower()

    assert column(texts, X.plain_words(F.col("x"))) == [three_steps(t) for t in texts]
