"""Long and repetitive texts: every text operator reads them whole, without deep recursion."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tidewire.operators import cleaning as C
from tidewire.operators import conform as K
from tidewire.operators import enrich as A
from tidewire.operators import sentiment as S
from tidewire.operators import transform as R
from tidewire.operators.quality import dq_results, rule_email, rule_non_empty

N = 20_000
TEXTS = {
    "spaces": " " * N,
    "tags": "< >" * N,
    "open tags": "<" * N + ">",
    "mentions": "<@U1>" * N,
    "links": "<https://a|" * N + ">",
    "untitled links": "<https://a" * N + ">",
    "bar before links": "|x" + "<https://a" * N + ">",
    "bar after links": "<https://a" * N + "|>",
    "unclosed links": "<https://a|" * N,
    "newlines": "\n" * N,
    "blank then word": " \t" * N + "x",
    "one word": "a" * N,
    "short words": "a b " * N,
    "colons": "From:\n" * N,
    "almost headers": " From \n" * N,
    "stamps": "1/5/24, 9:05 AM - " * N,
    "ats": "a@" * N,
    "dots": "a@b." + "c." * N,
    "braces": "{" * N,
    "unicode space": " " * N + "é",
    "last word counts": "word " * N + "great",
}


@pytest.fixture(scope="module")
def long_rows(spark):
    rows = [(k, v, v, v, v) for k, v in TEXTS.items()]
    return spark.createDataFrame(rows, "kind string, body string, message string, email string, name string").cache()


OPERATORS = {
    "parse_email": lambda df: K.parse_email(df),
    "conform_email": lambda df: K.conform_email(df.select("kind", "message")),
    "slack": lambda df: K.conform_slack(df.select(F.lit("u").alias("user"), F.lit("c").alias("channel"), F.col("body").alias("text"))),
    "chat": lambda df: K.conform_whatsapp(K.parse_chat_lines(df, "body")),
    "whatsapp": lambda df: K.conform_whatsapp(df.select(F.lit("u").alias("sender"), "body")),
    "clean": lambda df: C.row_quality_score(C.validate_rows(C.clean_all(df))),
    "sanitize": C.sanitize_text,
    "sentiment": lambda df: S.sentiment_full(df.select("kind", "body")),
    "quick": S.sentiment_quick,
    "features": lambda df: R.communication_features(R.transform_communication(df)),
    "rules": lambda df: dq_results(df, [rule_email(), rule_non_empty("name")], "kind"),
    "enrich": lambda df: A.ai_enrich(df, "rules"),
    "parse answers": lambda df: A.ai_parse_response(df, "body"),
    "payload": lambda df: A.ai_request_payload(df, "claude"),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_runs_on_long_texts(long_rows, name):
    start = time.perf_counter()
    OPERATORS[name](long_rows).write.format("noop").mode("overwrite").save()
    assert time.perf_counter() - start < 60


def test_texts_are_read_to_the_end(long_rows):
    got = {r.kind: r for r in S.sentiment_full(long_rows).collect()}
    assert got["last word counts"].positive_word_count == 1 and got["last word counts"].word_count == N + 1
    slack = OPERATORS["slack"](long_rows).select("body").collect()
    lengths = {len(r.body) for r in slack}
    assert len("@user") * N in lengths and len(slack) == len(TEXTS) - 2  # spaces and empty tags go
