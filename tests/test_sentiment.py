from __future__ import annotations

import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewire.functions.lexicon import NEGATIVE, POSITIVE, TONES
from tidewire.operators import sentiment as S


def full(rows, texts):
    df = rows(list(enumerate(texts)), "n int, body string")
    return S.sentiment_full(df).orderBy("n").collect()


def test_word_lists_are_complete():
    assert len(POSITIVE) == 24 and len(NEGATIVE) == 24 and list(TONES) == ["anger", "excitement", "sadness", "concern", "gratitude"]


def test_known_texts(rows):
    good, bad, none, blank, empty = full(rows, ["Great work, excellent result!", "This is a terrible problem and I am angry.", None, "   ", ""])
    assert good.sentiment_score == pytest.approx(1.8 / 5) and good.word_count == 5
    assert (good.sentiment_label, good.sentiment_intensity, good.positive_word_count) == ("positive", "moderate", 2)
    assert bad.sentiment_label == "negative" and bad.negative_word_count == 3 and bad.emotional_tone == "anger"
    assert bad.confidence == pytest.approx(-bad.sentiment_score)
    assert (none.sentiment_score, none.word_count, none.positive_word_count, none.emotional_tone) == (0.0, 0, 0, "neutral")
    assert (blank.sentiment_score, blank.word_count) == (0.0, 2) and empty.word_count == 1
    assert good.analysis_version == "1.0" and good.sender is None


def test_repeated_words_count_once(rows):
    (got,) = full(rows, ["good good good good"])
    assert got.sentiment_score == pytest.approx(0.6 / 4) and got.positive_word_count == 1


def test_tone_order(rows):
    texts = ["wonderful but mad", "sad and thrilled", "anxious unhappy", "grateful nervous", "thankful", "madness"]
    assert [r.emotional_tone for r in full(rows, texts)] == ["anger", "excitement", "sadness", "concern", "gratitude", "neutral"]


def by_hand(text):
    """Score with one word-boundary search per list word."""
    clean = re.sub(r"\b\w{1,2}\b", "", re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", text, flags=re.A), flags=re.A), flags=re.A).lower()
    net = Decimal(0)
    for sign, words in ((1, POSITIVE), (-1, NEGATIVE)):
        for w, v in words.items():
            if re.search(rf"\b{w}\b", clean):
                net += sign * Decimal(str(v))
    return float(net) / len(re.split(r"\s+", clean))


def test_scores_equal_word_by_word_search(rows):
    rng = random.Random(11)
    vocabulary = [*POSITIVE, *NEGATIVE, "and", "or", "x", "ill", "badly", "dislike,", "Great!", "é", "-", "\n"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 40))) for _ in range(300)]
    for text, row in zip(texts, full(rows, texts), strict=True):
        assert row.sentiment_score == pytest.approx(by_hand(text), abs=1e-12), text


def test_own_lexicon(rows):
    df = rows([("solid effort",)], "message string")
    got = S.sentiment_full(df, {"solid": 0.25}, {"effort": 0.5, "solid": 0.05}).first()
    assert got.sentiment_score == pytest.approx((0.25 - 0.05 - 0.5) / 2)
    assert (got.positive_word_count, got.negative_word_count) == (1, 2)


def test_text_alias_order(rows):
    got = S.sentiment_text(rows([("c", "t")], "content string, text string"))
    assert got.first().body == "t"
    assert S.sentiment_text(rows([(1,)], "k int")).first().body is None
    assert dict(S.sentiment_text(rows([(1,)], "k int")).dtypes)["body"] == "string"


def test_no_shuffle_and_no_python(rows):
    df = rows([("a",)], "body string")
    plan = S.sentiment_full(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_quick(rows):
    texts = ["I'm really HAPPY. Excellent work!", "serious problems, frustrating", "plain", None, "goodness, no problem"]
    got = S.sentiment_quick(rows([(t,) for t in texts], "body string")).collect()
    assert [(r.sentiment, r.sentiment_score) for r in got] == [
        ("positive", 0.8), ("negative", -0.6), ("neutral", 0.0), ("neutral", 0.0), ("positive", 0.8),
    ]


def test_limits_are_strict(spark):
    df = spark.createDataFrame([(0.1,), (0.11,), (-0.1,), (-0.11,), (0.5,), (0.2,), (0.19,)], "s double")
    got = df.select(S.label_of(F.col("s")), S.intensity_of(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [
        ("neutral", "weak"), ("positive", "weak"), ("neutral", "weak"), ("negative", "weak"),
        ("positive", "strong"), ("positive", "moderate"), ("positive", "weak"),
    ]
