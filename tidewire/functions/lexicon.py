"""Weighted word lists and the expressions that look tokens up in them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word weights in tenths, and the tone words in order of precedence.
POSITIVE = {
    "excellent": 1.0, "great": 0.8, "good": 0.6, "wonderful": 1.0, "amazing": 1.0,
    "fantastic": 1.0, "love": 0.8, "like": 0.4, "happy": 0.8, "pleased": 0.6,
    "satisfied": 0.6, "perfect": 1.0, "awesome": 0.9, "brilliant": 0.9, "outstanding": 1.0,
    "superb": 0.9, "impressive": 0.7, "successful": 0.7, "positive": 0.6, "helpful": 0.5,
    "useful": 0.5, "appreciate": 0.6, "thank": 0.5, "congratulations": 0.8,
}
NEGATIVE = {
    "terrible": 1.0, "awful": 1.0, "bad": 0.6, "poor": 0.5, "worst": 1.0, "horrible": 1.0,
    "hate": 0.9, "dislike": 0.5, "angry": 0.8, "frustrated": 0.7, "disappointed": 0.7,
    "upset": 0.6, "annoyed": 0.5, "concerned": 0.4, "worried": 0.5, "problem": 0.5,
    "issue": 0.4, "error": 0.5, "failure": 0.7, "wrong": 0.4, "difficult": 0.3,
    "impossible": 0.6, "urgent": 0.3, "serious": 0.4,
}
TONES = {
    "anger": ("angry", "furious", "outraged", "mad"),
    "excitement": ("excited", "thrilled", "amazed", "wonderful"),
    "sadness": ("sad", "disappointed", "unhappy", "depressed"),
    "concern": ("worried", "concerned", "anxious", "nervous"),
    "gratitude": ("grateful", "thankful", "appreciative"),
}
QUICK_POSITIVE = ("happy", "excellent", "great", "good", "wonderful")
QUICK_NEGATIVE = ("problem", "issue", "frustrating", "bad", "terrible")


def word_array(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def signed_weights(positive: Mapping[str, float], negative: Mapping[str, float]) -> Column:
    """Literal map word -> signed exact weight. A word on both lists nets out."""
    net = {w: positive.get(w, 0.0) - negative.get(w, 0.0) for w in {**positive, **negative}}
    pairs = [(F.lit(w), F.lit(f"{v:.3f}").cast("decimal(6,3)")) for w, v in net.items()]
    return F.create_map(*chain.from_iterable(pairs))


def contains_any(value: Column, words: Sequence[str]) -> Column:
    """True when any of the words occurs as a substring; plain searches, no regex."""
    return reduce(or_, [value.contains(w) for w in words])
