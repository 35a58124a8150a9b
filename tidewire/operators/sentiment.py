"""Lexicon sentiment and tone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.columns import coalesce_present, named, present, typed_null, with_all
from tidewire.functions.lexicon import (
    NEGATIVE,
    POSITIVE,
    QUICK_NEGATIVE,
    QUICK_POSITIVE,
    TONES,
    contains_any,
    signed_weights,
    word_array,
)
from tidewire.functions.text import flag, plain_words, spaced_words, without_short

# Fixed values.
TEXT_ALIASES = ("body", "message", "text", "content")
ANALYSIS_VERSION = "1.0"
LABEL_LIMIT = 0.1
STRONG, MODERATE = 0.5, 0.2

_SUM_TYPE = "decimal(12,3)"


def sentiment_text(df: DataFrame) -> DataFrame:
    """Makes sure of body, sender and recipient; body is the first text alias there is."""
    first = present(df, TEXT_ALIASES)[:1]
    missing = {n: typed_null("string") for n in ("sender", "recipient") if n not in df.columns}
    return with_all(df, {"body": coalesce_present(df, first), **missing})


def clean_text(df: DataFrame, column: str = "body") -> DataFrame:
    """Adds ``clean_text``."""
    return df.withColumn("clean_text", plain_words(named(column)))


def lexicon_hits(
    df: DataFrame,
    positive: Mapping[str, float] = POSITIVE,
    negative: Mapping[str, float] = NEGATIVE,
    tones: Mapping[str, Sequence[str]] = TONES,
) -> DataFrame:
    """Adds ``_hits`` (distinct list words present) and ``word_count`` from ``clean_text``, or
    from ``_spaced`` words, short ones included, where the frame has them.

    One hash lookup per token against all lists together; everything after works on the
    few hits instead of on the text. A gap at either end of the clean text counts as a word.
    """
    source = "_spaced" if "_spaced" in df.columns else "clean_text"
    listed = dict.fromkeys([*positive, *negative, *(w for ws in tones.values() for w in ws)])
    tokens = df.select("*", F.split(named(source), " ").alias("_tokens"))
    several = F.size("_tokens") > 1
    gaps = [
        (several & (F.length(F.get("_tokens", at)) <= 2)).cast("int")
        for at in (F.lit(0), F.size("_tokens") - 1)
    ]
    kept = F.size(F.filter("_tokens", lambda w: F.length(w) > 2))
    count = F.greatest(kept + gaps[0] + gaps[1], F.lit(1))
    return tokens.select(
        *[named(c) for c in df.columns if c != "_spaced"],
        F.array_intersect("_tokens", word_array(list(listed))).alias("_hits"),
        F.when(named(source).isNotNull(), count).otherwise(0).alias("word_count"),
    )


def score_of_hits(
    hits: Column,
    word_count: Column,
    positive: Mapping[str, float] = POSITIVE,
    negative: Mapping[str, float] = NEGATIVE,
) -> Column:
    """Exact weight sum of the hits over the word count; 0.0 without text."""
    weights = signed_weights(positive, negative)
    total = F.aggregate(
        hits,
        F.lit(0).cast(_SUM_TYPE),
        lambda acc, w: (acc + F.coalesce(F.try_element_at(weights, w), F.lit(0))).cast(_SUM_TYPE),
    )
    share = F.try_divide(total.cast("double"), word_count)
    return F.coalesce(share, F.lit(0.0))


def hits_on(hits: Column, words: Sequence[str]) -> Column:
    found = F.size(F.array_intersect(hits, word_array(list(words))))
    return F.when(hits.isNotNull(), found).otherwise(0)


def label_of(score: Column) -> Column:
    return (
        F.when(score > LABEL_LIMIT, "positive")
        .when(score < -LABEL_LIMIT, "negative")
        .otherwise("neutral")
    )


def intensity_of(score: Column) -> Column:
    return (
        F.when(F.abs(score) >= STRONG, "strong")
        .when(F.abs(score) >= MODERATE, "moderate")
        .otherwise("weak")
    )


def tone_of_hits(hits: Column, tones: Mapping[str, Sequence[str]] = TONES) -> Column:
    """First tone, in list order, with a word among the hits."""
    named_tones = [
        F.when(flag(F.arrays_overlap(hits, word_array(list(words)))), F.lit(tone))
        for tone, words in tones.items()
    ]
    return F.coalesce(*named_tones, F.lit("neutral"))


def sentiment_full(
    df: DataFrame,
    positive: Mapping[str, float] = POSITIVE,
    negative: Mapping[str, float] = NEGATIVE,
    as_of: Column | None = None,
) -> DataFrame:
    """All sentiment columns; a narrow plan without shuffle or Python."""
    text = df.transform(sentiment_text)
    # Only the output column needs the second search; nobody pays for it who does not read it.
    spaced = text.select("*", spaced_words(named("body")).alias("_spaced"))
    base = spaced.withColumn("clean_text", without_short(F.col("_spaced")))
    hit = lexicon_hits(base, positive, negative)
    scored = hit.withColumn(
        "sentiment_score", score_of_hits(named("_hits"), named("word_count"), positive, negative)
    )
    score, hits = named("sentiment_score"), named("_hits")
    return scored.select(
        *[named(c) for c in base.columns if c != "_spaced"],
        score,
        label_of(score).alias("sentiment_label"),
        F.abs(score).alias("confidence"),
        named("word_count"),
        hits_on(hits, positive).alias("positive_word_count"),
        hits_on(hits, negative).alias("negative_word_count"),
        intensity_of(score).alias("sentiment_intensity"),
        tone_of_hits(hits).alias("emotional_tone"),
        (F.current_timestamp() if as_of is None else as_of).alias("analyzed_at"),
        F.lit(ANALYSIS_VERSION).alias("analysis_version"),
    )


def sentiment_quick(df: DataFrame, column: str = "body") -> DataFrame:
    """Substring label and its fixed score."""
    text = F.col("_lowered")
    label = (
        F.when(contains_any(text, QUICK_POSITIVE), "positive")
        .when(contains_any(text, QUICK_NEGATIVE), "negative")
        .otherwise("neutral")
    )
    by_label = (
        F.when(named("sentiment") == "positive", 0.8)
        .when(named("sentiment") == "negative", -0.6)
        .otherwise(0.0)
    )
    lowered = df.select("*", F.lower(named(column)).alias("_lowered"))
    labelled = lowered.withColumn("sentiment", label).drop("_lowered")
    return labelled.withColumn("sentiment_score", by_label)
