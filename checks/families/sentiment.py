"""Lexicon sentiment over messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import as_of, query, rounded, twin, view
from tidewire.functions import lexicon as L
from tidewire.functions.columns import named
from tidewire.operators import sentiment as S
from tidewire.plans.communications import scored_daily

_CLEAN = (
    r"lower(regexp_replace(regexp_replace(regexp_replace(body, '[^\w\s]', ' ', 'g'), "
    r"'\s+', ' ', 'g'), '\b\w{1,2}\b', '', 'g'))"
)


def _weight_sum(words: dict[str, float]) -> str:
    return " + ".join(
        f"(CASE WHEN list_contains(tokens, '{w}') THEN {v:.1f} ELSE 0.0 END)"
        for w, v in words.items()
    )


def _hit_count(words) -> str:
    return " + ".join(f"(CASE WHEN list_contains(tokens, '{w}') THEN 1 ELSE 0 END)" for w in words)


def _has(words) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"list_has_any(tokens, [{listed}])"


_TONE = " ".join(f"WHEN {_has(ws)} THEN '{t}'" for t, ws in L.TONES.items())
_SCORED = rf"""
WITH t AS (SELECT *, {_CLEAN} AS clean_text FROM v_comm),
k AS (SELECT *, coalesce(regexp_split_to_array(clean_text, '\s+'), []) AS tokens FROM t),
s AS (SELECT *, CASE WHEN clean_text IS NULL THEN 0.0 ELSE
    CAST(({_weight_sum(L.POSITIVE)}) - ({_weight_sum(L.NEGATIVE)}) AS DOUBLE) / len(tokens) END AS raw_score
  FROM k),
r AS (SELECT *, CAST(len(tokens) AS INTEGER) AS word_count,
  CAST({_hit_count(L.POSITIVE)} AS INTEGER) AS positive_word_count,
  CAST({_hit_count(L.NEGATIVE)} AS INTEGER) AS negative_word_count,
  round(raw_score, 6) AS sentiment_score, round(abs(raw_score), 6) AS confidence,
  CASE WHEN raw_score > 0.1 THEN 'positive' WHEN raw_score < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
  CASE WHEN abs(raw_score) >= 0.5 THEN 'strong' WHEN abs(raw_score) >= 0.2 THEN 'moderate' ELSE 'weak' END AS sentiment_intensity,
  CASE {_TONE} ELSE 'neutral' END AS emotional_tone FROM s)
"""


def _twin(select: str) -> str:
    return twin("v_comm", f"{_SCORED} {select}")


def _hits(spark, sf):
    return S.lexicon_hits(S.clean_text(view(spark, sf, "v_comm")))


def _scores(spark, sf):
    hits = _hits(spark, sf)
    return hits.select(
        "id", S.score_of_hits(named("_hits"), named("word_count")).alias("sentiment_score")
    )


@query("clean_text", _twin("SELECT id, clean_text FROM r"))
def _(spark, sf):
    return S.clean_text(view(spark, sf, "v_comm")).select("id", "clean_text")


@query("text_column", twin("v_slack_raw", "SELECT conv_id, turn, text AS body, CAST(NULL AS VARCHAR) AS sender FROM v_slack_raw"))
def _(spark, sf):
    found = S.sentiment_text(view(spark, sf, "v_slack_raw"))
    return found.select("conv_id", "turn", "body", "sender")


@query("sentiment_score", _twin("SELECT id, sentiment_score FROM r"))
def _(spark, sf):
    return rounded(_scores(spark, sf), "sentiment_score")


@query("sentiment_label", _twin("SELECT id, sentiment_label FROM r"))
def _(spark, sf):
    return _scores(spark, sf).select("id", S.label_of(named("sentiment_score")).alias("sentiment_label"))


@query("sentiment_confidence", _twin("SELECT id, confidence FROM r"))
def _(spark, sf):
    return rounded(
        _scores(spark, sf).select("id", F.abs("sentiment_score").alias("confidence")), "confidence"
    )


@query("sentiment_word_count", _twin("SELECT id, word_count FROM r"))
def _(spark, sf):
    return _hits(spark, sf).select("id", "word_count")


@query("sentiment_word_hits", _twin("SELECT id, positive_word_count, negative_word_count FROM r"))
def _(spark, sf):
    hits = named("_hits")
    return _hits(spark, sf).select(
        "id",
        S.hits_on(hits, L.POSITIVE).alias("positive_word_count"),
        S.hits_on(hits, L.NEGATIVE).alias("negative_word_count"),
    )


@query("sentiment_intensity", _twin("SELECT id, sentiment_intensity FROM r"))
def _(spark, sf):
    level = S.intensity_of(named("sentiment_score")).alias("sentiment_intensity")
    return _scores(spark, sf).select("id", level)


@query("emotional_tone", _twin("SELECT id, emotional_tone FROM r"))
def _(spark, sf):
    return _hits(spark, sf).select("id", S.tone_of_hits(named("_hits")).alias("emotional_tone"))


@query(
    "sentiment_full",
    _twin(
        """SELECT id, sender, recipient, body, clean_text, sentiment_score, sentiment_label, confidence,
        word_count, positive_word_count, negative_word_count, sentiment_intensity, emotional_tone,
        TIMESTAMP '2024-01-31 00:00:00' AS analyzed_at, '1.0' AS analysis_version FROM r"""
    ),
)
def _(spark, sf):
    full = S.sentiment_full(view(spark, sf, "v_comm"), as_of=as_of())
    return rounded(full.drop("timestamp", "subject", "channel"), "sentiment_score", "confidence")


@query(
    "sentiment_quick",
    twin(
        "v_comm",
        """SELECT id, sentiment, CASE sentiment WHEN 'positive' THEN CAST(0.8 AS DOUBLE)
          WHEN 'negative' THEN CAST(-0.6 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS sentiment_score
        FROM (SELECT id, CASE WHEN regexp_matches(lower(body), 'happy|excellent|great|good|wonderful') THEN 'positive'
          WHEN regexp_matches(lower(body), 'problem|issue|frustrating|bad|terrible') THEN 'negative'
          ELSE 'neutral' END AS sentiment FROM v_comm)""",
    ),
)
def _(spark, sf):
    return S.sentiment_quick(view(spark, sf, "v_comm")).select("id", "sentiment", "sentiment_score")


@query(
    "daily_channel_summary",
    _twin(
        """SELECT CAST(timestamp AS DATE) AS day, channel, count(*) AS messages, count(DISTINCT sender) AS senders,
        round(avg(raw_score), 6) AS mean_score,
        CAST(sum(CASE WHEN sentiment_label = 'positive' THEN 1 ELSE 0 END) AS BIGINT) AS positive_messages,
        CAST(sum(CASE WHEN sentiment_label = 'negative' THEN 1 ELSE 0 END) AS BIGINT) AS negative_messages
        FROM r GROUP BY 1, 2"""
    ),
)
def daily_summary(spark, sf):
    return rounded(scored_daily(view(spark, sf, "v_comm")), "mean_score")
