"""Language-model text analysis as batch jobs: requests, answers, deterministic fallback."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.accumulators import Accumulator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.columns import named, present, text_columns
from tidewire.functions.lexicon import contains_any
from tidewire.functions.text import flag, is_blank, strip, word_runs

# Instruction text, request limits, answer keys with defaults, rule words.
PROMPT_HEAD = (
    "Analyze the following text for key themes, sentiment, and entities. "
    "Provide a concise summary in JSON format with fields: analysis, key_themes, "
    "sentiment (positive, negative, neutral), entities (comma-separated), "
    'confidence (high, medium, low).\n\nText: """'
)
PROMPT_TAIL = '"""'
MAX_TOKENS, TEMPERATURE, TOP_P = 500, 0.1, 0.9
TEXT_CANDIDATES = ("body", "text", "message", "content", "description")
ANSWER_DEFAULTS = {
    "analysis": "",
    "key_themes": "",
    "sentiment": "neutral",
    "entities": "",
    "confidence": "medium",
}
EMPTY_ANSWER = {**ANSWER_DEFAULTS, "confidence": "low"}
UNREADABLE_ANSWER = {**ANSWER_DEFAULTS, "key_themes": "analysis, communication"}
RULE_POSITIVE = ("great", "excellent", "good")
RULE_NEGATIVE = ("bad", "terrible", "problem")
RULE_THEMES = "communication, analysis, mock"
RULE_ENTITIES, RULE_CONFIDENCE = "mock_entity", "medium"
OUTPUT_NAMES = {
    "analysis": "ai_summary",
    "key_themes": "key_themes",
    "sentiment": "ai_sentiment",
    "entities": "extracted_entities",
    "confidence": "ai_confidence",
}
SUMMARY_LENGTH = 200

_ANSWER_DDL = ", ".join(f"{k} string" for k in ANSWER_DEFAULTS)


def text_column(df: DataFrame) -> str:
    """First candidate column there is, else the first text column."""
    found = present(df, TEXT_CANDIDATES) or text_columns(df)
    if not found:
        raise ValueError("No suitable text column found for AI processing")
    return found[0]


def model_family(model_id: str) -> str:
    name = model_id.lower()
    return next((f for f in ("claude", "llama") if f in name), "generic")


def _answer(values: dict[str, Column | str]) -> Column:
    parts = [v if isinstance(v, Column) else F.lit(v) for v in values.values()]
    return F.struct(*[p.alias(k) for k, p in zip(values, parts, strict=True)])


def prompt_of(text: Column) -> Column:
    return F.concat(F.lit(PROMPT_HEAD), text, F.lit(PROMPT_TAIL))


def ai_prompt(df: DataFrame, column: str | None = None) -> DataFrame:
    """Adds ``prompt``; NULL for NULL text."""
    return df.withColumn("prompt", prompt_of(named(column or text_column(df))))


def payload_of(prompt: Column, model_id: str) -> Column:
    """Request body as JSON text, by model family."""
    family = model_family(model_id)
    limits = [F.lit(TEMPERATURE).alias("temperature"), F.lit(TOP_P).alias("top_p")]
    if family == "claude":
        framed = F.concat(F.lit("Human: "), prompt, F.lit("\n\nAssistant:"))
        body = F.struct(
            framed.alias("prompt"), F.lit(MAX_TOKENS).alias("max_tokens_to_sample"), *limits
        )
    elif family == "llama":
        body = F.struct(prompt.alias("prompt"), F.lit(MAX_TOKENS).alias("max_gen_len"), *limits)
    else:
        settings = F.struct(
            F.lit(MAX_TOKENS).alias("maxTokenCount"),
            F.lit(TEMPERATURE).alias("temperature"),
            F.lit(TOP_P).alias("topP"),
        )
        body = F.struct(prompt.alias("inputText"), settings.alias("textGenerationConfig"))
    return F.to_json(body)


def ai_request_payload(df: DataFrame, model_id: str, column: str | None = None) -> DataFrame:
    """Adds ``payload``, one request per row with text; blank rows need no request."""
    text = named(column or text_column(df))
    asked = F.when(~is_blank(text), payload_of(prompt_of(text), model_id))
    return df.withColumn("payload", asked)


def ai_response_text(df: DataFrame, model_id: str, column: str = "raw_response") -> DataFrame:
    """Adds ``response``: the model's answer inside its JSON envelope, default ''."""
    path = {
        "claude": "$.completion",
        "llama": "$.generation",
        "generic": "$.results[0].outputText",
    }[model_family(model_id)]
    answer = F.get_json_object(named(column), path)
    return df.withColumn("response", F.coalesce(answer, F.lit("")))


def _with_parsed(df: DataFrame, column: str) -> DataFrame:
    """Adds ``_parsed``, the answer struct of a response text.

    A JSON object gives its values, with defaults for keys it lacks (a JSON null stays
    NULL). Anything else gives the start of the text as the analysis. One strict reading
    decides: single quotes, raw line breaks, trailing commas and text after the object are not
    JSON.
    """
    response = named(column)
    # Inside brackets the whole text must parse; a reader of one value ignores what follows it.
    whole = F.json_array_length(F.concat(F.lit("["), response, F.lit("]"))) == 1
    strict = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_corrupt"}
    values = F.from_json(response, f"{_ANSWER_DDL}, _corrupt string", strict)
    read = df.select("*", values.alias("_values"), whole.alias("_whole")).select(
        "*",
        flag(strip(response).startswith("{") & F.col("_whole") & F.col("_values._corrupt").isNull()).alias("_is_object"),
    )
    read = read.select("*", F.when(F.col("_is_object"), F.json_object_keys(response)).alias("_keys"))
    from_object = _answer(
        {
            k: F.when(F.array_contains("_keys", k), F.col("_values")[k]).otherwise(default)
            for k, default in ANSWER_DEFAULTS.items()
        }
    )
    start = F.coalesce(F.substring(response, 1, SUMMARY_LENGTH), F.lit(""))
    other = _answer({**UNREADABLE_ANSWER, "analysis": start})
    return read.select(
        *[named(c) for c in df.columns],
        F.when(F.col("_is_object"), from_object).otherwise(other).alias("_parsed"),
    )


def _with_ruled(df: DataFrame, text: Column) -> DataFrame:
    """Adds ``_ruled``, the deterministic analysis of a text from a few words.

    NULL and '' get the empty answer. Tone and word count are read from the text once.
    """
    tone = (
        F.when(contains_any(F.col("_lowered"), RULE_POSITIVE), "positive")
        .when(contains_any(F.col("_lowered"), RULE_NEGATIVE), "negative")
        .otherwise("neutral")
    )
    facts = df.select("*", text.alias("_ruled_text"), F.lower(text).alias("_lowered")).select(
        "*", tone.alias("_tone"), word_runs(F.col("_ruled_text")).cast("string").alias("_words")
    )
    summary = F.concat(
        F.lit("Mock analysis of "),
        F.col("_words"),
        F.lit("-word text with "),
        F.col("_tone"),
        F.lit(" sentiment"),
    )
    judged = _answer(
        {
            "analysis": summary,
            "key_themes": RULE_THEMES,
            "sentiment": F.col("_tone"),
            "entities": RULE_ENTITIES,
            "confidence": RULE_CONFIDENCE,
        }
    )
    ruled = F.when(F.col("_ruled_text") != "", judged).otherwise(_answer(EMPTY_ANSWER))
    return facts.select(*[named(c) for c in df.columns], ruled.alias("_ruled"))


def ai_rule_analysis(df: DataFrame, column: str | None = None) -> DataFrame:
    """Adds ``ai_analysis`` from the rules alone."""
    ruled = _with_ruled(df, named(column or text_column(df)))
    return ruled.withColumnRenamed("_ruled", "ai_analysis")


def ai_empty(df: DataFrame, column: str | None = None) -> DataFrame:
    """Adds ``ai_analysis`` holding the empty answer where the text is NULL or blank."""
    text = named(column or text_column(df))
    empty = F.when(text.isNull() | is_blank(text), _answer(EMPTY_ANSWER))
    return df.withColumn("ai_analysis", empty)


def ai_parse_response(df: DataFrame, column: str = "response") -> DataFrame:
    """Adds ``ai_analysis`` parsed from response text."""
    return _with_parsed(df, column).withColumnRenamed("_parsed", "ai_analysis")


def model_responses(
    make_client: Callable[[], Callable[[str], str]],
    concurrency: int = 1,
    failures: Accumulator | None = None,
):
    """Arrow UDF prompt -> response: one client per task, NULL where the call fails.

    A task has ``concurrency`` calls under way at a time and keeps the order; the client must
    then be safe to call from threads. Failed calls are added to ``failures``, so that a wrong
    key is seen and not taken for an answer by rules. NULL prompts are not sent. The UDF is
    marked nondeterministic, so the optimizer never repeats a call when several columns read
    its result.
    """

    @F.pandas_udf("string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        client = make_client()

        def ask(prompt: str | None) -> tuple[str | None, bool]:
            if prompt is None:
                return None, False
            try:
                return client(prompt), False
            except Exception:  # noqa: BLE001 - any client error means "use the rules"
                return None, True

        with ThreadPoolExecutor(concurrency) as pool:
            for prompts in batches:
                answers = list(pool.map(ask, prompts))
                if failures is not None:
                    failures.add(sum(failed for _, failed in answers))
                yield pd.Series([a for a, _ in answers], dtype=object)

    return call.asNondeterministic()


def flatten_answer(df: DataFrame, model_id: str, as_of: Column | None = None) -> DataFrame:
    """``ai_analysis`` to flat columns plus model name and time."""
    kept = [named(c) for c in df.columns if c != "ai_analysis"]
    flat = [named("ai_analysis")[k].alias(n) for k, n in OUTPUT_NAMES.items()]
    at = F.current_timestamp() if as_of is None else as_of
    return df.select(
        *kept, *flat, F.lit(model_id).alias("ai_model_used"), at.alias("ai_processed_at")
    )


def ai_enrich(
    df: DataFrame,
    model_id: str,
    make_client: Callable[[], Callable[[str], str]] | None = None,
    column: str | None = None,
    as_of: Column | None = None,
    concurrency: int = 1,
    failures: Accumulator | None = None,
) -> DataFrame:
    """Analysis columns for every row.

    Without a client the rules decide. With one, blank rows get the empty answer, rows the
    client fails on get the rules, and the rest their parsed response. ``concurrency`` and
    ``failures`` are those of :func:`model_responses`.
    """
    text = named(column or text_column(df))
    if make_client is None:
        return flatten_answer(ai_rule_analysis(df, column), model_id, as_of)
    asked = df.withColumn(
        "_prompt", F.when(~is_blank(text), prompt_of(text))  # NULL text gives a NULL prompt
    )
    answered = asked.withColumn("_response", model_responses(make_client, concurrency, failures)(named("_prompt")))
    unanswered = F.when(named("_response").isNull(), text)
    judged = _with_ruled(_with_parsed(answered, "_response"), unanswered)
    analysis = (
        F.when(named("_prompt").isNull(), _answer(EMPTY_ANSWER))
        .when(named("_response").isNull(), named("_ruled"))
        .otherwise(named("_parsed"))
    )
    result = judged.select(*[named(c) for c in df.columns], analysis.alias("ai_analysis"))
    return flatten_answer(result, model_id, as_of)
