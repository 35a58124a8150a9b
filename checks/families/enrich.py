"""Language-model requests, answers and the rule analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import as_of, query, struct_columns, twin, view
from tidewire.functions.text import UNICODE_SPACE
from tidewire.operators import enrich as A

_WS = f"'{UNICODE_SPACE}'"
_PROMPT = "concat('" + A.PROMPT_HEAD + "', {t}, '" + A.PROMPT_TAIL + "')"
_BLANK = f"trim({{t}}, {_WS}) = ''"


def _rule(t: str) -> dict[str, str]:
    tone = (
        f"CASE WHEN regexp_matches(lower({t}), 'great|excellent|good') THEN 'positive' "
        f"WHEN regexp_matches(lower({t}), 'bad|terrible|problem') THEN 'negative' ELSE 'neutral' END"
    )
    words = f"CAST(len(regexp_extract_all({t}, '[^{UNICODE_SPACE}]+')) AS VARCHAR)"
    return {
        "analysis": f"concat('Mock analysis of ', {words}, '-word text with ', {tone}, ' sentiment')",
        "key_themes": "'communication, analysis, mock'",
        "sentiment": tone,
        "entities": "'mock_entity'",
        "confidence": "'medium'",
    }


_EMPTY = {"analysis": "''", "key_themes": "''", "sentiment": "'neutral'", "entities": "''", "confidence": "'low'"}


def _parsed(r: str) -> dict[str, str]:
    # The other engine's check lets a trailing comma pass.
    is_object = f"starts_with(trim({r}, {_WS}), '{{') AND json_valid({r}) AND NOT regexp_matches({r}, ',\\s*\\}}\\s*$')"
    plain = {
        "analysis": f"substr({r}, 1, 200)",
        "key_themes": "'analysis, communication'",
        "sentiment": "'neutral'",
        "entities": "''",
        "confidence": "'medium'",
    }
    default = {"analysis": "''", "key_themes": "''", "sentiment": "'neutral'", "entities": "''", "confidence": "'medium'"}
    return {
        k: f"CASE WHEN {is_object} THEN CASE WHEN json_exists({r}, '$.{k}') THEN json_extract_string({r}, '$.{k}') "
        f"ELSE {default[k]} END ELSE {plain[k]} END"
        for k in default
    }


def _choose(when: str, yes: dict[str, str], no: dict[str, str]) -> dict[str, str]:
    return {k: f"CASE WHEN {when} THEN {yes[k]} ELSE {no[k]} END" for k in yes}


def _columns(values: dict[str, str], names: dict[str, str] | None = None) -> str:
    names = names or {k: k for k in values}
    return ", ".join(f"{v} AS {names[k]}" for k, v in values.items())


_RULE = _choose("body IS NULL OR body = ''", _EMPTY, _rule("body"))


@query(
    "ai_prompt",
    twin(
        "v_comm",
        f"SELECT id, CASE WHEN body IS NOT NULL THEN {_PROMPT.format(t='body')} END AS prompt FROM v_comm",
    ),
)
def _(spark, sf):
    return A.ai_prompt(view(spark, sf, "v_comm")).select("id", "prompt")


_PAYLOADS = {
    "claude": "{{'prompt': concat('Human: ', {p}, chr(10), chr(10), 'Assistant:'), 'max_tokens_to_sample': 500, 'temperature': 0.1, 'top_p': 0.9}}",
    "llama": "{{'prompt': {p}, 'max_gen_len': 500, 'temperature': 0.1, 'top_p': 0.9}}",
    "generic": "{{'inputText': {p}, 'textGenerationConfig': {{'maxTokenCount': 500, 'temperature': 0.1, 'topP': 0.9}}}}",
}
_MODELS = {"claude": "family.claude-v2", "llama": "family.LLAMA-2", "generic": "family.other"}


@query(
    "ai_request_payload",
    twin(
        "v_comm",
        " UNION ALL ".join(
            f"SELECT id, '{m}' AS model, CASE WHEN body IS NULL OR {_BLANK.format(t='body')} THEN NULL ELSE "
            f"CAST(to_json({_PAYLOADS[f].format(p=_PROMPT.format(t='body'))}) AS VARCHAR) END AS payload FROM v_comm"
            for f, m in _MODELS.items()
        ),
    ),
)
def _(spark, sf):
    rows = view(spark, sf, "v_comm")
    parts = [
        A.ai_request_payload(rows, m).select("id", F.lit(m).alias("model"), "payload")
        for m in _MODELS.values()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "ai_response_text",
    twin(
        "v_responses",
        " UNION ALL ".join(
            f"SELECT doc_id, '{m}' AS model, CASE WHEN doc_id % 7 = 0 THEN '' ELSE response END AS response FROM v_responses"
            for m in _MODELS.values()
        ),
    ),
)
def _(spark, sf):
    rows = view(spark, sf, "v_responses")
    answer = F.when(F.col("doc_id") % 7 != 0, F.col("response"))
    envelopes = {
        "claude": F.struct(answer.alias("completion")),
        "llama": F.struct(answer.alias("generation")),
        "generic": F.struct(F.array(F.struct(answer.alias("outputText"))).alias("results")),
    }
    parts = [
        A.ai_response_text(rows.withColumn("raw_response", F.to_json(envelopes[f])), m).select(
            "doc_id", F.lit(m).alias("model"), "response"
        )
        for f, m in _MODELS.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("ai_parse_response", twin("v_responses", f"SELECT doc_id, {_columns(_parsed('response'))} FROM v_responses"))
def _(spark, sf):
    return struct_columns(A.ai_parse_response(view(spark, sf, "v_responses")), "ai_analysis", ["doc_id"])


@query("ai_rule_analysis", twin("v_comm", f"SELECT id, {_columns(_RULE)} FROM v_comm"))
def _(spark, sf):
    return struct_columns(A.ai_rule_analysis(view(spark, sf, "v_comm")), "ai_analysis", ["id"])


@query(
    "ai_empty",
    twin(
        "v_comm",
        "SELECT id, "
        + ", ".join(f"CASE WHEN body IS NULL OR {_BLANK.format(t='body')} THEN {v} END AS {k}" for k, v in _EMPTY.items())
        + " FROM v_comm",
    ),
)
def _(spark, sf):
    return struct_columns(A.ai_empty(view(spark, sf, "v_comm")), "ai_analysis", ["id"])


_STAMP = "TIMESTAMP '2024-01-31 00:00:00' AS ai_processed_at"
_FLAT = ["id", *A.OUTPUT_NAMES.values(), "ai_model_used", "ai_processed_at"]


@query(
    "ai_enrich",
    twin("v_comm", f"SELECT id, {_columns(_RULE, A.OUTPUT_NAMES)}, 'rules' AS ai_model_used, {_STAMP} FROM v_comm"),
)
def _(spark, sf):
    return A.ai_enrich(view(spark, sf, "v_comm"), "rules", as_of=as_of()).select(*_FLAT)


_ASKED = _PROMPT.format(t="body")
_ANSWERS = {
    "analysis": f"CASE WHEN length({_ASKED}) % 3 = 1 THEN 'seen' ELSE substr(concat('plain ', {_ASKED}), 1, 200) END",
    "key_themes": f"CASE WHEN length({_ASKED}) % 3 = 1 THEN '' ELSE 'analysis, communication' END",
    "sentiment": f"CASE WHEN length({_ASKED}) % 3 = 1 THEN 'positive' ELSE 'neutral' END",
    "entities": "''",
    "confidence": "'medium'",
}


@query(
    "ai_fallback",
    twin(
        "v_comm",
        "SELECT id, "
        + _columns(
            _choose(
                f"body IS NULL OR {_BLANK.format(t='body')}",
                _EMPTY,
                _choose(f"length({_ASKED}) % 3 = 0", _rule("body"), _ANSWERS),
            ),
            A.OUTPUT_NAMES,
        )
        + f", 'family.other' AS ai_model_used, {_STAMP} FROM v_comm",
    ),
)
def _(spark, sf):
    def echo_client():
        # A stand-in that answers JSON, plain text or an error by the length of the prompt.
        # It is nested so that workers get it by value.
        def answer(prompt: str) -> str:
            kind = len(prompt) % 3
            if kind == 0:
                raise RuntimeError("model is busy")
            return '{"analysis":"seen","sentiment":"positive"}' if kind == 1 else "plain " + prompt

        return answer

    enriched = A.ai_enrich(view(spark, sf, "v_comm"), "family.other", echo_client, as_of=as_of())
    return enriched.select(*_FLAT)
