from __future__ import annotations

import json

import pytest

from tidewire.operators import enrich as A


def answers(df, column="ai_analysis"):
    return [tuple(r[column]) if r[column] is not None else None for r in df.collect()]


def test_rule_analysis(rows):
    texts = ["a good, really great day we had", "bad luck", "the train leaves at nine", "", None, " \xa0a b ", "goodbye problem"]
    got = answers(A.ai_rule_analysis(rows([(t,) for t in texts], "body string")))
    assert got[0] == ("Mock analysis of 7-word text with positive sentiment", "communication, analysis, mock", "positive", "mock_entity", "medium")
    assert [g[2] for g in got[1:3]] == ["negative", "neutral"]
    assert got[3] == got[4] == ("", "", "neutral", "", "low")
    assert got[5][0].startswith("Mock analysis of 2-word")
    assert got[6][2] == "positive"


def test_empty(rows):
    got = answers(A.ai_empty(rows([(None,), (" \xa0",), ("x",)], "body string")))
    assert got == [("", "", "neutral", "", "low")] * 2 + [None]


def parsed_by_hand(response):
    defaults = A.ANSWER_DEFAULTS
    try:
        if response.strip().startswith("{"):
            found = json.loads(response)
            return tuple(found.get(k, d) for k, d in defaults.items())
    except ValueError:
        pass
    return (response[:200], "analysis, communication", "neutral", "", "medium")


def test_parse_response(rows):
    texts = [
        '{"analysis":"ok","key_themes":"a, b","sentiment":"positive","entities":"x","confidence":"high"}',
        '  {"analysis":"partial"}\n',
        '{"analysis":"broken"',
        '{"analysis":"n","sentiment":null}',
        "",
        "plain " * 60,
        '{"analysis":"a"} tail',
        '{"analysis":"a"}, {"analysis":"b"}',
        '{"analysis":"a","analysis":"b"}',
        "[1]",
        "{}",
        '{"other":1}',
        "é" * 300,
        "{'analysis': 'single quotes'}",
        '{"analysis":"line\nbreak","sentiment":"positive"}',
        '{"analysis":"a",}',
        '{"analysis":"a"} {"analysis":"b"}',
        '{analysis:"bare"}',
        '{"analysis":"tab\there"}',
        ' \n{"analysis":"inner \\u00e9 \\n text"}\n ',
    ]
    got = answers(A.ai_parse_response(rows([(t,) for t in texts], "response string")))
    assert got == [parsed_by_hand(t) for t in texts]


def test_payloads(rows):
    df = rows([("hi \"you\"\n",), ("  ",), (None,)], "body string")
    claude = A.ai_request_payload(df, "x.Claude-v2").collect()
    body = json.loads(claude[0].payload)
    assert body["prompt"].startswith("Human: Analyze the following text") and body["prompt"].endswith('"""\n\nAssistant:')
    assert 'Text: """hi "you"\n"""' in body["prompt"]
    assert {k: body[k] for k in ("max_tokens_to_sample", "temperature", "top_p")} == {"max_tokens_to_sample": 500, "temperature": 0.1, "top_p": 0.9}
    assert claude[1].payload is None and claude[2].payload is None
    assert json.loads(A.ai_request_payload(df, "llama3").first().payload)["max_gen_len"] == 500
    other = json.loads(A.ai_request_payload(df, "m").first().payload)
    assert other["textGenerationConfig"] == {"maxTokenCount": 500, "temperature": 0.1, "topP": 0.9}


def test_response_text(rows):
    def read(raw, model):
        return A.ai_response_text(rows([(raw,)], "raw_response string"), model).first().response

    assert read('{"completion":"c"}', "claude") == "c"
    assert read('{"generation":"g"}', "llama") == "g"
    assert read('{"results":[{"outputText":"o"}]}', "m") == "o"
    assert read("{}", "claude") == read("bad", "m") == ""


@pytest.fixture
def busy_on_short():
    # Nested, so workers get it by value and need no test module.
    def make_client():
        def client(prompt):
            if "short" in prompt:
                raise RuntimeError("busy")
            return '{"analysis":"done","entities":null}' if "json please" in prompt else "free text"

        return client

    return make_client


def test_enrich_with_client(rows, busy_on_short):
    df = rows([(1, "json please"), (2, "short bad"), (3, "else"), (4, " "), (5, None)], "n int, body string")
    got = {r.n: r for r in A.ai_enrich(df, "m", busy_on_short).collect()}
    assert (got[1].ai_summary, got[1].extracted_entities, got[1].ai_confidence) == ("done", None, "medium")
    assert got[2].ai_summary == "Mock analysis of 2-word text with negative sentiment"
    assert (got[3].ai_summary, got[3].key_themes) == ("free text", "analysis, communication")
    assert got[4].ai_confidence == got[5].ai_confidence == "low"
    assert got[1].ai_model_used == "m"


def test_client_is_called_once_per_row(rows, busy_on_short):
    plan = A.ai_enrich(rows([(1, "x")], "n int, body string"), "m", busy_on_short)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1


def test_enrich_without_client(rows):
    got = A.ai_enrich(rows([("k", "good")], "key string, text string"), "rules").first()
    assert got.ai_sentiment == "positive" and got.key == "k"
    with pytest.raises(ValueError, match="text column"):
        A.ai_enrich(rows([(1,)], "n int"), "rules")
    assert A.text_column(rows([("a", 1)], "note string, n int")) == "note"
    assert A.text_column(rows([("a", "b")], "message string, text string")) == "text"


def test_concurrent_calls_keep_their_order_and_count_failures(spark, rows):
    def make_client():
        def client(prompt):
            import time

            if '"""7"""' in prompt:
                raise RuntimeError("busy")
            time.sleep(0.2 if '"""1' in prompt else 0)
            return "answer " + prompt.split('"""')[1]

        return client

    failures = spark.sparkContext.accumulator(0)
    df = rows([(n, str(n)) for n in range(20)], "n int, body string")
    got = {r.n: r.ai_summary for r in A.ai_enrich(df, "m", make_client, concurrency=8, failures=failures).collect()}
    assert {n: s for n, s in got.items() if n != 7} == {n: f"answer {n}" for n in range(20) if n != 7}
    assert got[7].startswith("Mock analysis of 1-word") and failures.value == 1
