"""Channel exports to the communication shape."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import query, struct_columns, twin, view
from tidewire.functions.mail import HEADERS
from tidewire.functions.text import UNICODE_SPACE
from tidewire.operators import conform as K
from tidewire.operators import filters as P
from tidewire.plans.communications import communications

_WS = f"'{UNICODE_SPACE}'"


def _header(name: str) -> str:
    return f"list_filter(pairs, lambda p: p.k = '{name}')[-1].v"


_LINES = f"""
WITH e0 AS (SELECT doc_id, message, split_part(message, chr(10) || chr(10), 1) AS block,
    strpos(message, chr(10) || chr(10)) AS gap FROM v_email_raw),
e AS (SELECT *, list_transform(list_filter(string_split(block, chr(10)), lambda l: strpos(l, ':') > 1),
      lambda l: {{'k': trim(substr(l, 1, strpos(l, ':') - 1), {_WS}), 'v': trim(substr(l, strpos(l, ':') + 1), {_WS})}}) AS pairs,
    CASE WHEN message = '' THEN NULL WHEN gap > 0 THEN trim(substr(message, gap + 2), {_WS}) ELSE '' END AS parsed_body FROM e0)"""
_BARE_DATE = rf"regexp_replace(regexp_replace({_header('Date')}, '^[A-Za-z]{{3}},\s*', ''), '\s*\([^)]*\)\s*$', '')"
_EMAIL = f"""SELECT doc_id, {_header('Message-ID')} AS id, {_header('From')} AS sender, {_header('To')} AS recipient,
  try_strptime({_BARE_DATE}, '%d %b %Y %H:%M:%S %z') AT TIME ZONE 'UTC' AS timestamp,
  parsed_body AS body, {_header('Subject')} AS subject, 'email' AS channel FROM e"""


@query(
    "parse_email",
    twin(
        "v_email_raw",
        f"{_LINES} SELECT doc_id, "
        + ", ".join(f'{_header(h)} AS "{h}"' for h in HEADERS)
        + ', parsed_body AS "Body" FROM e',
    ),
)
def _(spark, sf):
    return struct_columns(K.parse_email(view(spark, sf, "v_email_raw")), "parsed", ["doc_id"])


@query("conform_email", twin("v_email_raw", f"{_LINES} {_EMAIL}"))
def _(spark, sf):
    rows = K.conform_email(view(spark, sf, "v_email_raw"))
    return rows.select("doc_id", "id", "sender", "recipient", "timestamp", "body", "subject", "channel")


@query(
    "source_router",
    twin(
        "v_email_raw",
        f"""{_LINES}, m AS ({_EMAIL})
        SELECT 'enron' AS source, id AS key, sender, subject AS title FROM m
        UNION ALL SELECT 'clinton_emails', CAST(doc_id AS VARCHAR), NULL, message FROM v_email_raw
        UNION ALL SELECT 'biden_emails', CAST(doc_id AS VARCHAR), NULL, message FROM v_email_raw""",
    ),
)
def _(spark, sf):
    raw = view(spark, sf, "v_email_raw")
    mapped = K.route_source(raw, "enron").selectExpr("'enron' AS source", "id AS key", "sender", "subject AS title")
    for source in ("clinton_emails", "biden_emails"):
        same = K.route_source(raw, source).selectExpr(
            f"'{source}' AS source", "CAST(doc_id AS STRING) AS key", "CAST(NULL AS STRING) AS sender", "message AS title"
        )
        mapped = mapped.unionByName(same)
    return mapped


def _markup(x: str) -> str:
    for pattern, by in (
        ("<@U[A-Z0-9]+>", "@user"),
        (r"<#C[A-Z0-9]+\|([^>]+)>", r"#\1"),
        (r"<(https?://[^|>]+)\|([^>]+)>", r"\2 (\1)"),
        ("<([^>]+)>", r"\1"),
    ):
        x = f"regexp_replace({x}, '{pattern}', '{by}', 'g')"
    return f"trim({x})"


_CHANNEL = "CASE WHEN starts_with(channel_name, '#') THEN channel_name ELSE '#' || channel_name END"
_SLACK = f"""SELECT "user" AS sender, {_CHANNEL} AS recipient,
  CASE WHEN thread_ts IS NOT NULL THEN 'Thread Reply' ELSE 'Slack Message' END AS subject, {_markup('text')} AS body,
  ts AS timestamp, thread_ts AS thread_timestamp, coalesce(subtype, 'message') AS message_subtype,
  CAST(NULL AS VARCHAR) AS reactions, reply_count, client_msg_id AS message_id FROM v_slack_raw"""
_SLACK_KEPT = f"""SELECT *, 'slack' AS communication_type FROM ({_SLACK}) WHERE sender IS NOT NULL AND recipient IS NOT NULL
  AND body <> '' AND message_subtype NOT IN ('channel_join', 'channel_leave')"""


@query("conform_slack", twin("v_slack_raw", _SLACK_KEPT))
def _(spark, sf):
    rows = K.conform_slack(view(spark, sf, "v_slack_raw"))
    return rows.withColumn("reactions", F.col("reactions").cast("string"))


@query("clean_slack_markup", twin("v_slack_raw", f"SELECT conv_id, turn, {_markup('text')} AS text FROM v_slack_raw"))
def _(spark, sf):
    return K.clean_slack_markup(view(spark, sf, "v_slack_raw").select("conv_id", "turn", "text"), "text")


@query("prefix_channel", twin("v_slack_raw", f"SELECT conv_id, turn, {_CHANNEL} AS recipient FROM v_slack_raw"))
def _(spark, sf):
    raw = view(spark, sf, "v_slack_raw")
    return K.prefix_channel(raw.selectExpr("conv_id", "turn", "channel_name AS recipient"))


@query(
    "slack_keep",
    twin(
        "v_slack_raw",
        """SELECT "user" AS sender, channel_name AS recipient, text AS body, coalesce(subtype, 'message') AS message_subtype
        FROM v_slack_raw WHERE channel_name IS NOT NULL AND text <> '' AND coalesce(subtype, '') NOT IN ('channel_join', 'channel_leave')""",
    ),
)
def _(spark, sf):
    rows = P.slack_keep(K.slack_fields(view(spark, sf, "v_slack_raw")))
    return rows.select("sender", "recipient", "body", "message_subtype")


# Epoch seconds or ISO text to a clock in UTC.
_EPOCH = (
    "coalesce(make_timestamp(CAST(TRY_CAST({c} AS DECIMAL(20, 6)) * 1000000 AS BIGINT)), "
    "TRY_CAST({c} AS TIMESTAMPTZ) AT TIME ZONE 'UTC')"
)


@query("slack_ts", twin("v_slack_raw", f"SELECT conv_id, turn, {_EPOCH.format(c='ts')} AS ts FROM v_slack_raw"))
def _(spark, sf):
    return K.slack_ts(view(spark, sf, "v_slack_raw").select("conv_id", "turn", "ts"), "ts")


_STAMP = r"\d{1,2}/\d{1,2}/\d{2,4}, \d{1,2}:\d{2} [AP]M"
_CHAT = rf"""SELECT * FROM (SELECT regexp_extract(value, '({_STAMP})', 1) AS timestamp,
  regexp_extract(value, '{_STAMP} - ([^:]+):', 1) AS sender,
  regexp_extract(value, '{_STAMP} - [^:]+: (.+)', 1) AS message FROM v_chat_lines)
  WHERE timestamp <> '' AND sender <> '' AND message <> ''"""
_WHATSAPP = f"""SELECT trim(sender) AS sender, 'Direct Message' AS recipient, 'WhatsApp Message' AS subject, message AS body,
  timestamp, CAST(NULL AS VARCHAR) AS message_type, CAST(NULL AS VARCHAR) AS media_type, CAST(NULL AS VARCHAR) AS message_id FROM ({_CHAT})"""
_WHATSAPP_KEPT = f"""SELECT *, 'whatsapp' AS communication_type FROM ({_WHATSAPP}) WHERE sender IS NOT NULL AND body <> ''
  AND NOT regexp_matches(body, '.*left|joined|added|removed.*')"""
_CHAT_TIME = (
    "coalesce(try_strptime({c}, '%m/%d/%y, %I:%M %p'), try_strptime({c}, '%m/%d/%Y, %I:%M %p'), "
    "TRY_CAST({c} AS TIMESTAMPTZ) AT TIME ZONE 'UTC')"
)
# Some rows carry ISO clocks, as exports by other tools do.
_MIXED_CHAT = f"""SELECT CASE WHEN strlen(message) % 3 = 0 THEN '2024-02-03T04:05:06Z' ELSE timestamp END AS timestamp,
  sender, message FROM ({_CHAT})"""
_MIXED_KEPT = _WHATSAPP_KEPT.replace(_CHAT, _MIXED_CHAT)


def _chat(spark, sf):
    return K.parse_chat_lines(view(spark, sf, "v_chat_lines"))


def _mixed_chat(spark, sf):
    iso = F.when(F.octet_length("message") % 3 == 0, "2024-02-03T04:05:06Z").otherwise(F.col("timestamp"))
    return _chat(spark, sf).withColumn("timestamp", iso)


@query("chat_line_ok", twin("v_chat_lines", _CHAT))
def _(spark, sf):
    return _chat(spark, sf)


@query("conform_whatsapp", twin("v_chat_lines", _WHATSAPP_KEPT))
def _(spark, sf):
    return K.conform_whatsapp(_chat(spark, sf))


@query(
    "whatsapp_keep",
    twin(
        "v_chat_lines",
        f"SELECT * FROM ({_WHATSAPP}) WHERE body <> '' AND NOT regexp_matches(body, '^(Ann|Bob) (left|joined)')",
    ),
)
def _(spark, sf):
    return P.whatsapp_keep(K.whatsapp_fields(_chat(spark, sf)), "^(Ann|Bob) (left|joined)")


@query("chat_ts", twin("v_chat_lines", f"SELECT sender, message, {_CHAT_TIME.format(c='timestamp')} AS timestamp FROM ({_MIXED_CHAT})"))
def _(spark, sf):
    return K.chat_ts(_mixed_chat(spark, sf))


@query("media_flag", twin("v_chat_lines", f"SELECT *, contains(body, '<Media omitted>') AS has_media FROM ({_WHATSAPP})"))
def _(spark, sf):
    return K.media_flag(K.whatsapp_fields(_chat(spark, sf)))


@query(
    "conform_local_email",
    twin("v_comm", "SELECT sender, recipient, subject, body, timestamp FROM v_comm"),
)
def _(spark, sf):
    raw = view(spark, sf, "v_comm").withColumnsRenamed({"sender": "from", "recipient": "to"})
    return K.conform_local_email(raw)


@query(
    "conform_local_slack",
    twin("v_comm", "SELECT sender, recipient, 'slack_message' AS subject, body, timestamp FROM v_comm"),
)
def _(spark, sf):
    raw = view(spark, sf, "v_comm").drop("channel")
    renamed = {"sender": "user", "recipient": "channel", "body": "message"}
    return K.conform_local_slack(raw.withColumnsRenamed(renamed))


def _framed(*parts: str) -> str:
    """SQL of the id's digest: every part with its length in bytes before it, NULL as '-'."""
    framed = " || ".join(f"coalesce(CAST(strlen({p}) AS VARCHAR) || ':' || {p}, '-')" for p in parts)
    return f"sha256({framed})"


_SLACK_ID = _framed("'own'", "'slack'", "message_id")
_CHAT_ID = _framed("'whatsapp'", "sender", "recipient", "CAST(epoch_us(timestamp) AS VARCHAR)", "body")
_UNION = f"""{_LINES}, m AS ({_EMAIL}),
s AS (SELECT sender, recipient, {_EPOCH.format(c='timestamp')} AS timestamp, body, subject, message_id FROM ({_SLACK_KEPT})),
w AS (SELECT sender, recipient, {_CHAT_TIME.format(c='timestamp')} AS timestamp, body, subject FROM ({_MIXED_KEPT}))
SELECT id, sender, recipient, timestamp, body, subject, channel FROM m
UNION ALL SELECT {_SLACK_ID}, sender, recipient, timestamp, body, subject, 'slack' FROM s
UNION ALL SELECT {_CHAT_ID}, sender, recipient, timestamp, body, subject, 'whatsapp' FROM w"""


@query("union_channels", twin("v_email_raw v_slack_raw v_chat_lines", _UNION))
def _(spark, sf):
    rows = communications(
        view(spark, sf, "v_email_raw"), view(spark, sf, "v_slack_raw"), _mixed_chat(spark, sf)
    )
    return rows.select("id", "sender", "recipient", "timestamp", "body", "subject", "channel")
