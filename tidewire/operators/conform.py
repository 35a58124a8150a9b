"""Raw channel exports to the communication shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.columns import (
    as_instant,
    coalesce_present,
    field_type,
    framed,
    instant_present,
    is_number,
    is_text,
    named,
    present,
    typed_null,
    with_all,
)
from tidewire.functions.mail import (
    HEADERS,
    header_block,
    header_value,
    mail_instant,
    message_body,
    raw_header,
)
from tidewire.functions.times import message_instant
from tidewire.operators.filters import slack_keep, whatsapp_keep
from tidewire.schemas import COMMUNICATION_FIELDS

MEDIA_MARK = "<Media omitted>"
REACTIONS_TYPE = "array<struct<name:string,count:bigint,users:array<string>>>"

# Headers behind the communication fields, and the pieces of an exported
# chat line.
EMAIL_FIELDS = {
    "id": "Message-ID",
    "timestamp": "Date",
    "sender": "From",
    "recipient": "To",
    "subject": "Subject",
}
# Slack's markup, and the aliases of each shared field.
_MENTION, _CHANNEL_LINK, _BARE_TAG = r"<@U[A-Z0-9]+>", r"<#C[A-Z0-9]+\|([^>]+)>", r"<([^>]+)>"
_TITLED = r"(?s)<(https?://[^|>]+)\|(.*)\z"
SLACK_ALIASES = {
    "sender": ["user", "sender", "username", "user_id"],
    "recipient": ["channel", "channel_id", "channel_name"],
    "body": ["text", "message", "content", "body"],
    "timestamp": ["ts", "timestamp", "created_at", "sent_at"],
    "message_id": ["client_msg_id", "message_id"],
}
WHATSAPP_ALIASES = {
    "sender": ["sender", "from", "username", "contact"],
    "recipient": ["recipient", "to", "chat_name"],
    "body": ["message", "text", "content", "body"],
    "timestamp": ["timestamp", "date", "sent_at"],
    "message_id": ["message_id"],
}
_CHAT_STAMP = r"\d{1,2}/\d{1,2}/\d{2,4}, \d{1,2}:\d{2} [AP]M"
_CHAT_MESSAGE = f"{_CHAT_STAMP} - [^:]+: (.+)"

# Raw text that the markup rules and the trim turn into ''. Possessive, since Java walks a
# possessive group in a loop and any other repeated group by recursion.
_EMPTY_MARKUP = r"^(?: ++|< ++>)*+\z"


def _with_raw_headers(df: DataFrame, message: str, names: Sequence[str]) -> DataFrame:
    """Raw headers as ``_h_<name>``, each found by one search of the header block.

    Block, search and trimming are projections of their own: the optimizer keeps them apart
    because each result is read several times, and prunes headers nobody reads.
    """
    blocked = df.select("*", header_block(named(message)).alias("_block"))
    found = [raw_header(F.col("_block"), n).alias(f"_h_{n}") for n in names]
    return blocked.select(*[named(c) for c in df.columns], *found)


def parse_email(df: DataFrame, message: str = "message") -> DataFrame:
    """Adds ``parsed``: all known headers and the body; NULL for an empty message."""
    raw = _with_raw_headers(df, message, HEADERS)
    fields = [header_value(named(f"_h_{h}")).alias(h) for h in HEADERS]
    parsed = F.struct(*fields, message_body(named(message)).alias("Body"))
    return raw.select(
        *[named(c) for c in df.columns], F.when(named(message) != "", parsed).alias("parsed")
    )


def conform_email(df: DataFrame, message: str = "message") -> DataFrame:
    """Raw message text to the ten communication fields; lineage columns are carried."""
    raw = _with_raw_headers(df, message, list(EMAIL_FIELDS.values()))
    values = {k: header_value(named(f"_h_{h}")) for k, h in EMAIL_FIELDS.items()}
    # The date is read twice by the parser, so its trimmed text gets a step of its own.
    dated = raw.withColumn("_date", values["timestamp"])
    fields = {
        "id": values["id"],
        "sender": values["sender"],
        "recipient": values["recipient"],
        "timestamp": mail_instant(named("_date")),
        "body": message_body(named(message)),
        "subject": values["subject"],
        "channel": F.lit("email"),
        "attachments": F.array().cast("array<string>"),
        "sentiment": typed_null("string"),
        "language": typed_null("string"),
    }
    lineage = [named(c) for c in df.columns if c != message and c not in fields]
    return dated.select(*lineage, *[v.alias(k) for k, v in fields.items()])


def _unchanged(df: DataFrame) -> DataFrame:
    return df


# Data sources and how each is mapped.
EMAIL_SOURCES = {
    "enron": conform_email,
    "clinton_emails": _unchanged,
    "biden_emails": _unchanged,
}


def route_source(df: DataFrame, source: str) -> DataFrame:
    """Mapper of a data source applied to its frame."""
    if source not in EMAIL_SOURCES:
        raise ValueError(f"Unknown source {source}")
    return EMAIL_SOURCES[source](df)


def _titled_links(text: Column, pieces: Column) -> Column:
    """``<https://x|Site>`` to ``Site (https://x)``; linear in the text.

    A link ends at the first closing bracket and needs a bar before it, so each piece between
    brackets is searched up to its last bar only: any link start before it is followed no
    further than the next bar. ``pieces`` is the text split on closing brackets.
    """

    def rewritten(piece: Column) -> Column:
        tail = F.substring_index(piece, "|", -1)
        head = F.substr(piece, F.lit(1), F.length(piece) - F.length(tail))
        url, after = F.regexp_extract(head, _TITLED, 1), F.regexp_extract(head, _TITLED, 2)
        title = F.concat(after, tail)
        found = (url != "") & (title != "")
        before = F.substr(head, F.lit(1), F.length(head) - F.length(F.regexp_extract(head, _TITLED, 0)))
        link = F.concat(before, title, F.lit(" ("), url, F.lit(")"))
        closed = F.concat(piece, F.lit(">"))
        return F.when(piece.contains("|") & found, link).otherwise(closed)

    closed_pieces = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), rewritten)
    linked = F.concat(F.concat_ws("", closed_pieces), F.element_at(pieces, -1))
    return F.when(text.contains("|") & text.contains("<http"), linked).otherwise(text)


def _split_closed(text: Column) -> tuple[Column, Column]:
    """The text up to its last closing bracket, and what follows."""
    tail = F.substring_index(text, ">", -1)
    return F.substr(text, F.lit(1), F.length(text) - F.length(tail)), tail


def clean_slack_markup(df: DataFrame, column: str = "body") -> DataFrame:
    """Mentions, channel links, titled links and bare tags to plain text.

    Every rule ends on a closing bracket, so the text after the last one is left out of the
    searches: unclosed brackets there would each be followed to the end of the text.
    """
    text, tail = _split_closed(named(column))
    text = F.regexp_replace(text, _MENTION, "@user")
    text = F.regexp_replace(text, _CHANNEL_LINK, "#$1")
    # Read several times by the next rule, so a step of its own.
    staged = df.select("*", text.alias("_markup"), tail.alias("_tail"))
    staged = staged.select("*", F.split("_markup", ">").alias("_pieces"))
    staged = staged.select("*", _titled_links(F.col("_markup"), F.col("_pieces")).alias("_linked"))
    # A link takes its bracket away, so what is left open may again follow the last one.
    text, open_end = _split_closed(F.col("_linked"))
    bare = F.regexp_replace(text, _BARE_TAG, "$1")
    cleaned = with_all(staged, {column: F.trim(F.concat(bare, open_end, F.col("_tail")))})
    return cleaned.select(*[named(c) for c in df.columns])


def prefix_channel(df: DataFrame, column: str = "recipient") -> DataFrame:
    """``#`` before the channel name unless it is there; NULL stays NULL."""
    name = named(column)
    prefixed = F.when(name.startswith("#"), name).otherwise(F.concat(F.lit("#"), name))
    return with_all(df, {column: prefixed})


def slack_fields(df: DataFrame) -> DataFrame:
    """Aliased Slack columns under their shared names, not yet cleaned or filtered."""
    thread = coalesce_present(df, ["thread_ts"])
    return df.select(
        coalesce_present(df, SLACK_ALIASES["sender"]).alias("sender"),
        coalesce_present(df, SLACK_ALIASES["recipient"]).alias("recipient"),
        F.when(thread.isNotNull(), "Thread Reply").otherwise("Slack Message").alias("subject"),
        coalesce_present(df, SLACK_ALIASES["body"]).alias("body"),
        coalesce_present(df, SLACK_ALIASES["timestamp"]).alias("timestamp"),
        thread.alias("thread_timestamp"),
        coalesce_present(df, ["subtype"], F.lit("message")).alias("message_subtype"),
        coalesce_present(df, ["reactions"], data_type=REACTIONS_TYPE).alias("reactions"),
        coalesce_present(df, ["reply_count"], data_type="bigint").alias("reply_count"),
        coalesce_present(df, SLACK_ALIASES["message_id"]).cast("string").alias("message_id"),
    )


def conform_slack(df: DataFrame) -> DataFrame:
    """Slack export rows to cleaned, kept messages.

    The keep conditions are tested on the raw columns, where they are cheap and reach the
    scan: a filter on the cleaned body would run every markup rule a second time.
    """
    fields = slack_fields(df)
    kept = slack_keep(fields).filter(~named("body").rlike(_EMPTY_MARKUP))
    return (
        kept.transform(clean_slack_markup)
        .transform(prefix_channel)
        .withColumn("communication_type", F.lit("slack"))
    )


def parse_chat_lines(df: DataFrame, column: str = "value") -> DataFrame:
    """Exported chat lines to timestamp, sender, message; other lines are dropped.

    A line with a message part has the other two parts as well, so one search decides. A
    ``message_id`` of the lines is carried.
    """
    line = named(column)
    own = [named(c) for c in present(df, WHATSAPP_ALIASES["message_id"])]
    return df.filter(line.rlike(_CHAT_MESSAGE)).select(
        F.regexp_extract(line, f"({_CHAT_STAMP})", 1).alias("timestamp"),
        F.regexp_extract(line, f"{_CHAT_STAMP} - ([^:]+):", 1).alias("sender"),
        F.regexp_extract(line, _CHAT_MESSAGE, 1).alias("message"),
        *own,
    )


def whatsapp_fields(df: DataFrame) -> DataFrame:
    """Aliased WhatsApp columns under their shared names, not yet filtered."""
    chat = coalesce_present(df, WHATSAPP_ALIASES["recipient"])
    return df.select(
        F.trim(coalesce_present(df, WHATSAPP_ALIASES["sender"])).alias("sender"),
        F.when(chat.isNull() | (chat == ""), "Direct Message").otherwise(chat).alias("recipient"),
        F.lit("WhatsApp Message").alias("subject"),
        coalesce_present(df, WHATSAPP_ALIASES["body"]).alias("body"),
        coalesce_present(df, WHATSAPP_ALIASES["timestamp"]).alias("timestamp"),
        coalesce_present(df, ["message_type"]).alias("message_type"),
        coalesce_present(df, ["media_type"]).alias("media_type"),
        coalesce_present(df, WHATSAPP_ALIASES["message_id"]).cast("string").alias("message_id"),
    )


def conform_whatsapp(df: DataFrame, system_pattern: str | None = None) -> DataFrame:
    """WhatsApp rows to kept messages; ``system_pattern`` overrides the system-line test."""
    kept = whatsapp_keep(whatsapp_fields(df), system_pattern)
    return kept.withColumn("communication_type", F.lit("whatsapp"))


def conform_local_email(df: DataFrame) -> DataFrame:
    return df.selectExpr("`from` AS sender", "`to` AS recipient", "subject", "body", "timestamp")


def conform_local_slack(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "`user` AS sender",
        "`channel` AS recipient",
        "'slack_message' AS subject",
        "message AS body",
        "timestamp",
    )


def _clock_of(df: DataFrame, column: str) -> Column:
    if is_text(field_type(df, column)) or is_number(field_type(df, column)):
        return message_instant(named(column).cast("string"))
    return as_instant(named(column), field_type(df, column))


def slack_ts(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Epoch-seconds, ISO or chat clock text to a timestamp, in place; timestamps stay."""
    return with_all(df, {column: _clock_of(df, column)})


def chat_ts(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Chat, ISO or epoch clock text to a timestamp, in place; timestamps stay."""
    return with_all(df, {column: _clock_of(df, column)})


def media_flag(df: DataFrame) -> DataFrame:
    """Adds ``has_media``: a media type is given or the body is the media placeholder."""
    marked = F.coalesce(named("body").contains(MEDIA_MARK), F.lit(False))
    if present(df, ["media_type"]):
        marked = named("media_type").isNotNull() | marked
    return df.withColumn("has_media", marked)


def _id_part(df: DataFrame, name: str) -> Column:
    if isinstance(field_type(df, name), T.TimestampType):
        return F.unix_micros(named(name)).cast("string")
    return named(name).cast("string")


def to_communication(df: DataFrame, channel: str, id_columns: list[str]) -> DataFrame:
    """A conformed channel frame in contract columns, with an id.

    The id is a digest of the channel and the source's own ``message_id``, or of the
    ``id_columns`` where there is none: equal messages of one minute then share an id, so give
    sources without ids one (:func:`tidewire.sources.readers.read_chat_text` takes the line's
    place in its file). Clocks count as microseconds, so no session setting changes an id.
    """
    content = F.sha2(framed([F.lit(channel), *[_id_part(df, c) for c in id_columns]]), 256)
    key = content
    if "message_id" in df.columns:
        own = F.sha2(framed([F.lit("own"), F.lit(channel), named("message_id").cast("string")]), 256)
        key = F.when(named("message_id").isNotNull(), own).otherwise(content)
    fixed = {
        "id": key,
        "timestamp": instant_present(df, ["timestamp"]),
        "channel": F.lit(channel),
        "attachments": F.array().cast("array<string>"),
    }
    return df.select(
        *[
            fixed.get(n, coalesce_present(df, [n], data_type=t)).alias(n)
            for n, t in COMMUNICATION_FIELDS.items()
        ]
    )
