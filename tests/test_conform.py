"""Channel exports on literal rows, and the header parser against a plain statement of its rule."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewire.functions.mail import HEADERS
from tidewire.functions.times import chat_instant, epoch_text_instant, message_instant
from tidewire.operators import conform as K
from tidewire.operators import filters as P
from tidewire.operators.contract import contract_strict
from tidewire.operators.transform import select_contract
from tidewire.plans import communications as C
from tidewire.schemas import COMMUNICATION

MAIL = (
    "Message-ID: <1@x>\nDate: Mon, 14 May 2001 16:39:00 -0700 (PDT)\nFrom: a@x.com\nTo: b@x.com\n"
    "Subject: Re: one: two\nSubject: last\nX-Folder:  inbox \n folded line\n\nhello\n\nsecond part \n"
)


def headers_by_hand(message: str) -> dict[str, str | None]:
    head, gap, rest = message.partition("\n\n")
    found = {}
    for line in head.split("\n"):
        name, colon, value = line.partition(":")
        if colon and name:
            found[name.strip()] = value.strip()
    return {**{h: found.get(h) for h in HEADERS}, "Body": rest.strip() if gap else ""}


def test_parse_email_example(rows):
    got = K.parse_email(rows([(1, MAIL), (2, ""), (3, None)], "n int, message string")).orderBy("n").collect()
    parsed = got[0].parsed.asDict()
    assert parsed == headers_by_hand(MAIL)
    assert parsed["Subject"] == "last" and parsed["X-Folder"] == "inbox" and parsed["X-To"] is None
    assert parsed["Body"] == "hello\n\nsecond part"
    assert got[1].parsed is None and got[2].parsed is None


def test_parse_email_follows_the_rule_on_random_messages(rows):
    rng = random.Random(5)
    pieces = ["From", "To", "Subject", "from", "X-To", ":", ": ", " ", "\n", "\n", "\n\n", "\xa0", "é", "\r", "\t", "v", "=?"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(1, 25))) for _ in range(400)]
    texts += ["From:", ":x\nFrom : y", "\n\nbody", "From: a\nFrom:\n\n", " To : v\x1c", "XFrom: 1", "From\n: x"]
    df = rows(list(enumerate(texts)), "n int, message string")
    got = K.parse_email(df).orderBy("n").collect()
    for text, row in zip(texts, got, strict=True):
        assert row.parsed.asDict() == headers_by_hand(text), repr(text)


def test_conform_email(rows):
    df = rows([(7, MAIL), (8, "")], "doc int, message string")
    got = K.conform_email(df).orderBy("doc").collect()
    assert got[0].asDict() == {
        "doc": 7,
        "id": "<1@x>",
        "sender": "a@x.com",
        "recipient": "b@x.com",
        "timestamp": got[0].timestamp,
        "body": "hello\n\nsecond part",
        "subject": "last",
        "channel": "email",
        "attachments": [],
        "sentiment": None,
        "language": None,
    }
    assert K.conform_email(df).select(F.col("timestamp").cast("string")).first()[0] == "2001-05-14 23:39:00"
    assert got[1].body is None and got[1].sender is None
    contract_strict(select_contract(K.conform_email(df), COMMUNICATION), COMMUNICATION)


def test_mail_dates(column):
    from tidewire.functions.mail import mail_instant

    given = ["Mon, 1 Jan 2024 10:00:00 +0100", "1 Jan 2024 10:00:00 +0000", "2024-01-01 10:00:00", "not a date", None, ""]
    got = column(given, mail_instant(F.col("x")).cast("string"))
    assert got == ["2024-01-01 09:00:00", "2024-01-01 10:00:00", "2024-01-01 10:00:00", None, None, None]


def test_router(rows):
    df = rows([(MAIL,)], "message string")
    assert K.route_source(df, "enron").first().subject == "last"
    for source in ("clinton_emails", "biden_emails"):
        assert K.route_source(df, source).columns == ["message"]
    with pytest.raises(ValueError, match="Unknown source"):
        K.route_source(df, "whatsapp")


def test_slack_markup(rows):
    given = {
        "hi <@U12AB> in <#C99|gen>": "hi @user in #gen",
        "read <https://a.example/x|Site> now": "read Site (https://a.example/x) now",
        "<mailto:x> <b>": "mailto:x b",
        "  <>  ": "<>",
        "< >": "",
        "a > b <c> d < e": "a > b c d < e",
        "no brackets": "no brackets",
        "": "",
    }
    df = rows(list(enumerate(given)), "n int, body string")
    got = [r.body for r in K.clean_slack_markup(df).orderBy("n").collect()]
    assert got == list(given.values())


def test_conform_slack_keeps_what_the_cleaned_body_decides(rows):
    rng = random.Random(3)
    bodies = ["".join(rng.choices("<> \na", k=rng.randrange(0, 7))) for _ in range(400)] + [None, "", " ", "< >", "\n"]
    df = rows([("u", "c", b) for b in bodies], "user string, channel string, text string")
    late = P.slack_keep(K.prefix_channel(K.clean_slack_markup(K.slack_fields(df))))
    early = K.conform_slack(df)
    assert sorted(r.body for r in early.collect()) == sorted(r.body for r in late.collect())


def test_conform_slack_fields(rows):
    df = rows(
        [
            ("ann", "general", "hi", "1704067200.000100", None, None),
            ("bob", "#dev", "yo", "1704067201.5", "1704067200.0", "bot_message"),
            ("eve", "ops", "x", "1", None, "channel_join"),
            (None, "ops", "x", "1", None, None),
            ("ann", None, "x", "1", None, None),
            ("ann", "ops", "  ", "1", None, None),
        ],
        "user string, channel_name string, text string, ts string, thread_ts string, subtype string",
    )
    got = [r.asDict() for r in K.conform_slack(df).orderBy("sender").collect()]
    assert [(g["sender"], g["recipient"], g["subject"], g["message_subtype"]) for g in got] == [
        ("ann", "#general", "Slack Message", "message"),
        ("bob", "#dev", "Thread Reply", "bot_message"),
    ]
    assert got[0]["reactions"] is None and got[0]["reply_count"] is None
    assert {g["communication_type"] for g in got} == {"slack"}


def test_epoch_text_is_exact(column):
    given = ["1704067200.000100", "1704067200", "x", None, "1704067200.999999"]
    got = column(given, epoch_text_instant(F.col("x")).cast("string"))
    assert got == ["2024-01-01 00:00:00.0001", "2024-01-01 00:00:00", None, None, "2024-01-01 00:00:00.999999"]


CHAT = [
    "1/5/24, 9:05 AM - Ann: I left my keys",
    "01/05/2024, 10:15 PM - Bob: hello: there",
    "1/5/2024, 12:00 PM - Bob joined using this link",
    "continuation",
    "1/6/24, 9:06 PM - Bob: <Media omitted>",
    "",
]


def test_chat_lines(rows):
    got = K.parse_chat_lines(rows([(c,) for c in CHAT], "value string")).collect()
    assert [tuple(r) for r in got] == [
        ("1/5/24, 9:05 AM", "Ann", "I left my keys"),
        ("01/05/2024, 10:15 PM", "Bob", "hello: there"),
        ("1/6/24, 9:06 PM", "Bob", "<Media omitted>"),
    ]
    assert P.chat_line_ok(rows([("", "a", "b"), ("t", "a", "b")], "timestamp string, sender string, message string")).count() == 1


def test_chat_stamps(column):
    given = ["1/5/24, 9:05 AM", "01/05/2024, 10:15 PM", "13/45/24, 9:05 AM", "x"]
    got = column(given, chat_instant(F.col("x")).cast("string"))
    assert got == ["2024-01-05 09:05:00", "2024-01-05 22:15:00", None, None]


def test_whatsapp(rows):
    df = rows(
        [(" Ann ", None, "I left my keys", None), ("Bob", "", "hi", None), ("Eve", "Club", "pic", "image"), ("Al", "x", "", None)],
        "contact string, chat_name string, text string, media_type string",
    )
    got = K.conform_whatsapp(df).orderBy("sender").collect()
    assert [(r.sender, r.recipient) for r in got] == [("Bob", "Direct Message"), ("Eve", "Club")]
    anchored = K.conform_whatsapp(df, r"^\w+ (left|joined)$").orderBy("sender").collect()
    assert [r.sender for r in anchored] == ["Ann", "Bob", "Eve"]
    flags = K.media_flag(K.whatsapp_fields(df)).orderBy("sender").collect()
    assert [r.has_media for r in flags] == [False, False, False, True]


def test_local_shapes(rows):
    mail = rows([("a@x", "b@x", "s", "t", "2023-01-01T10:30:00Z")], "`from` string, to string, subject string, body string, timestamp string")
    assert K.conform_local_email(mail).first().asDict()["recipient"] == "b@x"
    chat = rows([("john", "#general", "hi", "2023-01-01T09:00:00Z")], "user string, channel string, message string, timestamp string")
    assert tuple(K.conform_local_slack(chat).first()) == ("john", "#general", "slack_message", "hi", "2023-01-01T09:00:00Z")


def test_union_and_summary(rows):
    mail = rows([(MAIL,)], "message string")
    slack = rows([("ann", "general", "great work", "1704067200.0")], "user string, channel string, text string, ts string")
    chat = K.parse_chat_lines(rows([(CHAT[1],)], "value string"))
    both = C.communications(mail, slack, chat)
    assert both.schema.simpleString() == COMMUNICATION.simpleString()
    got = {r.channel: r for r in both.collect()}
    assert set(got) == {"email", "slack", "whatsapp"}
    assert got["slack"].recipient == "#general" and got["whatsapp"].body == "hello: there"
    assert C.union_channels(None, mail).columns == ["message"]
    with pytest.raises(ValueError):
        C.union_channels(None)
    daily = {(str(r.day), r.channel): r for r in C.scored_daily(both).collect()}
    assert daily["2024-01-01", "slack"].mean_score == pytest.approx(0.4)
    assert daily["2024-01-01", "slack"].positive_messages == 1


def test_union_fills_absent_columns(rows):
    out = C.union_channels(rows([(1, "a")], "x int, y string"), rows([("b", 2.0)], "y string, z double"))
    assert sorted(tuple(r) for r in out.select("y", "x", "z").collect()) == [("a", 1, None), ("b", None, 2.0)]


def test_ids_do_not_depend_on_partitioning(rows):
    df = rows([("u", "c", f"m{i}", dt.datetime(2024, 1, 1)) for i in range(20)], "sender string, recipient string, body string, timestamp timestamp")
    once = {r.body: r.id for r in K.to_communication(df, "slack", C.CHAT_ID).collect()}
    again = {r.body: r.id for r in K.to_communication(df.repartition(5), "slack", C.CHAT_ID).collect()}
    assert once == again and len(set(once.values())) == 20


def test_clocks_of_all_forms(column, rows):
    given = ["2023-01-01T09:00:00Z", "2023-01-01 09:00:00", "1/5/24, 9:05 AM", "1704067200.0001", " 2023-01-01 ", "12:30", "x", None]
    got = column(given, message_instant(F.col("x")).cast("string"))
    assert got == [
        "2023-01-01 09:00:00", "2023-01-01 09:00:00", "2024-01-05 09:05:00", "2024-01-01 00:00:00.0001", "2023-01-01 00:00:00", None, None, None,
    ]
    real = rows([(dt.datetime(2024, 1, 1, 2),)], "timestamp timestamp")
    assert K.slack_ts(real).first()[0] == K.chat_ts(real).first()[0] == dt.datetime(2024, 1, 1, 2)
    sample = rows([("u", "c", "t", "2023-01-01T09:00:00Z")], "user string, channel string, text string, sent_at string")
    assert str(C.slack_messages(sample).first().timestamp) == "2023-01-01 09:00:00"
    chat = rows([("u", "t", "2023-01-01T09:00:00Z")], "sender string, text string, date string")
    assert str(C.whatsapp_messages(chat).first().timestamp) == "2023-01-01 09:00:00"


def test_ids_tell_messages_apart_in_any_time_zone(spark, rows):
    schema = "user string, channel string, text string, ts string, client_msg_id string"
    same = rows([("u", "c", "ok", "1704067200.0", "1"), ("u", "c", "ok", "1704067200.0", "2")], schema)
    assert len({r.id for r in C.slack_messages(same).collect()}) == 2
    odd = rows([("\x1e", "b", None), (None, "b", "x"), ("a:b", "c", "x"), ("a", "b:c", "x")], "sender string, recipient string, body string")
    odd = odd.withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert len({r.id for r in K.to_communication(odd, "slack", C.CHAT_ID).collect()}) == 4
    bare = same.drop("client_msg_id").limit(1)
    zone = spark.conf.get("spark.sql.session.timeZone")
    ids = set()
    try:
        for name in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            ids |= {r.id for r in C.slack_messages(bare).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(ids) == 1


def test_slack_markup_follows_the_plain_rules_on_random_text(rows):
    import re

    def plain(t):
        for pattern, by in ((r"<@U[A-Z0-9]+>", "@user"), (r"<#C[A-Z0-9]+\|([^>]+)>", r"#\1"), (r"<(https?://[^|>]+)\|([^>]+)>", r"\2 (\1)"), (r"<([^>]+)>", r"\1")):
            t = re.sub(pattern, by, t)
        return t.strip(" ")

    rng = random.Random(11)
    pieces = ["<https://a", "<http://", "|", "|", ">", ">", "<", "b c", "\n", "$1", "\\", "<@U1>", "<#C1|x>", "é"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(1, 14))) for _ in range(1500)]
    got = K.clean_slack_markup(rows(list(enumerate(texts)), "n int, body string")).orderBy("n").collect()
    assert [r.body for r in got] == [plain(t) for t in texts]
