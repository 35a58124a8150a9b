"""Derived inputs and small helpers shared by the query families.

A view is one SQL text for both engines. ``@name`` stands for a driver table and ``@G``
for the replace-all flag one engine needs.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.columns import named, with_all

AS_OF_TEXT = "2024-01-31 00:00:00"

VIEWS = {
    "v_comm": """
SELECT concat('d', CAST(doc_id AS STRING)) AS id,
  concat('user', CAST(doc_id % 17 AS STRING), '@mail', CAST(doc_id % 5 AS STRING), '.example.com') AS sender,
  concat('team', CAST(doc_id % 6 AS STRING)) AS recipient,
  TIMESTAMP '2024-01-01 00:00:00' + CAST(doc_id * 7 % 40000 AS INT) * INTERVAL '1' MINUTE AS timestamp,
  CASE WHEN doc_id % 3 = 0 THEN concat('Re: ', source) WHEN doc_id % 3 = 1 THEN source ELSE NULL END AS subject,
  CASE CAST(doc_id % 3 AS INT) WHEN 0 THEN 'email' WHEN 1 THEN 'slack' ELSE 'whatsapp' END AS channel,
  CASE CAST(doc_id % 4 AS INT) WHEN 0 THEN text
    WHEN 1 THEN concat('Thank you, grateful for the help. ', text)
    WHEN 2 THEN concat('Not bad, but worried about the issue. ', text)
    ELSE concat(text, ' see [attachment] urgent') END AS body
FROM @documents
UNION ALL
SELECT concat('c', CAST(conv_id AS STRING), '-', CAST(turn AS STRING)) AS id,
  concat('user', CAST(conv_id % 17 AS STRING), '@mail', CAST(turn % 5 AS STRING), '.example.com') AS sender,
  concat('team', CAST(turn % 6 AS STRING)) AS recipient,
  TIMESTAMP '2024-01-01 00:00:00' + CAST(conv_id * 11 % 40000 AS INT) * INTERVAL '1' MINUTE AS timestamp,
  CASE WHEN turn % 3 = 0 THEN 'RE: chat' WHEN turn % 3 = 1 THEN role ELSE NULL END AS subject,
  CASE CAST(turn % 3 AS INT) WHEN 0 THEN 'email' WHEN 1 THEN 'slack' ELSE 'whatsapp' END AS channel,
  CASE WHEN (conv_id + turn) % 97 = 0 THEN NULL WHEN (conv_id + turn) % 97 = 1 THEN '' WHEN (conv_id + turn) % 97 = 2 THEN '   '
    ELSE concat(CASE CAST((conv_id + turn) % 11 AS INT)
      WHEN 0 THEN 'Great work, excellent result! '
      WHEN 1 THEN 'This is a terrible problem and I am angry. '
      WHEN 2 THEN 'Thank you, grateful for the help. '
      WHEN 3 THEN 'Not bad, but worried about the issue. '
      WHEN 4 THEN 'I am happy, it''s great! '
      WHEN 5 THEN 'see [attachment] urgent '
      WHEN 6 THEN 'Wonderful, amazing, excellent! '
      WHEN 7 THEN 'So sad and disappointed. '
      WHEN 8 THEN 'thrilled but nervous '
      ELSE '' END, text) END AS body
FROM @conversations""",
    "v_dirty": """
SELECT c_custkey AS id, c_acctbal AS balance,
  CASE CAST(c_custkey % 7 AS INT) WHEN 0 THEN 'N/A' WHEN 1 THEN '' WHEN 2 THEN concat('  ', c_name, '   X ')
    WHEN 3 THEN 'None' WHEN 4 THEN NULL WHEN 5 THEN ' null ' ELSE c_name END AS name,
  CASE CAST(c_custkey % 5 AS INT) WHEN 0 THEN concat(' User', CAST(c_custkey AS STRING), '@Example.COM ')
    WHEN 1 THEN 'invalid-email' WHEN 2 THEN NULL ELSE concat('u', CAST(c_custkey AS STRING), '@example.com') END AS email,
  CASE CAST(c_custkey % 4 AS INT) WHEN 0 THEN '+1 (555) 010-2030' WHEN 1 THEN '555-01' WHEN 2 THEN NULL ELSE '5550102030' END AS phone,
  CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN CAST(c_custkey % 90 AS STRING) WHEN 1 THEN 'abc' ELSE NULL END AS age,
  concat(c_mktsegment, chr(10), chr(9), ' note') AS note
FROM @customer""",
    "v_profile": """
SELECT c_custkey AS user_id, concat('h', CAST(c_custkey AS STRING)) AS handle,
  CASE CAST(c_custkey % 6 AS INT) WHEN 0 THEN concat('a', CAST(c_custkey AS STRING), '@gmail.com')
    WHEN 1 THEN 'b@outlook.com' WHEN 2 THEN NULL WHEN 3 THEN 'nodomain' ELSE 'c@corp.example' END AS email,
  CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE NULL END AS full_name,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Ann' END AS first_name,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'Lee' END AS last_name,
  c_mktsegment AS team, 'buyer' AS title
FROM @customer""",
    "v_email_raw": """
SELECT doc_id, CASE WHEN doc_id % 11 = 10 THEN '' ELSE concat(
  'Message-ID: <', CAST(doc_id AS STRING), '@mail.example.com>', chr(10),
  CASE WHEN doc_id % 4 = 3 THEN 'Date: not a date' ELSE concat('Date: Mon, ', CAST(1 + doc_id % 28 AS STRING), ' May 2001 16:39:00 -0700 (PDT)') END, chr(10),
  'From: u', CAST(doc_id % 17 AS STRING), '@example.com', chr(10), 'To: v@example.com', chr(10),
  'Subject: Re: topic: ', source, chr(10), 'Subject: last ', source, chr(10), 'X-Folder:  inbox ', chr(10), ' folded line', chr(10), chr(10),
  text, chr(10), chr(10), 'second part ') END AS message
FROM @documents""",
    "v_slack_raw": """
SELECT conv_id, turn, role AS "user",
  CASE CAST(turn % 4 AS INT) WHEN 0 THEN 'general' WHEN 1 THEN '#dev' WHEN 2 THEN NULL ELSE 'ops' END AS channel_name,
  CASE WHEN (conv_id + turn) % 101 = 0 THEN '' WHEN (conv_id + turn) % 101 = 1 THEN NULL
    WHEN (conv_id + turn) % 4 = 0 THEN concat('hi <@U12AB> see <#C99|gen> ', text)
    WHEN (conv_id + turn) % 4 = 1 THEN concat('read <https://a.example/x|Site> or <mailto:x> ', text)
    WHEN (conv_id + turn) % 4 = 2 THEN concat(text, ' <https://b.example|> <b|c> a|b <http://c.example|two|bars>') ELSE text END AS text,
  CASE WHEN conv_id % 4 = 3 THEN concat('2024-01-0', CAST(1 + conv_id % 9 AS STRING), 'T09:1', CAST(turn % 10 AS STRING), ':00Z')
    ELSE concat(CAST(1704067200 + conv_id * 60 + turn AS STRING), '.000100') END AS ts,
  concat(CAST(conv_id AS STRING), '-', CAST(turn AS STRING)) AS client_msg_id,
  CASE WHEN turn % 2 = 1 THEN concat(CAST(1704067200 + conv_id * 60 AS STRING), '.000100') ELSE NULL END AS thread_ts,
  CASE WHEN conv_id % 13 = 0 THEN 'channel_join' WHEN conv_id % 13 = 1 THEN 'bot_message' ELSE NULL END AS subtype,
  CAST(turn % 3 AS INT) AS reply_count
FROM @conversations""",
    "v_chat_lines": """
SELECT conv_id, turn, concat(CASE CAST((conv_id + turn) % 6 AS INT)
  WHEN 0 THEN 'just a continuation line '
  WHEN 1 THEN concat('1/', CAST(1 + conv_id % 28 AS STRING), '/24, 9:05 AM - Ann: I left my keys ')
  WHEN 2 THEN concat('1/', CAST(1 + conv_id % 28 AS STRING), '/24, 9:06 PM - Bob: <Media omitted> ')
  WHEN 3 THEN '1/5/2024, 12:00 PM - Bob joined using this link '
  ELSE concat('01/', CAST(1 + conv_id % 28 AS STRING), '/2024, 10:15 PM - ', role, ': ') END,
  replace(coalesce(text, ''), chr(10), ' ')) AS value
FROM @conversations""",
    "v_runs": """
SELECT event_id AS run_id, event_type AS job_name, CAST(user_id % 4 + 1 AS INT) AS attempt_number, 3 AS max_attempts,
  CASE CAST(event_id % 6 AS INT) WHEN 0 THEN 'pending' WHEN 1 THEN 'running' WHEN 2 THEN 'failed' WHEN 3 THEN 'cancelled' WHEN 4 THEN 'retrying' ELSE 'completed' END AS status,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE ts END AS started_at,
  CASE WHEN event_id % 6 IN (2, 3, 5) THEN ts + CAST(event_id % 300 AS INT) * INTERVAL '1' SECOND ELSE NULL END AS completed_at,
  CAST(event_id % 1000 AS INT) AS records_processed, CAST((event_id % 1000) - (event_id % 1000) % 7 AS INT) AS records_successful
FROM @events""",
    "v_paths": """
SELECT event_id, CASE CAST(event_id % 5 AS INT)
  WHEN 0 THEN concat('raw/year=2024/month=0', CAST(1 + event_id % 9 AS STRING), '/f.json')
  WHEN 1 THEN 'Cleaned/region=north/env=blue_7/part.csv'
  WHEN 2 THEN 'etl/month=11/deep/month=12/year=1999/f.json'
  WHEN 3 THEN 'nlp/config=a=b=c/other=last/f.json' ELSE 'other/f.json' END AS path
FROM @events""",
    "v_sensor": """
SELECT event_id AS id, ts AS timestamp,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(15 + event_id % 20 AS DOUBLE) + 0.5 END AS temperature,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(30 + event_id % 40 AS DOUBLE) END AS humidity,
  CAST(1000 + event_id % 20 AS DOUBLE) AS pressure,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 180 - 90 AS DOUBLE) END AS lat, CAST(event_id % 360 - 180 AS DOUBLE) AS lon,
  concat('City_', CAST(event_id % 10 AS STRING)) AS city, CAST(70 + event_id % 31 AS DOUBLE) / 100 AS quality_score
FROM @events""",
    "v_responses": """
SELECT doc_id, CASE WHEN doc_id % 100 = 99 THEN '' ELSE CASE CAST(doc_id % 10 AS INT)
  WHEN 0 THEN concat('{"analysis":"', t, '","key_themes":"a, b","sentiment":"positive","entities":"x","confidence":"high"}')
  WHEN 1 THEN concat('  {"analysis":"', t, '"}') WHEN 2 THEN concat('{"analysis":"broken ', t, '"')
  WHEN 3 THEN concat('{"analysis":"', t, '","sentiment":null}')
  WHEN 4 THEN concat('{', chr(39), 'analysis', chr(39), ':', chr(39), t, chr(39), '}')
  WHEN 5 THEN concat('{"analysis":"a', chr(10), 'b ', t, '"}')
  WHEN 6 THEN concat('{"analysis":"', t, '",}')
  WHEN 7 THEN concat('{"analysis":"', t, '"} thanks')
  WHEN 8 THEN concat('{"analysis":{"note":"', t, '"},"sentiment":"negative"}')
  ELSE text END END AS response
FROM (SELECT doc_id, text, replace(replace(replace(replace(text, chr(92), concat(chr(92), chr(92))), chr(34), concat(chr(92), chr(34))),
  chr(10), concat(chr(92), 'n')), chr(9), concat(chr(92), 't')) AS t FROM @documents) AS escaped""",
    "v_log": """
SELECT l_orderkey AS run_id,
  CASE l_returnflag WHEN 'A' THEN 'error' WHEN 'R' THEN 'warning' ELSE 'output' END AS kind,
  l_shipdate + CAST(l_extendedprice AS INT) * INTERVAL '1' SECOND AS logged_at, l_discount * 1000 AS quality_score
FROM @lineitem""",
}

_TABLE = re.compile(r"@([a-z]\w*)")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    sql = VIEWS[name].replace("@G", "").replace('"user"', "`user`")
    return spark.sql(_TABLE.sub(lambda m: f"parquet.`{sf}/{m[1]}.parquet`", _guard(sql)))


def _guard(sql: str) -> str:
    # Signs inside text literals ('@example.com') are not table marks.
    return re.sub(r"'[^']*'", lambda m: m[0].replace("@", "\\u0040"), sql)


def twin(views: str, body: str) -> str:
    """Oracle SQL: the named views as CTEs, then the query."""
    ctes = []
    for name in views.split():
        sql = VIEWS[name].replace("@G", ", 'g'")
        parts = re.split(r"('[^']*')", sql)
        sql = "".join(p if p.startswith("'") else _TABLE.sub(r"\1", p) for p in parts)
        ctes.append(f"{name} AS ({sql})")
    rest = body.strip()
    if not ctes:
        return rest
    joiner = ",\n" if rest.upper().startswith("WITH ") else "\n"
    return "WITH " + ",\n".join(ctes) + joiner + (rest[5:] if joiner.startswith(",") else rest)


def as_of() -> Column:
    return F.lit(AS_OF_TEXT).cast("timestamp")


def plain_clock(df: DataFrame) -> DataFrame:
    """Zoned timestamps as wall clocks, so both engines return the same type."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return with_all(df, {c: named(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return with_all(df, {c: F.round(named(c), places) for c in columns})


def struct_columns(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """``keep`` plus the fields of a struct column, side by side."""
    return df.select(*keep, f"{column}.*")


QUERIES: dict[str, object] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query, and its SQL twin if there is one.

    The wrapper fixes the session clock to UTC, which calendar operators depend on.
    """

    def add(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plain_clock(fn(spark, sf))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
