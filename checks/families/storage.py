"""Sources, sinks and streams: derived rows are written to the shared folder and read back."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from checks.base import as_of, query, table, twin, view
from checks.families.cleaning import _CLEAN, _VALID, _score
from checks.families.conform import _CHAT, _EPOCH, _SLACK_ID, _SLACK_KEPT
from checks.families.transform import nested_sensor
from tidewire.operators.conform import parse_chat_lines
from tidewire.operators.transform import add_base_fields, sensor_transform
from tidewire.plans.cleaning import cleaned
from tidewire.plans.communications import slack_messages, union_channels
from tidewire.session import fresh_path
from tidewire.sinks import writers as W
from tidewire.sources import readers as S
from tidewire.streaming.files import stream_conform, stream_files

_ORDERS = "SELECT * FROM orders"


@query("read_auto", _ORDERS)
def _(spark, sf):
    """Orders in nested folders of three formats, all rows and columns back."""
    path = fresh_path(spark, "read_auto")
    orders = table(spark, sf, "orders")
    for i, fmt in enumerate(("json", "csv", "parquet")):
        part = orders.where(F.col("o_orderkey") % 3 == i).write
        part = part.option("header", True) if fmt == "csv" else part
        part.format(fmt).save(f"{path}/{fmt}/2024/0{i}")
    return S.read_auto(spark, path, schema=orders.schema).select(*orders.columns)


@query("read_auto_parquet_first", _ORDERS)
def _(spark, sf):
    path = fresh_path(spark, "read_auto_parquet")
    table(spark, sf, "orders").write.parquet(path)
    return S.read_auto(spark, path, S.PARQUET_FIRST)


@query(
    "read_chat",
    twin("v_chat_lines", f"SELECT timestamp, sender, message FROM ({_CHAT}) UNION ALL SELECT timestamp, sender, message || '!' FROM ({_CHAT})"),
)
def _(spark, sf):
    """A text export in a nested folder beside a JSON export of the same chat."""
    path = fresh_path(spark, "read_chat")
    lines = view(spark, sf, "v_chat_lines")
    lines.select("value").write.text(f"{path}/texts/old")
    rows = parse_chat_lines(lines)
    rows.withColumn("message", F.concat("message", F.lit("!"))).write.json(f"{path}/rows")
    return S.read_chat(spark, path, rows.schema).select("timestamp", "sender", "message")


@query("read_parquet", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def _(spark, sf):
    return S.read_parquet(spark, f"{sf}/orders.parquet").select("o_orderkey", "o_orderdate", "o_totalprice")


@query("read_first_path", twin("v_dirty", _CLEAN))
def _(spark, sf):
    from tidewire.operators.cleaning import clean_all

    root = fresh_path(spark, "read_first_path")
    W.write_zone(clean_all(view(spark, sf, "v_dirty")), root, "cleaned")
    return S.read_first_path(spark, root)


@query("read_optional", twin("v_comm", "SELECT id, sender, body FROM v_comm"))
def _(spark, sf):
    path = fresh_path(spark, "read_optional")
    view(spark, sf, "v_comm").select("id", "sender", "body").write.parquet(path)
    return union_channels(S.read_optional(spark, path), S.read_optional(spark, f"{path}-absent"))


@query("read_chat_text", twin("v_chat_lines", _CHAT))
def _(spark, sf):
    path = fresh_path(spark, "read_chat_text")
    view(spark, sf, "v_chat_lines").select("value").write.text(path)
    return S.read_chat_text(spark, path)


@query(
    "read_csv_header",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer",
)
def _(spark, sf):
    path = fresh_path(spark, "read_csv_header")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    return S.read_csv_header(spark, path)


@query(
    "read_json_array",
    twin(
        "v_sensor",
        """SELECT id, temperature AS temperature_celsius, round(temperature * 9 / 5 + 32, 1) AS temperature_fahrenheit,
        coalesce(humidity, 0) AS humidity_percent, city AS location_city FROM v_sensor WHERE temperature IS NOT NULL""",
    ),
)
def _(spark, sf):
    def as_array_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # JSON lines of a partition as the lines of one array, batch by batch. Nested so that
        # workers get it by value.
        lead = "["
        for batch in batches:
            lines = batch["value"].tolist()
            if lines:
                yield pd.DataFrame({"value": [lead + lines[0], *("," + x for x in lines[1:])]})
                lead = ","
        yield pd.DataFrame({"value": ["[]" if lead == "[" else "]"]})

    path = fresh_path(spark, "read_json_array")
    nested = nested_sensor(spark, sf)
    lines = nested.select(F.to_json(F.struct("*")).alias("value"))
    lines.mapInPandas(as_array_files, "value string").write.text(path)
    flat = sensor_transform(S.read_json_array(spark, path, nested.schema))
    return flat.select("id", "temperature_celsius", "temperature_fahrenheit", "humidity_percent", "location_city")


@query(
    "write_zone",
    twin("v_dirty", f"SELECT *, {_score()} AS data_quality_score, TIMESTAMP '2024-01-31 00:00:00' AS cleaned_at FROM ({_VALID})"),
)
def _(spark, sf):
    root = fresh_path(spark, "write_zone")
    W.write_zone(cleaned(view(spark, sf, "v_dirty"), as_of()), root, "cleaned")
    return S.read_parquet(spark, W.zone_path(root, "cleaned"))


@query(
    "write_partitioned",
    twin(
        "v_comm",
        """SELECT id, body, strftime(timestamp, '%Y') AS year, strftime(timestamp, '%m') AS month, strftime(timestamp, '%d') AS day,
        'enron' AS data_source, 'mail' AS dataset_name FROM v_comm""",
    ),
)
def _(spark, sf):
    path = fresh_path(spark, "write_partitioned")
    rows = add_base_fields(view(spark, sf, "v_comm").select("id", "timestamp", "body"), "enron", "mail", as_of())
    W.write_partitioned(rows, path)
    back = S.read_partitioned(spark, path, rows.schema, W.PARTITION_KEYS)
    return back.select("id", "body", *W.PARTITION_KEYS)


@query("write_results", twin("v_dirty", _CLEAN))
def _(spark, sf):
    from tidewire.operators.cleaning import clean_all

    root = fresh_path(spark, "write_results")
    W.write_zone(clean_all(view(spark, sf, "v_dirty")), root, "cleaned")
    return S.read_parquet(spark, W.write_results(spark, W.zone_path(root, "cleaned"), root, "cleaning"))


@query("write_compact", "SELECT *, 4 AS files FROM lineitem")
def _(spark, sf):
    path = fresh_path(spark, "write_compact")
    W.write_compact(table(spark, sf, "lineitem"), path, files=4)
    back = S.read_parquet(spark, path)
    return back.withColumn("files", F.lit(len(back.inputFiles())))


@query("write_dual", "SELECT 'parquet' AS format, * FROM customer UNION ALL SELECT 'json', * FROM customer")
def _(spark, sf):
    customers = table(spark, sf, "customer")
    parquet, json = W.write_dual(customers, fresh_path(spark, "write_dual"))
    return S.read_parquet(spark, parquet).withColumn("format", F.lit("parquet")).unionByName(
        spark.read.schema(customers.schema).json(json).withColumn("format", F.lit("json"))
    )


@query(
    "stream_conform",
    twin(
        "v_slack_raw",
        " UNION ALL ".join(
            f"""SELECT {_SLACK_ID} AS id, sender, recipient, timestamp, body, subject, 'slack' AS channel FROM
            (SELECT sender, recipient, {_EPOCH.format(c='timestamp')} AS timestamp, body, subject, message_id || '{again}' AS message_id FROM ({_SLACK_KEPT}))"""
            for again in ("", "-again")
        ),
    ),
)
def _(spark, sf):
    landing, target, state = (fresh_path(spark, f"stream_{p}") for p in ("in", "out", "state"))
    raw = view(spark, sf, "v_slack_raw")
    # Every message is said twice in its minute, and each of the two lands twice, as a retried
    # upload would: the repeated upload goes, the repeated message stays.
    said_again = raw.withColumn("client_msg_id", F.concat("client_msg_id", F.lit("-again")))
    both = raw.unionByName(said_again)
    both.unionByName(both).write.parquet(landing)
    source = stream_files(spark, landing, raw.schema)
    # The id keeps the state small: a digest per message, not its text.
    stream_conform(source, slack_messages, target, state, keys=["id"], delay="30 days").awaitTermination()
    return spark.read.parquet(target).select("id", "sender", "recipient", "timestamp", "body", "subject", "channel")
