from __future__ import annotations

import gzip
import json
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.operators.conform import conform_slack, slack_ts
from tidewire.operators.transform import add_base_fields
from tidewire.plans.cleaning import cleaned
from tidewire.plans.communications import slack_messages
from tidewire.schemas import PARTITION_KEYS
from tidewire.session import fresh_path, shared_dir
from tidewire.sinks import writers as W
from tidewire.sources import readers as S
from tidewire.sources.paths import with_path_partitions
from tidewire.streaming.files import LateRows, stream_conform, stream_files


@pytest.fixture
def people(rows):
    return rows([(1, "a"), (2, "b")], "id bigint, name string")


def values(df):
    return sorted((int(r.id), r.name) for r in df.collect())


class _Session:
    """As much of a session as the folder lookup reads."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder}
        self.sparkContext = SimpleNamespace(master=master, applicationId="app-1")


def test_shared_dir_is_the_clusters():
    assert shared_dir(_Session("yarn", "hdfs:///work/")) == "hdfs:///work"
    assert shared_dir(_Session("local[2]", "/set")) == "/set"
    own = shared_dir(_Session("local[2]"))
    assert Path(own).is_dir() and shared_dir(_Session("local[2]")) == own
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Session("yarn"))
    assert fresh_path(_Session("local[2]"), "x") != fresh_path(_Session("local[2]"), "x")


def test_read_auto_goes_by_ending(spark, people, tmp_path):
    for fmt in ("json", "parquet", "csv"):
        path = str(tmp_path / fmt)
        writer = people.write.option("header", True) if fmt == "csv" else people.write
        writer.format(fmt).save(path)
        assert S.formats_at(spark, path) == {fmt}
        for order in (S.FORMATS, S.PARQUET_FIRST):
            assert values(S.read_auto(spark, path, order)) == [(1, "a"), (2, "b")]
    assert dict(S.read_auto(spark, str(tmp_path / "csv")).dtypes) == {"id": "string", "name": "string"}


def test_read_auto_reads_a_mixed_folder_whole_or_not_at_all(spark, tmp_path):
    (tmp_path / "a.JSON").write_text('{"id": 1, "name": "a"}\n')
    (tmp_path / "b.csv").write_text("id,name\n2,b\n")
    assert values(S.read_auto(spark, str(tmp_path))) == [(1, "a"), (2, "b")]
    assert values(S.read_auto(spark, str(tmp_path), schema="id int, name string")) == [(1, "a"), (2, "b")]
    (tmp_path / "c").write_text("id,name\n3,c\n")
    with pytest.raises(S.UnreadableError, match="also holds 1 files"):
        S.read_auto(spark, str(tmp_path))
    with pytest.raises(S.UnreadableError, match="also holds 2 files"):
        S.read_auto(spark, str(tmp_path), ("csv",))
    assert values(S.read_auto(spark, str(tmp_path), only="csv")) == [(2, "b")]


def test_read_chat_stacks_text_and_rows(spark, tmp_path):
    (tmp_path / "rows").mkdir()
    (tmp_path / "old" / "deep").mkdir(parents=True)
    (tmp_path / "rows" / "a.json").write_text('{"timestamp": "t", "sender": "s", "message": "m"}\n')
    (tmp_path / "old" / "deep" / "c.txt").write_text("1/5/24, 9:05 AM - Ann: ok\n1/5/24, 9:05 AM - Ann: ok\n")
    got = S.read_chat(spark, str(tmp_path))
    assert sorted(r.message for r in got.collect()) == ["m", "ok", "ok"]
    placed = S.read_chat(spark, str(tmp_path), positions=True)
    assert len({r.message_id for r in placed.collect() if r.message == "ok"}) == 2
    (tmp_path / "b.parquet").write_text("x")
    with pytest.raises(S.UnreadableError, match="1 with parquet"):
        S.read_chat(spark, str(tmp_path))


@pytest.mark.parametrize("schema", [None, "id bigint, name string"])
def test_read_auto_looks_into_nested_folders(spark, people, tmp_path, schema):
    for fmt in ("json", "csv", "parquet"):
        root = tmp_path / fmt
        people.where("id = 1").write.option("header", True).format(fmt).save(str(root / "2024" / "01"))
        people.where("id = 2").write.option("header", True).format(fmt).save(str(root / "2025"))
        assert values(S.read_auto(spark, str(root), schema=schema)) == [(1, "a"), (2, "b")]


def test_read_auto_keeps_folder_keys(spark, people, tmp_path):
    people.write.json(str(tmp_path / "plain" / "year=2024"))
    people.write.json(str(tmp_path / "keyed" / "x" / "who=a+b c"))
    got = S.read_auto(spark, str(tmp_path / "plain"))
    assert values(got) == [(1, "a"), (2, "b")] and got.first().year == 2024
    nested = S.read_auto(spark, str(tmp_path / "keyed"))
    assert values(nested) == [(1, "a"), (2, "b")] and nested.first().who == "a+b c"


def test_read_parquet_pushes_down(spark):
    got = S.read_parquet(spark, "/root/testdata/sf0.001/orders.parquet").filter("o_orderstatus = 'F'").select("o_orderkey")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_read_auto_nameless_csv_is_not_taken_for_json(spark, tmp_path):
    (tmp_path / "data").write_text("id,name\n1,a\n2,b\n")
    for order in (S.FORMATS, S.PARQUET_FIRST):
        assert values(S.read_auto(spark, str(tmp_path / "data"), order)) == [(1, "a"), (2, "b")]
    with pytest.raises(S.UnreadableError):
        S.read_auto(spark, str(tmp_path / "data"), ("parquet", "json"))


def test_first_and_optional_paths(spark, people, tmp_path):
    root = str(tmp_path)
    with pytest.raises(S.UnreadableError):
        S.read_first_path(spark, root + "/none")
    people.write.parquet(root + "/cleaned")
    assert values(S.read_first_path(spark, root)) == [(1, "a"), (2, "b")]
    assert values(S.read_optional(spark, root + "/cleaned")) == [(1, "a"), (2, "b")]
    assert S.read_optional(spark, root + "/absent") is None
    people.limit(0).write.parquet(root + "/empty")
    assert S.read_optional(spark, root + "/empty") is None


def test_json_array_file(spark, tmp_path):
    data = [{"id": "1", "s": {"t": 1.5}}, {"id": "2", "s": {"t": None}}]
    (tmp_path / "a.json").write_text(json.dumps(data, indent=2))
    got = S.read_json_array(spark, str(tmp_path), "id string, s struct<t:double>")
    assert sorted((r.id, r.s.t) for r in got.collect()) == [("1", 1.5), ("2", None)]


def test_chat_text_and_csv(spark, tmp_path):
    (tmp_path / "chat.txt").write_text("1/5/24, 9:05 AM - Ann: hi\nmore\n")
    assert [tuple(r) for r in S.read_chat_text(spark, str(tmp_path / "chat.txt")).collect()] == [("1/5/24, 9:05 AM", "Ann", "hi")]
    (tmp_path / "t.csv").write_text("id,age\n1,007\n")
    assert S.read_csv_header(spark, str(tmp_path / "t.csv")).first().age == "007"


def test_zone_writer_counts_and_overwrites(spark, people, tmp_path):
    root = str(tmp_path)
    assert W.write_zone(people, root, "slack") == 2
    assert W.write_zone(people.limit(1), root, "slack") == 1
    assert S.read_parquet(spark, root + "/communications/slack").count() == 1


def test_partitioned_table_prunes(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = rows([("a", "2024-01-05 10:00:00"), ("b", "2024-01-05 11:00:00"), ("c", "2024-11-15 00:00:00")], "id string, ts string")
    df = add_base_fields(df.select("id", F.to_timestamp("ts").alias("timestamp")), "enron", "mail")
    assert W.write_partitioned(df, path) == 3
    assert W.write_partitioned(df, str(tmp_path / "u"), rebalance=False) == 3
    back = S.read_partitioned(spark, path, df.schema, PARTITION_KEYS)
    day = back.filter("month = '01' AND day = '05'")
    assert sorted(r.id for r in day.collect()) == ["a", "b"] and day.first().year == "2024"
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert len(day.inputFiles()) >= 1
    columns = "id STRING, timestamp TIMESTAMP, ingestion_timestamp TIMESTAMP, processing_date DATE, schema_version STRING"
    W.register_partitioned(spark, "messages_by_day", path, columns)
    try:
        got = spark.table("messages_by_day")
        assert got.filter("month = '11'").first().id == "c" and dict(got.dtypes)["day"] == "string"
    finally:
        spark.sql("DROP TABLE messages_by_day")


def test_path_columns_from_files(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "year=2024" / "who=é x"))
    df = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path))
    got = with_path_partitions(df, ["year", "who", "none"]).first()
    assert (got.year, got.who, got.none) == ("2024", "é x", None)


def test_results_copy_warns_only(spark, people, tmp_path, caplog):
    root = str(tmp_path)
    W.write_zone(people, root, "cleaned")
    target = W.write_results(spark, root + "/cleaned", root, "cleaning")
    assert values(spark.read.parquet(target)) == [(1, "a"), (2, "b")]
    assert W.write_results(spark, root + "/absent", root, "x") is None
    assert "results copy of x failed" in caplog.text


def test_compact_and_dual(spark, people, tmp_path):
    path = str(tmp_path / "c")
    assert W.write_compact(people.repartition(2), path, files=1) == 2
    assert len(spark.read.parquet(path).inputFiles()) == 1
    assert W.write_compact(spark.range(10), str(tmp_path / "m"), files=1, max_records=4) == 10
    assert len(spark.read.parquet(str(tmp_path / "m")).inputFiles()) == 3
    assert W.write_compact(people, str(tmp_path / "auto")) == 2
    parquet, js = W.write_dual(people, str(tmp_path / "d"))
    assert values(spark.read.parquet(parquet)) == values(spark.read.schema(people.schema).json(js))


def test_compact_files_need_no_shuffle(spark, people, tmp_path, monkeypatch):
    """Each file's task reads its share of parquet, also where tasks hold one row, and the shares go in the end."""
    plans, frame = [], type(people)
    own = frame.observe
    monkeypatch.setattr(frame, "observe", lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or own(df, *a))
    cases = {"wide": (spark.range(0, 1000, 1, 7), 4), "single": (spark.range(0, 9, 1, 9), 3), "few": (spark.range(0, 2, 1, 1), 4), "none": (spark.range(0), 4)}
    for name, (ids, files) in cases.items():
        rows = ids.select("id", (F.col("id") * 2).alias("Part"), F.when(F.col("id") > 3, "x").alias("a.b"))
        path = str(tmp_path / "out" / name)
        assert W.write_compact(rows, path, files=files) == ids.count()
        back = spark.read.parquet(path)
        assert back.dtypes == rows.dtypes and back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
        sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
        assert len(back.inputFiles()) == max(1, min(files, ids.count())) and (not sizes or max(sizes) - min(sizes) <= 7)
    assert not any("Exchange" in p for p in plans)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == sorted(cases)


SLACK = T.StructType([T.StructField(n, T.StringType()) for n in ("user", "channel", "text", "ts")])


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    landing, target, state = (str(tmp_path / d) for d in ("in", "out", "state"))

    def land(data):
        spark.createDataFrame(data, SLACK).coalesce(1).write.mode("append").parquet(landing)

    def conform(df):
        return slack_ts(conform_slack(df)).select("sender", "recipient", "body", "timestamp")

    def run():
        stream = stream_files(spark, landing, SLACK)
        stream_conform(stream, conform, target, state, ["sender", "body"], delay="1 hour").awaitTermination()
        return sorted((r.sender, r.recipient, r.body) for r in spark.read.parquet(target).collect())

    land([("ann", "dev", "hi <@U1>", "1704067200.0"), ("bob", "dev", "", "1704067200.0"), ("ann", "dev", "hi <@U1>", "1704067260.0")])
    assert run() == [("ann", "#dev", "hi @user")]
    land([("ann", "dev", "hi <@U1>", "1704067300.0"), ("eve", "#x", "yo", "1704067300.0")])
    assert run() == [("ann", "#dev", "hi @user"), ("eve", "#x", "yo")]


def test_late_rows_are_counted(spark, tmp_path):
    late = LateRows(spark)
    landing, target, state = (str(tmp_path / d) for d in ("in", "out", "state"))

    def conform(df):
        return slack_ts(conform_slack(df)).select("sender", "body", "timestamp")

    def run(data):
        spark.createDataFrame(data, SLACK).coalesce(1).write.mode("append").parquet(landing)
        query = stream_conform(stream_files(spark, landing, SLACK), conform, target, state, ["sender", "body"], delay="1 hour")
        query.awaitTermination()
        return late.of(query)

    assert run([("ann", "c", "new", "1704067200.0")]) == 0
    assert run([("ann", "c", "old", "1700000000.0"), ("ann", "c", "newer", "1704067300.0")]) == 1
    spark.streams.removeListener(late)


def test_late_rows_of_more_batches_than_are_kept(spark, tmp_path):
    landing, target, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    spark.createDataFrame([("ann", "c", "new", "1704067200.0")], SLACK).coalesce(1).write.parquet(landing)
    for n in range(5):
        spark.createDataFrame([("ann", "c", f"old {n}", "1700000000.0")], SLACK).coalesce(1).write.mode("append").parquet(landing)
    late = LateRows(spark)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        stream = stream_files(spark, landing, SLACK, max_files_per_trigger=1)
        query = stream_conform(stream, lambda df: slack_ts(conform_slack(df)).select("sender", "body", "timestamp"), target, state, ["sender", "body"], delay="1 hour")
        query.awaitTermination()
        assert len(query.recentProgress) <= 2
        assert late.of(query) + spark.read.parquet(target).count() == 6
        assert late.of(query) >= 3
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
        spark.streams.removeListener(late)


def test_stream_keeps_equal_messages_with_ids(spark, tmp_path):
    landing, target, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    schema = "user string, channel string, text string, created_at string, client_msg_id string"
    data = [("ann", "c", "ok", "2023-01-01T09:00:00Z", "1"), ("ann", "c", "ok", "2023-01-01T09:00:00Z", "2"), ("ann", "c", "ok", None, "3")]
    df = spark.createDataFrame(data, schema)
    df.union(df).write.parquet(landing)
    stream_conform(stream_files(spark, landing, df.schema), slack_messages, target, state, ["id"]).awaitTermination()
    got = [str(r.timestamp) for r in spark.read.parquet(target).collect()]
    assert got.count("2023-01-01 09:00:00") == 2 and got.count("None") >= 1


def test_cleaning_stream(spark, tmp_path):
    landing, target, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("1, Ann ,A@B.COM\n2,n/a,bad\n")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "name", "email")])
    stream_conform(stream_files(spark, landing, schema, "csv", 1), cleaned, target, state).awaitTermination()
    got = spark.read.parquet(target).collect()
    assert [(r.id, r.name, r.email, r.data_quality_score) for r in got] == [("1", "Ann", "a@b.com", 100)]


def test_plain_stream_keeps_every_row(spark, rows, tmp_path):
    landing, target, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    spark.createDataFrame([("a", "c", "x", "1")] * 3, SLACK).write.parquet(landing)
    stream_conform(stream_files(spark, landing, SLACK), conform_slack, target, state).awaitTermination()
    assert spark.read.parquet(target).count() == 3


def test_a_file_is_read_by_one_format(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"a": 1}\n')
    (tmp_path / "b.json.csv").write_text("a\n2\n")
    (tmp_path / "d.csv").write_text("a\n3\n")
    with gzip.open(tmp_path / "e.JSON.gz", "wt") as out:
        out.write('{"a": 4}\n')
    got = S.read_auto(spark, str(tmp_path))
    assert sorted(int(r.a) for r in got.collect()) == [1, 2, 3, 4]
    assert S.read_chat(spark, str(tmp_path)).count() == 4
    (tmp_path / "f.json.bak").write_text("x")
    with pytest.raises(S.UnreadableError):
        S.read_auto(spark, str(tmp_path))


@pytest.mark.parametrize("plain", [False, True])
def test_folder_keys_have_one_type_however_nested(spark, tmp_path, plain):
    for value, day, word in (("05", "2024-01-02", "x"), ("7", "2024-01-03", "8"), ("__HIVE_DEFAULT_PARTITION__", "2024-01-03", "y")):
        folder = tmp_path / f"m={value}" / f"d={day}" / f"w={word}"
        folder = folder / "plain" if plain else folder
        folder.mkdir(parents=True)
        (folder / "a.json").write_text('{"a": 1}\n')
    got = S.read_auto(spark, str(tmp_path))
    assert [got.schema[c].dataType.simpleString() for c in ("m", "d", "w")] == ["int", "date", "string"]
    assert sorted((r.m or 0, str(r.d), r.w) for r in got.collect()) == [(0, "2024-01-03", "y"), (5, "2024-01-02", "x"), (7, "2024-01-03", "8")]
