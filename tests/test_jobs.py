"""Jobs end to end on small landing folders."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.test_conform import CHAT, MAIL
from tidewire.operators.contract import ContractError
from tidewire.operators.quality import custom_rule, dq_results
from tidewire.operators.transform import sensor_transform
from tidewire.plans import jobs as J
from tidewire.sources.readers import UnreadableError, read_csv_header, read_json_array


def test_channels_to_sentiment_and_analysis(spark, rows, tmp_path):
    root = str(tmp_path / "lake")
    rows([("m1", MAIL)], "file string, message string").write.parquet(str(tmp_path / "mail"))
    (tmp_path / "slack").mkdir()
    (tmp_path / "slack" / "day.json").write_text(
        json.dumps({"user": "ann", "channel": "dev", "text": "great <@U1>", "ts": "1704067200.000100", "reactions": [{"name": "+1", "count": 2}]})
        + "\n"
        + json.dumps({"user": "bob", "channel": "dev", "text": "joined", "ts": "1704067201.0", "subtype": "channel_join"})
    )
    (tmp_path / "chat").mkdir()
    (tmp_path / "chat" / "export.txt").write_text("\n".join(CHAT))

    with pytest.raises(UnreadableError):
        J.sentiment_job(spark, root)
    assert J.email_job(spark, str(tmp_path / "mail"), root, "enron", "mail", ["file"]) == 1
    assert J.slack_job(spark, str(tmp_path / "slack"), root) == 1
    assert J.whatsapp_job(spark, str(tmp_path / "chat"), root) == 2
    assert J.sentiment_job(spark, root) == 4

    scored = {(r.channel, r.sender): r for r in spark.read.parquet(root + "/sentiment_analysis").collect()}
    assert scored["slack", "ann"].sentiment_label == "positive" and scored["slack", "ann"].body == "great @user"
    assert str(scored["slack", "ann"].timestamp) == "2024-01-01 00:00:00.000100"
    assert str(scored["whatsapp", "Bob"].timestamp) in ("2024-01-05 22:15:00", "2024-01-06 21:06:00")
    assert scored["email", "a@x.com"].id == "<1@x>"

    assert J.ai_job(spark, root, "rules") == 4
    assert spark.read.parquet(root + "/ai_processed").first().ai_model_used == "rules"


def test_unmapped_source_fails_its_contract(spark, rows, tmp_path):
    rows([(MAIL,)], "message string").write.parquet(str(tmp_path / "mail"))
    with pytest.raises(ContractError, match="missing fields"):
        J.email_job(spark, str(tmp_path / "mail"), str(tmp_path / "lake"), "biden_emails", "mail")


def test_cleaning_and_transform(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "people.csv").write_text("id,name,email\n1, Ann ,A@B.COM\n2,n/a,bad\n3,Bob,\n3,Bob,\n")
    root = str(tmp_path / "lake")
    assert J.cleaning_job(spark, str(tmp_path / "raw"), root) == 3
    got = sorted((r.id, r.name, r.email, r.data_quality_score) for r in spark.read.parquet(root + "/cleaned").collect())
    assert got == [("1", "Ann", "a@b.com", 100), ("3", "Bob", None, 66), ("3", "Bob", None, 66)]
    assert J.ai_job(spark, root, "rules") == 3
    assert J.transform_job(spark, str(tmp_path / "raw"), root) == 3
    assert J.transform_job(spark, str(tmp_path / "raw"), root, "user_profile") == 4
    profile = spark.read.parquet(root + "/transformed").filter("user_id = '1'").first()
    assert (profile.email_domain, profile.user_category) == ("B.COM", "internal")


def test_transform_kinds(rows):
    df = rows([("2024-01-01 10:00:00", "Re: x", "a b")], "timestamp string, subject string, body string")
    assert J.transform(df, "communication").first().word_count == 2
    assert J.transform(df, "temporal").first().time_of_day == "morning"
    assert "record_hash" in J.transform(df, "other").columns


def test_malformed_sensor_records_drop(spark, tmp_path):
    records = [
        {"id": "1"},
        {"id": "2", "timestamp": "invalid-date", "sensor_data": {"temperature": 20.0}},
        {"id": "3", "timestamp": "2025-10-12T10:00:00Z", "sensor_data": "text"},
    ]
    (tmp_path / "in.json").write_text(json.dumps(records))
    schema = "id string, timestamp string, sensor_data struct<temperature:double,humidity:double,pressure:double>, location struct<lat:double,lon:double,city:string>, quality_score double"
    got = sensor_transform(read_json_array(spark, str(tmp_path), schema)).collect()
    assert [(r.id, r.timestamp, r.temperature_fahrenheit, r.location_city) for r in got] == [("2", "invalid-date", 68.0, None)]


def test_published_sensor_rules(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,sensor_type,quality_score\n1,temperature,0.95\n2,light,0.92\n3,pressure,1.5\n")
    rules = [
        custom_rule("kind", "sensor_type IN ('temperature', 'humidity', 'pressure')", field="sensor_type"),
        custom_rule("score", "try_cast(quality_score AS double) BETWEEN 0 AND 1", field="quality_score"),
    ]
    failed = dq_results(read_csv_header(spark, str(tmp_path)), rules, "id").filter(~F.col("passed"))
    assert sorted((r.record_id, r.rule_name) for r in failed.collect()) == [("2", "kind"), ("3", "score")]


def test_one_action_per_job(spark, tmp_path, rows):
    rows([("1", "Ann")], "id string, name string").write.json(str(tmp_path / "raw"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-action", "cleaning job")
    J.cleaning_job(spark, str(tmp_path / "raw"), str(tmp_path / "lake"), "id string, name string")
    jobs = tracker.getJobIdsForGroup("one-action")
    spark.sparkContext.setJobGroup("rest", "rest")
    assert len(jobs) <= 3  # two for the file listing's distinct, one for the write
