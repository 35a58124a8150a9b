from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewire.operators import transform as R
from tidewire.schemas import COMMUNICATION
from tidewire.sources.paths import path_partitions, zone_route


def now():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def test_communication_aliases(rows):
    df = rows(
        [("a", "c", "hi", "2024-01-02T03:04:05Z"), (None, None, None, "rubbish")],
        "user string, channel string, text string, date string",
    )
    got = R.transform_communication(df).collect()
    assert tuple(got[0]) == ("a", "c", "No Subject", "hi", dt.datetime(2024, 1, 2, 3, 4, 5), "unknown")
    assert got[1].timestamp is None and got[1].body is None


def test_first_alias_wins_even_when_unreadable(rows):
    df = rows([("bad", dt.datetime(2024, 1, 1)), (None, dt.datetime(2024, 1, 1))], "timestamp string, date timestamp")
    got = [r.timestamp for r in R.transform_communication(df).collect()]
    assert got == [None, dt.datetime(2024, 1, 1)]


def test_features(rows):
    df = rows(
        [("a b  c", "Re: x"), ("", "RE:x"), (None, None), (" see [attachment] ", "re: x")], "body string, subject string"
    )
    got = [tuple(r)[2:] for r in R.communication_features(df).collect()]
    assert got == [(3, False, True), (1, False, True), (0, False, False), (4, True, False)]


def test_profiles(rows):
    df = rows(
        [(1, "h", "a@gmail.com", None, "Ann", None), (2, "h", "nodomain", "F", "x", "y"), (3, "h", None, None, None, None), (4, "h", "a@b@c.com", None, "A", "B")],
        "id int, handle string, email_address string, full_name string, first_name string, last_name string",
    )
    got = R.profile_features(R.transform_user_profile(df)).collect()
    assert [(r.user_id, r.full_name, r.email_domain, r.user_category) for r in got] == [
        (1, "Ann", "gmail.com", "external"),
        (2, "F", "", "internal"),
        (3, "", None, "internal"),
        (4, "A B", "b@c.com", "internal"),
    ]
    assert got[0].department is None and got[0].role is None
    assert R.transform_user_profile(rows([(1,)], "id int")).first().full_name is None


def test_temporal(rows):
    df = rows([("2024-01-06T09:30:00Z",), ("2024-01-01 18:00:00",), ("x",), ("2024-12-30 12:00:00",)], "timestamp string")
    got = R.temporal_buckets(R.transform_temporal(df)).collect()
    sat, mon, bad, late = got
    assert (sat.day_of_week, sat.day_name, sat.month_name, sat.time_of_day, sat.is_weekend, sat.is_business_hours) == (
        7, "Saturday", "January", "morning", True, False,
    )
    assert (mon.hour, mon.time_of_day, mon.week_of_year, mon.is_business_hours) == (18, "evening", 1, False)
    assert (bad.year, bad.time_of_day, bad.is_weekend, bad.is_business_hours) == (None, "night", False, False)
    assert (late.week_of_year, late.is_business_hours) == (1, True)
    with pytest.raises(ValueError, match="timestamp"):
        R.transform_temporal(rows([(1,)], "a int"))


@pytest.mark.parametrize("hour,part", [(5, "night"), (6, "morning"), (11, "morning"), (12, "afternoon"), (17, "afternoon"), (18, "evening"), (22, "evening"), (23, "night")])
def test_parts_of_day(rows, hour, part):
    got = R.temporal_buckets(rows([(hour, 3)], "hour int, day_of_week int")).first()
    assert got.time_of_day == part and got.is_business_hours == (9 <= hour <= 17)


def test_dedupe_keeps_rows_that_share_a_hash(rows):
    df = rows([(1, None), (None, 1), (1, None), (1, 1)], "a int, b int")
    got = R.standard_transform(df, now())
    assert sorted(((r.a, r.b) for r in got.collect()), key=str) == [(1, 1), (1, None), (None, 1)]
    assert got.columns == ["a", "b", "processed_at", "record_hash"]
    import struct

    import xxhash

    one = R.standard_transform(rows([(7,)], "k bigint"), now(), "xxhash64").first()
    expected = xxhash.xxh64(struct.pack("<q", 7), seed=42).intdigest()
    assert one.record_hash == (expected - (1 << 64) if expected >> 63 else expected)
    wide = R.standard_transform(df, now(), "xxhash64")
    assert dict(wide.dtypes)["record_hash"] == "bigint"


def test_hot_copies_dedupe_to_one(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    assert R.dedupe_rows(df).count() == 2001


def test_lineage_and_ids(rows):
    df = rows([(1, "a"), (2, None), (3, "")], "k int, v string")
    got = R.add_base_fields(df, "enron", "mail", now()).first()
    assert (got.data_source, got.dataset_name, got.processing_date, got.schema_version) == ("enron", "mail", dt.date(2024, 1, 31), "2.0")
    keyed = {r.k: r.record_id for r in R.record_ids(df, "DOC", ["k", "v"]).collect()}
    assert keyed == {r.k: r.record_id for r in R.record_ids(df.repartition(3), "DOC", ["k", "v"]).collect()}
    odd = rows([("a", "\x1e"), ("a", None), ("a\x1f", ""), ("a", "\x1f"), ("1:a", "-"), ("", "1:a-")], "x string, y string")
    assert len({r.record_id for r in R.record_ids(odd, "T", ["x", "y"]).collect()}) == 6
    assert len(set(keyed.values())) == 3 and all(v.startswith("DOC-") for v in keyed.values())
    plain = [r.record_id for r in R.record_ids(df).collect()]
    assert len(set(plain)) == 3 and plain[0].startswith("REC-")
    assert R.add_partitions(df, {"year": "2024"}).first().year == "2024"


def test_select_contract_order(rows):
    df = rows([("b", 1, "i")], "body string, extra int, id string")
    assert R.select_contract(df, COMMUNICATION).columns == ["id", "body"]


def test_sensor_rows(rows):
    nested = "id string, timestamp string, sensor_data struct<temperature:double,humidity:double,pressure:double>, location struct<lat:double,lon:double,city:string>, quality_score double"
    df = rows(
        [
            ("a", "t", (12.25, 61.0, 998.5), (48.1, 11.6, "Munich"), 0.93),
            ("b", "t", (None, 1.0, 1.0), None, 0.95),
            ("c", "t", (-40.0, None, None), (None, 1.0, None), 0.9),
            ("d", "t", (0.0, 1.0, 1.0), None, None),
        ],
        nested,
    )
    got = {r.id: r for r in R.sensor_transform(df).collect()}
    assert set(got) == {"a", "c", "d"}
    a, c, d = got["a"], got["c"], got["d"]
    assert (a.temperature_fahrenheit, a.data_quality, a.location_city, a.location_coordinates) == (54.1, "high", "Munich", [48.1, 11.6])
    assert (c.temperature_fahrenheit, c.humidity_percent, c.pressure_hpa, c.data_quality) == (-40.0, 0.0, 0.0, "medium")
    assert (c.location_city, c.location_coordinates) == ("", [0.0, 1.0])
    assert (d.quality_score, d.location_city, d.location_coordinates) == (0.0, None, None)


def test_flat_sensor_golden_rows(rows):
    df = rows(
        [("k", "2031-02-03T04:05:06Z", "wind", "7.75", "mast 4", "0.5"), ("l", "2031-02-03T04:06:06Z", "wind", "calm", "mast 4", "0.4")],
        "id string, timestamp string, sensor_type string, value string, location string, quality_score string",
    )
    got = [tuple(r) for r in R.sensor_flat(df).collect()]
    assert got[0] == ("k", "2031-02-03T04:05:06Z", "wind", 7.75, "mast 4", 0.5, "2031-02-03T04:05:06Z")
    assert got[1][3] is None


PATHS = {
    "lake/tier=gold": {"tier": "gold"},
    "tier=gold/day=07/slot=3/part-0.csv": {"tier": "gold", "day": "07", "slot": "3"},
    "plain/part-0.csv": {},
    "": {},
    "=x/ =y/k=": {},
    "q/sum=1=2=3/part": {"sum": "1=2=3"},
    "stadt=Köln/straße=Süd/f": {"stadt": "Köln", "straße": "Süd"},
    "Tier=a/TIER=b/tier=c/f": {"Tier": "a", "TIER": "b", "tier": "c"},
    "a=1/b=2/a=3/c=4/b=5": {"a": "3", "b": "5", "c": "4"},
    "x.y-z=9/k v=w": {"z": "9", "v": "w"},
}


def test_path_partitions(column):
    assert column(list(PATHS), path_partitions(F.col("x"))) == list(PATHS.values())


def test_zone_route(column):
    given = ["raw/a", "ETL/b", "cleaned/x/y", "Sentiment", "nlp/", "other/x", "", None, "/raw/x"]
    want = ["etl", "cleaned", "sentiment", "nlp", "analytics", None, None, None, None]
    assert column(given, zone_route(F.col("x"))) == want
