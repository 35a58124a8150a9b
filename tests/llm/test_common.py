"""Tables with an end of life, joins on hot keys, samples by row identity."""

from __future__ import annotations

import os
import threading

import pytest
from pyspark.sql import functions as F

from tidewire.llm import common, html, quality
from tidewire.llm import queries as Q
from tidewire.session import shared_dir

SF = "/root/testdata/sf0.001"


def folders(spark):
    there = shared_dir(spark)
    return set(os.listdir(there)) if os.path.isdir(there) else set()


@pytest.mark.parametrize("name", ["op5_line_dedup", "op7_minhash_near_dedup", "op8_quality_rules"])
def test_no_folder_is_left(spark, tmp_path, name):
    before = folders(spark)
    with common.Scope():
        Q.QUERIES[name](spark, SF).write.parquet(str(tmp_path / "out"))
    assert folders(spark) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() >= 0


def test_tables_go_with_their_last_reader(spark, rows):
    before = folders(spark)
    with common.Scope():
        a = common.written(rows([(1,)], "i int"), "a")
        b = common.written(a.select(F.col("i") + 1), "b", last=[a])
        assert len(folders(spark) - before) == 1
        with common.Scope():
            common.written(b, "c")
        assert len(folders(spark) - before) == 1
    assert folders(spark) == before


def test_no_setting_is_changed(spark, rows):
    seen, stop = set(), threading.Event()

    def watch():
        while not stop.is_set():
            seen.add(spark.conf.get(common.SHUFFLE_CLEANUP, None))

    before, thread = spark.conf.get(common.SHUFFLE_CLEANUP, None), threading.Thread(target=watch)
    thread.start()
    with common.Scope():
        common.written(rows([(i,) for i in range(100)], "i int").groupBy("i").count(), "x")
    stop.set()
    thread.join()
    assert seen == {before}


def test_salted_join_copies_hot_keys_only(rows, monkeypatch):
    monkeypatch.setattr(common, "SALT_ROWS", 50)
    data = [(1, i) for i in range(900)] + [(k, k) for k in range(2, 40)] + [(None, 7)] * 20
    big, small = rows(data, "k bigint, v bigint"), rows([(k, k * 10) for k in range(1, 30)], "k bigint, w bigint")
    hot = common.hot_keys(big.where("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n")), ["k"], "n")
    assert len(hot.hashes) == 1 and hot.salts == 18
    for how in ("inner", "left"):
        got, want = common.salted_join(big, small, ["k"], F.col("v"), hot, how), big.join(small, "k", how)
        assert sorted(map(str, got.select("k", "v", "w").collect())) == sorted(map(str, want.select("k", "v", "w").collect()))
    none = common.salted_join(big, small, ["k"], F.col("v"), common.NO_HOT, "left")
    assert none.count() == len(data)


def test_least_rows_counts_copies_once(rows):
    data = [(None, "copy")] * 3000 + [(None, f"t{i}") for i in range(500)]
    frame = rows(data, "k bigint, t string").withColumn("_place", F.xxhash64("k", "t"))
    got = common.least_rows(frame.repartition(5), 100).collect()
    assert len(got) == 100
    assert {r._place for r in got} == set(sorted({r._place for r in frame.collect()})[:100])
    assert common.least_rows(frame.limit(0), 5).collect() == []


def test_samples_are_bounded_whatever_the_rows(rows, monkeypatch):
    monkeypatch.setattr(quality, "UNLABELLED", 300)
    monkeypatch.setattr(quality, "POSITIVES", 50)
    taken = {}
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda p, u, prior: taken.update(p=len(p), u=len(u)) or fit(p, u, prior, epochs=1))
    docs = rows([(None, f"no id {i}") for i in range(6000)] + [(i, f"word {i}") for i in range(2000)] + [(5, "word 5")] * 3000, "doc_id bigint, text string")
    quality.train(docs, rows([(i, i % 2) for i in range(1000)], "doc_id bigint, quality int"), F.lit(True))
    assert taken == {"p": 50, "u": 300}
    monkeypatch.setattr(html, "SAMPLE_PAGES", 20)
    pages = rows([(1, "<article><p>The same page with words in it.</p></article><nav>x</nav>")] * 3000, "page_id bigint, html string")
    seen = {}
    monkeypatch.setattr(html, "fit_text", lambda x, y: seen.update(n=len(y)) or html.UNTRAINED.weights)
    html.train(pages)
    assert seen["n"] == 2


def test_ascii_lower(column):
    texts = ["ABC xyz", "ÄBC İ K ß", "", None, "K A"]
    assert column(texts, common.ascii_lower(F.col("x"))) == ["abc xyz", "Äbc İ k ß", "", None, "K a"]
