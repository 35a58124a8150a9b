"""Toxicity: search against all cosines, calibration, held-out accuracy and odd tables."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewire.llm import queries as Q
from tidewire.llm import toxicity


def made(n=400, seed=3):
    draw = np.random.default_rng(seed)
    texts, toxic = [], []
    for _ in range(n):
        bad = draw.random() < 0.3
        words = [f"word{draw.integers(40)}" for _ in range(draw.integers(5, 60))]
        words += [str(draw.choice(["vile", "vileness", "rotten", "rottenly"])) for _ in range(draw.integers(1, 5))] if bad else []
        draw.shuffle(words)
        texts.append(" ".join(words) + ".")
        toxic.append(float(bad))
    return texts, np.array(toxic)


def trained(spark):
    texts, toxic = made()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return toxicity.train(docs, spark.createDataFrame([(i, int(y)) for i, y in enumerate(toxic)], "doc_id bigint, toxic int"), F.lit(True))


@pytest.fixture(scope="module")
def index(spark):
    return trained(spark)


def dense(index):
    n_terms, n_blocks = len(index.known) + 1, index.block_most.shape[1]
    out = np.zeros((len(index.ids), n_terms))
    for t in range(n_terms):
        a, b = index.posting_start[t * n_blocks], index.posting_start[(t + 1) * n_blocks]
        out[index.posting_entry[a:b], t] = index.posting_weight[a:b]
    return out


def test_nearest_equals_all_cosines(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 4)
    monkeypatch.setattr(toxicity, "_own_votes", lambda table, _: table.select("_y", F.lit(0.5).alias("vote")))
    index = trained(spark)
    assert index.block_most.shape[1] > 3
    every = dense(index)
    assert np.allclose((every**2).sum(1), 1)
    others, _ = made(80, 9)
    found = toxicity.terms(pa.array(others, pa.large_string()), index.known)
    owner, h, times = toxicity._counted(found.h, found.owner)
    for i in range(len(others)):
        at, weight = index.vector(h[owner == i], times[owner == i])
        query = np.zeros(every.shape[1])
        query[at] = weight
        scores = every @ query
        entries, cosines = index.nearest(at, weight, 5)
        want = np.lexsort((np.arange(len(scores)), -np.round(scores, 9)))[:5]
        assert entries.tolist() == want.tolist() and np.allclose(cosines, scores[want])


def test_terms_are_telling_and_votes_calibrated(index):
    assert {"vile", "rott", "rotten"} <= set(index.spelled) and not any(s.startswith("word") for s in index.spelled)
    assert np.all(np.diff(index.steps[1]) >= 0) and np.all(np.diff(index.steps[0]) >= 0)
    at, chance = toxicity.isotonic(np.array([0.1, 0.1, 0.2, 0.9, 0.9]), np.array([0, 1, 0, 1, 1.0]))
    assert np.interp(0.15, at, chance) < 0.5 < np.interp(0.9, at, chance)


DOCS = [(1, "a vile and rotten thing", "x"), (2, "a plain thing", "x"), (3, None, "x"), (4, "", None), (2, "a plain thing", "x"), (None, "rottenly", "x")]


def test_vote_without_itself_is_that_of_an_index_without_it(index):
    every = dense(index)
    for entry in (0, len(index.ids) // 2, len(index.ids) - 1):
        at = np.append(np.flatnonzero(every[entry, :-1]), every.shape[1] - 1)
        for label in {index.toxic[entry] / index.count[entry], 0.0, 1.0} & {0.0, 1.0}:
            if (label and not index.toxic[entry]) or (not label and index.toxic[entry] == index.count[entry]):
                continue
            rest = np.flatnonzero((np.arange(len(every)) != entry) | (index.count[entry] > 1))
            scores = every @ every[entry]
            near = rest[np.lexsort((rest, -np.round(scores[rest], 9)))][: toxicity.K]
            share = [(index.toxic[e] - label * (e == entry)) / (index.count[e] - (e == entry)) for e in near]
            w = scores[near] ** toxicity.SHARPNESS
            want = ((w * share).sum() + toxicity.FAR_VOTE * index.prior) / (w.sum() + toxicity.FAR_VOTE)
            assert abs(index.vote_without(at, every[entry][at], int(label)) - want) < 1e-9


def test_odd_rows(rows, index):
    docs = rows([*DOCS, (9, "plain vile " * 40_000, "x")], "doc_id bigint, text string, score string")
    out = toxicity.score(docs, index).collect()
    assert len(out) == 7
    by = {r.doc_id: r for r in out}
    assert by[1].score > 0.8 and by[9].score > 0.8 and by[None].score > 0.8
    assert by[2].score == by[3].score == by[4].score < 0.2
    assert by[1].neighbours[0].toxic == 1.0 and {"vile", "rotten"} <= set(by[1].found) and by[2].found == []
    assert toxicity.score(docs.limit(0), index).collect() == []


def test_training_over_odd_tables(rows):
    docs = rows([*DOCS] + [(10 + i, t, "s") for i, t in enumerate(made(60)[0])], "doc_id bigint, text string, toxic string")
    labels = rows([(10 + i, int(y)) for i, y in enumerate(made(60)[1])] + [(10, None), (None, 1), (999, 1)], "doc_id bigint, toxic int")
    index = toxicity.train(docs, labels, F.lit(True))
    assert sum(len(i) for i in index.ids) >= 1 and index.count.sum() == 60
    assert {round(r.score, 6) for r in toxicity.score(docs, toxicity.train(docs, labels.limit(0), F.lit(True))).collect()} == {0.5}


def test_sample_is_bounded_whatever_the_copies(rows, monkeypatch):
    monkeypatch.setattr(toxicity, "EXAMPLES", 20)
    docs = rows([(7, "vile")] * 3000, "doc_id bigint, text string")
    docs = docs.union(rows([(100 + i, f"text {i}") for i in range(200)], "doc_id bigint, text string"))
    labels = rows([(7, 1)] + [(100 + i, i % 2) for i in range(200)], "doc_id bigint, toxic int")
    index = toxicity.train(docs, labels, F.lit(True))
    assert index.count.sum() == 40


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    truth = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    got = Q.QUERIES["op11_toxicity"](spark, sf).collect()
    assert len(got) == 10_000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    own = [r for r in got if r.held_out and r.doc_id in truth]
    bad, good = ([r.score for r in own if truth[r.doc_id] == y] for y in (1, 0))
    auc = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert auc > 0.93
    assert sum(s >= 0.5 for s in bad) > 0.8 * len(bad) and sum(s >= 0.5 for s in good) < 0.03 * len(good)
