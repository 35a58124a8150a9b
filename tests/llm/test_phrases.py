"""Collocations against a count of all phrases."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tidewire.llm import phrases

NAMES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def corpus(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    passages = [" ".join(draw.choices(words, k=draw.randint(2, 7))) for _ in range(12)]
    out = []
    for i in range(150):
        parts = []
        for _ in range(draw.randint(0, 12)):
            parts.append(draw.choice(passages) if draw.random() < 0.3 else " ".join(words[min(59, int(draw.expovariate(0.1)))] for _ in range(draw.randint(1, 9))))
            parts.append(draw.choice([" ", ". ", "\n", ",", "  ", "\t", "!"]))
        out.append((draw.choice(["en", "de", None]), "".join(parts) or None, i))
    return [*out, ("fr", "", 1), ("fr", " \t\n", 2), ("und", "W1 \u00c9t\u00e9 w1", 3), ("es", None, 4)]


@pytest.mark.parametrize("share,top", [(0.02, 6), (0.02, 400), (1.0, 1)])
def test_rounds_equal_a_full_count(rows, monkeypatch, share, top):
    monkeypatch.setattr(phrases, "ROUND_WORDS", 0)
    docs = corpus(int(100 * share) + top)
    frame = rows(docs, "lang string, text string, rank int")
    got = phrases.mine(frame, least=6, top=top, share=share)
    assert got.columns == list(NAMES)
    want = brute.phrases([(x, t) for x, t, _ in docs], 6, top)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 2


def test_same_over_many_partitions(rows):
    docs = corpus(5)
    got = phrases.mine(rows(docs, "lang string, text string, rank int").repartition(7), least=6, top=50)
    assert sorted(tuple(r) for r in got.collect()) == brute.phrases([(x, t) for x, t, _ in docs], 6, 50)


def test_words_and_sums_in_parts():
    texts = pa.array(["One two  three.", "", None, "Two\tthree one", "x" * 50])
    assert [n for _, n in phrases._parts(texts)] == [5]
    whole = phrases.Words(*phrases.text_bytes(texts), np.zeros(5, np.uint64))
    assert whole.spelled(np.array([0, 3]), 3).to_pylist() == ["one two three", "two three one"]
    assert whole.joined.tolist() == [True, True, False, True, True, False, False]
    h = whole.phrases(2)[0]
    assert h[1] == h[3] and h[0] != h[1]
    sums = phrases._Sums()
    for _ in range(3):
        sums.add(h[[1, 0]], np.array([2, 1]), pa.array(["en", "en"]), whole.spelled(np.array([1, 0]), 2))
    out = pa.Table.from_batches(list(sums.out())).to_pylist()
    assert sorted((r["phrase"], r["n"]) for r in out) == [("one two", 3), ("two three", 6)]


def test_large_products_are_exact(rows):
    wide = 3_000_000_000_000_000
    frame = rows([(wide, 4 * wide, wide + 1, wide + 2)], "a bigint, n bigint, l bigint, r bigint")
    from pyspark.sql import functions as F

    got = frame.select(phrases._score(F.col("a"), F.col("n"), F.col("l"), F.col("r"))).first()[0]
    assert got == 1000 * wide * 4 * wide // ((wide + 1) * (wide + 2))


def test_no_rows(rows):
    assert phrases.mine(rows([], "lang string, text string")).collect() == []
    assert phrases.mine(rows([("en", None), (None, "")], "lang string, text string")).collect() == []
