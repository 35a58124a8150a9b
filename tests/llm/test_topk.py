"""Top-k search over many blocks: exact, and vectors move only to queries that can reach them."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidewire.llm import topk


def vectors(n, falling, seed=1):
    draw = np.random.default_rng(seed)
    out = draw.normal(size=(n, 12))
    if falling:
        out *= (1 / (1 + np.arange(n) / 20))[:, None]
    return [(i, [float(x) for x in v]) for i, v in enumerate(out)]


@pytest.mark.parametrize("falling,group", [(True, 1), (False, 3)])
def test_blocks_equal_all_products(rows, monkeypatch, falling, group):
    for name, value in {"BLOCK": 100, "QUERY_BLOCK": 16, "SEEDS": 64, "GROUP": group, "CELLS": 1}.items():
        monkeypatch.setattr(topk, name, value)
    moved = {}
    dealt = topk.dealt_vectors

    def counted(blocks, cells):
        out = dealt(blocks, cells)
        moved.update(all=blocks.count() * len(cells), some=out.count())
        return out

    monkeypatch.setattr(topk, "dealt_vectors", counted)
    data = vectors(4000, falling)
    got: dict = {}
    for r in topk.search(rows(data, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == brute.top_k(data)
    limit = (0.6 if group == 1 else 0.999) if falling else 1
    assert moved["some"] <= limit * moved["all"]


def test_reachable_groups():
    lengths = np.array([9.0, 0.0, 5.0, 2.0])
    assert [topk.reachable(lengths, 1.0, x) for x in (100.0, 8.5, 4.0, -1.0)] == [0, 1, 3, 4]
