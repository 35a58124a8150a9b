"""Near duplicates where buckets and shingles are shared by many, against a count of all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import brute
from tidewire.llm import common, neardup, shingles


def corpus(seed, n=260):
    """Groups of near copies, chains of them, passages that many texts share, short texts and copies."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = draw.choices(words, k=40)
    out = []
    for g in range(n // 13):
        base = draw.choices(words, k=draw.choice([6, 9, 30, 60]))
        if g % 2:
            base = passage + base
        text = list(base)
        for k in range(13):
            if k % 3 == 0:
                text = list(base)
            for _ in range(draw.randint(0, 3)):
                text[draw.randrange(len(text))] = draw.choice(words)
            out.append(" ".join(text[: len(text) - draw.randint(0, 2)]))
    draw.shuffle(out)
    return [(i, t) for i, t in enumerate(out)] + [(n + 1, "one two"), (n + 2, "one two"), (n + 3, None), (n + 4, " ")]


@pytest.mark.parametrize("small,chunk", [(48, 256), (1, 8)])
def test_groups_equal_all_pairs(rows, monkeypatch, small, chunk):
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    monkeypatch.setattr(common, "SALT_ROWS", 20)
    docs = corpus(small)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_groups(rows(docs, "doc_id bigint, text string")).collect()}
    assert got == brute.near(docs)


def test_linked_sets_share_a_prefix(rows):
    """Whatever the order of shingles: pairs at the least similarity, and rows of classes without a partner."""
    draw = random.Random(8)
    texts = []
    for i in range(60):
        base = [f"a{i}x{j}" for j in range(draw.randint(5, 40))]
        texts += [" ".join(base), " ".join([*base, *(f"b{i}x{j}" for j in range(len(base) // 4))])]
    frame = rows([(i, t) for i, t in enumerate(texts)], "id bigint, t string")
    members = rows([(i, max(1, len(t.split()) - 4), i) for i, t in enumerate(texts)], "id bigint, n bigint, label bigint")
    held: dict = {}
    for r in neardup._prefixes(members, frame).collect():
        held.setdefault(r.key, set()).add(r.id)
    met = {(a, b) for ids in held.values() for a in ids for b in ids if a < b}
    sets = [brute.shingles(t) for t in texts]
    linked = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert linked and linked <= met


def test_estimates_of_many_pairs_equal_single_ones():
    draw = np.random.default_rng(2)
    value = [np.unique(draw.integers(0, 1 << 62, n).astype(np.uint64)) for n in (1, 8, 64, 1024, 4096)]
    value += [np.unique(np.concatenate([value[3][:800], draw.integers(0, 1 << 62, 200).astype(np.uint64)])), np.zeros(0, np.uint64)]
    sizes = np.array([len(v) for v in value])
    made = shingles.registers(np.concatenate(value), np.concatenate([[0], np.cumsum(sizes)]))
    pairs = [(a, b) for a in range(len(value)) for b in range(len(value))]
    left, right = (np.array(x) for x in zip(*pairs, strict=True))
    many = shingles.jaccard_of(made[left], made[right], sizes[left], sizes[right])
    one = [shingles.jaccard(made[a], made[b], sizes[a], sizes[b]) for a, b in pairs]
    assert np.allclose(many, one, atol=0.02)


def sketch(values):
    return shingles.sketches(values, np.array([0, len(values)]))[0]


def test_sketches_drop_no_link():
    """Cells that differ are no more than shingles that differ, whatever the sizes; sets that are far apart are told."""
    draw, told = np.random.default_rng(5), 0
    for n in (1, 2, 3, 7, 63, 64, 65, 300, 1024, 3000):
        whole = np.unique(draw.integers(0, 1 << 63, 3 * n + 8).astype(np.uint64))
        for shared in (0, n // 2, 3 * n // 4, n - n // 8, n):
            for more in (0, n - shared, (n + 3) // 4, 2 * n):
                a, b = whole[:n], np.concatenate([whole[:shared], whole[n : n + more]])
                if not len(b):
                    continue
                apart, inter = shingles.unlike(sketch(a), sketch(b)), len(np.intersect1d(a, b))
                assert apart == shingles.unlike(sketch(b), sketch(a)) <= len(a) + len(b) - 2 * inter
                assert shingles.may_link(apart, len(a), len(b)) or not shingles.linked(inter, len(a), len(b))
                told += not shingles.may_link(apart, len(a), len(b))
    assert told > 50
    assert len(shingles.sketches(np.zeros(0, np.uint64), np.zeros(1, np.int64))) == 0


def test_rows_that_may_meet_are_those_of_linkable_pairs():
    draw = np.random.default_rng(6)
    whole = np.unique(draw.integers(0, 1 << 63, 4000).astype(np.uint64))
    sets = [np.sort(whole[s : s + n]) for s, n in zip(draw.integers(0, 60, 40) * 40, draw.integers(40, 160, 40), strict=True)]
    made, n, labels = [sketch(s) for s in sets], np.array([len(s) for s in sets]), draw.integers(0, 30, 40)
    left, right = draw.random(40) < 0.5, draw.random(40) < 0.7
    got = neardup.may_meet(made, n, labels, left, right)
    linked = set()
    for i in np.flatnonzero(left):
        for j in np.flatnonzero(right):
            if labels[i] != labels[j] and shingles.linked(len(np.intersect1d(sets[i], sets[j])), n[i], n[j]):
                linked |= {i, j}
    assert linked and linked <= set(np.flatnonzero(got).tolist()) and not got.all()


@pytest.mark.parametrize("small", [48, 4])
def test_texts_of_chance_buckets_do_not_move(rows, monkeypatch, small):
    """Short texts that share a passage meet in buckets; only the two that are linked are looked at in full."""
    moved, own, lists = [], neardup.confirmed, neardup._large_links
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "confirmed", lambda pairs, texts: moved.append(pairs.count()) or own(pairs, texts))
    monkeypatch.setattr(neardup, "_large_links", lambda dealt, texts: moved.append(dealt.count()) or lists(dealt, texts))
    passage = [f"p{j}" for j in range(8)]
    texts = [[*passage, *(f"w{i}x{j}" for j in range(20))] for i in range(40)]
    texts.append([*texts[3], "more"])
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_groups(rows(docs, "doc_id bigint, text string")).collect()}
    assert got == brute.near(docs) and got[40][1] == 3
    assert 1 <= sum(moved) <= 4


def test_among_keeps_what_is_wanted_and_few_others(rows):
    whole = rows([(i,) for i in range(20_000)], "id bigint")
    wanted = rows([(i,) for i in (*range(0, 20_000, 50), 99_999)], "b bigint")
    kept = common.among(whole, "id", wanted)
    assert "Python" not in kept._jdf.queryExecution().executedPlan().toString()  # workers of its own would add to each task's
    left = {r.id for r in kept.collect()}
    assert set(range(0, 20_000, 50)) <= left and len(left) < 2_000
    assert common.among(whole, "id", wanted.where("b < 0")).count() == 0


@pytest.mark.parametrize("small", [48, 4])
def test_rows_without_a_partner_stay_where_they_are(rows, monkeypatch, small):
    """Of 2,000 texts 60 meet others: no others' texts, registers, sketches or bands come to a join."""
    came, own = [], common.among
    monkeypatch.setattr(neardup, "among", lambda *a: came.append((a[0].count(), own(*a).count())) or own(*a))
    monkeypatch.setattr(neardup, "SMALL", small)
    passage = [f"p{j}" for j in range(30)]
    texts = [[*passage, *(f"w{i}x{j}" for j in range(6))] for i in range(60)]
    texts += [[f"y{i}x{j}" for j in range(12)] for i in range(1_940)]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_groups(rows(docs, "doc_id bigint, text string")).collect()}
    assert got == brute.near(docs)
    assert len(came) >= 5 and all(after <= 0.2 * before for before, after in came)


def test_counters_move_as_small_rows(rows, monkeypatch):
    """No task sends all counters as one value, so none holds those of many tasks at once."""
    sent, own = [], neardup.mapped
    monkeypatch.setattr(neardup, "PART", 7)
    monkeypatch.setattr(neardup, "mapped", lambda df, run, schema: sent.append(own(df, run, schema)) or sent[-1])
    docs = rows([(i, f"a b c d e{i % 3} f g h i j") for i in range(40)], "id bigint, t string")
    members = rows([(i, 6, i) for i in range(40)], "id bigint, n bigint, label bigint")
    keys = neardup._prefixes(members, docs)
    assert keys.where("key IS NOT NULL").count() > 0
    for made in sent:
        assert "binary" not in dict(made.dtypes).values()
