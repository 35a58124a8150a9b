"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, votes by distance.

Terms are words and the beginnings of words, so that inflected forms of a stem meet. The index holds a bounded sample of
labelled texts, one entry for each distinct vector with the labels of its texts. It knows only terms whose share among
toxic examples differs from that among the others by more than chance over all terms, and one term that every text has:
a text without any telling term is then nearest to the examples without one.

Entries lie in blocks of alike ones. For each term a block has its largest weight; a query's products with those bound all
its cosines in the block, so blocks are searched from the highest bound down until none can reach the k-th best cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import drop, hash_parts, least_rows, mapped, text_bytes, written

#: Most examples of each label in the index; rows are taken by the hash of their content.
EXAMPLES = 6_000
#: Nearest distinct vectors that vote; entries of a block; a vote's weight is similarity ** SHARPNESS.
K, BLOCK, SHARPNESS = 16, 512, 4
#: Weight of the prior beside the votes.
FAR_VOTE = 0.1
#: Beginnings of words in bytes; most terms; chance at which any term at all is told apart wrongly; texts that hold a term.
PREFIXES, MOST_TERMS, CHANCE, LEAST_TEXTS = (4, 5, 6, 7, 8), 4_096, 0.05, 4
#: Texts whose terms are counted together.
PART = 512


def _word_bytes() -> np.ndarray:
    table = np.zeros(256, bool)
    table[128:] = True
    for first, last in (b"az", b"AZ", b"09"):
        table[first : last + 1] = True
    return table


_INSIDE = _word_bytes()


@dataclass
class Terms:
    """Terms of some texts: hash, text number, and the bytes it was read from."""

    h: np.ndarray
    owner: np.ndarray
    start: np.ndarray
    length: np.ndarray
    raw: np.ndarray


def terms(texts: pa.Array, known: np.ndarray | None = None) -> Terms:
    """Words and their beginnings in all texts, lower-cased; only those in the sorted hashes ``known`` if given."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    raw, offsets = text_bytes(pc.utf8_lower(texts.cast(pa.large_string())))
    n = len(raw)
    inside = _INSIDE[raw]
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    fresh[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | fresh[1:]
    start, end = np.flatnonzero(fresh), np.flatnonzero(last) + 1
    owner = np.searchsorted(offsets, start, side="right") - 1
    if known is not None:
        few = np.zeros(1 << 16, bool)
        few[(known >> np.uint64(48)).astype(np.int64)] = True
    found = []
    for size in (0, *PREFIXES):
        which = np.flatnonzero(end - start > size) if size else np.arange(len(start))
        length = np.full(len(which), size) if size else end - start
        at = start[which]
        h = hash_parts(raw, at, length)
        if known is not None:
            hit = np.flatnonzero(few[(h >> np.uint64(48)).astype(np.int64)])
            place = np.minimum(np.searchsorted(known, h[hit]), max(0, len(known) - 1))
            hit = hit[known[place] == h[hit]] if len(known) else hit[:0]
            h, which, at, length = h[hit], which[hit], at[hit], length[hit]
        found.append((h, owner[which], at, length))
    return Terms(*(np.concatenate([f[i] for f in found]) for i in range(4)), raw)


def _counted(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, term, times), sorted."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])) if len(h) else np.zeros(0, np.int64)
    return owner[first], h[first], np.diff(np.append(first, len(h)))


def telling(held: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """Terms whose share differs between labels, of (h, n, toxic): the texts that hold a term, and the toxic ones of them.

    A likelihood ratio over a bound that holds for all terms together (Bonferroni's, on the tail of one normal deviate
    squared); the highest MOST_TERMS of them.
    """
    rate = F.col("n") / (n_toxic + n_clean)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    a, b = F.col("toxic"), F.col("n") - F.col("toxic")
    ratio = 2 * (part(a, n_toxic * rate) + part(b, n_clean * rate) + part(n_toxic - a, n_toxic * (1 - rate)) + part(n_clean - b, n_clean * (1 - rate)))
    # exp(-x / 2) bounds the tail of a squared normal deviate.
    sure = (ratio > 2 * math.log(max(1, held.count()) / CHANCE)) & (F.col("n") >= LEAST_TEXTS)
    return held.withColumn("ratio", ratio).where(sure).orderBy(F.col("ratio").desc(), "h").limit(MOST_TERMS)


@dataclass
class Index:
    """Distinct example vectors in blocks, postings by term and block, and what a vote means."""

    known: np.ndarray
    spelled: list[str]
    idf: np.ndarray
    ids: list[list[int]] = field(default_factory=list)
    toxic: np.ndarray | None = None
    count: np.ndarray | None = None
    posting_start: np.ndarray | None = None
    posting_entry: np.ndarray | None = None
    posting_weight: np.ndarray | None = None
    block_most: np.ndarray | None = None
    steps: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.zeros(1))
    prior: float = 0.5

    def vector(self, h: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights) of one text, of length 1; the last term is the one that every text has."""
        at = np.append(np.searchsorted(self.known, h), len(self.known))
        weight = np.append((1 + np.log(times)) * self.idf[at[:-1]], 1.0)
        return at, weight / np.sqrt((weight**2).sum())

    def build(self, vectors: list[tuple[np.ndarray, np.ndarray]], ids: list[int], toxic: np.ndarray) -> None:
        groups: dict[tuple, list[int]] = {}
        for i, (t, w) in enumerate(vectors):
            groups.setdefault((t.tobytes(), np.round(w, 12).tobytes()), []).append(i)
        # Alike entries lie together: by their heaviest terms.
        members = sorted(groups.values(), key=lambda g: ([int(x) for x in vectors[g[0]][0][np.argsort(-vectors[g[0]][1], kind="stable")][:3]], ids[g[0]]))
        self.ids = [sorted(ids[i] for i in g)[:K] for g in members]
        self.toxic = np.array([toxic[g].sum() for g in members], float)
        self.count = np.array([len(g) for g in members], float)
        n_terms, n_blocks = len(self.known) + 1, max(1, -(-len(members) // BLOCK))
        entry = np.concatenate([np.full(len(vectors[g[0]][0]), e) for e, g in enumerate(members)]) if members else np.zeros(0, np.int64)
        term = np.concatenate([vectors[g[0]][0] for g in members]) if members else np.zeros(0, np.int64)
        weight = np.concatenate([vectors[g[0]][1] for g in members]) if members else np.zeros(0)
        order = np.lexsort((entry, term))
        entry, term, weight = entry[order], term[order], weight[order]
        cell = term * n_blocks + entry // BLOCK
        self.posting_start = np.searchsorted(cell, np.arange(n_terms * n_blocks + 1))
        self.posting_entry, self.posting_weight = entry, weight
        self.block_most = np.zeros((n_terms, n_blocks))
        np.maximum.at(self.block_most, (term, entry // BLOCK), weight)

    def _in_block(self, at: np.ndarray, weight: np.ndarray, block: int) -> np.ndarray:
        """Cosines of all entries of a block, from the postings of all terms at once."""
        cell = at * self.block_most.shape[1] + block
        start, size = self.posting_start[cell], self.posting_start[cell + 1] - self.posting_start[cell]
        ends = np.cumsum(size)
        place = np.repeat(start - ends + size, size) + np.arange(ends[-1])
        low = block * BLOCK
        return np.bincount(self.posting_entry[place] - low, np.repeat(weight, size) * self.posting_weight[place], min(BLOCK, len(self.ids) - low))

    def nearest(self, at: np.ndarray, weight: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(entries, cosines) of the k nearest, ties to the smaller entry; ``without`` takes no part. Exact."""
        bound = weight @ self.block_most[at]
        entries, best, least = np.zeros(0, np.int64), np.zeros(0), 0.0
        for block in np.argsort(-bound, kind="stable") if self.ids else ():
            if len(best) >= k and bound[block] < least:
                break
            score = self._in_block(at, weight, int(block))
            low = block * BLOCK
            if low <= without < low + len(score):
                score[without - low] = -1.0
            near = np.flatnonzero(score >= least)
            entries, best = np.append(entries, near + low), np.append(best, score[near])
            order = np.lexsort((entries, -np.round(best, 9)))[:k]
            entries, best = entries[order], best[order]
            least = best[-1] - 1e-9 if len(best) >= k else 0.0
        sound = best > 0
        return entries[sound], best[sound]

    def vote(self, entries: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic among the neighbours by similarity, drawn to the prior by one far vote."""
        w = cosines**SHARPNESS
        share = self.toxic[entries] / self.count[entries]
        return float(((w * share).sum() + FAR_VOTE * self.prior) / (w.sum() + FAR_VOTE))

    def vote_without(self, at: np.ndarray, weight: np.ndarray, label: int) -> float:
        """The vote on one of the examples as if it were not there."""
        own = int(self.nearest(at, weight, 1)[0][0])
        alone = self.count[own] == 1
        entries, cosines = self.nearest(at, weight, K, own if alone else -1)
        w = cosines**SHARPNESS
        less = (entries == own) & ~alone
        share = (self.toxic[entries] - label * less) / (self.count[entries] - less)
        return float(((w * share).sum() + FAR_VOTE * self.prior) / (w.sum() + FAR_VOTE))

    def calibrated(self, votes: np.ndarray) -> np.ndarray:
        return np.interp(votes, *self.steps)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of a rising curve of the chance of label 1 by vote: neighbouring violators pooled, each pool smoothed by a label of each kind."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for vote, label in zip(x[order].tolist(), y[order].tolist(), strict=True):
        pools.append([vote, 1.0, label, vote])
        # Equal votes are one pool; a pool that is not above the one before joins it.
        while len(pools) > 1 and (pools[-1][0] <= pools[-2][3] or pools[-1][2] * pools[-2][1] <= pools[-2][2] * pools[-1][1]):
            _, n, ones, most = pools.pop()
            pools[-1][1] += n
            pools[-1][2] += ones
            pools[-1][3] = most
    at, chance = [0.0], [0.0]
    for low, n, ones, high in pools:
        p = (ones + 0.5) / (n + 1)
        at += [low, high]
        chance += [p, p]
    at.append(1.0)
    chance.append(1.0)
    # A little slope keeps votes of one pool in order.
    return np.array(at), np.maximum.accumulate(0.999 * np.array(chance) + 0.001 * np.array(at))


def _held(examples: DataFrame) -> DataFrame:
    """(h, n, toxic): how many of the examples (_y, _t) hold each term, and how many toxic ones; tasks add up their own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, PART):
                part = batch.slice(i, PART)
                found = terms(part.column(1))
                owner, h, _ = _counted(found.h, found.owner)
                where, names = pd.factorize(h)
                toxic = part.column(0).to_numpy().astype(np.float64)[owner]
                sums = [np.bincount(where, weights=w, minlength=len(names)).astype(np.int64) for w in (None, toxic)]
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), *map(pa.array, sums)], names=["h", "n", "toxic"])

    counts = mapped(examples.select("_y", "_t"), run, "h long, n long, toxic long")
    return counts.groupBy("h").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def _vectors(examples: DataFrame, known: np.ndarray) -> DataFrame:
    """(_k, _place, _y, h, times, spelled) of the examples (_k, _place, _y, _t): their known terms, and how they are written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, PART):
                part = batch.slice(i, PART)
                found = terms(part.column(3), known)
                owner, h, times = _counted(found.h, found.owner)
                names, first = np.unique(found.h, return_index=True)
                written_as = [found.raw[found.start[j] : found.start[j] + found.length[j]].tobytes().decode("utf-8", "ignore") for j in first]
                spelled = pa.array(written_as, pa.string()).take(pa.array(np.searchsorted(names, h)))
                starts = pa.array(np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(starts, x) for x in (pa.array(h.view(np.int64)), pa.array(times.astype(np.int64)), spelled)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in range(3)), *lists], names=["_k", "_place", "_y", "h", "times", "spelled"])

    schema = "_k long, _place long, _y int, h array<long>, times array<long>, spelled array<string>"
    return mapped(examples.select("_k", "_place", "_y", "_t"), run, schema)


def build_index(examples: DataFrame) -> Index:
    """The index of the examples (_k, _place, _y, _t). Without both labels every score is the share of toxic ones, smoothed by one of each.

    The driver gets the telling terms, the examples' counts of those, and a vote of each; texts stay in the tasks.
    """
    seen = examples.agg(F.count_if(F.col("_y") == 1).alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    prior, both = (seen["toxic"] + 1) / (seen["n"] + 2), 0 < seen["toxic"] < seen["n"]
    held = written(_held(examples), "term-counts")
    chosen = telling(held, seen["toxic"], seen["n"] - seen["toxic"]).collect() if both else []
    drop(held)
    chosen.sort(key=lambda r: r["h"] % (1 << 64))
    known = np.array([r["h"] for r in chosen], np.int64).view(np.uint64)
    counts = np.array([r["n"] for r in chosen], np.float64)
    index = Index(known, [""] * len(known), np.log((seen["n"] + 1) / (counts + 1)) + 1, prior=prior)
    table = written(_vectors(examples, known), "vectors")
    rows = table.orderBy("_place").collect()
    for r in rows:
        for h, name in zip(r["h"], r["spelled"], strict=True):
            at = int(np.searchsorted(known, np.uint64(h % (1 << 64))))
            index.spelled[at] = min(index.spelled[at] or name, name)
    vectors = [index.vector(np.array(r["h"], np.int64).view(np.uint64), np.array(r["times"], np.float64)) for r in rows]
    index.build(vectors, [r["_k"] for r in rows], np.array([r["_y"] for r in rows], np.float64))
    if both:
        votes = _own_votes(table, index).collect()
        index.steps = isotonic(np.array([r["vote"] for r in votes]), np.array([r["_y"] for r in votes], np.float64))
    else:
        index.steps = (np.array([0.0, 1.0]), np.array([prior, prior]))
    drop(table)
    return index


def _own_votes(table: DataFrame, index: Index) -> DataFrame:
    """(_y, vote): each example's vote without itself: with the rest of its own entry, or none of it if it is alone there."""
    shared = table.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        same: dict[tuple, float] = {}
        for batch in batches:
            votes = []
            for y, h, times in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                key = (y, tuple(h), tuple(times))
                if key not in same:
                    same[key] = own.vote_without(*own.vector(np.array(h, np.int64).view(np.uint64), np.array(times, np.float64)), y)
                votes.append(same[key])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(votes, pa.float64())], names=["_y", "vote"])

    return mapped(table.select("_y", "h", "times"), run, "_y int, vote double")


def train(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Index:
    """The index of the labelled rows where ``learn`` holds: at most EXAMPLES distinct rows (key and text) of each label.

    Rows are chosen by the hash of their content, so copies of a row count once. Of several labels of one key the greatest
    counts. Null, empty and very long texts are texts like others; rows without a key have no label; without both labels
    every score is the prior's. Ties between examples go to the least hash. Other columns are not read.
    """
    marks = labels.select(F.col(key).cast("long").alias("_k"), F.col(label).cast("int").alias("_y")).where("_k IS NOT NULL AND _y IS NOT NULL")
    marks = marks.groupBy("_k").agg(F.max("_y").alias("_y"))
    rows = docs.where(learn).select(F.col(key).cast("long").alias("_k"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    rows = rows.withColumn("_place", F.xxhash64("_k", "_t"))
    # Chosen by place before any text moves.
    places = written(rows.select("_k", "_place").join(marks, "_k"), "labelled")
    chosen = [least_rows(places.where(F.col("_y") == y), EXAMPLES) for y in (1, 0)]
    few = written(chosen[0].union(chosen[1]).select("_k", "_place", "_y"), "chosen", last=[places])
    examples = written(rows.join(F.broadcast(few), ["_k", "_place"]).dropDuplicates(["_place"]), "examples", last=[few])
    index = build_index(examples)
    drop(examples)
    return index


def score(docs: DataFrame, index: Index, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """(key, score, neighbours, found): each whole text's chance of being toxic and why; one row out for each row in.

    ``neighbours`` are the nearest examples, (ids, toxic share, cosine), nearest first; ``found`` the text's telling terms.
    A null, empty or very long text is a text like others: without telling terms its neighbours are the examples without
    any. Repeated rows and copies get one score; ties between examples go to the first in the index. A null key stays null;
    an empty table gives no rows; other columns are not carried.
    """
    schema = f"{key} long, score double, neighbours array<struct<ids: array<long>, toxic: double, cosine: double>>, found array<string>"
    shape = pa.list_(pa.struct([("ids", pa.list_(pa.int64())), ("toxic", pa.float64()), ("cosine", pa.float64())]))
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        same: dict[bytes, tuple[float, list]] = {}

        def judged(at: np.ndarray, weight: np.ndarray) -> tuple[float, list]:
            entries, cosines = own.nearest(at, weight, k)
            why = [
                {"ids": own.ids[e], "toxic": own.toxic[e] / own.count[e], "cosine": float(c)} for e, c in zip(entries.tolist(), cosines, strict=True)
            ]
            return float(own.calibrated(np.array([own.vote(entries, cosines)]))[0]), why

        for batch in batches:
            for i in range(0, batch.num_rows, PART):
                part = batch.slice(i, PART)
                found = terms(part.column(1), own.known)
                owner, h, times = _counted(found.h, found.owner)
                edges = np.searchsorted(owner, np.arange(part.num_rows + 1))
                out, spelled = [], []
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    at, weight = own.vector(h[a:b], times[a:b])
                    name = at.tobytes() + times[a:b].tobytes()
                    if name not in same:
                        if len(same) > 50_000:
                            same.clear()
                        same[name] = judged(at, weight)
                    out.append(same[name])
                    spelled.append([own.spelled[j] for j in at[:-1][np.argsort(-weight[:-1], kind="stable")]])
                columns = [part.column(0), pa.array([s for s, _ in out], pa.float64()), pa.array([w for _, w in out], shape), pa.array(spelled, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "score", "neighbours", "found"])

    rows = docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    return mapped(rows, run, schema)
