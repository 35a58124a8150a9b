"""Quality classifier by positive-unlabelled learning: the non-negative unbiased risk, with an estimated class prior.

Kiryo et al., "Positive-Unlabeled Learning with Non-Negative Risk Estimator" (2017). Trusted positives and unlabelled text
are bounded samples, taken by hash over all rows; a small network is fitted to them, and every whole text is scored in
parallel. Features are shares and shapes counted on the bytes of a text, many texts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import least_rows, mapped, text_bytes, word_hashes, written

#: Most positives and most unlabelled texts of the fit; rows are taken by the hash of their key.
POSITIVES, UNLABELLED = 8_000, 16_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 24, 60, 1024, 0.01, 1e-4, 7
_SYMBOLS = b"#*$%&|<>@^~=+_\\/{}[]"
_MARKS = b".,;:!?'\"()-"


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of numbers from 0 to about 1 for each text; a text without words has mostly zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(size, 1)

    table = np.zeros(256, np.uint8)
    classes = [range(65, 91), range(97, 123), range(48, 58), b" \t\r\x0b\x0c", b"\n", _MARKS, _SYMBOLS, range(128, 256)]
    for c, members in enumerate(classes, 1):
        table[np.array(list(members), np.int64)] = c
    kind = table[raw]
    columns = [share(kind == c) for c in range(len(classes) + 1)]
    columns += [share(raw == b) for b in b"#*$%&|!.,@/"]
    same = np.zeros(len(raw), bool)
    same[1:] = (raw[1:] == raw[:-1]) & (raw[1:] > 32)
    columns.append(share(same))
    hashes, owner, length = word_hashes(raw, offsets)
    words = np.bincount(owner, minlength=n).astype(np.float64)
    some = np.maximum(words, 1)
    mean = np.bincount(owner, weights=length, minlength=n) / some
    spread = np.sqrt(np.maximum(0, np.bincount(owner, weights=length.astype(np.float64) ** 2, minlength=n) / some - mean**2))
    order = np.lexsort((hashes, owner))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    distinct = np.bincount(owner[order][fresh], minlength=n)
    # The expected share of distinct words falls with length, so it is seen beside the length.
    columns += [np.log1p(words) / 10, np.minimum(mean, 30) / 15, np.minimum(spread, 30) / 15, distinct / some]
    twice = np.zeros(len(hashes))
    twice[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    columns.append(np.bincount(owner, weights=twice, minlength=n) / some)
    for k in (2, 4):
        pair = np.zeros(len(hashes), np.uint64)
        last = len(hashes) - k + 1
        if last > 0:
            for j in range(k):
                pair[:last] = pair[:last] * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + last]
            sound = np.zeros(len(hashes), bool)
            sound[:last] = owner[:last] == owner[k - 1 :]
            value, mine = pair[sound], owner[sound]
            order = np.lexsort((value, mine))
            again = np.zeros(len(order))
            again[1:] = (value[order][1:] == value[order][:-1]) & (mine[order][1:] == mine[order][:-1])
            columns.append(np.bincount(mine[order], weights=again, minlength=n) / some)
        else:
            columns.append(np.zeros(n))
    lines = share(kind == 5) * size + 1
    columns += [np.log1p(lines) / 10, np.log1p(size / lines) / 10]
    out = np.stack(columns, axis=1)
    # Small shares tell most: the square root spreads them.
    return np.concatenate([out, np.sqrt(np.abs(out))], axis=1).astype(np.float32)


@dataclass
class Model:
    """A network with one hidden layer; ``prior`` is the class prior that it was fitted with."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Chance of the positive class, 0 to 1."""
        z = ((x - self.mean) / self.scale).clip(-8, 8)
        w, b, v, c = self.weights
        margin = (np.tanh(z @ w + b) @ v + c).astype(np.float64)
        return 1 / (1 + np.exp(-margin.clip(-40, 40)))


def nn_risk(margin_p: np.ndarray, margin_u: np.ndarray, prior: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Non-negative risk under the logistic loss, and its step for each margin.

    Risk: prior * loss(P as +) + max(0, loss(U as -) - prior * loss(P as -)). Where the difference is negative the step
    goes up along it instead, as the paper has it, so that the network does not overfit the positives.
    """
    soft = lambda m: np.logaddexp(0, m)
    up = lambda m: 1 / (1 + np.exp(-m.clip(-40, 40)))
    n_p, n_u = max(1, len(margin_p)), max(1, len(margin_u))
    positive = prior * soft(-margin_p).sum() / n_p
    negative = soft(margin_u).sum() / n_u - prior * soft(margin_p).sum() / n_p
    if negative >= 0:
        step_p = prior * (up(margin_p) - 1) / n_p - prior * up(margin_p) / n_p
        return positive + negative, step_p, up(margin_u) / n_u
    return positive, prior * up(margin_p) / n_p, -up(margin_u) / n_u


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Fits the network by Adam on mixed batches; without positives or unlabelled rows all scores are the prior's."""
    width = positive.shape[1] if len(positive) else unlabelled.shape[1]
    every = np.concatenate([positive, unlabelled]) if len(positive) + len(unlabelled) else np.zeros((1, width), np.float32)
    mean, scale = every.mean(0), every.std(0) + 1e-3
    random = np.random.default_rng(seed)
    weights = [random.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), np.array(np.log(prior / (1 - prior)))]
    model = Model(mean, scale, weights, prior)
    if not len(positive) or not len(unlabelled):
        weights[2] = np.zeros(HIDDEN)
        return model
    p, u = (((x - mean) / scale).clip(-8, 8).astype(np.float64) for x in (positive, unlabelled))
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    rounds = max(1, -(-(len(p) + len(u)) // BATCH))
    for epoch in range(epochs):
        p_order, u_order = np.array_split(random.permutation(len(p)), rounds), np.array_split(random.permutation(len(u)), rounds)
        for mine, others in zip(p_order, u_order, strict=True):
            if not len(mine) or not len(others):
                continue
            x = np.concatenate([p[mine], u[others]])
            w, b, v, c = weights
            hidden = np.tanh(x @ w + b)
            margin = hidden @ v + c
            _, step_p, step_u = nn_risk(margin[: len(mine)], margin[len(mine) :], prior)
            g = np.concatenate([step_p, step_u])
            back = np.outer(g, v) * (1 - hidden**2)
            grads = [x.T @ back + DECAY * w, back.sum(0), hidden.T @ g + DECAY * v, g.sum()]
            step += 1
            rate = RATE * (1 - epoch / epochs)
            for i, grad in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad**2
                weights[i] = weights[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return model


def _sample_features(rows: DataFrame, most: int) -> np.ndarray:
    """Features of the ``most`` rows (_place, _t) with the least places; only their texts move, and only their features leave."""
    width = features(np.zeros(0, np.uint8), np.zeros(1, np.int64)).shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                made = features(*text_bytes(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in made], pa.binary())], names=["h", "f"])

    got = mapped(least_rows(rows, most).select("_place", "_t"), run, "h long, f binary").collect()
    got.sort(key=lambda r: (r["h"], r["f"]))
    return np.stack([np.frombuffer(r["f"], np.float32) for r in got]) if got else np.zeros((0, width), np.float32)


def train(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fits on rows where ``learn`` holds: trusted positives are those labelled 1, unlabelled text is any of them.

    The class prior is estimated as the share of label 1 among the labels of those rows, smoothed by one of each. Both
    samples are of distinct rows (key and text), chosen by their hash: at most POSITIVES and UNLABELLED of them, whatever
    the number of copies. Rows without a key can be unlabelled text; null, empty and very long texts are texts like
    others. Of several labels of one key the least counts. Without rows or labels all scores are the prior's. Other
    columns are not read.
    """
    marks = labels.select(F.col(key).cast("long").alias("_k"), F.col(label).cast("int").alias("_y")).where("_k IS NOT NULL AND _y IS NOT NULL")
    marks = marks.groupBy("_k").agg(F.min("_y").alias("_y"))
    rows = docs.where(learn).select(F.col(key).cast("long").alias("_k"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    rows = rows.withColumn("_place", F.xxhash64("_k", "_t"))
    places = rows.where("_k IS NOT NULL").groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    known = written(places.join(marks, "_k"), "labelled")
    seen = known.agg(F.count_if(F.col("_y") == 1).alias("p"), F.count(F.lit(1)).alias("n")).first()
    prior = (seen["p"] + 1) / (seen["n"] + 2)
    # Trusted rows are found by their keys; few more than the sample needs are looked at, as keys are chosen by hash too.
    trusted = least_rows(known.where("_y = 1").select("_k", F.xxhash64("_k").alias("_place")), POSITIVES).select("_k")
    positive = rows.join(F.broadcast(trusted), "_k", "left_semi")
    return fit(_sample_features(positive, POSITIVES), _sample_features(rows, UNLABELLED), prior)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of each whole text, one row out for each row in; a null text is scored as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                made = model.scores(features(*text_bytes(part.column(1))))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.float64())], names=[key, "score"])

    rows = docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    return mapped(rows, run, f"{key} long, score double")


def scored_rows(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``_score``, one row out for each row in; a column of that name is replaced.

    A null text is scored as an empty one, whole texts of any length; copies and repeated rows get one score, so there are
    no ties to decide. An empty table gives no rows.
    """
    docs = docs.drop("_score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                made = model.scores(features(*text_bytes(part.column(text))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.float64())], names=[*part.schema.names, "_score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return mapped(docs, run, f"{fields}, _score double")
