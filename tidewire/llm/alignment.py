"""Cross-tokenizer alignment: two tokenizers' ids of the same bytes, cut where tokens of both end.

Texts are shuffled by their full text, so each distinct text is tokenised and aligned once, whatever the number of its
copies. A pair of ids counts once for each link, times the copies of the text; tasks add up the pairs of many texts before
anything is shuffled. Measures come back to the documents by the digest of their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import hot_keys, mapped, salted_join, written
from tidewire.llm.tokens import file_encoder, file_ranks

#: Pairs that a task holds before it adds them up.
PENDING = 2_000_000
#: Counts of up to so many pairs (16 bytes each) are sent to the tasks; beyond, pairs are joined with their counts.
LOOKUP_PAIRS = 2_000_000
ALIGNED = (
    "digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
)
_ZERO = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Side:
    """One tokenizer: ids of many texts, the bytes of each id, and what an id is written as within and at the end of a group."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], entries: list[bytes], end: str):
        self.encode, self.entries = encode, entries
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.names = [f"{i}{mark}".encode() for i in range(len(entries)) for mark in (",", end)]


@lru_cache(2)
def byte_side(path: str) -> Side:
    """A byte-level BPE file of the tokenizers library, over a space and the text; special tokens are plain text."""
    table, encode = file_ranks(path), file_encoder(path)
    entries = [b""] * (max(table.values()) + 1)
    for token, i in table.items():
        entries[i] = token
    return Side(lambda texts: [encode(" " + t) for t in texts], entries, "|")


@lru_cache(2)
def piece_side(path: str) -> Side:
    """A sentencepiece model over the text, which puts a space in front itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    entries = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return Side(lambda texts: model.encode(texts, num_threads=1), entries, ";")


@lru_cache(2)
def _names(left: Side, right: Side) -> list[bytes]:
    return left.names + right.names


def groups(a: np.ndarray, b: np.ndarray, left: Side, right: Side) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Places of the tokens of ``a`` and of ``b`` that end together, and all groups written out.

    Both sides are the same bytes and no token is empty, so at each common end one token of each side ends.
    """
    ends_a, ends_b = np.cumsum(left.sizes[a]), np.cumsum(right.sizes[b])
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    last_a, last_b = np.searchsorted(ends_a, common), np.searchsorted(ends_b, common)
    # Each group's ids of the one side stand before those of the other: a token moves by the others written before it.
    code = np.empty(len(a) + len(b), np.int64)
    before = np.concatenate([[0], last_b + 1])[np.searchsorted(common, ends_a)]
    after = (last_a + 1)[np.searchsorted(common, ends_b)]
    marks_a, marks_b = 2 * a, 2 * b + 2 * len(left.entries)
    marks_a[last_a] += 1
    marks_b[last_b] += 1
    code[np.arange(len(a)) + before] = marks_a
    code[np.arange(len(b)) + after] = marks_b
    return last_a, last_b, b"".join(map(_names(left, right).__getitem__, code.tolist()))[:-1]


def align(texts: list[str], left: Side, right: Side) -> Iterator[tuple]:
    """(n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of each text; a pair is a's id times b's entries plus b's id."""
    width = len(right.entries)
    for text, ids_a, ids_b in zip(texts, left.encode(texts), right.encode(texts), strict=True):
        whole = b" " + text.encode()
        if any(b"".join(map(side.entries.__getitem__, ids)) != whole for side, ids in ((left, ids_a), (right, ids_b))):
            yield 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        last_a, last_b, shown = groups(a, b, left, right)
        pairs, times = np.unique(a[last_a] * width + b[last_b], return_counts=True)
        yield len(a), len(b), len(last_a), len(last_a), hashlib.sha256(shown).hexdigest(), pairs, times


def aligned_texts(docs: DataFrame, byte_path: str, piece_path: str, text: str = "text") -> DataFrame:
    """ALIGNED: one row for each distinct text that is neither null nor empty, with its distinct pairs and how often each links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = byte_side(byte_path), piece_side(piece_path)
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                part = batch.slice(i, 128)
                texts = part.column(0).to_pylist()
                found = list(align(texts, left, right))
                lists = []
                for at in (5, 6):
                    starts = np.concatenate([[0], np.cumsum([len(f[at]) for f in found])]).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate([f[at] for f in found]))))
                columns = [pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary()), part.column(1)]
                columns += [pa.array([f[k] for f in found], pa.int64()) for k in range(4)]
                columns += [pa.array([f[4] for f in found], pa.string()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ALIGNED.split(", ")])

    whole = docs.select(F.col(text).cast("string").alias("_t")).where("_t IS NOT NULL AND _t != ''")
    return mapped(whole.groupBy("_t").agg(F.count(F.lit(1)).alias("copies")), run, ALIGNED)


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): links of each pair of ids corpus-wide, and whether no other pair of its second id has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys[0]), pa.array(counts[0])], names=["pair", "n"])

        for batch in batches:
            pairs, times = batch.column(1), batch.column(2)
            sizes = np.diff(pairs.offsets.to_numpy())
            keys.append(pairs.flatten().to_numpy())
            counts.append(times.flatten().to_numpy() * np.repeat(batch.column(0).to_numpy(), sizes))
            held += len(keys[-1])
            if held > PENDING:
                key, count = _added(keys, counts)
                keys, counts, held = [key], [count], 0
                if len(key) > PENDING:
                    yield out()
                    keys, counts = [], []
        if keys:
            key, count = _added(keys, counts)
            keys, counts = [key], [count]
            yield out()

    linked = mapped(aligned.select("copies", "pairs", "times"), run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    linked = written(linked, "pairs")
    second = F.pmod("pair", F.lit(width))
    most = linked.groupBy(second.alias("_b")).agg(F.max("n").alias("_most"), F.count(F.lit(1)).alias("_pairs"))
    joined = salted_join(linked.withColumn("_b", second), most.drop("_pairs"), ["_b"], F.col("pair"), hot_keys(most, ["_b"], "_pairs"))
    return written(joined.select("pair", "n", (F.col("n") == F.col("_most")).alias("best")), "pair-counts", last=[linked])


def measured(aligned: DataFrame, counts: DataFrame, lookup_pairs: int = LOOKUP_PAIRS) -> DataFrame:
    """(digest, n_best, count_sum) of each aligned text with links."""
    spark = aligned.sparkSession
    if counts.count() > lookup_pairs:
        rows = aligned.select("digest", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("digest", "p.pairs", "p.times")
        rows = rows.withColumnRenamed("pairs", "pair")
        held = rows.groupBy("pair").agg(F.count(F.lit(1)).alias("_texts"))
        joined = salted_join(rows, counts, ["pair"], F.col("digest"), hot_keys(held, ["pair"], "_texts"))
        best = F.when(F.col("best"), F.col("times")).otherwise(0)
        return joined.groupBy("digest").agg(F.sum(best).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    table = counts.orderBy("pair").toArrow()
    # The sign of a count tells whether it is its second id's highest.
    signed = np.where(table["best"].to_numpy(), table["n"].to_numpy(), -table["n"].to_numpy())
    known = spark.sparkContext.broadcast((table["pair"].to_numpy(), signed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n = known.value
        for batch in batches:
            starts = batch.column(1).offsets.to_numpy()
            starts = starts - starts[0]
            times = batch.column(2).flatten().to_numpy()
            found = n[np.searchsorted(pair, batch.column(1).flatten().to_numpy())]
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * (found > 0), times * np.abs(found))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(s[starts[1:]] - s[starts[:-1]]) for s in sums)], names=["digest", "n_best", "count_sum"]
            )

    return mapped(aligned.where("n_links > 0").select("digest", "pairs", "times"), run, "digest binary, n_best long, count_sum long")


def align_documents(
    docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text", lookup_pairs: int = LOOKUP_PAIRS
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row out for each row in.

    A text that is null, empty, or changed by either tokenizer (its tokens joined are not a space and the text) has no
    tokens: zeros and ''. Whole texts of any length are aligned. Repeated rows and copies come out alike and count each.
    Ties for the highest count are all best. A null key stays null; an empty table gives no rows; other columns are not
    carried.
    """
    aligned = written(aligned_texts(docs, byte_path, piece_path, text), "aligned")
    counts = pair_counts(aligned, len(piece_side(piece_path).entries))
    measures = aligned.select("digest", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    measures = measures.join(measured(aligned, counts, lookup_pairs), "digest", "left")
    measures = written(measures, "measures", last=[aligned, counts])
    rows = docs.select(
        F.col(key).cast("long").alias("_key"), F.when(F.col(text) != "", F.unhex(F.sha2(F.col(text).cast("string").cast("binary"), 256))).alias("digest")
    )
    joined = salted_join(rows, measures.drop("copies"), ["digest"], F.col("_key"), hot_keys(measures, ["digest"], "copies"), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _ZERO]
    return joined.select(F.col("_key").alias(key), *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
