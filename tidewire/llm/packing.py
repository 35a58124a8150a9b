"""Best-fit packing of token sequences after a Martello-Toth dominance reduction.

The pieces' lengths form a histogram of at most ``capacity`` numbers, whatever the corpus; the plan is made on it, and
pieces find their place in the plan by length and rank, in parallel. Martello and Toth, "Lower bounds and reduction
procedures for the bin packing problem" (1990): a set of pieces that holds the longest one left and dominates every
other set with it can be fixed without loss. Equal lengths are fixed together.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.bpe import BATCH
from tidewire.llm.common import mapped, numbered, written
from tidewire.llm.tokens import file_encoder

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(2)
def _encoder(path: str) -> Callable[[str], list[int]]:
    """Ids of a text as the tokenizers library gives them: an added token of the file in a text is one id of its own."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError("added tokens that match by their surroundings are not supported")
    own = {t["content"]: t["id"] for t in added if t["content"]}
    plain = file_encoder(path)
    if not own:
        return plain
    parts = re.compile("(" + "|".join(re.escape(t) for t in sorted(own, key=len, reverse=True)) + ")")

    def encode(text: str) -> list[int]:
        found = parts.split(text)
        if len(found) == 1:
            return plain(text)
        return [i for k, part in enumerate(found) for i in ([own[part]] if k % 2 else plain(part))]

    return encode


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else a shorter first piece and full ones."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Tokenises whole texts, ends each with id 0 and cuts the long ones: PIECES, and ``ids`` if asked for.

    A null text is empty: one piece with id 0 alone. Repeated rows give their pieces each time; texts of any length are
    read whole; an empty table gives no rows; other columns are not carried.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _encoder(path)
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                out: list[tuple] = []
                for doc, words in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.array([*made(words), 0], "<u4").tobytes()
                    for k, (start, length) in enumerate(cut_points(len(ids) // 4, capacity)):
                        own = ids[4 * start : 4 * (start + length)]
                        out.append((doc, k, start, length, zlib.crc32(own), np.frombuffer(own, "<i4") if keep_ids else None))
                columns = list(zip(*out, strict=True)) or [()] * 6
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())][: 5 + keep_ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=names)

    schema = PIECES.replace("doc_id", key, 1) + ", ids array<int>" * keep_ids
    names = [f.split()[0] for f in schema.split(", ")]
    rows = docs.select(F.col(key).cast("long").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return mapped(rows, run, schema)


class Instance:
    """Numbers of pieces by length, and the sorted lengths that still have some."""

    def __init__(self, counts: dict[int, int]):
        self.counts = Counter({length: n for length, n in counts.items() if n > 0})
        self.lengths = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.lengths[bisect.bisect_left(self.lengths, length)]

    def largest(self, room: int, used: Counter) -> int:
        """Longest length up to ``room`` of which a piece is left besides the used ones; 0 if none."""
        at = bisect.bisect_right(self.lengths, room) - 1
        while at >= 0 and self.counts[self.lengths[at]] <= used[self.lengths[at]]:
            at -= 1
        return self.lengths[at] if at >= 0 else 0

    def smallest(self, n: int, used: Counter) -> list[int]:
        out: list[int] = []
        for length in self.lengths:
            out += [length] * min(n - len(out), self.counts[length] - used[length])
            if len(out) == n:
                break
        return out


def dominating(left: Instance, longest: int, capacity: int) -> tuple[int, ...] | None:
    """A set with ``longest`` that dominates every feasible set with it, or None."""
    room, used = capacity - longest, Counter([longest])
    least = left.smallest(3, used)
    if not least or least[0] > room:
        return (longest,)
    one = left.largest(room, used)
    # A partner that fills the bin replaces any other partners; so does the largest one where only one fits.
    if one == room or len(least) < 2 or least[0] + least[1] > room:
        return (longest, one)
    if len(least) == 3 and sum(least) <= room:
        return None  # three more may fit: nothing is proved
    second = left.largest(room - one, used + Counter([one]))
    if second:
        # Of any pair x >= y, x is at most the largest partner and y at most the largest piece in half the room.
        return (longest, one, second) if second >= left.largest(room // 2, used) else None
    # The largest partner fits alone only: it dominates if it holds the best pair.
    best, smaller = 0, left.lengths[: bisect.bisect_right(left.lengths, room)]
    for x in smaller:
        if left.counts[x] > used[x] and (y := left.largest(min(x, room - x), used + Counter([x]))):
            best = max(best, x + y)
    return (longest, one) if best <= one else None


def reduce_instance(left: Instance, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fixes dominating sets from the longest length down, again until none is left: (lengths, times)."""
    fixed, again = [], True
    while again:
        again = False
        for longest in sorted(left.lengths, reverse=True):
            while left.counts[longest] and (found := dominating(left, longest, capacity)):
                # Taking pieces away leaves fewer rivals, so the proof holds while the set's own pieces last.
                need = Counter(found)
                times = min(left.counts[x] // k for x, k in need.items())
                for x, k in need.items():
                    left.take(x, times * k)
                fixed.append((found, times))
                again = True
    return fixed


def best_fit(left: Instance, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first: each piece goes to the open bin with the least room that takes it; equal bins together."""
    open_bins: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(room: int, held: tuple[int, ...], times: int) -> None:
        if room not in open_bins:
            open_bins[room] = []
            bisect.insort(rooms, room)
        open_bins[room].append([held, times])

    for length in sorted(left.lengths, reverse=True):
        n = left.counts[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                if n >= each:
                    put(capacity - each * length, (length,) * each, n // each)
                if n % each:
                    put(capacity - n % each * length, (length,) * (n % each), 1)
                break
            room = rooms[at]
            held, times = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[at]
            each = room // length  # a bin that took one is the tightest, and takes more
            full = min(times, n // each)
            if full:
                put(room - each * length, held + (length,) * each, full)
                n -= full * each
            if full < times and 0 < n < each:
                put(room - n * length, held + (length,) * n, 1)
                full, n = full + 1, 0
            if full < times:
                put(room, held, times - full)
    return [(held, times) for groups in open_bins.values() for held, times in groups]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Where the pieces of each length go: ranks from ``rank`` on lie ``each`` to a bin, bins from ``bin`` on, first at ``offset``."""
    left = Instance(counts)
    bins = reduce_instance(left, capacity)
    bins += best_fit(left, capacity)
    used: Counter = Counter()
    rows, first = [], 0
    for held, times in bins:
        offset = 0
        for length, each in sorted(Counter(held).items(), reverse=True):
            rows.append((length, used[length], each, first, offset))
            used[length] += each * times
            offset += each * length
        first += times
    return pd.DataFrame(rows, columns=["length", "rank", "each", "bin", "offset"]).sort_values(["length", "rank"], ignore_index=True)


def place(length: np.ndarray, rank: np.ndarray, table: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of pieces, from their lengths and their ranks among the pieces of that length."""
    columns = {c: table[c].to_numpy(np.int64) for c in table.columns}
    row = np.searchsorted((columns["length"] << 42) | columns["rank"], (length << 42) | rank, side="right") - 1
    ahead = rank - columns["rank"][row]
    each = columns["each"][row]
    return columns["bin"][row] + ahead // each, columns["offset"][row] + ahead % each * length


def pack(cut: DataFrame, capacity: int = CAPACITY, key: str = "doc_id") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces: no sequence over ``capacity``, as few as the method finds.

    The driver holds the counts by length (``capacity`` numbers at most) and the plan (a few rows for each length). Ties
    in length are placed by hash; an empty table gives no rows.
    """
    counts = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = plan(counts, capacity)
    ranked = numbered(cut, ["length"], [key, "piece", "ids_crc32"], "_rank").select(*cut.columns, "_rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "_rank"))
            where, offset = place(length, rank, table)
            rest = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(where), pa.array(offset)], names=[*rest, "sequence_id", "offset"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return mapped(ranked, run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places; texts are tokenised once and the pieces written in between.

    Null, empty and very long texts, repeated rows and other columns are treated as in ``pieces``, ties as in ``pack``; an
    empty table gives no rows.
    """
    return pack(written(pieces(docs, path, capacity, key, text, keep_ids), "pieces"), capacity, key)
