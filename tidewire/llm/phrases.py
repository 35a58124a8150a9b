"""Phrase collocation mining by best-first branch and bound.

A phrase's score is that of its worst cut, floor(1000 * a * n / (l * r)). The part before a cut holds the first word and
the part after it the last word, and neither is rarer than the phrase, so no phrase with first or last word w scores over
floor(1000 * n / f(w)). Words are therefore expanded from the rarest up: a round takes each language's words up to a
frequency as anchors and grows the phrases that start or end with one, a word at a time, right of a frequent prefix and
left of a frequent suffix. All counts that such a phrase needs (its parts, and phrases longer by a word) start or end with
an anchor too. A language is settled once its 2000th surviving score is above the bound of its next word; the 2000th score
so far says how far a round has to go.

Tasks count the phrases of many texts in numpy and send each phrase once with its sum. What may be frequent is told by a
table of bits of bounded size: a false bit costs a count that is thrown away, none is missing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import Bits, bits_of, hash_parts, mapped, mix, text_bytes, written

#: Most words of a phrase, least count, and results for each language.
WORDS, LEAST, TOP = 5, 100, 2000
#: The first round's words stand for this share of a language's words; a round that finds too little takes GROWTH times that.
SHARE, GROWTH = 0.04, 8
#: Fewer words are not worth a round of their own.
ROUND_WORDS = 2_000_000
#: Bytes of text counted together; phrases that a task holds before it sends them.
PART, PENDING = 1 << 20, 250_000
UNKNOWN = "und"
_COUNTS = "lang string, phrase string, h long, n long"
_SPACE, _BREAK = 1, 2


def _kinds() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(b" \t")] = _SPACE
    table[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
    return table


_KINDS = _kinds()


class Words:
    """Words of some texts in order: where they are, which language's, their hashes, and whether the next one follows on."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, owner_hash: np.ndarray):
        raw = raw + ((raw >= 65) & (raw <= 90)) * np.uint8(32)
        kind = _KINDS[raw]
        inside = kind == 0
        fresh = inside.copy()
        fresh[1:] &= ~inside[:-1]
        edges = offsets[(offsets > 0) & (offsets < len(raw))]
        fresh[edges] = inside[edges]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | fresh[1:]
        self.raw, self.start, self.end = raw, np.flatnonzero(fresh), np.flatnonzero(last) + 1
        own = hash_parts(raw, self.start, self.end - self.start)
        self.owner = np.searchsorted(offsets, self.start, side="right") - 1
        self.word = own
        self.lang = owner_hash[self.owner]
        broken = np.cumsum(kind == _BREAK)
        here = broken[self.start] if len(raw) else np.zeros(0, np.int64)
        self.joined = np.zeros(len(self.start), bool)
        self.joined[:-1] = (here[1:] == here[:-1]) & (self.owner[1:] == self.owner[:-1])

    def phrases(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the phrase of so many words from each word on, by language, and whether there is one."""
        n = len(self.word)
        h, sound = mix(self.word ^ self.lang), np.ones(n, bool)
        for k in range(1, size):
            h = _ahead(self.word, k, np.uint64(0)) + mix(h + np.uint64(k)) * np.uint64(3)
            h = mix(h)
            sound &= _ahead(self.joined, k - 1, False)
        return h, sound

    def spelled(self, at: np.ndarray, size: int) -> pa.Array:
        """The phrases from these words on, their words parted by one blank each."""
        index = at[:, None] + np.arange(size)[None, :]
        start, length = self.start[index].ravel(), (self.end[index] - self.start[index] + 1).ravel()
        total = np.concatenate([[0], np.cumsum(length)])
        place = np.arange(total[-1]) - np.repeat(total[:-1] - start, length)
        out = np.append(self.raw, np.uint8(32))[np.minimum(place, len(self.raw))]
        out[total[1:] - 1] = 32
        ends = total[:: size] if size else total
        keep = np.ones(len(out), bool)
        keep[ends[1:] - 1] = False
        offsets = (ends - np.arange(len(ends))).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(out[keep].tobytes()))


def _ahead(values: np.ndarray, k: int, fill) -> np.ndarray:
    """The value ``k`` places on; ``fill`` at the end."""
    if not k:
        return values
    out = np.full(len(values), fill, values.dtype)
    out[:-k] = values[k:]
    return out


def _lang_hash(lang: str) -> np.uint64:
    value = np.zeros(1, np.uint64)
    for byte in lang.encode():
        value = mix(value + np.uint64(byte + 1))
    return value[0]


def _parts(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, rows) of slices of about PART bytes; a longer text is a slice of its own."""
    _, offsets = text_bytes(column)
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + PART, side="right")) - 1)
        yield start, stop - start
        start = stop


def distinct(h: np.ndarray, places: bool = False) -> tuple[np.ndarray, ...]:
    """The distinct values in the order of their first places, those places, how often each stands, and if asked for each one's number."""
    where, unique = pd.factorize(h)
    first = np.zeros(len(unique), np.int64)
    first[where[::-1]] = np.arange(len(h))[::-1]
    out = (unique, first, np.bincount(where, minlength=len(unique)).astype(np.int64))
    return (*out, where) if places else out


class _Sums:
    """Counts by hash, with each hash's language and phrase."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]] = []
        self.rows = 0

    def add(self, h: np.ndarray, n: np.ndarray, lang: pa.Array, phrase: pa.Array) -> None:
        self.held.append((h, n, lang, phrase))
        self.rows += len(h)

    def merge(self) -> None:
        if len(self.held) < 2:
            return
        h, n = (np.concatenate([x[i] for x in self.held]) for i in (0, 1))
        lang, phrase = (pa.concat_arrays([x[i] for x in self.held]) for i in (2, 3))
        unique, first, _, where = distinct(h, True)
        total = np.zeros(len(unique), np.int64)
        np.add.at(total, where, n)
        self.held = [(unique, total, lang.take(pa.array(first)), phrase.take(pa.array(first)))]
        self.rows = len(unique)

    def out(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        for h, n, lang, phrase in self.held:
            for i in range(0, len(h), 100_000):
                rows = slice(i, i + 100_000)
                columns = [lang[rows], phrase[rows].cast(pa.string()), pa.array(h[rows].view(np.int64)), pa.array(n[rows])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "h", "n"])
        self.held, self.rows = [], 0


def _counted(texts: DataFrame, size: int, tables: Broadcast | None) -> DataFrame:
    """(lang, phrase, h, n): counts of the phrases of ``size`` words that may be frequent, one row for each phrase.

    Words (size 1) are all counted, and each language's number of words is the row with the phrase null. Longer phrases are
    made of frequent words, start or end with an anchor, and the part without the other end is a frequent phrase.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, totals = _Sums(), {}
        for batch in batches:
            for start, rows in _parts(batch.column(1)):
                part = batch.slice(start, rows)
                langs = part.column(0).dictionary_encode()
                names, code = langs.dictionary, langs.indices.to_numpy()
                seeds = np.array([_lang_hash(x) for x in names.to_pylist()], np.uint64)
                words = Words(*text_bytes(part.column(1)), seeds[code])
                if not len(words.word):
                    continue
                if tables is None:
                    h, chosen = words.phrases(1)[0], np.arange(len(words.word))
                    for i, n in enumerate(np.bincount(code[words.owner], minlength=len(names)).tolist()):
                        totals[names[i].as_py()] = totals.get(names[i].as_py(), 0) + n
                else:
                    h, chosen = _candidates(words, size, *tables.value)
                unique, first, n = distinct(h[chosen])
                at = chosen[first]
                sums.add(unique, n, names.take(pa.array(code[words.owner[at]])), words.spelled(at, size))
                if sums.rows > PENDING:
                    sums.merge()
                    if sums.rows > PENDING // 2:
                        yield from sums.out()
        yield from sums.out()
        if totals:
            n = len(totals)
            columns = [pa.array(list(totals), pa.string()), pa.nulls(n, pa.string()), pa.array([0] * n, pa.int64()), pa.array(list(totals.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "h", "n"])

    return mapped(texts, run, _COUNTS).groupBy("lang", "phrase").agg(F.min("h").alias("h"), F.sum("n").alias("n"))


def _candidates(words: Words, size: int, frequent: Bits, anchors: Bits, shorter: Bits) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the phrases of ``size`` words, and the words that a phrase worth counting starts at."""
    one = words.phrases(1)[0]
    often = frequent.has(one)
    anchor = often & anchors.has(one)
    h, sound = words.phrases(size)
    for k in range(size):
        sound &= _ahead(often, k, False)
    less = words.phrases(size - 1)[0]
    sound &= anchor | _ahead(anchor, size - 1, False)
    chosen = np.flatnonzero(sound)
    known = np.zeros(len(h), bool)
    look = np.unique(np.concatenate([chosen, chosen + 1]))
    look = look[look < len(h)]
    known[look] = shorter.has(less[look])
    right, left = anchor & known, _ahead(anchor, size - 1, False) & _ahead(known, 1, False)
    return h, np.flatnonzero(sound & (right | left))


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (l * r)) in exact decimals of up to 38 digits; beyond those the query fails, it never rounds."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", (wide(a) * wide(n) * F.lit(1000).cast("decimal(4,0)")), wide(left) * wide(right))


def _survivors(grams: DataFrame, words: DataFrame, totals: dict[str, int], limits: dict[str, int]) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates between anchors that no longer phrase stands for as often.

    ``grams`` are the frequent phrases with an anchor at an end, ``words`` the frequent words, ``totals`` each language's
    number of words and ``limits`` the frequency of its anchors. Between anchors all parts of a phrase are among ``grams``.
    """
    split = F.split("phrase", " ")
    m = F.size(split)
    # A longer phrase as frequent holds one longer by a single word that is as frequent.
    inner = F.array(*(F.array_join(F.slice(split, s, m - 1), " ") for s in (F.lit(1), F.lit(2))))
    held = grams.where(m > 2).select("lang", F.explode(inner).alias("phrase"), F.col("n").alias("longer"))
    held = held.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    open_ = grams.join(held, ["lang", "phrase"], "left").where("longer IS NULL OR longer < n").select("lang", "phrase", F.col("n").alias("a"))
    cuts = open_.withColumns({"m": m, "k": F.explode(F.sequence(F.lit(1), m - 1))}).select(
        "*", F.array_join(F.slice(split, F.lit(1), F.col("k")), " ").alias("first"), F.array_join(F.slice(split, F.col("k") + 1, F.col("m") - F.col("k")), " ").alias("rest")
    )
    counts = words.select("lang", "phrase", "n").union(grams.select("lang", "phrase", "n"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    of_lang, limit = (F.element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), F.col("lang")).cast("long") for table in (totals, limits))
    scored = cuts.withColumn("n", of_lang).withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    ends = F.count_if((F.col("k") == 1) & (F.col("l") <= limit)) + F.count_if((F.col("k") == F.col("m") - 1) & (F.col("r") <= limit))
    worst = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("w"), ends.alias("ends"))
    return worst.where("ends = 2").select("lang", "phrase", *(f"w.{c}" for c in ("a", "l", "r", "n", "score")))


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _octaves(words: DataFrame) -> dict[str, list[tuple[int, int]]]:
    """(octave of the frequency, words that stand there) of each language's frequent words, rising: a few numbers for each."""
    octave = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    out: dict[str, list[tuple[int, int]]] = {}
    for r in words.groupBy("lang", octave.alias("o")).agg(F.sum("n").alias("n")).orderBy("o").collect():
        out.setdefault(r["lang"], []).append((r["o"], r["n"]))
    return out


def _limits(octaves: dict[str, list[tuple[int, int]]], totals: dict[str, int], share: float) -> dict[str, int]:
    """The frequency up to which a language's frequent words stand for about ``share`` of all its words, ROUND_WORDS at least."""
    limits = {}
    for lang, rising in octaves.items():
        held = 0
        for o, n in rising:
            held += n
            limits[lang] = 2 ** (o + 1)
            if held >= max(share * totals[lang], ROUND_WORDS):
                break
    return limits


def mine(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP, words: int = WORDS, share: float = SHARE
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``words`` words by their worst cut.

    Null and empty texts have no words; a null language is ``und``. Whole texts of any length are counted, copies and
    repeated rows each time. Equal scores are ordered by the higher count, then by the phrase's bytes, so no tie is left
    open. A language without a phrase as frequent as ``least`` has no rows, nor has an empty table; other columns are not
    carried. The driver holds a few numbers for each language and tables of bits of at most MOST_BITS.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).cast("string").alias("t")).where("t != ''")
    counts = _counted(texts, 1, None)
    kept = written(counts.where((F.col("n") >= least) | F.col("phrase").isNull()), "words")
    total = {r["lang"]: r["n"] for r in kept.where("phrase IS NULL").select("lang", "n").collect()}
    known = kept.where("phrase IS NOT NULL")
    frequent = bits_of(known)
    octaves = _octaves(known)
    limits = _limits(octaves, total, share)
    parts: list[DataFrame] = []
    while limits:
        open_texts = texts.where(F.col("lang").isin(list(limits)))
        limit = F.create_map(*(F.lit(x) for pair in limits.items() for x in pair))
        marked = known.where(F.col("lang").isin(list(limits))).withColumn("anchor", F.col("n") <= F.element_at(limit, F.col("lang")))
        anchors = marked.where("anchor")
        grams = _grown(open_texts, frequent, anchors, least, words)
        found = written(_best(_survivors(grams, known, total, limits), top), "survivors", last=[grams])
        share *= GROWTH
        further = _limits(octaves, total, share)
        # The least frequent word that is not expanded bounds all that is left; its language is settled if nothing can reach the last place.
        nexts = {r["lang"]: r["n"] for r in marked.where("NOT anchor").groupBy("lang").agg(F.min("n").alias("n")).collect()}
        last = {r["lang"]: r["score"] for r in found.where(F.col("rank") == top).select("lang", "score").collect()}
        wider = {}
        for name, reached in limits.items():
            if name not in nexts:
                continue
            if name not in last:
                wider[name] = max(2 * reached, further[name])
            elif 1000 * total[name] // nexts[name] >= last[name]:
                # Words up to this frequency can reach the last place's score; no other can.
                wider[name] = max(reached + 1, 1000 * total[name] // max(1, last[name]))
        parts.append(found.where(~F.col("lang").isin(list(wider))) if wider else found)
        limits = wider
    if not parts:
        return spark.createDataFrame([], "lang string, rank int, phrase string, a long, l long, r long, n long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _grown(texts: DataFrame, frequent: Bits, anchors: DataFrame, least: int, words: int) -> DataFrame:
    """(lang, phrase, n): the frequent phrases of 2 to ``words`` words that start or end with an anchor."""
    spark = texts.sparkSession
    starts, shorter, found = bits_of(anchors), frequent, []
    for size in range(2, words + 1):
        tables = spark.sparkContext.broadcast((frequent, starts, shorter))
        grams = written(_counted(texts, size, tables).where(F.col("n") >= least), f"phrases-of-{size}")
        tables.unpersist()
        found.append(grams)
        shorter = bits_of(grams)
        if not shorter.words.any():
            break
    every = found[0]
    for grams in found[1:]:
        every = every.union(grams)
    return written(every.select("lang", "phrase", "n"), "phrases-all", last=found)
