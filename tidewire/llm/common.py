"""Helpers the operators share: salted joins, gapless numbers, written tables, text bytes."""

from __future__ import annotations

import hashlib
import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence
from contextvars import ContextVar
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewire.session import fresh_path

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Keys that a salted join may split, rows of one part of such a key, and most parts: bounds on what it copies.
HOT_KEYS, SALT_ROWS, MOST_SALTS = 256, 2_000, 1024
#: Bits for each value of a table of bits, most bits of one (16 MB), and 64-bit words of one of its rows.
SPARSE, MOST_BITS, BIT_WORDS = 16, 1 << 27, 512
#: Tasks that merge the sketches of a sample.
MERGERS = 64


@lru_cache(maxsize=None)
def _package(application: str) -> str:
    """This library as an archive; the driver serves it to the executors."""
    root = Path(__file__).resolve().parents[2]
    return shutil.make_archive(f"{tempfile.mkdtemp(prefix='tidewire-code-')}/tidewire", "zip", root, "tidewire")


@lru_cache(maxsize=None)
def _shipped(application: str) -> None:
    SparkSession.active().sparkContext.addPyFile(_package(application))


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this library wherever they start."""
    _shipped(spark.sparkContext.applicationId)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Scope:
    """Owner of the tables that ``written`` makes while it is open: all of them go when it closes.

    ``with Scope():`` around a query and the write of its result leaves no folder behind. Scopes nest; a table belongs to
    the innermost one. A table goes earlier if its last reader drops it; outside any scope it goes when the driver ends.
    """

    _open: ContextVar[tuple[Scope, ...]] = ContextVar("scopes", default=())

    def __init__(self) -> None:
        self.paths: dict[str, SparkSession] = {}

    def __enter__(self) -> Scope:
        self._token = Scope._open.set((*Scope._open.get(), self))
        return self

    def release(self, table: DataFrame) -> None:
        """Hands a table over to the scope around this one, if there is one."""
        path = table._written_to
        if self.paths.pop(path, None) is not None:
            for scope in Scope._open.get()[:-1][-1:]:
                scope.paths[path] = table.sparkSession

    def __exit__(self, *_: object) -> None:
        Scope._open.reset(self._token)
        for path, spark in self.paths.items():
            _delete(spark, path)
        self.paths.clear()


def _folder(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system of a path, and the path: the folder may lie in any store that Spark writes to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def _delete(spark: SparkSession, path: str) -> None:
    store, place = _folder(spark, path)
    store.delete(place, True)


def drop(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` whose last reader has been written."""
    for table in tables:
        _delete(table.sparkSession, table._written_to)
        for scope in Scope._open.get():
            scope.paths.pop(table._written_to, None)


def written(df: DataFrame, name: str, last: Sequence[DataFrame] = ()) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage and survives lost executors.

    What the step shuffled is of no more use then, and goes when it ends; so do the tables ``last``, of which it was the
    last reader. The table itself goes with its scope.
    """
    spark = df.sparkSession
    ship(spark)
    path = fresh_path(spark, name)
    store, place = _folder(spark, path)
    store.deleteOnExit(place)
    for scope in Scope._open.get()[-1:]:
        scope.paths[path] = spark
    # A clone of the session has settings of its own: no query planned meanwhile sees this one.
    apart = spark._jsparkSession.cloneSession()
    apart.conf().set(SHUFFLE_CLEANUP, "true")
    spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(apart, df._jdf.logicalPlan()).write().parquet(path)
    drop(*last)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


@dataclass(frozen=True)
class Hot:
    """Hashes of the keys that hold most rows, and into how many parts each of them is split."""

    hashes: tuple[int, ...]
    salts: int


#: No key holds many rows.
NO_HOT = Hot((), 1)


def hot_keys(counts: DataFrame, keys: list[str], weight: str) -> Hot:
    """The HOT_KEYS heaviest keys of ``counts`` that hold over SALT_ROWS rows; any other key has less than 1/HOT_KEYS of all.

    ``counts`` has a row for each key and its number of rows; the driver gets HOT_KEYS rows of it at most.
    """
    top = counts.select(F.xxhash64(*keys).alias("h"), F.col(weight).alias("n")).orderBy(F.col("n").desc()).limit(HOT_KEYS).collect()
    hot = [r for r in top if r["n"] > SALT_ROWS]
    return Hot(tuple(sorted({r["h"] for r in hot})), min(MOST_SALTS, -(-hot[0]["n"] // SALT_ROWS)) if hot else 1)


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], spread: Column, hot: Hot, how: str = "inner") -> DataFrame:
    """``big`` joined with ``small`` (one row for each key): hot keys of ``big`` are split by ``spread``, all others stay whole.

    Only the hot keys' rows of ``small`` are copied. Rows of ``big`` without a key match nothing and are spread too.
    """
    if not hot.hashes and how == "inner":
        return big.join(small, keys, how)
    is_hot = F.xxhash64(*keys).isin(list(hot.hashes)) if hot.hashes else F.lit(False)
    loose = F.lit(False)
    for key in keys:
        loose = loose | F.col(key).isNull()
    part = F.pmod(F.xxhash64(spread), F.when(is_hot, F.lit(hot.salts)).otherwise(F.lit(MOST_SALTS)))
    left = big.withColumn("_salt", F.when(is_hot | loose, part).otherwise(F.lit(0)).cast("int"))
    parts = F.when(is_hot, F.sequence(F.lit(0), F.lit(hot.salts - 1))).otherwise(F.array(F.lit(0)))
    return left.join(small.withColumn("_salt", F.explode(parts)), [*keys, "_salt"], how).drop("_salt")


@dataclass(frozen=True)
class Bits:
    """A set of hashes by their low bits: has no false absence."""

    words: np.ndarray

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h & np.uint64(64 * len(self.words) - 1)
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def bits_of(rows: DataFrame, h: str = "h") -> Bits:
    """The set of hashes ``h``: the driver gets one row for each 64 bits of the table at most, whatever the number of rows."""
    n = rows.count()
    bits = 1 << 16
    while bits < min(MOST_BITS, SPARSE * n):
        bits *= 2
    place = F.col(h).bitwiseAND(F.lit(bits - 1))
    slots = rows.groupBy(F.shiftright(place, 6).alias("slot")).agg(F.expr(f"bit_or(shiftleft(1L, cast(`{h}` & 63 AS int)))").alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[slots["slot"].to_numpy()] = slots["bits"].to_numpy().view(np.uint64)
    return Bits(words)


def among(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose value of ``column`` is one of the only column of ``wanted``, and a few others, before a join with those.

    Told by a table of bits that every task gets: no wanted row is lost, most others stay where they are. The table is a few
    rows of BIT_WORDS words each, so no Python worker is needed to look at it.
    """
    words = bits_of(wanted.select(F.xxhash64(*wanted.columns).alias("h"))).words.view(np.int64)
    parts = pa.ListArray.from_arrays(pa.array(np.arange(0, len(words) + 1, BIT_WORDS, dtype=np.int32)), pa.array(words))
    table = rows.sparkSession.createDataFrame(pa.table({"_part": pa.array(np.arange(len(parts))), "_words": parts}))
    place = F.xxhash64(column).bitwiseAND(F.lit(64 * len(words) - 1))
    word = F.get("_words", F.pmod(F.shiftright(place, 6), F.lit(BIT_WORDS)).cast("int"))
    inside = F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1
    return rows.join(F.broadcast(table), (F.col("_part") == F.shiftright(place, (64 * BIT_WORDS).bit_length() - 1)) & inside, "left_semi")


def least_rows(rows: DataFrame, most: int, place: str = "_place") -> DataFrame:
    """The rows of the ``most`` smallest distinct values of ``place`` (a hash of a row's content), one row for each value.

    A sample by row identity: copies count once, rows without an id are rows like others. Tasks keep a sketch of the
    smallest values, sketches are merged by a tree of tasks, and the driver gets their greatest value alone.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros(0, np.int64)
        for batch in batches:
            kept = np.unique(np.concatenate([kept, batch.column(0).to_numpy(zero_copy_only=False)]))[:most]
        yield pa.RecordBatch.from_arrays([pa.array(kept)], names=["p"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            values = batch.column(place).to_pylist()
            fresh = [i for i, v in enumerate(values) if not (v in seen or seen.add(v))]
            yield batch.take(pa.array(fresh, pa.int64()))

    places = mapped(rows.select(F.col(place).alias("p")), sketch, "p long")
    places = mapped(mapped(places.repartition(MERGERS), sketch, "p long").coalesce(1), sketch, "p long")
    limit = places.agg(F.max("p").alias("p")).first()["p"]
    chosen = rows.where(F.col(place) <= F.lit(limit).cast("long"))
    return mapped(chosen, first, chosen.schema).dropDuplicates([place])


def numbered(df: DataFrame, group: list[str], order: list[str], slot: str, rows: int = 50_000, least: int = 64) -> DataFrame:
    """Adds ``slot``: within each value of ``group`` (never null) the rows count from 0 without gaps.

    A group of any size is split into hashed parts of about ``rows`` rows, each numbered by its own task; the parts'
    starts are sums over one small row for each part. Rows equal in all of ``order`` are interchangeable.
    """
    parts = max(least, df.count() // rows)
    spread = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    sizes = spread.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order)) - 1
    return (
        spread.withColumn("_local", local)
        .join(starts, [*group, "_part"])
        .withColumn(slot, (F.col("_start") + F.col("_local")).cast("long"))
        .drop("_part", "_start", "_local")
    )


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, whatever the number of uses."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; the cheaper function serves strings without other letters."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def mapped(rows: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``rows`` through a function of Arrow batches; workers get this library before the function is bound to them."""
    ship(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets into them; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(offsets) else raw, offsets - offsets[0]


_LENGTH = np.uint64(0xD6E8FEB86659FD93)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Words longer than this are hashed one by one.
_LONG = 256


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_parts(raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hashes of parts of the bytes, eight bytes at a time for all parts at once."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    # The eight bytes from each place on, as one number.
    eight = np.ndarray((len(raw) + 1,), "<u8", buffer=padded.data, strides=(1,))
    h = mix((eight[start] & _MASKS[np.minimum(length, 8)]) + length.astype(np.uint64) * _LENGTH)
    at, more = 8, np.flatnonzero((length > 8) & (length <= _LONG))
    while len(more):
        h[more] = mix(h[more] * np.uint64(3) + (eight[start[more] + at] & _MASKS[np.minimum(length[more] - at, 8)]))
        at += 8
        more = more[length[more] > at]
    for i in np.flatnonzero(length > _LONG).tolist():
        part = raw[start[i] : start[i] + length[i]].tobytes()
        h[i] = np.frombuffer(hashlib.blake2b(part, digest_size=8).digest(), "<u8")[0]
    return h


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words between blanks in all texts, each word's text number, and each word's length in bytes."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if lower:
        raw = raw + ((raw >= 65) & (raw <= 90)) * np.uint8(32)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    fresh[edges] = inside[edges]  # a text's first byte starts a word of its own
    start = np.flatnonzero(fresh)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | fresh[1:]
    end = np.flatnonzero(last) + 1
    length = end - start
    hashes = hash_parts(raw, start, length)
    return hashes, np.searchsorted(offsets, start, side="right") - 1, length
