"""Readers. Formats are named or found by file ending, never by catching parse errors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.columns import named, with_all
from tidewire.operators.conform import parse_chat_lines
from tidewire.sources.paths import with_path_partitions

FORMATS = ("json", "parquet", "csv")
PARQUET_FIRST = ("parquet", "json", "csv")

_CORRUPT = "_corrupt_record"
#: One grammar of file names, for listing and loading alike: the last ending names the format, but for a codec's.
_ENDINGS = ("json", "parquet", "csv", "txt")
_CODECS = ("gz", "gzip", "bz2", "zst", "zstd", "lz4", "snappy", "deflate", "xz", "br")
_ENDING = rf"\.({'|'.join(_ENDINGS)})(\.({'|'.join(_CODECS)}))?$"
#: Types of a key of key=value folders, tried in this order, as Spark does for its own.
_KEY_TYPES = ("int", "bigint", "double", "date", "timestamp")


class UnreadableError(ValueError):
    """No format gives rows for a path."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system of ``path`` knows it; asks for metadata only."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(jsc.hadoopConfiguration()).exists(hadoop_path)


def _is_glob(path: str) -> bool:
    return any(c in path for c in "*?[{")


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(ending, pairs, plain) of each file below ``path``: its format, its key=value folders,
    and whether it lies in another kind of folder. Only names are listed: the content
    column is pruned away.
    """
    if _is_glob(path):
        below = F.lit("")
    else:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        root = hadoop.getFileSystem(conf).makeQualified(hadoop).toUri().getPath()
        # The folder part below the root; '' for a file that is the root itself.
        rest = F.substr(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), F.lit(1))
        rest = F.regexp_replace(rest, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")
        below = F.regexp_extract(F.substring(rest, len(root) + 1, 1 << 20), r"^/?(.*)/[^/]*$", 1)
    folders = F.filter(F.split(below, "/"), lambda x: x != "")
    pair = r"^\w+=[^/]+$"
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        F.regexp_extract(F.lower("path"), _ENDING, 1).alias("ending"),
        F.filter(folders, lambda x: x.rlike(pair)).alias("pairs"),
        F.exists(folders, lambda x: ~x.rlike(pair)).alias("plain"),
    )


@dataclass(frozen=True)
class Listing:
    """Files by ending ('' for none that is known), the types of their folders' keys, and
    whether other folders lie between."""

    counts: Mapping[str, int]
    keys: Mapping[str, str]
    nested: bool


def listing(spark: SparkSession, path: str) -> Listing:
    """Counts of the files below ``path``, listed once; a row per ending and folder key comes back.

    A key's type is the first that all its values have, as Spark infers it where it makes the
    columns itself, so the same folders give the same types however they are nested.
    """
    value = F.nullif(F.expr("substr(pair, instr(pair, '=') + 1)"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    files = _files(spark, path).select("ending", "plain", F.explode_outer("pairs").alias("pair"), F.size("pairs").alias("n_pairs"))
    fits = [F.bool_and(value.try_cast(t).isNotNull() | value.isNull()).alias(t) for t in _KEY_TYPES]
    # A file counts once, as the fraction of its pairs that a row stands for.
    found = (
        files.groupBy("ending", F.substring_index("pair", "=", 1).alias("key"))
        .agg(F.sum(1 / F.greatest("n_pairs", F.lit(1))).alias("n"), F.max("plain").alias("plain"), *fits)
        .collect()
    )
    counts: dict[str, float] = {}
    for r in found:
        counts[r["ending"]] = counts.get(r["ending"], 0) + r["n"]
    named_keys = dict.fromkeys(r["key"] for r in found if r["key"] is not None)
    keys = {
        k: next((t for t in _KEY_TYPES if all(r[t] for r in found if r["key"] == k)), "string") for k in named_keys
    }
    return Listing({e: round(n) for e, n in counts.items()}, keys, any(r["plain"] for r in found))


def formats_at(spark: SparkSession, path: str) -> set[str]:
    """Formats by file ending."""
    return set(listing(spark, path).counts) - {""}


def _only(fmt: str) -> str:
    """Glob of the file names that the listing counts to a format, in any case, compressed or not."""

    def any_case(word: str) -> str:
        return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)

    return f"*.{any_case(fmt)}{{,{','.join('.' + any_case(c) for c in _CODECS)}}}"


def _load(
    spark: SparkSession,
    fmt: str,
    path: str,
    schema: T.StructType | str | None,
    by_name: bool,
    seen: Listing,
) -> DataFrame:
    """Files of one format, found the way they were listed.

    Folders named key=value are left to the source, which makes columns of them. Where other
    folders lie between, the source is told to look into all, and the keys come from the paths.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if by_name:
        reader = reader.option("pathGlobFilter", _only(fmt))
    if fmt == "csv":
        reader = reader.option("header", True)
    if not seen.nested:
        return reader.format(fmt).load(path)
    rows = reader.option("recursiveFileLookup", "true").format(fmt).load(path)
    keys = {k: t for k, t in seen.keys.items() if k not in rows.columns}
    rows = with_path_partitions(rows, list(keys))
    return with_all(rows, {k: F.nullif(named(k), F.lit("__HIVE_DEFAULT_PARTITION__")).cast(t) for k, t in keys.items()})


def _stacked(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames one below the other by column name; columns of unequal types as text."""
    kinds: dict[str, set[str]] = {}
    for df in frames:
        for f in df.schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    mixed = {c for c, k in kinds.items() if len(k) > 1}
    same = [with_all(df, {c: as_text(df, c) for c in df.columns if c in mixed}) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), same)


def as_text(df: DataFrame, name: str) -> Column:
    nested = isinstance(df.schema[name].dataType, (T.StructType, T.ArrayType, T.MapType))
    return F.to_json(named(name)) if nested else named(name).cast("string")


def _unread(seen: Listing, read: Sequence[str], path: str) -> None:
    left = {e or "no known ending": n for e, n in seen.counts.items() if e not in read}
    if left:
        files = ", ".join(f"{n} with {e}" for e, n in sorted(left.items()))
        raise UnreadableError(f"{path} also holds {sum(left.values())} files that would not be read: {files}")


def read_auto(
    spark: SparkSession,
    path: str,
    formats: Sequence[str] = FORMATS,
    schema: T.StructType | str | None = None,
    only: str | None = None,
) -> DataFrame:
    """All rows of the files below ``path``, nested folders included.

    Files with known endings are read by their names, each format by its reader, and stacked by
    column name. A file that none of ``formats`` would read raises an error with the count;
    ``only`` names one format to read and leaves the others out knowingly. Where no file has a
    known ending the formats are tried in order, and a JSON read that understands nothing counts
    as a failure. Give ``schema`` for large JSON: to infer one, Spark reads the data once more.
    """
    seen = listing(spark, path)
    if only is not None:
        return _load(spark, only, path, schema, True, seen)
    by_name = [f for f in formats if f in seen.counts]
    if by_name:
        _unread(seen, by_name, path)
        return _stacked([_load(spark, f, path, schema, True, seen) for f in by_name])
    if set(seen.counts) - {""}:
        _unread(seen, (), path)
    failure = None
    for fmt in formats:
        try:
            df = _load(spark, fmt, path, schema, False, seen)
        # A wrong guess fails while planning, or in the task that reads a parquet footer.
        except (PySparkException, Py4JJavaError) as error:
            failure = error
            continue
        if df.columns and df.columns != [_CORRUPT]:
            return df
    raise UnreadableError(f"none of {list(formats)} reads {path}") from failure


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_first_path(
    spark: SparkSession, root: str, candidates: Sequence[str] = ("communications", "cleaned", "")
) -> DataFrame:
    """Parquet at the first existing candidate below ``root``; '' is the root itself."""
    tried = [f"{root.rstrip('/')}/{c}".rstrip("/") for c in candidates]
    for path in tried:
        if path_exists(spark, path):
            return spark.read.parquet(path)
    raise UnreadableError(f"no folder at any of {tried}")


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet frame, or None when the path is missing or holds no rows."""
    if not path_exists(spark, path):
        return None
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise
    return None if df.isEmpty() else df


def read_chat_text(
    spark: SparkSession, path: str, positions: bool = False, only_txt: bool = False
) -> DataFrame:
    """Exported chat text files to timestamp, sender, message; nested folders included.

    ``positions`` adds ``message_id``, the file and the line's number in it, which keeps equal
    messages apart. Each file is then read whole by one task, as exports of single chats allow.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if only_txt:
        reader = reader.option("pathGlobFilter", _only("txt"))
    if not positions:
        return parse_chat_lines(reader.text(path))
    files = reader.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    lines = files.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("line", "value"))
    return parse_chat_lines(lines.select("value", F.concat_ws("#", "file", "line").alias("message_id")))


def read_chat(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    only: str | None = None,
    positions: bool = False,
) -> DataFrame:
    """All rows of a chat export: JSON and CSV rows as they are, text files parsed to rows.

    Stacked by column name; other files raise an error, as in :func:`read_auto`.
    """
    seen = listing(spark, path)
    there = [f for f in ("json", "csv", "txt") if f in seen.counts and only in (None, f)]
    if not there:
        return read_auto(spark, path, ("json", "csv"), schema, only)
    if only is None:
        _unread(seen, there, path)
    return _stacked(
        [
            read_chat_text(spark, path, positions, only_txt=True) if f == "txt" else _load(spark, f, path, schema, True, seen)
            for f in there
        ]
    )


def read_csv_header(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line, every column text."""
    return spark.read.option("header", True).csv(path)


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Files that each hold one JSON array. Such a file is read by one task, so spread
    large data over many files."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("multiLine", True).json(path)


def read_partitioned(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]
) -> DataFrame:
    """Partitioned parquet with its key columns as text, so '05' stays '05'."""
    fields = [f for f in schema.fields if f.name not in keys]
    full = T.StructType([*fields, *[T.StructField(k, T.StringType()) for k in keys]])
    return spark.read.schema(full).parquet(path)
