"""Values carried by file paths."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.columns import with_all

# A key=value path segment, and the job each top folder leads to.
PARTITION_PAIR = r"(?U)(\w+)=([^/]+)"
ZONE_ROUTES = {
    "raw": "etl",
    "etl": "cleaned",
    "cleaned": "sentiment",
    "sentiment": "nlp",
    "nlp": "analytics",
}


def path_partitions(path: Column) -> Column:
    """Map of the key=value pairs in a path; the last value of a repeated key wins."""
    # Reversed, the last pair of a key is the first one array_position finds.
    keys = F.reverse(F.regexp_extract_all(path, F.lit(PARTITION_PAIR), F.lit(1)))
    values = F.reverse(F.regexp_extract_all(path, F.lit(PARTITION_PAIR), F.lit(2)))
    unique = F.array_distinct(keys)
    last = F.transform(
        unique, lambda k: F.element_at(values, F.array_position(keys, k).cast("int"))
    )
    return F.map_from_arrays(unique, last)


def with_path_partitions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Columns for the named pairs of each row's own file path; NULL where absent."""
    # A plus sign in a path is one; the decoder would read it as a blank.
    raw = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    pairs = path_partitions(F.url_decode(raw))
    found = df.select("*", pairs.alias("_pairs"))
    out = with_all(found, {k: F.try_element_at(F.col("_pairs"), F.lit(k)) for k in keys})
    return out.drop("_pairs")


def zone_route(path: Column) -> Column:
    """Job that handles a path, by its lower-cased top folder; NULL for an unknown one."""
    routes = F.create_map(*[F.lit(x) for x in chain.from_iterable(ZONE_ROUTES.items())])
    return F.try_element_at(routes, F.substring_index(F.lower(path), "/", 1))
