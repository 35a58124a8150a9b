"""Line dedup: lines that several documents hold stay in the first of them only.

Lines are exploded, keyed and hashed once, into a narrow table of (document, position, hash) that all later steps read.
Each hash's smallest and largest document tell whether two documents hold it, so no set of documents is gathered. Dropped
positions come back to their document, which is cut between them in one pass. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import BLANKS, ascii_lower, hot_keys, let, salted_join, written

#: Shortest key, in code points, that can be dropped.
LEAST_CHARS = 10
_LAST = 9223372036854775807


def _kept(lines: Column, drops: Column) -> Column:
    """The lines between the sorted dropped positions; linear in the number of lines."""
    bounds = F.concat(F.array(F.lit(-1)), F.coalesce(drops, F.array().cast("array<int>")), F.array(F.size(lines)))
    return let(
        F.struct(lines.alias("l"), bounds.alias("b")),
        lambda v: F.flatten(
            F.transform(
                F.sequence(F.lit(1), F.size(v["b"]) - 1),
                lambda i: F.slice(v["l"], F.get(v["b"], i - 1) + 2, F.get(v["b"], i) - F.get(v["b"], i - 1) - 1),
            )
        ),
    )


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with ``text`` cut, and the columns ``n_lines`` and ``n_dropped``; one row out for each row in.

    A null or empty text is one empty line and becomes ''. A null key is one document, after all others. Repeated rows
    of one key are one document: their lines are not dropped for each other's sake. Whole texts of any length are read;
    a text without lines left becomes ''. Columns of the names ``n_lines`` and ``n_dropped`` are replaced.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    whole = F.coalesce(F.col(text), F.lit(""))
    # Other columns travel in a struct, so none of them can meet a name used here.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns if c != text] or [F.lit(0).alias("none")]).alias("_row"),
        whole.alias("_whole"),
        F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("_doc"),
        F.unhex(F.md5(whole.cast("binary"))).alias("_text"),
    )
    held = (
        rows.select("_doc", "_text", F.posexplode(F.split("_whole", "\n")).alias("_pos", "_line"))
        .withColumn("_line", F.btrim(F.col("_line"), F.lit(BLANKS)))
        .where(F.char_length("_line") >= least_chars)
        .select("_doc", "_text", "_pos", F.unhex(F.md5(ascii_lower(F.col("_line")).cast("binary"))).alias("_hash"))
    )
    held = written(held, "keyed-lines")
    shared = (
        held.groupBy("_hash")
        .agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last"), F.count(F.lit(1)).alias("_n"))
        .where("_first < _last")
        .select("_hash", "_first", "_n")
    )
    shared = written(shared, "shared-lines")
    drops = (
        salted_join(held, shared.drop("_n"), ["_hash"], F.xxhash64("_doc", "_pos"), hot_keys(shared, ["_hash"], "_n"))
        .where("_doc > _first")
        .groupBy("_doc", "_text")
        .agg(F.sort_array(F.collect_set("_pos")).alias("_drops"))
    )
    drops = written(drops, "dropped-lines", last=[held, shared])
    # Texts are hashed to the narrow side's places, never sorted.
    cut = rows.join(drops.hint("shuffle_hash"), ["_doc", "_text"], "left")
    lines = F.split("_whole", "\n")
    return cut.select(
        *(F.array_join(_kept(lines, F.col("_drops")), "\n").alias(c) if c == text else F.col("_row")[c].alias(c) for c in columns),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("_drops"), F.lit(0)).cast("long").alias("n_dropped"),
    )
