"""Quality rules: base counts of each text, and lines that many documents of one host share.

All of it is DataFrame expressions. Repeated passages are found within a row (hashes of the windows, sorted only where
two are equal), so no window leaves its row. Lines are counted over distinct texts of a host: copies of one text are no
evidence that its lines are boilerplate, and all copies get the same verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import BLANKS, ascii_lower, hot_keys, let, salted_join, written

#: Words in a window, least words of a text, most repeated words in percent.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: A line of any length goes if at least LEAST_TEXTS texts and SHARE of all texts of its host hold it; a document goes if
#: less than LEFT of its words stay.
LEAST_TEXTS, SHARE, LEFT = 20, 0.05, 0.2


def split_words(text: Column) -> Column:
    """Words between blanks, tabs, newlines, vertical tabs, form feeds and returns; none for a null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def count_words(line: Column) -> Column:
    """Words of a trimmed line that is not empty; where single blanks alone part them their number tells."""
    plain = ~F.contains(line, F.lit("  "))
    for blank in BLANKS[1:]:
        plain = plain & ~F.contains(line, F.lit(blank))
    single = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    return F.when(plain, single).otherwise(F.size(F.split(line, r"[\x20\x09-\x0D]+")))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that stand in a window found twice or more in the text."""
    zero = F.lit(0)

    def marked(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            pairs,
            lambda p: F.sort_array(
                F.transform(
                    F.filter(
                        p,
                        lambda x, i: F.coalesce(F.get(p, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(p, i + 1)["h"] == x["h"], F.lit(False)),
                    ),
                    lambda x: x["i"],
                )
            ),
        )

    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.transform(starts, lambda s, i: F.least(F.lit(window), F.coalesce(F.get(starts, i + 1) - s, F.lit(window)))), zero, lambda a, x: a + x
        )

    def counted(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), zero).otherwise(let(marked(hashes), covered))

    def windows(w: Column) -> Column:
        return F.when(F.size(w) <= window, zero).otherwise(
            let(F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)), lambda i: F.xxhash64(F.slice(w, i, window))), counted)
        )

    return let(words, windows).cast("long")


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    whole = F.coalesce(F.col(text), F.lit(""))
    counts = let(
        split_words(F.col(text)),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )
    filled = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return (
        docs.withColumns(
            {
                "_counts": counts,
                "n_symbols": F.char_length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("long"),
                "n_dup_lines": let(filled, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            }
        )
        .withColumns({c: F.col("_counts")[c] for c in ("n_words", "word_chars", "n_repeat_words")})
        .drop("_counts")
        .withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    )


def host_lines(docs: DataFrame, host: Column, text: str = "text") -> DataFrame:
    """(_host, _text, _line, _words) once for each distinct line of each distinct text of a host; words of all its copies."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return (
        docs.select(host.alias("_host"), F.unhex(F.md5(whole.cast("binary"))).alias("_text"), F.explode(F.split(whole, "\n")).alias("_l"))
        .withColumn("_l", F.btrim(F.col("_l"), F.lit(BLANKS)))
        .where("_l != ''")
        .withColumn("_words", count_words(F.col("_l")))
        .select("_host", "_text", F.unhex(F.md5(ascii_lower(F.col("_l")).cast("binary"))).alias("_line"), "_words")
        .groupBy("_host", "_text", "_line")
        .agg(F.sum("_words").alias("_words"))
    )


def judge(docs: DataFrame, text: str = "text", host: str = "source", removed: bool = True) -> DataFrame:
    """``docs`` with the base counts, ``kept`` and, if asked for, ``n_removed_words``; one row out for each row in.

    ``kept`` is false for a text that fails the base rules and for one whose words are nearly all in lines that its host
    repeats. A null text has no words and fails. A null host is one host. Whole texts of any length are read. Copies and
    repeated rows share a verdict; ties cannot occur. An empty table gives no rows. Columns of the added names are replaced.
    """
    owner = F.coalesce(F.concat(F.lit("h"), F.col(host)), F.lit(""))
    gone = removed_words(docs, owner, text, depleted_only=not removed)
    counted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    columns = [c for c in docs.columns if c not in (*counted, "n_removed_words")]
    # Other columns travel in a struct, so none of them can meet a name used here.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns if c != text] or [F.lit(0).alias("none")]).alias("_row"),
        F.col(text).alias("_whole"),
        owner.alias("_host"),
        _digest(F.col(text)).alias("_text"),
    )
    # Few texts are depleted: their table is small, so they are sent to the texts and whole texts stay where they are.
    judged = (
        base_counts(rows, "_whole")
        .join(gone if removed else gone.drop("_gone"), ["_host", "_text"], "left")
        .withColumn("kept", ~F.col("base_failed") & ~F.coalesce("_depleted", F.lit(False)))
    )
    own = [F.col("_whole").alias(c) if c == text else F.col("_row")[c].alias(c) for c in columns]
    return judged.select(*own, *counted, *([F.coalesce("_gone", F.lit(0)).alias("n_removed_words")] if removed else []))


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def removed_words(docs: DataFrame, host: Column, text: str = "text", depleted_only: bool = False) -> DataFrame:
    """(_host, _text, _gone, _depleted) of the texts that lose words: how many, and whether less than LEFT of them stay.

    A text's words are those of its lines, so the narrow table of lines decides alone.
    """
    lines = written(host_lines(docs, host, text), "host-lines")
    common = lines.groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= LEAST_TEXTS)
    common = written(common, "common-lines")
    copies = docs.select(host.alias("_host"), _digest(F.col(text)).alias("_text")).groupBy("_host", "_text").agg(F.count(F.lit(1)).alias("_copies"))
    copies = written(copies, "copies")
    texts = written(copies.groupBy("_host").agg(F.count(F.lit(1)).alias("_texts")), "hosts")
    many = salted_join(common, texts, ["_host"], F.col("_line"), hot_keys(texts, ["_host"], "_texts"))
    removed = written(many.where(F.col("_n") >= SHARE * F.col("_texts")).select("_host", "_line", "_n"), "removed-lines", last=[common, texts])
    by_line = hot_keys(removed, ["_host", "_line"], "_n")
    gone = salted_join(lines, removed.drop("_n"), ["_host", "_line"], F.col("_text"), by_line)
    gone = written(gone.groupBy("_host", "_text").agg(F.sum("_words").alias("_gone")), "gone")
    # Only texts that lose lines are counted in full. All sums are over a text's copies.
    words = lines.join(gone, ["_host", "_text"]).groupBy("_host", "_text").agg(F.sum("_words").alias("_all"), F.first("_gone").alias("_gone"))
    found = words.join(copies, ["_host", "_text"]).select(
        "_host", "_text", F.expr("_gone div _copies").alias("_gone"), (F.col("_all") - F.col("_gone") < LEFT * F.col("_all")).alias("_depleted")
    )
    return written(found.where("_depleted") if depleted_only else found, "removed-words", last=[lines, removed, gone, copies])
