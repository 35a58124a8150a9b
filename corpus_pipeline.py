"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import lines, neardup, packing, quality, rules
from tidewire.llm.common import Scope, read, written
from tidewire.llm.queries import LEAST_SCORE, TOKENIZER, held_out

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and keep text after their host's common lines.

    A null or empty text fails; a null source is one host; rows without an id are documents like others. Texts of any length
    are judged whole, copies and repeated rows alike, so there are no ties. An empty table stays empty; other columns go.
    """
    return rules.judge(docs.select(*COLUMNS), removed=False).where("kept").select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of at least LEAST_SCORE.

    Nulls, empty and long texts and repeated rows are scored as :func:`quality.scored_rows` states; each row is judged by
    itself, so there are no ties. An empty table stays empty; other columns go.
    """
    docs = docs.select(*COLUMNS)
    model = quality.train(docs, read(spark, sf_dir, "labels"), ~held_out())
    return quality.scored_rows(docs, model).where(F.col("_score") >= LEAST_SCORE).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document holds; every document stays, if with an empty text."""
    cut = lines.dedup_lines(docs.select(*COLUMNS))
    return cut.select(*(F.char_length("text").cast("long").alias(c) if c == "n_chars" else c for c in COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group, as :func:`neardup.one_of_each` keeps them; nulls, blanks and ties are stated there."""
    return neardup.one_of_each(docs.select(*COLUMNS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences of 2048.

    A null text is empty, repeated rows are packed each, long texts are cut into pieces; ties are placed by hash. An empty
    table gives no pieces; other columns are not carried.
    """
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: A stage with a fitted model has no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What a stage wrote for itself goes once its result is written, and that once the next one's is."""
    docs, held = read(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with Scope() as tables:
            kept = written(stage(spark, docs, sf_dir), name, last=held)
            tables.release(kept)
        docs, held = kept, [kept]
    return STAGES[-1][1](spark, docs, sf_dir)
