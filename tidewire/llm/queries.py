"""One query for each operator: production parameters over the whole table, and digests of its results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import alignment, bpe, html, lines, neardup, packing, phrases, quality, rules, sharding, topk, toxicity, urls
from tidewire.llm.common import hot_keys, read, salted_join
from tidewire.llm.oracles import ORACLES  # noqa: F401 (registered beside the queries)

SHARDS = 8
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
LEAST_SCORE, TOXIC_SCORE = 0.3, 0.5
RANKS, TOKENIZER, PIECES = "byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def held_out():
    """Rows that no label is learned from: checksum of the id's digits, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read(spark, sf_dir, "labels"), ~held_out())
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= LEAST_SCORE, 1).otherwise(0).alias("predicted")
    )


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read(spark, sf_dir, "documents"), shards=SHARDS)


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document it was made from, whose number is the last one in its path."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(urls.url_path(F.col("url")), r"/([0-9]{1,18})(?:\.[A-Za-z]+)?/?$", 1)
    labels = read(spark, sf_dir, "labels").where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("good"))
    pages = pages.withColumn("doc_id", F.try_to_number(number, F.lit("9" * 18)).cast("long"))
    many = hot_keys(pages.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")), ["doc_id"], "n")
    marked = salted_join(pages, labels, ["doc_id"], F.col("page_id"), many, "left")
    return urls.judge_urls(marked, URL_RULES)


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_groups(read(spark, sf_dir, "documents"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(read(spark, sf_dir, "documents").select("doc_id", "source", "text"), removed=False)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages"))


@query
def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings"), F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False)))


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``evidence``: the telling terms found, and the nearest examples as id, cosine and share of toxic ones."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    index = toxicity.train(docs, read(spark, sf_dir, "labels"), ~held_out())
    near = F.transform(
        F.slice("neighbours", 1, 3), lambda x: F.format_string("%d:%.2f:%.2f", F.element_at(x["ids"], 1), x["cosine"], x["toxic"])
    )
    scored = toxicity.score(docs, index)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= TOXIC_SCORE, 1).otherwise(0).alias("predicted"),
        F.concat_ws(" ", F.slice("found", 1, 5), F.lit("|"), near).alias("evidence"),
    )


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(read(spark, sf_dir, "documents"))


@query
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES))
