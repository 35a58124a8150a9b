"""Alignment of two tokenizers against one token at a time with the libraries themselves."""

from __future__ import annotations

import public_tokenizers
import pytest

from tests.llm import brute
from tidewire.llm import alignment

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
TEXTS = [
    "The quick brown fox jumps over the lazy dog.",
    "The quick brown fox jumps over the lazy dog.",
    "Größe und Maß, déjà vu; señor \u00e9\u0301 \u4f60\u597d \U0001f600",
    "  two  spaces\tand\n\nlines  ",
    "special <|endoftext|> <s> </s> <unk> <0x41>",
    "a \u2581 mark that the model writes for a space",
    "\u2581",
    " ",
    "\x00\x01 controls",
    "",
    None,
    "word " * 20_000,
]


def measures(out):
    return {r["doc_id"]: tuple(r[c] for c in NAMES) for r in out.collect()}


@pytest.mark.parametrize("lookup_pairs", [alignment.LOOKUP_PAIRS, 0])
def test_measures_equal_one_by_one(rows, lookup_pairs):
    docs = [(i, t, f"x{i}") for i, t in enumerate(TEXTS)]
    frame = rows(docs, "doc_id bigint, text string, digest string")
    got = measures(alignment.align_documents(frame, *PATHS, lookup_pairs=lookup_pairs))
    assert got == brute.alignment([(i, t) for i, t, _ in docs])
    assert sum(n[0] > 0 for n in got.values()) >= 6 and got[9] == got[10] == (0, 0, 0, 0, 0, 0, "")


def test_long_texts_and_copies(rows):
    out = measures(alignment.align_documents(rows([(1, TEXTS[-1]), (2, TEXTS[-1]), (3, "word"), (None, "word")], "doc_id bigint, text string"), *PATHS))
    assert out[1] == out[2] and out[1][0] >= 20_000 and out[1][5] > out[1][3]
    assert out[3] == out[None]


def test_no_rows(rows):
    assert alignment.align_documents(rows([], "doc_id bigint, text string"), *PATHS).collect() == []


def test_query_equals_one_by_one(spark):
    import duckdb

    from tidewire.llm import queries as Q

    sf = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    assert measures(Q.QUERIES["op13_tokenizer_alignment"](spark, sf)) == brute.alignment(docs)
