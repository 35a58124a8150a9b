"""Each query against a plain version of it, over the whole small tables."""

from __future__ import annotations

import hashlib
import re

import duckdb
import public_tokenizers
import pytest

from tests.llm import brute
from tidewire.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    return lambda name, columns: con.execute(f"SELECT {columns} FROM '{SF}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def docs(tables):
    return tables("documents", "doc_id, text")


def rows(spark, name):
    return [r.asDict() for r in Q.QUERIES[name](spark, SF).collect()]


def test_quality_classifier(spark, docs, tables):
    import zlib

    got = {r["doc_id"]: r for r in rows(spark, "op1_quality_classifier")}
    assert len(got) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    got = [r for r in Q.QUERIES["op1_quality_classifier"](spark, sf).collect() if r["held_out"] and r["doc_id"] in truth]
    good = [r["score"] for r in got if truth[r["doc_id"]] == 1]
    bad = [r["score"] for r in got if truth[r["doc_id"]] == 0]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.95
    assert sum(r["predicted"] for r in got if truth[r["doc_id"]] == 1) >= 0.98 * len(good)


def test_sharding(spark, docs):
    import zlib

    got = rows(spark, "op2_sharding")
    text = dict(docs)
    for r in got:
        raw = (text[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw) and r["law"] == "key"
        assert r["shard"] == brute.jump(r["doc_id"], 8) and r["grown_shard"] == brute.jump(r["doc_id"], 9)
        assert r["grown_shard"] in (r["shard"], 8)
    for s in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_url_filter(spark, tables):
    got = {r["page_id"]: r for r in rows(spark, "op3_url_filter")}
    pages = tables("pages", "page_id, url")
    assert len(got) == len(pages)
    for i, url in pages:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = brute.low(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [r for r in Q.URL_RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[0] + best[1])
        assert r["verdict"] == (best[2] if best else r["verdict"]) and r["verdict"] in ("allow", "block")


def test_byte_bpe(spark, docs):
    encoding = brute.tiktoken_encoding()
    got = {r["doc_id"]: r for r in rows(spark, "op4_byte_bpe")}
    for i, t in docs:
        ids = encoding.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(brute.ids_bytes(ids)).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_line_dedup(spark, docs):
    want = brute.line_dedup(docs)
    got = rows(spark, "op5_line_dedup")
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got} == want
    assert sum(r["n_dropped"] for r in got) > 0


def test_best_fit_packing(spark, docs):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = rows(spark, "op6_best_fit_packing")
    mine: dict = {}
    for r in got:
        mine.setdefault(r["doc_id"], {})[r["piece"]] = r
    total = 0
    for i, t in docs:
        ids = made.encode(t or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        parts = [mine[i][k] for k in range(len(mine[i]))]
        assert [p["start"] for p in parts] == [sum(q["length"] for q in parts[:k]) for k in range(len(parts))]
        assert sum(p["length"] for p in parts) == len(ids)
        assert len(parts) == -(-len(ids) // 2048) and all(p["length"] == 2048 for p in parts[1:])
        assert all(p["ids_crc32"] == brute.crc(ids[p["start"] : p["start"] + p["length"]]) for p in parts)
    bins: dict = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-total // 2048) + 2


def test_near_dedup(spark, docs):
    want = brute.near(docs)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(spark, "op7_minhash_near_dedup")}
    assert got == want


def test_quality_rules(spark, docs):
    got = {r["doc_id"]: r for r in rows(spark, "op8_quality_rules")}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for i, t in docs:
        assert tuple(got[i][c] for c in names) == brute.base_rules(t)
        assert not (got[i]["base_failed"] and got[i]["kept"])


def test_html_extraction(spark, tables):
    got = {r["page_id"]: r for r in rows(spark, "op9_html_extraction")}
    for i, url, page in tables("pages", "page_id, url, html"):
        import html as h

        body = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)
        parts = re.split(r"</?(?:p|h1)>", body[1]) if body else []
        plain = [re.sub(r"\s+", " ", h.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", p)))).strip() for p in parts]
        assert got[i]["url"] == url and got[i]["n_chars"] == len(got[i]["text"])
        if body and page.endswith("</html>"):
            assert got[i]["text"] == "\n\n".join(p for p in plain if p)


def test_exact_top_k(spark, tables):
    want = brute.top_k(tables("embeddings", "vec_id, embedding"))
    got: dict = {}
    for r in sorted(rows(spark, "op10_exact_top_k"), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == want
