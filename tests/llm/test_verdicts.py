"""Verdicts of the rules, url and packing operators against plain versions, on rows made to be refused."""

from __future__ import annotations

import random
import subprocess
import sys
from pathlib import Path

import duckdb
import public_tokenizers
import pytest

from checks.compare import normalised
from tests.llm import brute
from tidewire.llm import neardup, packing, rules, urls
from tidewire.llm.oracles import QUALITY_RULES

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def hosts(seed=4):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    long_line = " ".join(draw.choices(words, k=30))
    docs = []
    for i in range(100):
        own = " ".join(draw.sample(words, 6))
        docs.append((i, "long", f"{long_line}\n{own}" if i % 3 else f"{own}\n {long_line.upper()} \n{' '.join(draw.sample(words, 40))}"))
    docs += [(200 + i, "few", f"{long_line}\n{i} x") for i in range(19)]
    docs += [(300 + i, "copies", f"{long_line}\nsame") for i in range(50)]
    docs += [(400 + i, "mixed", "\n".join([*(draw.choice(["menu line here", "cookie  line\there", long_line]) for _ in range(4)), " ".join(draw.sample(words, draw.randint(1, 60)))])) for i in range(200)]
    docs += [(700, None, None), (701, None, ""), (702, "long", "short"), (703, "mixed", " ".join(["a b c d e f g h"] * 10))]
    return docs


def test_kept_on_lines_of_any_length(rows):
    docs = hosts()
    frame = rows(docs, "doc_id bigint, source string, text string")
    got = {r.doc_id: r.kept for r in rules.judge(frame, removed=False).select("doc_id", "kept").collect()}
    want = dict(zip([d[0] for d in docs], brute.kept_by_rules([d[1:] for d in docs]), strict=True))
    assert got == want and 60 < sum(want.values()) < 350
    assert {r.doc_id: r.kept for r in rules.judge(frame).collect()} == want


def test_rules_twin_states_the_same_rule(rows):
    docs = hosts(5)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    found = rules.judge(rows(docs, "doc_id bigint, source string, text string"), removed=False).select(*columns)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", docs)
    twin = con.execute(QUALITY_RULES)
    names = [d[0] for d in twin.description]
    assert normalised(columns, [tuple(r) for r in found.collect()]) == normalised(names, twin.fetchall())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_url_verdicts_of_blocked_hosts(rows, seed):
    draw = random.Random(seed)
    pages = []
    for host in ("a.com", "b.org", "c.net"):
        for _ in range(500):
            section = draw.choice(["news", "spam", "blog", f"user{draw.randint(1, 30)}", draw.choice("pqrstuvwxyz") * 3])
            path = f"/{section}/{draw.choice(['x', 'y', str(draw.randint(1, 99)), 'slug' + draw.choice('abcdefgh')])}" + draw.choice(["", "/deep", f"/{draw.randint(1, 9)}/end"])
            bad = section == "spam" or (host == "b.org" and "slug" in path) or (host == "c.net" and path.endswith("/deep"))
            label = None if draw.random() < 0.4 else int(draw.random() > (0.92 if bad else 0.05))
            pages.append((host, path, label))
    data = [(i, f"http://{h}{p}", y) for i, (h, p, y) in enumerate(pages)]
    got = {r.page_id: r.verdict for r in urls.judge_urls(rows(data, "page_id bigint, url string, good int")).collect()}
    want = brute.url_verdicts(pages)
    assert [got[i] for i in range(len(pages))] == want
    assert 100 < want.count("block") < len(want) - 100


def test_ids_of_added_tokens(rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(TOKENIZER)
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}", f"{end} starts", f"ends {end}", f"a  {end}  b\n{end}", "<|endoftext", f"x<|{end}|>", "plain", "", " " * 9 + end]
    cut = packing.pieces(rows(list(enumerate(texts)), "doc_id bigint, text string"), TOKENIZER, keep_ids=True).collect()
    got = {r.doc_id: list(r.ids) for r in cut}
    assert got == {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}


def test_rows_of_one_key_are_one_document(rows):
    one, two, other = ("word%d " * 9 % tuple(range(k, k + 9)) for k in (0, 20, 40))
    docs = [(3, one), (5, one), (5, two), (7, two), (8, other), (9, other), (9, None), (None, one), (None, other), (10, "short text"), (10, "other words")]
    got = sorted(((r.doc_id or 0, r.component_id or 0, r.kept) for r in neardup.near_groups(rows(docs, "doc_id bigint, text string")).collect()))
    assert got == sorted([(3, 3, True), (5, 3, False), (5, 3, False), (7, 3, False), (8, 8, True), (9, 8, False), (9, 9, True), (0, 3, False), (0, 8, False), (10, 10, True), (10, 10, True)])


def test_operators_work_when_called_directly(tmp_path):
    """Workers find the library although neither a query nor a reader was called before."""
    code = f"""
import sys; sys.path.insert(0, {str(Path(__file__).resolve().parents[2])!r})
from tidewire.session import build_session
from tidewire.llm import packing, sharding
spark = build_session("direct", "local[1]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "1"}})
spark.sparkContext.setLogLevel("ERROR")
df = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id bigint, text string")
print(packing.pack_documents(df, {TOKENIZER!r}).count() + sharding.assign_shards(df).count())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=200, check=False)
    assert done.stdout.strip().endswith("4"), done.stderr[-2000:]
