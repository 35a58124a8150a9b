"""SQL of another engine for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from tidewire.llm import phrases, rules
from tidewire.llm.common import LOWER, UPPER
from tidewire.llm.lines import LEAST_CHARS

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"'[^\x20\x09-\x0D]+'"


def _lower(x: str) -> str:
    return f"translate({x}, '{UPPER}', '{LOWER}')"


LINE_DEDUP = f"""
WITH lines AS (SELECT doc_id, i, string_split(t, chr(10))[i] AS line, n FROM
    (SELECT doc_id, t, len(string_split(t, chr(10))) AS n, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS i
     FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))),
keyed AS (SELECT *, {_lower(f"trim(line, {_BLANKS})")} AS k FROM lines),
shared AS (SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= {LEAST_CHARS} GROUP BY k HAVING min(doc_id) < max(doc_id)),
marked AS (SELECT doc_id, i, line, n, s.k IS NOT NULL AND doc_id > s.first AS dropped FROM keyed LEFT JOIN shared s USING (k))
SELECT doc_id, n AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id, n"""

NEAR_DEDUP = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, {_WORD}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k FROM
    (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT p.x, p.y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2) p
    JOIN n a ON a.doc_id = p.x JOIN n b ON b.doc_id = p.y WHERE 100 * c >= 75 * (a.n + b.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM (SELECT x AS doc_id, min(y) AS c FROM reach GROUP BY x) LEFT JOIN n USING (doc_id)"""

QUALITY_RULES = f"""
WITH d AS (SELECT doc_id, coalesce('h' || source, '') AS host, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + {rules.WINDOW - 1}], ' ') AS k FROM
    (SELECT doc_id, w, unnest(range(1, len(w) - {rules.WINDOW - 2})) AS i FROM d WHERE len(w) >= {rules.WINDOW})),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {rules.WINDOW})) AS p FROM twice) GROUP BY doc_id),
base AS (SELECT doc_id, host, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(list_filter(string_split(t, chr(10)), lambda x: trim(x, {_BLANKS}) <> ''))
      - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: trim(x, {_BLANKS}) <> ''))) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words FROM d LEFT JOIN covered USING (doc_id)),
lines AS (SELECT host, t, k, sum(words) AS words FROM (SELECT host, t, {_lower("l")} AS k, len(regexp_extract_all(l, {_WORD})) AS words FROM
    (SELECT DISTINCT host, t, i, trim(string_split(t, chr(10))[i], {_BLANKS}) AS l FROM
      (SELECT host, t, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS i FROM (SELECT DISTINCT host, t FROM d))) WHERE l <> '') GROUP BY host, t, k),
texts AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY host),
common AS (SELECT host, k FROM (SELECT host, k, count(*) AS c FROM lines GROUP BY host, k) JOIN texts USING (host)
    WHERE c >= {rules.LEAST_TEXTS} AND c >= {rules.SHARE} * n),
gone AS (SELECT host, t, sum(words) AS words FROM lines JOIN common USING (host, k) GROUP BY host, t)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words - words >= {rules.LEFT} * n_words AS kept
FROM (SELECT base.*, coalesce(gone.words, 0) AS words,
    n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED} * n_words AS base_failed
  FROM base LEFT JOIN gone USING (host, t))"""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""

PHRASES = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({_lower("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM
    (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, range(1, {phrases.WORDS} + 1) AS s(m)) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE m = 1 GROUP BY lang),
cand AS (SELECT * FROM grams WHERE m >= 2 AND f >= {phrases.LEAST}),
cuts AS (SELECT lang, m, phrase, f, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS x, array_to_string(string_split(phrase, ' ')[k + 1:m], ' ') AS y
    FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)),
scored AS (SELECT c.lang, c.m, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, n,
    CAST((CAST(1000 AS HUGEINT) * c.f * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.x JOIN grams y ON y.lang = c.lang AND y.phrase = c.y JOIN totals t ON t.lang = c.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
alive AS (SELECT * FROM worst x WHERE NOT EXISTS (SELECT 1 FROM cand y WHERE y.lang = x.lang AND y.m > x.m AND y.f >= x.a
    AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' '))),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank FROM alive)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {phrases.TOP}"""

ORACLES = {
    "op5_line_dedup": LINE_DEDUP,
    "op7_minhash_near_dedup": NEAR_DEDUP,
    "op8_quality_rules": QUALITY_RULES,
    "op10_exact_top_k": TOP_K,
    "op12_phrase_collocations": PHRASES,
}
