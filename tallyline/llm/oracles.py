"""SQL counterparts (DuckDB) of the operators that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _folded(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


RANKED_SEARCH = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_folded("coalesce(text, '')")} AS t FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id, {_folded("coalesce(text, '')")} AS t FROM benchmark),
words AS (SELECT r, unnest(regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
asked AS (
    SELECT i, term, count(*) AS times
    FROM (SELECT i, unnest(regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM items) GROUP BY i, term),
tf AS (SELECT r, term, count(*) AS tf FROM words GROUP BY r, term),
lengths AS (SELECT r, count(*) AS n FROM words GROUP BY r),
sizes AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf, sizes WHERE term IN (SELECT term FROM asked) GROUP BY term, n_docs),
scored AS (
    SELECT i, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (r), sizes GROUP BY i, r),
ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank, doc_id, score
    FROM scored JOIN items USING (i) JOIN docs USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

DIVERGENCE = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_folded("coalesce(text, '')")} AS t
    FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT lang, source, coalesce(CAST(sum(n) AS BIGINT), 0) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
shares AS (
    SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000 * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p
    FROM totals JOIN sizes USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
whole AS (
    SELECT lang, term, 1 + (1000000000 * (sum(n) + 5)) // ((SELECT sum(total) FROM totals WHERE totals.lang = shares.lang) + 5 * any_value(v)) AS q
    FROM shares JOIN sizes USING (lang) GROUP BY lang, term),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

LINE_DEDUP = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
cut AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM docs),
keyed AS (SELECT *, {_folded("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM cut),
frequent AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
marked AS (SELECT r, doc_id, line, place, frequent.key IS NOT NULL AS gone FROM keyed LEFT JOIN frequent USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""

ORACLES = {
    "op11_ranked_search": RANKED_SEARCH,
    "op12_divergence": DIVERGENCE,
    "op13_line_dedup": LINE_DEDUP,
}
