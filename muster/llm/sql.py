"""SQL for DuckDB of the operators that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS pos FROM split
), keys AS (
  SELECT doc_id, pos, lines[pos] AS line,
         translate(regexp_replace(regexp_replace(lines[pos], '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line
), often AS (
  SELECT key FROM keys WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT k.doc_id, count(*) AS n_lines, count(o.key) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN o.key IS NULL THEN k.line END, chr(10) ORDER BY k.pos), '')) AS kept_sha256
FROM keys k LEFT JOIN often o ON k.key = o.key
GROUP BY k.doc_id
"""

OP3 = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, pos, array_to_string(words[pos : pos + 7], ' ') AS w
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 7)) AS pos FROM base WHERE len(words) >= 8)
), repeated AS (
  SELECT doc_id, pos FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest(generate_series(pos, pos + 7)) AS place FROM repeated) GROUP BY doc_id
), measured AS (
  SELECT b.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(regexp_extract_all(text, '\p{Lu}{2,}')) AS n_shouted, len(regexp_extract_all(text, '!+')) AS n_marks
  FROM base b LEFT JOIN covered c USING (doc_id)
), judged AS (
  SELECT *, (n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
    + 8 * (n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines)::INT + 16 * (10 * n_shouted > 3 * n_words)::INT
    + 32 * (10 * n_marks > 3 * n_words)::INT
    + 64 * (word_chars > 20 * n_words OR word_chars < 2 * n_words)::INT AS failed
  FROM measured
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed::BIGINT AS failed
FROM judged
"""

OP6 = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), judged AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
  END AS rule
  FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN regexp_matches(host || path, '(?:^|[^a-z0-9])(?:ad|ads|adserver|banner|banners|popunder|popup|track|tracker|tracking'
              || '|(?:ad|ads|banner|popup|track|tracker|tracking)(?:click|count|engine|frame|iframe|image|pixel|script|serve|server|view|zone)'
              || '|(?:best|big|cheap|easy|free|instant|online|win)[_-]?(?:bets|betting|casino|jackpot|loans|lottery|pills|poker|slots|viagra)'
              || '|(?:bets|betting|casino|jackpot|loans|lottery|pills|poker|slots|viagra)[_-]?(?:best|big|cheap|easy|free|instant|online|win)'
              || ')(?:[^a-z0-9]|$)')
            THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

OP9 = r"""
WITH norm AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY n_chars DESC, doc_id) AS nth,
         count(*) OVER (PARTITION BY body) AS group_size,
         first_value(doc_id) OVER (PARTITION BY body ORDER BY n_chars DESC, doc_id) AS keep_id
  FROM norm
)
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, sha256(body) AS text_sha256 FROM ranked
"""

OP11 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), found AS (
  SELECT d, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT d) >= 3
), langs AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM found JOIN kept k USING (lang, term) GROUP BY ALL
), totals AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL
), shares AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (t.n + l.v) AS p,
    1 + 1000000000::HUGEINT * (k.n + 1) // (l.n + l.v) AS q
  FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM totals a JOIN totals b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 200
"""

OP12 = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT d, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE concat_ws(' ', w[i], w[i + 1], w[i + 2]) END AS s
  FROM (SELECT d, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT d, count(*) AS n FROM shingles GROUP BY d
), common AS (
  SELECT a.d AS a, b.d AS b, count(*) AS m FROM shingles a JOIN shingles b ON a.s = b.s AND a.d <> b.d GROUP BY ALL
), links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.d = c.a JOIN sizes y ON y.d = c.b WHERE 100 * m >= 85 * (x.n + y.n - m)
), reach AS (
  SELECT d AS a, d AS b FROM docs UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(doc_id = component_id, false) AS kept
FROM docs LEFT JOIN sizes USING (d)
JOIN (SELECT r.a AS d, min(o.doc_id) AS component_id FROM reach r JOIN docs o ON o.d = r.b GROUP BY r.a) USING (d)
"""


def statements() -> dict[str, str]:
    return {
        "op1_line_dedup": OP1,
        "op3_quality_rules": OP3,
        "op6_url_filters": OP6,
        "op9_exact_dedup": OP9,
        "op11_source_divergence": OP11,
        "op12_minhash": OP12,
    }
