"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from coverloom.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

ORACLE = {
    "op1_quality_rules": f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM d
), g AS (
  SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1))) AS i FROM w)
), r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g), range(5) AS x(k)
  WHERE c > 1 GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_shouts,
         len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS n_stop,
         len(ls) AS n_lines,
         len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…) *$'))) AS n_ellipsis,
         len(list_filter(ls, lambda x: regexp_matches(x, '^ *[-*•]'))) AS n_bullets
  FROM w LEFT JOIN r USING (doc_id)
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
  AND word_chars / n_words BETWEEN 2.0 AND 14.0
  AND n_symbols / n_words <= 0.25
  AND n_shouts / n_words <= 0.5
  AND (n_words < 40 OR n_stop / n_words >= 0.04)
  AND n_dup_lines / n_lines <= 0.3
  AND n_ellipsis / n_lines <= 0.3
  AND n_bullets / n_lines <= 0.9 AS kept
FROM b
""",
    "op2_ngram_join": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), inter AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS MATERIALIZED (
  SELECT x, y FROM inter JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.y FROM reach r JOIN e ON e.x = r.y
), m AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.c, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN m ON m.x = w.doc_id
""",
    "op3_url_filter": """
WITH r AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), p AS (
  SELECT page_id, rest, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|gclid|fbclid)(=|$)'))) AS params
  FROM r
), c AS (
  SELECT page_id, host, path, CASE WHEN rest IS NOT NULL THEN
      regexp_replace(regexp_replace(host, '^(www|m)\\.', ''), ':(80|443)$', '')
      || regexp_replace(regexp_replace(path, '/index\\.html?$', ''), '/+$', '')
      || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canon
  FROM p
), l AS (
  SELECT DISTINCT canon FROM c WHERE page_id % 50 = 0 AND canon <> ''
), f AS (
  SELECT page_id, host, path, CASE
      WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
      WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
      WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
      WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
      WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule,
    canon IN (SELECT canon FROM l) AS listed
  FROM c
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM f
""",
    "op4_decontamination": """
WITH lowered AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), w AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM lowered
), win AS (
  SELECT DISTINCT id AS item, least(len(ws), 10) AS n, array_to_string(ws[i:i+9], ' ') AS phrase
  FROM (SELECT id, ws, unnest(range(1, greatest(len(ws) - 8, 2))) AS i FROM w WHERE kind = 'b' AND len(ws) > 0)
), sizes AS (SELECT DISTINCT n FROM win
), grams AS (
  SELECT id, n, i, array_to_string(ws[i:i+n-1], ' ') AS phrase
  FROM (SELECT id, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM w, sizes WHERE kind = 'd' AND len(ws) >= n)
), hit AS (
  SELECT DISTINCT g.id, g.i, g.n, win.item FROM grams g JOIN win ON g.n = win.n AND g.phrase = win.phrase
), cov AS (
  SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY id
), b AS (
  SELECT row_number() OVER () AS v, terms FROM (SELECT DISTINCT ws[i:i+9] AS terms FROM (SELECT ws, unnest(range(1, greatest(len(ws) - 8, 2))) AS i FROM w WHERE kind = 'b' AND len(ws) > 0))
), offs AS (
  SELECT v, off, terms[off] AS term FROM (SELECT v, terms, unnest(range(1, len(terms) + 1)) AS off FROM b)
), tok AS MATERIALIZED (
  SELECT id, pos, ws[pos] AS term FROM (SELECT id, ws, unnest(range(1, len(ws) + 1)) AS pos FROM w WHERE kind = 'd') WHERE ws[pos] IN (SELECT term FROM offs)
), ranked AS (
  SELECT v, offs.term, row_number() OVER (PARTITION BY v ORDER BY coalesce(df, 0), off) AS k FROM offs LEFT JOIN (SELECT term, count(*) AS df FROM tok GROUP BY term) x ON x.term = offs.term
), pairs AS (
  SELECT DISTINCT x.term AS a, y.term AS b FROM ranked x JOIN ranked y ON x.v = y.v AND x.k = 1 AND y.k = 2
), near AS (
  SELECT id, count(DISTINCT (a, b)) AS n_near
  FROM (SELECT p.id, pairs.a, pairs.b FROM tok p JOIN pairs ON pairs.a = p.term JOIN tok q ON q.id = p.id AND q.term = pairs.b AND q.pos <> p.pos AND abs(q.pos - p.pos) <= 9) GROUP BY id
), its AS (
  SELECT id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item::VARCHAR, ',' ORDER BY item::VARCHAR) AS items FROM hit GROUP BY id
)
SELECT w.id AS doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM w LEFT JOIN cov ON w.id = cov.id LEFT JOIN its ON w.id = its.id LEFT JOIN near ON w.id = near.id WHERE kind = 'd'
""",
    # what is stored and read back through the manifest; places of rows aren't for SQL
    "op6_sharding": "SELECT doc_id, octet_length(encode(text))::BIGINT AS n_bytes, sha256(text) AS text_sha256, true AS live FROM documents",
    # texts as hexadecimal digits, two for each byte
    "op10_suffix_dedup": """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS g FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d)
), c AS (
  SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM w) WHERE k > 1
), o AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM c
), s AS (
  SELECT doc_id, min(i) AS s, max(i) + 100 AS e FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM o) GROUP BY doc_id, run
), p AS (
  SELECT d.doc_id, h, s, coalesce(lag(e) OVER (PARTITION BY d.doc_id ORDER BY s), 0) AS b FROM d JOIN s ON s.doc_id = d.doc_id
), k AS (
  SELECT doc_id, string_agg(substr(h, 2 * b + 1, 2 * (s - b)), '' ORDER BY s) AS kept FROM p GROUP BY doc_id
), t AS (
  SELECT doc_id, sum(e - s)::BIGINT AS n_removed, count(*) AS n_spans, max(e) AS last FROM s GROUP BY doc_id
)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t ON t.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
""",
    "op11_merkle_manifest": """
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) ORDER BY b) AS tab FROM range(256) AS x(b)
), e AS (
  SELECT row_number() OVER () AS r, doc_id, lang, n_chars,
         coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS before,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS behind,
         CASE WHEN xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, x: xor(c // 256, tab[xor(c, x) % 256 + 1]), 4294967295), 4294967295) % 7 = 0
              THEN n_chars + 1 ELSE n_chars END AS changed
  FROM documents, crc
), l AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM (SELECT r, doc_id, coalesce(lang, '') || (lang IS NULL) AS t, lang,
               sha256(before || coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') || behind) AS leaf,
               sha256(before || coalesce(length(changed::VARCHAR) || ':' || changed, '-') || behind) AS claimed FROM e)
), lev AS (
  SELECT t, 0 AS k, i, leaf AS h FROM l
  UNION ALL
  SELECT t, k + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER (PARTITION BY t) AS n FROM lev) WHERE n > 1 GROUP BY t, k, i // 2
), sub AS (
  SELECT t, max(k) AS depth, arg_max(h, k) AS subroot, row_number() OVER (ORDER BY any_value(lang) NULLS FIRST) - 1 AS g FROM lev JOIN (SELECT DISTINCT t, lang FROM l) USING (t) GROUP BY t
), up AS (
  SELECT 0 AS k, g AS i, subroot AS h FROM sub
  UNION ALL
  SELECT k + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS n FROM up) WHERE n > 1 GROUP BY k, i // 2
), whole AS (SELECT max(k) AS depth, arg_max(h, k) AS root FROM up
), places AS (
  SELECT r, x.k, x.i % 2 AS odd, s.h
  FROM (SELECT r, t, k, i // (1 << k) AS i FROM (SELECT r, t, i, unnest(range(depth)) AS k FROM l JOIN sub USING (t))) x LEFT JOIN lev s ON s.t = x.t AND s.k = x.k AND s.i = xor(x.i, 1)
  UNION ALL
  SELECT r, x.k + 1000, x.i % 2, u.h
  FROM (SELECT r, k, g // (1 << k) AS i FROM (SELECT r, g, unnest(range(whole.depth)) AS k FROM l JOIN sub USING (t), whole)) x LEFT JOIN up u ON u.k = x.k AND u.i = xor(x.i, 1)
), p AS MATERIALIZED (
  SELECT r, list(struct_pack(a := CASE WHEN odd = 1 THEN coalesce(h, '') ELSE '' END, b := CASE WHEN odd = 0 THEN coalesce(h, '') ELSE '' END) ORDER BY k) AS s,
         string_agg(coalesce(h, ''), '' ORDER BY k) AS all_of FROM places GROUP BY r
), f AS (
  SELECT l.r, 0 AS k, claimed AS acc, coalesce(len(s), 0) AS n, s FROM l LEFT JOIN p ON p.r = l.r
  UNION ALL
  SELECT r, k + 1, sha256(s[k + 1].a || acc || s[k + 1].b), n, s FROM f WHERE k < n
)
SELECT l.doc_id, leaf, subroot, root, sha256(coalesce(all_of, '')) AS proof_sha256, acc AS folded_root, acc = root AS verified
FROM l JOIN sub USING (t) CROSS JOIN whole JOIN f ON f.r = l.r AND f.k = f.n LEFT JOIN p ON p.r = l.r
""",
    "op12_line_dedup": """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT r, doc_id, i, ls[i] AS line, translate(trim(ls[i], concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)
), c AS (
  SELECT key, max(doc_id) AS last FROM (SELECT DISTINCT r, doc_id, key FROM l WHERE length(key) >= 20) GROUP BY key HAVING count(*) >= 3
), k AS (
  SELECT r, doc_id, i, line, c.key IS NOT NULL AND doc_id IS DISTINCT FROM c.last AS gone FROM l LEFT JOIN c ON c.key = l.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM k GROUP BY r
""",
    "op13_collocations": """
WITH p AS (
  SELECT row_number() OVER () AS r, lang, ws FROM (
    SELECT lang, regexp_extract_all(unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS ws
    FROM (SELECT text, coalesce(lang, 'und') AS lang FROM documents))
), w AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM p
), total AS (SELECT lang, count(*) AS n FROM w GROUP BY lang
), f AS MATERIALIZED (
  SELECT lang, k, array_to_string(ws[i:i+k-1], ' ') AS phrase, count(*) AS a FROM w, range(1, 6) AS x(k) WHERE i + k - 1 <= len(ws) GROUP BY ALL HAVING count(*) >= 100
), c AS MATERIALIZED (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1
), parts AS (
  SELECT DISTINCT lang, a, array_to_string(ws[i:i+j-1], ' ') AS phrase FROM c, range(1, 5) AS x(i), range(2, 5) AS y(j) WHERE j < k AND i + j - 1 <= k
), alone AS (
  SELECT c.* FROM c ANTI JOIN parts ON c.lang = parts.lang AND c.phrase = parts.phrase AND parts.a >= c.a
), cuts AS (
  SELECT lang, phrase, a, j, array_to_string(ws[1:j], ' ') AS x, array_to_string(ws[j+1:], ' ') AS y FROM alone, range(1, 5) AS z(j) WHERE j < k
), s AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, j, l.a AS l, r.a AS r, n, (1000::HUGEINT * cuts.a * n) // (l.a::HUGEINT * r.a) AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = x JOIN f r ON r.lang = cuts.lang AND r.phrase = y JOIN total ON total.lang = cuts.lang
), best AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000
""",
}
