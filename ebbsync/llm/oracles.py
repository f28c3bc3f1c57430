"""SQL that DuckDB runs on the same tables, for the operators it can express."""

from __future__ import annotations

# Fixed value: a word, in the escapes of DuckDB's expressions.
_WORD = r"[^\x20\x09-\x0D]+"

ORACLES = {}

ORACLES["op2_mix_sources"] = rf"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0) AS size,
    md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))) AS digest,
    greatest(0.05, 1 - 4 * length(regexp_replace(coalesce(text, ''), '[^0-9#*$%&|<>!?]+', '', 'g'))
      / greatest(length(coalesce(text, '')), 1)::DOUBLE) AS quality
  FROM documents),
keyed AS (
  SELECT *, -ln((('0x' || substr(digest, 1, 13))::BIGINT + 1) / 4503599627370496.0::DOUBLE) / quality AS draw FROM docs),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS weight,
    2 * source_size AS full_at, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM totals),
levels AS (
  SELECT *, full_at / weight AS fills_at,
    (budget - coalesce(sum(full_at) OVER (ORDER BY full_at / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / (sum(weight) OVER (ORDER BY full_at / weight, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM weighed),
final AS (SELECT level FROM levels WHERE fills_at > level ORDER BY fills_at, source NULLS LAST LIMIT 1),
aims AS (
  SELECT source, source_size,
    coalesce(least(full_at::DOUBLE, weight * (SELECT level FROM final)), full_at::DOUBLE) AS target FROM levels),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM aims),
equal_rows AS (
  SELECT source, digest, draw, size, count(*) * size AS words FROM keyed GROUP BY source, digest, draw, size),
running AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY draw, digest
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM equal_rows)
SELECT k.doc_id, k.size::BIGINT AS size, k.source, p.source_size, p.target,
  (k.size * (p.epochs + CASE WHEN r.before + r.words / 2 <= p.target - p.epochs * p.source_size
    AND r.words > 0 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM keyed k JOIN planned p ON k.source IS NOT DISTINCT FROM p.source
JOIN running r ON k.source IS NOT DISTINCT FROM r.source AND k.digest = r.digest
"""

ORACLES["op8_decontaminate"] = rf"""
WITH words AS (
  SELECT doc_id, text, regexp_extract_all(text, '{_WORD}') AS w FROM (SELECT DISTINCT doc_id, text FROM documents)),
doc_shingles AS (
  SELECT DISTINCT doc_id, text, list_reduce(['' ] || w[i:i + 4], lambda a, b: a || ' ' || b) AS shingle
  FROM words, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS t(i) WHERE len(w) > 0),
item_words AS (
  SELECT item_id, text, regexp_extract_all(text, '{_WORD}') AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
item_shingles AS (
  SELECT DISTINCT item_id, text, list_reduce([''] || w[i:i + 4], lambda a, b: a || ' ' || b) AS shingle
  FROM item_words, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT item_id, text, count(*) AS n_item FROM item_shingles GROUP BY ALL),
shared AS (
  SELECT d.doc_id, d.text AS doc_text, i.item_id, i.text, count(*) AS n_shared
  FROM doc_shingles d JOIN item_shingles i USING (shingle) GROUP BY ALL)
SELECT DISTINCT doc_id, item_id, n_item, n_shared
FROM shared JOIN sizes USING (item_id, text) WHERE 10 * n_shared >= 8 * n_item
"""

_CANON = r"""
  regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), ':(80|443)$', ''), '^www\.', '')
  || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/$', '')
  || CASE WHEN regexp_extract(bare, '\?(.*)$', 1) = '' THEN ''
     ELSE '?' || array_to_string(list_sort(string_split(regexp_extract(bare, '\?(.*)$', 1), '&')), '&') END"""

ORACLES["op4_revisits"] = rf"""
WITH pages_at AS (
  SELECT page_id, 1700000000 + page_id * 7 AS seen, html,
    regexp_replace(regexp_replace(trim(url, ' '), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages),
visits AS (
  SELECT page_id, seen, html, {_CANON} AS url, '"' || substr(md5(html), 1, 16) || '"' AS etag FROM pages_at),
again AS (
  SELECT page_id, url, seen + 86400 AS seen, CASE WHEN page_id % 10 = 3 THEN '"changed"' ELSE etag END AS etag FROM visits),
latest AS (
  SELECT a.page_id, a.etag, v.page_id AS source, v.etag AS stored, v.html
  FROM again a JOIN visits v ON a.url = v.url AND v.seen < a.seen
  QUALIFY row_number() OVER (PARTITION BY a.page_id ORDER BY v.seen DESC, v.page_id DESC) = 1),
judged AS (SELECT *, etag = stored AS same FROM latest)
SELECT page_id, CASE WHEN same THEN 'resolved' ELSE 'mismatch' END AS status,
  CASE WHEN same THEN source END AS refers_to, 'W/' || etag AS etag,
  CASE WHEN same THEN 'text/html' ELSE 'text/plain' END AS content_type, 'max-age=60' AS cache_control,
  (page_id % 100)::VARCHAR AS age, CASE WHEN same THEN 5 ELSE 4 END::BIGINT AS n_headers,
  CASE WHEN same THEN strlen(html) END AS payload_bytes, CASE WHEN same THEN md5(html) END AS payload_md5
FROM judged
"""

ORACLES["op9_perspectives"] = r"""
WITH plain AS (
  SELECT conv_id, turn,
    replace(replace(coalesce(role, 'unknown'), '<|im_start|>', '<\|im_start|>'), '<|im_end|>', '<\|im_end|>') AS speaker,
    replace(replace(coalesce(text, ''), '<|im_start|>', '<\|im_start|>'), '<|im_end|>', '<\|im_end|>') AS body
  FROM conversations),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, speaker, md5(body)) - 1 AS place FROM plain),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM plain WHERE speaker <> 'system'),
views AS (
  SELECT conv_id, perspective FROM people
  UNION ALL SELECT DISTINCT conv_id, NULL FROM plain
    WHERE NOT EXISTS (FROM people WHERE people.conv_id IS NOT DISTINCT FROM plain.conv_id)),
shown AS (
  SELECT p.conv_id, place, speaker, body, perspective, speaker IS NOT DISTINCT FROM perspective AS own,
    '<|im_start|>' || CASE WHEN speaker IS NOT DISTINCT FROM perspective THEN 'assistant'
      WHEN speaker = 'system' THEN 'system' ELSE 'user:' || speaker END || chr(10) AS head
  FROM ranked p JOIN views v ON p.conv_id IS NOT DISTINCT FROM v.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 11) OVER (PARTITION BY conv_id, perspective
    ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM shown)
SELECT conv_id, perspective, place // 256 AS part, min(pos) AS start, count(*) AS n_turns,
  string_agg(head || body || '<|im_end|>' || chr(10), '' ORDER BY place) AS text,
  coalesce(string_agg((pos + length(head))::VARCHAR || '-' || (pos + length(head) + length(body) + 10)::VARCHAR, ','
    ORDER BY place) FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, perspective, place // 256
"""

ORACLES["op13_filter_audit"] = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    coalesce(regexp_extract_all(text, '{_WORD}'), []) AS words FROM documents),
firsts AS (SELECT text, min(doc_id) AS first_id FROM docs GROUP BY text),
marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    {{'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
      'C': 100 * length(regexp_replace(d.text, '[^A-Z]+', '', 'g')) > 2 * length(d.text),
      'D': regexp_matches(d.text, '[#$%&*|]'), 'E': coalesce(first_id < d.doc_id, false)}} AS f
  FROM docs d JOIN firsts USING (text) LEFT JOIN marks ON marks.doc_id = d.doc_id),
sets AS (
  SELECT part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x WHEN 'A' THEN f.A WHEN 'B' THEN f.B
      WHEN 'C' THEN f.C WHEN 'D' THEN f.D ELSE f.E END) AS fails,
    count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failed GROUP BY ALL),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step::INTEGER AS step, substr(filter_order, step::INTEGER, 1) AS own,
    string_split(substr(filter_order, 1, step::INTEGER - 1), '') AS prior
  FROM orders, range(1, 6) AS r(step)),
applied AS (
  SELECT part, filter_order, step, own, n, good, toxic, len(fails) AS n_fails,
    list_contains(fails, own) AS fails_own, list_has_any(fails, prior) AS gone FROM sets, steps),
counted AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (NOT fails_own AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails_own AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails_own AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails_own AND n_fails = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fails_own AND NOT gone), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (fails_own AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM applied GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted"""
