"""SQL beside the registered queries, where SQL can express them."""

ORACLES: dict[str, str] = {}

ORACLES["op8_line_dedup"] = """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
cut AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split),
lines AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM cut),
firsts AS (SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10 GROUP BY key),
judged AS (SELECT l.*, f.first IS NULL OR f.first = l.doc_id AS stays FROM lines l LEFT JOIN firsts f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_HELD = r"""
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
cut AS (
  SELECT side, id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM texts WHERE text IS NOT NULL),
shingles AS (
  SELECT DISTINCT side, id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM cut WHERE len(w) >= 5),
sizes AS (SELECT id AS item_id, count(*) AS n_item FROM shingles WHERE side = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, any_value(n_item) AS n_item,
       count(*) / any_value(n_item) AS containment
FROM shingles d JOIN shingles i ON d.s = i.s AND d.side = 'd' AND i.side = 'i' JOIN sizes ON item_id = i.id
GROUP BY d.id, i.id HAVING count(*) >= 0.8 * any_value(n_item)
"""
ORACLES["op9_benchmark_items"] = _HELD

ORACLES["op6_passage_dedup"] = r"""
WITH cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS pos,
         unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS s
  FROM cut WHERE len(w) >= 13),
firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos
  FROM windows JOIN firsts USING (s) WHERE doc_id > first),
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM cut),
judged AS (SELECT p.*, g.pos IS NULL AS stays FROM placed p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.pos = p.pos),
sums AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (NOT stays) AS n_removed,
         string_agg(word, ' ' ORDER BY pos) FILTER (stays) AS left_text
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(left_text, '')) AS kept_sha256
FROM documents d LEFT JOIN sums USING (doc_id)
"""
