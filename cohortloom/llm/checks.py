"""SQL over whole tables for the queries that SQL can express; every list and threshold is spelled out."""

from __future__ import annotations

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), s AS (
  SELECT *, len(regexp_extract_all(text, '###|</turn>')) AS marks,
    4 + length(role) + len(regexp_extract_all(role, '[\:\n]')) + 2 + length(text) + 9 AS plain
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(plain + marks) AS BIGINT) AS formatted_chars,
  count(*) FILTER (marks > 0) AS n_escaped
FROM s GROUP BY conv_id
"""

LINES = r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS n FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), shared AS (
  SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) <> max(doc_id)
), m AS (
  SELECT k.*, coalesce(first <> doc_id, false) AS gone FROM k LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

QUALITY = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), grams AS (
  SELECT doc_id, i, array_to_string(words[i : i + 4], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d)
), twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM grams) WHERE times > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), c AS (
  SELECT d.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(lines.dup, 0) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines,
    len(list_filter(words, lambda w: list_contains([
      'the', 'of', 'and', 'to', 'a', 'in', 'is', 'that', 'it', 'for', 'on', 'was', 'with', 'as', 'be', 'this', 'by',
      'are', 'at', 'from', 'not', 'or', 'have', 'but', 'de', 'la', 'le', 'et', 'les', 'des', 'en', 'un', 'du', 'une',
      'que', 'est', 'pour', 'qui', 'dans', 'au', 'par', 'pas', 'sur', 'avec', 'ne', 'ce', 'il', 'der', 'die', 'und',
      'den', 'von', 'zu', 'das', 'mit', 'sich', 'auf', 'für', 'ist', 'nicht', 'im', 'dem', 'ein', 'als', 'eine', 'auch',
      'wie', 'el', 'y', 'los', 'se', 'del', 'las', 'con', 'no', 'una', 'su', 'para', 'es', 'al', 'lo', 'como', 'más',
      'o'], w))) AS n_stop
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
), f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / greatest(n_words, 1) BETWEEN 1.5 AND 20 AND n_symbols / greatest(n_words, 1) <= 0.2
  AND (n_words < 50 OR n_stop / greatest(n_words, 1) >= 0.02) AND n_dup_lines / greatest(n_lines, 1) <= 0.5 AS kept
FROM f
"""

MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id::VARCHAR) AS h FROM documents
), u AS (
  SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
    list_transform([1, 9, 17, 25], lambda k: ('0x' || substr(h, k, 8))::BIGINT) AS hs FROM d
), c AS (
  SELECT *, len(units) AS n, least(hs[1] % (len(units) + 1), hs[2] % (len(units) + 1)) AS a,
    greatest(hs[1] % (len(units) + 1), hs[2] % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR regexp_matches(text, '<P>|<S>|<M>') OR hs[3] % 100 >= 90 THEN 'plain'
      WHEN hs[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u
), p AS (
  SELECT *, array_to_string(units[1 : a], '') AS prefix, array_to_string(units[a + 1 : b], '') AS middle,
    array_to_string(units[b + 1 :], '') AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

# Pages of the given tables mark their article and hold h1, p, b and br inside it.
MAIN_TEXT = r"""
WITH a AS (
  SELECT page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'),
    '</?(?:p|h1)>') AS blocks FROM pages
), b AS (
  SELECT page_id, url, list_transform(blocks, lambda x: trim(regexp_replace(replace(regexp_replace(regexp_replace(
    regexp_replace(regexp_replace(replace(regexp_replace(x, '</?b>', '', 'g'), '<br>', ' '), '&lt;?', '<', 'g'), '&gt;?',
    '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), chr(10), ' '), '\s+', ' ', 'g'))) AS blocks FROM a
)
SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10) || chr(10)) AS text,
  length(array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10) || chr(10))) AS n_chars
FROM b
"""

ORACLE_SQL: dict[str, str] = {
    "op2_chat_format": CHAT,
    "op9_line_dedup": LINES,
    "op10_quality_rules": QUALITY,
    "op11_fill_middle": MIDDLE,
    "op13_main_text": MAIN_TEXT,
}
