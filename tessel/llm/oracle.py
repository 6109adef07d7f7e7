"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op6_quality_rules"] = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
runs AS (
  SELECT r, i, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM runs),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice WHERE n > 1) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
f AS (
  SELECT w.r, doc_id, source, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w JOIN lines USING (r) LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT)::DOUBLE AS x FROM b GROUP BY source),
m AS (SELECT sum(x) / sum(n) AS m, coalesce(var_samp(x / n), 0) AS v FROM h),
p AS (SELECT m, CASE WHEN v > 0 THEN least(1000.0, greatest(1.0, m * (1 - m) / v - 1)) ELSE 1000.0 END AS k FROM m),
s AS (SELECT source, n, m, k, (x + m * k) / (n + k) AS r FROM h, p),
bad AS (SELECT source FROM s WHERE r * (1 - m) >= 2.0 * m * (1 - r) AND r - m > 3.0 * sqrt(r * (1 - r) / (n + k + 1)))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM b.source) AS kept
FROM b
"""

#: A turn is escaped exactly if its text holds an end marker that the parser would meet first.
SQL["op2_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (
  SELECT *, length(regexp_replace(role, '[\\|\n<\[]', 'xxx', 'g')) + length(text) + 11 + CASE WHEN role = 'assistant' THEN 0 ELSE 13 END
    + CASE WHEN contains(text, '</s>') OR (role <> 'assistant' AND contains(text, '[/INST]')) THEN len(regexp_extract_all(text, '[<\[]\\*/?(?:s>|INST\])')) ELSE 0 END AS size FROM t)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(size)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""

#: crc32 by its table, byte by byte; words at distance one meet in what is left when a letter goes.
SQL["op13_spelling"] = r"""
WITH RECURSIVE tbl AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i)),
o AS (
  SELECT doc_id, run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) GROUP BY ALL),
x AS (SELECT *, hex(encode(concat(doc_id, ':', run))) AS s FROM o),
c AS (
  SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s), 2), lambda i: ('0x' || substr(s, i, 2))::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h FROM x, tbl),
w AS (
  SELECT word, sum(k)::BIGINT AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN concat(substr(run, 1, (h % length(run))::INT), substr(run, (h % length(run))::INT + 2)) ELSE run END AS word, k FROM c)
  GROUP BY word HAVING sum(k) >= 5 AND length(word) >= 6),
d AS (SELECT word, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1))::INT AS i FROM w)),
p AS (
  SELECT a.word, b.word AS other FROM d a JOIN d b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT d.word, w.word FROM d JOIN w ON d.rest = w.word
  UNION SELECT w.word, d.word FROM d JOIN w ON d.rest = w.word),
b AS (SELECT p.word, count(*) AS n_near, min_by(other, (-w.n, encode(other))) AS best, max(w.n) AS best_n FROM p JOIN w ON p.other = w.word GROUP BY p.word),
f AS (SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form, CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n FROM w LEFT JOIN b USING (word)),
r AS (SELECT word, word AS root, form AS next FROM f UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON r.next = f.word)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM f JOIN r USING (word) WHERE r.next IS NULL
"""
