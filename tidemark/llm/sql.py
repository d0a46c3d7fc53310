"""SQL that gives the rows of a query by brute force, for the operators that SQL can state."""

_CRC_TABLE = """
crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)
              ORDER BY n) AS tab
  FROM (SELECT unnest(range(256)) AS n))"""


def _crc(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of an expression, with ``tab`` of ``crc_table`` in scope."""
    hexed = f"hex(encode({text}))"
    octets = f"list_transform(range(octet_length(encode({text}))), lambda j: CAST('0x' || substr({hexed}, 2 * j + 1, 2) AS BIGINT))"
    return f"""xor(4294967295, list_reduce({octets},
      lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)]), CAST(4294967295 AS BIGINT)))"""


CASCADE = r"""
WITH given AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
places AS (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i FROM given),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, said) AS n FROM (
    SELECT r, i, list(word) OVER w AS said FROM places WINDOW w AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING))
  WHERE len(said) = 5),
repeats AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM windows WHERE n > 1) GROUP BY r),
measured AS (
  SELECT doc_id, text, words, lines, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         (SELECT CAST(count(*) - count(DISTINCT line) AS BIGINT) FROM (SELECT unnest(lines) AS line)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) AS n_dup_lines,
         coalesce(repeats.n, 0) AS n_repeat_words
  FROM given LEFT JOIN repeats USING (r)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
         OR 100 * n_dup_lines > 50 * len(lines)
         OR 2 * len(regexp_extract_all(text, '\p{Lu}')) > len(regexp_extract_all(text, '\p{L}'))
         OR 5 * len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) > n_words
         OR 2 * len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) < n_words
         OR 5 * len(regexp_extract_all(text, '!')) > n_words
         OR 20 * len(regexp_extract_all(text, '[{}\[\]\\]')) > n_words) AS kept
FROM judged"""

_WORDS = r"""regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

GAINS = f"""
WITH {_CRC_TABLE},
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
placed AS (SELECT r, unnest(words) AS word FROM docs),
wanted AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
known AS (
  SELECT word, {_crc("word")} % 10000 AS bucket
  FROM (SELECT word FROM placed UNION SELECT word FROM wanted), crc_table),
raw AS (SELECT bucket, count(*) AS s FROM placed JOIN known USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM wanted JOIN known USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM placed) AS all_s, (SELECT count(*) FROM wanted) AS all_t),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(all_s + 10000 AS DOUBLE)
                                      / (CAST(s + 1 AS DOUBLE) * CAST(all_t + 10000 AS DOUBLE)))) AS BIGINT) AS g
  FROM raw LEFT JOIN target USING (bucket), sums),
weighed AS (SELECT r, CAST(sum(g) AS BIGINT) AS weight FROM placed JOIN known USING (word) JOIN gain USING (bucket) GROUP BY r),
scored AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000.0 * ln(-ln(
           (CAST(CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS DOUBLE) + 0.5)
           / 4294967296.0))) AS BIGINT) AS score
  FROM docs LEFT JOIN weighed USING (r)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank
FROM ranked"""

DIALOGUE = f"""
WITH RECURSIVE {_CRC_TABLE},
coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place
  FROM conversations),
hit AS (SELECT *, {_crc("place")} % 20 AS code FROM coded, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit),
lined AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE 'whole' END AS kind,
         lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS role_before
  FROM lined),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
         count(*) FILTER (kind = 'blank') AS blank, count(*) FILTER (kind = 'duplicate') AS duplicate,
         count(*) FILTER (kind = 'truncated') AS truncated,
         count(*) FILTER (role_before IS NOT NULL AND left(role_before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
-- states 0 to 3: nothing yet, after a system, a user, an assistant row; k insertions lead from q to p
inserted(q, k, p, rows) AS (VALUES
  (0, 0, 0, []), (1, 0, 1, []), (2, 0, 2, []), (3, 0, 3, []),
  (0, 1, 2, ['user:']), (1, 1, 2, ['user:']), (2, 1, 3, ['assistant:']), (3, 1, 2, ['user:']),
  (0, 2, 3, ['user:', 'assistant:']), (1, 2, 3, ['user:', 'assistant:']), (2, 2, 2, ['assistant:', 'user:']),
  (3, 2, 3, ['user:', 'assistant:'])),
-- edit e takes p to t; a kept row needs the letter, a changed one gets the role
edits(p, e, t, letter, role, cost) AS (VALUES
  (0, 'D', 0, NULL, NULL, 4), (1, 'D', 1, NULL, NULL, 4), (2, 'D', 2, NULL, NULL, 4), (3, 'D', 3, NULL, NULL, 4),
  (0, 'K', 1, 's', NULL, 0), (0, 'K', 2, 'u', NULL, 0), (1, 'K', 2, 'u', NULL, 0), (2, 'K', 3, 'a', NULL, 0),
  (3, 'K', 2, 'u', NULL, 0),
  (0, 'R', 2, NULL, 'user', 3), (1, 'R', 2, NULL, 'user', 3), (2, 'R', 3, NULL, 'assistant', 3), (3, 'R', 2, NULL, 'user', 3)),
paths(conv_id, i, q, cost, audit, rows) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, 0, '', CAST([] AS VARCHAR[]) FROM conversations
  UNION ALL
  SELECT conv_id, i, q, cost, audit, rows FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) AS place FROM (
      SELECT s.conv_id, f.i, d.t AS q,
             s.cost + 3 * a.k + d.cost + CASE WHEN f.kind = 'truncated' AND d.e <> 'D' THEN 3 ELSE 0 END AS cost,
             s.audit || repeat('I', a.k) || d.e AS audit,
             list_concat(list_concat(s.rows, a.rows),
                         CASE d.e WHEN 'D' THEN [] ELSE [coalesce(d.role, f.role) || ':' || f.text] END) AS rows
      FROM paths s JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1
      JOIN inserted a ON a.q = s.q JOIN edits d ON d.p = a.p
      WHERE (d.e = 'D' OR f.kind NOT IN ('blank', 'duplicate')) AND (d.e <> 'K' OR d.letter = left(f.role, 1))))
  WHERE place = 1),
ends AS (
  SELECT s.conv_id, c.n, gaps, blank, duplicate, truncated, illegal, s.cost + 3 * a.k AS cost,
         s.audit || repeat('I', a.k) AS audit, list_concat(s.rows, a.rows) AS rows
  FROM paths s LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id
  JOIN inserted a ON a.q = s.q
  WHERE s.i = coalesce(c.n, 0) AND a.p IN (0, 3)),
best AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS place FROM ends)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(cost AS BIGINT) AS cost, audit,
       sha256(array_to_string(rows, chr(10))) AS repaired_sha256
FROM best WHERE place = 1"""


_FINE = "{0} IS NOT NULL AND len(list_filter({0}, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

TOP_K = f"""
WITH vecs AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings WHERE vec_id IS NOT NULL AND {_FINE.format("embedding")}),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.vec, c.vec) AS BIGINT) AS score
  FROM vecs q JOIN vecs c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec) WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 10"""

# links(a, b) in both directions; every id of nodes(id) gets the smallest id that links reach
_REACHED = """
reached(id, other) AS (
  SELECT id, id FROM nodes UNION SELECT r.id, l.b FROM reached r JOIN links l ON l.a = r.other),
named AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)"""

NEAR_VECTORS = f"""
WITH RECURSIVE vecs AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vec
  FROM embeddings WHERE {_FINE.format("embedding")} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
nodes AS (SELECT vec_id AS id FROM embeddings),
links AS (
  SELECT p.id AS a, q.id AS b FROM vecs p JOIN vecs q ON p.id <> q.id AND len(p.vec) = len(q.vec)
  WHERE list_cosine_similarity(p.vec, q.vec) >= 0.95),
{_REACHED}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id) AS n_links, component_id, id = component_id AS kept
FROM named"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE given AS (
  SELECT doc_id AS id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
sets AS (
  SELECT id, list_distinct(list_transform(
    range(CASE WHEN len(words) = 0 THEN 0 ELSE greatest(1, len(words) - 3) END),
    lambda i: array_to_string(words[i + 1 : i + 4], ' '))) AS shingles FROM given),
nodes AS (SELECT id FROM sets),
placed AS (SELECT id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
common AS (
  SELECT p.id AS a, q.id AS b, count(*) AS joint, p.n + q.n AS n
  FROM placed p JOIN placed q ON p.shingle = q.shingle AND p.id <> q.id GROUP BY p.id, q.id, p.n, q.n),
links AS (SELECT a, b FROM common WHERE 100 * joint >= 80 * (n - joint)),
{_REACHED}
SELECT id AS doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, id = component_id AS kept
FROM sets JOIN named USING (id)"""
