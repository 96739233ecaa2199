"""SQL for the text queries whose results it can state over whole tables.

Each says what the query must return, the plain way: every window and every pair of texts
that share a shingle. The other queries rest on trained models, tokenizers or files.
"""

from __future__ import annotations

WORDS = r"'[^\x20\x09-\x0D]+'"

# Connected components of the links between all texts that share a shingle of three words.
NEAR_DUPLICATES = f"""WITH RECURSIVE told AS (
  SELECT doc_id, row_number() OVER () AS line, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORDS}) AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT line, array_to_string(words[i : i + 2], ' ') AS shingle
  FROM told, unnest(range(1, greatest(len(words) - 1, 2))) AS t(i) WHERE len(words) > 0),
sizes AS (SELECT line, count(*) AS n FROM shingles GROUP BY line),
shared AS (
  SELECT a.line AS one, b.line AS two, count(*) AS common
  FROM shingles a JOIN shingles b USING (shingle) WHERE a.line < b.line GROUP BY a.line, b.line),
links AS (
  SELECT one, two FROM shared JOIN sizes x ON x.line = one JOIN sizes y ON y.line = two
  WHERE 100 * common >= 85 * (x.n + y.n - common)),
edges AS (SELECT one, two FROM links UNION ALL SELECT two, one FROM links),
reached AS (
  SELECT line, line AS other FROM told
  UNION SELECT r.line, e.two FROM reached r JOIN edges e ON e.one = r.other),
least AS (
  SELECT r.line, min(t.doc_id) AS component_id FROM reached r JOIN told t ON t.line = r.other GROUP BY r.line)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM told LEFT JOIN sizes USING (line) JOIN least USING (line)"""

# Every window of 35 words that starts twice.
REPEATED_PASSAGES = f"""WITH told AS (
  SELECT doc_id, row_number() OVER () AS line, regexp_extract_all(coalesce(text, ''), {WORDS}) AS words
  FROM documents),
windows AS (
  SELECT line, i, sha256(array_to_string(words[i : i + 34], ' ')) AS held
  FROM told, unnest(range(1, len(words) - 33)) AS t(i) WHERE len(words) >= 35),
repeated AS (SELECT held FROM windows GROUP BY held HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT line, i + step AS place FROM windows JOIN repeated USING (held), range(35) AS s(step)),
numbered AS (
  SELECT line, i AS place, words[i] AS word FROM told, unnest(range(1, len(words) + 1)) AS t(i)),
left_over AS (
  SELECT line, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS kept
  FROM numbered ANTI JOIN covered USING (line, place) GROUP BY line)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM told LEFT JOIN left_over USING (line)"""

# Captures and list entries follow from the pages; an entry is in force from the day it is
# added to the day it is removed, and of those in force the longest key decides.
URL_LISTS = r"""WITH bare AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 7) % 365 AS INTEGER) AS day,
    regexp_replace(regexp_replace(trim(url, ' '), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '[?#].*$', '') AS rest
  FROM pages),
parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_replace(
      split_part(rest, '/', 1), '^.*@', '')), ':[0-9]*$', ''), '^www[.]', '') AS host,
    regexp_replace(regexp_extract(rest, '(/.*)$', 1), '/+$', '') AS path FROM bare),
captures AS (
  SELECT page_id, url, day, CASE WHEN host <> '' THEN host || path END AS normal,
    CASE WHEN host <> '' THEN host END AS host FROM parts),
hosts AS (SELECT host AS key, min(page_id) AS n FROM captures GROUP BY host HAVING min(page_id) % 3 = 0),
entries AS (
  SELECT key, 'add' AS action, n % 200 AS after, 'spam' AS reason FROM hosts
  UNION ALL SELECT key, 'remove', n % 200 + 60, 'spam' FROM hosts
  UNION ALL SELECT key, 'add', n % 200 + 120, 'malware' FROM hosts WHERE n % 2 = 0
  UNION ALL SELECT 'url:' || normal, 'add', page_id % 300, 'removed on request' FROM captures
    WHERE page_id % 5 = 1),
daily AS (
  SELECT key, DATE '2024-01-01' + CAST(after AS INTEGER) AS day, max(action || ':' || reason) AS change
  FROM entries WHERE key IS NOT NULL GROUP BY ALL),
states AS (
  SELECT key, day AS valid_from, split_part(change, ':', 1) AS action, split_part(change, ':', 2) AS reason,
    lag(split_part(change, ':', 1)) OVER (PARTITION BY key ORDER BY day) AS was FROM daily),
turns AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY key ORDER BY valid_from) AS valid_to FROM states
  WHERE action IS DISTINCT FROM coalesce(was, 'remove')),
wanted AS (
  SELECT page_id, day, 'url:' || normal AS key, 1 << 30 AS size FROM captures WHERE normal IS NOT NULL
  UNION ALL SELECT page_id, day, array_to_string(names[i :], '.'), length(array_to_string(names[i :], '.'))
  FROM (SELECT page_id, day, string_split(host, '.') AS names FROM captures WHERE host IS NOT NULL),
    unnest(range(1, len(names) + 1)) AS t(i)),
hits AS (
  SELECT page_id, max_by(struct_pack(key := w.key, valid_from := valid_from, reason := reason), (size, w.key)) AS hit
  FROM wanted w JOIN turns t ON t.key = w.key AND action = 'add' AND w.day >= valid_from
    AND (valid_to IS NULL OR w.day < valid_to)
  GROUP BY page_id)
SELECT c.page_id AS capture_id, url, day, hit IS NOT NULL AS blocked, hit.key AS matched_key,
  hit.valid_from AS valid_from, hit.reason AS reason
FROM captures c LEFT JOIN hits USING (page_id)"""

ORACLES: dict[str, str] = {
    "op4_near_duplicates": NEAR_DUPLICATES,
    "op6_url_lists": URL_LISTS,
    "op9_repeated_passages": REPEATED_PASSAGES,
}
