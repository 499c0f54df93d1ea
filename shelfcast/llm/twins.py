"""SQL twins of the trie, the archive and the spelling variants."""

# crc32 of a list of bytes, by a table made from the polynomial (0xEDB88320).
CRC_TABLE = """
table_of AS (
  SELECT list(list_reduce(list_prepend(CAST(i AS BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
)"""


def _crc(value: str) -> str:
    """Of a text, where the list ``t`` is at hand."""
    pair = f"'0x' || substr(hex(encode({value})), CAST(2 * i + 1 AS BIGINT), 2)"
    said = f"list_transform(range(strlen({value})), lambda i: CAST({pair} AS BIGINT))"
    return (
        f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {said}), "
        "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
    )


TRIE_SQL = f"""
WITH {CRC_TABLE}, own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 's': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), hashed AS (
  SELECT conv_id, turns, {_crc("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM own, table_of
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(list_slice(b.turns, 1, c.h), []),
    list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
), steps AS (
  SELECT conv_id, d, list_slice(turns, 1, d) AS way, d = len(turns) AS ends
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT way, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(way[d].s) END AS own_saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
      FILTER (WHERE ends), '')) AS ends_sha256
  FROM steps GROUP BY way, d
), parents AS (
  SELECT n.way, n.d, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.way = list_slice(n.way, 1, n.d - 1)
), children AS (
  SELECT list_slice(way, 1, d - 1) AS way, d - 1 AS d, count(*) AS n_children
  FROM nodes WHERE d > 0 GROUP BY ALL
), totals AS (
  SELECT list_slice(way, 1, a) AS way, a AS d, count(*) FILTER (WHERE leaf) AS n_leaves,
    sum(own_saved) AS saved_tokens
  FROM (SELECT n.way, n.own_saved, c.d IS NULL AS leaf, unnest(range(0, n.d + 1)) AS a
    FROM nodes n LEFT JOIN children c ON c.way = n.way AND c.d = n.d)
  GROUP BY ALL
)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM nodes JOIN parents USING (way, d) JOIN totals USING (way, d) LEFT JOIN children USING (way, d)
"""

_BASE32 = " || ".join(
    f"to_base(CAST('0x' || substr(sha, {at}, 5) AS BIGINT), 32, 4)" for at in range(1, 41, 5)
)
ARCHIVE_SQL = f"""
SELECT page_id, strlen(body) AS payload_bytes,
  translate({_BASE32}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')
    AS payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM (SELECT page_id, body, sha1(body) AS sha, max(page_id) OVER (PARTITION BY body) AS newest
  FROM (SELECT page_id, coalesce(html, '') AS body FROM pages))
"""

SPELLING_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents
), hashed AS (
  SELECT run, CAST({_crc("said")} AS BIGINT) AS h
  FROM (SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS said FROM runs
    WHERE length(run) >= 7), table_of
), spelt AS (
  SELECT CASE WHEN h % 31 = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM hashed
), words AS (
  SELECT word, count(*) AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
), found AS (
  SELECT a.word, b.word AS near, b.n AS near_n
  FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON w.word = l.rest
  UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON w.word = l.rest
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near,
    max(near_n) AS near_n
  FROM found GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN near_n >= 10 * w.n THEN near END AS form,
    CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), way AS (
  SELECT word, word AS here, 0 AS step FROM words
  UNION ALL SELECT way.word, form, step + 1 FROM way JOIN formed ON way.here = formed.word
  WHERE form IS NOT NULL
)
SELECT f.word, form, root, n, n_near, form_n
FROM formed f JOIN (SELECT word, arg_max(here, step) AS root FROM way GROUP BY word) r USING (word)
"""
