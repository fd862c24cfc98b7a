"""DuckDB SQL for the queries that SQL can express, with the same columns."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK_WORDS = r"[^\x20\x09-\x0D]+"
ALNUM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(pattern: str, lower: bool) -> str:
    text = "coalesce(text, '')"
    if lower:
        text = f"translate({text}, '{UPPER}', '{LOWER}')"
    return f"regexp_extract_all({text}, '{pattern}')"


JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words(BLANK_WORDS, True)} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:p + least(len(ws), 5) - 1], ' ') AS g
  FROM w, unnest(range(1, len(ws) - least(len(ws), 5) + 2)) AS t(p) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
  FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM i JOIN n AS p ON p.doc_id = x JOIN n AS q ON q.doc_id = y
  WHERE 100 * i >= 75 * (p.n + q.n - i)),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents AS d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""

DECONTAMINATE = f"""
WITH w AS (SELECT doc_id, {_words(ALNUM_WORDS, True)} AS ws FROM documents),
i AS (SELECT item_id, {_words(ALNUM_WORDS, True)} AS ws FROM benchmark),
win AS (
  SELECT item_id, least(len(ws), 13) AS n, array_to_string(ws[p:p + least(len(ws), 13) - 1], ' ') AS g
  FROM i, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS t(p) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT doc_id, p, n, array_to_string(ws[p:p + n - 1], ' ') AS g
  FROM w, sizes, unnest(range(1, len(ws) - n + 2)) AS t(p)),
hit AS (SELECT DISTINCT doc_id, p, n, item_id FROM dw JOIN win USING (n, g)),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hit, unnest(range(p, p + n)) AS t(q) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

RECOMPRESSION = f"""
WITH w AS (SELECT doc_id, {_words(BLANK_WORDS, False)} AS ws FROM documents),
g AS (
  SELECT doc_id, p, md5(array_to_string(ws[p:p + 49], ' ')) AS k
  FROM w, unnest(range(1, len(ws) - 48)) AS t(p)),
m AS (SELECT k, min(doc_id) AS first_id FROM g GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, q FROM g JOIN m USING (k), unnest(range(p, p + 50)) AS t(q) WHERE first_id < doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY q) AS kept
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS q FROM w) ANTI JOIN gone USING (doc_id, q)
  GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(lost.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

#: Base 32 from the hexadecimal digest: five hexadecimal digits are four characters.
_FIVE = "('0x' || substr(h, 5 * k + 1, 5))::BIGINT"
_CHARS = " || ".join(f"substr('{UPPER}234567', (({_FIVE} >> {s}) & 31)::INT + 1, 1)" for s in (15, 10, 5, 0))
WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda k: {_CHARS}), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM p JOIN f USING (h)
"""

STATEMENTS = {"op4_jaccard": JACCARD, "op6_decontaminate": DECONTAMINATE, "op7_warc": WARC,
              "op10_recompression": RECOMPRESSION}
