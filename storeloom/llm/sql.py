"""Plain SQL for the queries that it can express, for DuckDB over the same tables."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"[^\x20\x09-\x0D]+"

SQL: dict[str, str] = {}

SQL["op4_jaccard_join"] = rf"""
WITH RECURSIVE
worded AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORDS}') AS w FROM documents),
shingled AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM worded),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM shingled),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS same
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (SELECT x, y FROM shared WHERE 100 * same >= 85 * (nx + ny - same)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (
  SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
  least(doc_id, coalesce((SELECT min(y) FROM reach r WHERE r.x = d.doc_id), doc_id)) AS component_id
FROM shingled d
"""

ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SQL["op10_decontamination"] = rf"""
WITH
docs AS (SELECT doc_id, regexp_extract_all({LOWER}, '{ITEM_WORD}') AS w FROM documents),
tests AS (SELECT item_id, regexp_extract_all({LOWER}, '{ITEM_WORD}') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
    unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1),
      lambda i: array_to_string(w[i:i + 9], ' '))) AS item
  FROM tests WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
runs AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS pos,
    unnest(list_transform(range(1, len(w) - size + 2),
      lambda i: array_to_string(w[i:i + size - 1], ' '))) AS item
  FROM docs, sizes WHERE len(w) >= size),
found AS (SELECT doc_id, item_id, pos, r.size FROM runs r JOIN windows v USING (size, item)),
hits AS (
  SELECT doc_id, count(DISTINCT word) AS n
  FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(i.n, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h USING (doc_id) LEFT JOIN named i USING (doc_id)
"""

SQL["op7_warc_index"] = """
WITH paid AS (
  SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha1(coalesce(html, '')) AS digest FROM pages),
last AS (SELECT digest, max(page_id) AS page FROM paid WHERE bytes >= 1000 GROUP BY digest)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id < page THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < page THEN page END AS refers_to
FROM paid LEFT JOIN last USING (digest)
"""

# The sample dialogues have few turns, so each is one part.
SQL["op5_perspective_chat"] = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS who,
    replace(replace(coalesce(text, ''), '<|im_start|>', '< |im_start|>'),
      '<|im_end|>', '< |im_end|>') || '<|im_end|>' AS body
  FROM conversations),
participants AS (SELECT DISTINCT conv_id AS of, who AS speaker FROM said),
rendered AS (
  SELECT conv_id, turn, speaker, who, body,
    CASE WHEN who = speaker THEN '<|im_start|>assistant' || chr(10)
      ELSE '<|im_start|>user name=' || who || chr(10) END AS head
  FROM said JOIN participants ON conv_id IS NOT DISTINCT FROM of),
placed AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (
    PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, who, body ROWS UNBOUNDED PRECEDING) AS till
  FROM rendered)
SELECT conv_id, CAST(0 AS BIGINT) AS part, speaker, count(*) AS n_turns,
  CAST(sum(length(head) + length(body) + 1) AS BIGINT) AS n_chars,
  sha256(string_agg(head || body || chr(10), '' ORDER BY till)) AS text_sha256,
  string_agg((till - 1 - length(body)) || ':' || (till - 1), ',' ORDER BY till)
    FILTER (WHERE who = speaker) AS mask
FROM placed GROUP BY conv_id, speaker
"""

SQL["op11_substring_dedup"] = rf"""
WITH
worded AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
placed AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM worded),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS pos,
    unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS run
  FROM worded WHERE len(w) >= 13),
earliest AS (SELECT run, min(doc_id) AS owner FROM windows GROUP BY run),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos
  FROM windows JOIN earliest USING (run) WHERE owner < doc_id),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS words
  FROM placed ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (doc_id)
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SQL["op12_lexical_search"] = rf"""
WITH
said AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all({LOWER}, '{TERM}') AS w
  FROM documents),
termed AS (SELECT doc_id, row, CAST(len(w) AS BIGINT) AS n, w FROM said WHERE len(w) > 0),
totals AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM termed),
counts AS (
  SELECT row, any_value(doc_id) AS doc_id, any_value(n) AS n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT row, doc_id, n, unnest(w) AS term FROM termed) GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, CAST(count(*) AS BIGINT) AS df FROM counts GROUP BY term), totals),
asked AS (
  SELECT item_id, term, CAST(count(*) AS BIGINT) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term FROM benchmark)
  GROUP BY item_id, term),
scores AS (
  SELECT item_id, doc_id, row, CAST(sum(times * weight * (
    (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term), totals
  GROUP BY item_id, doc_id, row),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER)
    AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

SQL["op13_hard_negatives"] = """
WITH
usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
met AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    CAST(row_number() OVER (
      PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM met WHERE rank <= 3
"""
