"""The same results in SQL, where SQL can express them."""

from __future__ import annotations

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 50 = 0 AND len(q.v) = len(c.v)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

WORDS = r"""list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"""

SHINGLE_JOIN = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.format(
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
  )} AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * k >= 85 * (a.n + b.n - k)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
"""

HOST_RULES = rf"""
WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t)
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 8)) AS place
    FROM windows JOIN (SELECT doc_id, words FROM windows GROUP BY ALL HAVING count(*) > 1) USING (doc_id, words)
  ) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), counts AS (
  SELECT t.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         coalesce(l.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM t LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
), hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS f FROM judged WHERE source IS NOT NULL GROUP BY source
), sums AS (
  SELECT sum(n) AS total, sum(f) / sum(n) AS mean, count(*) AS k, sum(f * f / n) AS sq, sum(n * n) AS nn FROM hosts
), fit AS (
  SELECT mean, mean * (1 - mean) AS noise,
         (sq - total * mean * mean - mean * (1 - mean) * (k - 1)) / greatest(1e-9, total - nn / total) AS spread
  FROM sums
), prior AS (
  SELECT greatest(mean * weight, 1e-6) AS a, greatest((1 - mean) * weight, 1e-6) AS b
  FROM (SELECT mean, least(greatest(CASE WHEN spread > 0 THEN noise / spread - 1 ELSE 1e6 END, 1), 1e6) AS weight FROM fit)
), rejected AS (
  SELECT source FROM hosts, prior WHERE (f + a) / (n + a + b) >= 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM rejected)) AS kept
FROM judged
"""

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# Unsigned CRC-32 of an ASCII text, bit by bit.
CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split({}, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)))"""

CONVERSATION_REPAIR = rf"""
WITH RECURSIVE shown AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC32.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS hit
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN hit = 3 THEN 2 ELSE 1 END)) AS copy
  FROM shown WHERE hit <> 0
), placed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), '') AS conv, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS ended
  FROM damaged
), judged AS (
  SELECT *, again AND NOT blank AS duplicate, NOT (blank OR again OR ended) AS truncated,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair
  FROM placed
), counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
         max(place) AS n
  FROM judged GROUP BY conv
), inserts(state, met, added, lines) AS (
  VALUES ('', '', '', ''), ('s', 's', '', ''), ('u', 'u', '', ''), ('a', 'a', '', ''),
         ('', 'u', 'I', chr(10) || 'user:'), ('s', 'u', 'I', chr(10) || 'user:'), ('a', 'u', 'I', chr(10) || 'user:'),
         ('u', 'a', 'I', chr(10) || 'assistant:'),
         ('', 'a', 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
         ('s', 'a', 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
), moves(met, symbol) AS (
  VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')
), edits AS (
  SELECT conv, place, m.met, m.symbol AS after, CASE WHEN truncated THEN 5 ELSE 0 END AS cost, 'K' AS edit, chr(10) || role || ':' || text AS line
  FROM judged JOIN moves m ON m.symbol = initial WHERE NOT blank AND NOT duplicate
  UNION ALL
  SELECT conv, place, m.met, m.symbol, CASE WHEN truncated THEN 6 ELSE 1 END, 'R',
         chr(10) || CASE m.symbol WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text
  FROM judged JOIN moves m ON m.symbol IN ('u', 'a') WHERE NOT blank AND NOT duplicate
  UNION ALL
  SELECT conv, place, met, met, 2, 'D', '' FROM judged, (VALUES (''), ('s'), ('u'), ('a')) AS states(met)
), parse AS (
  SELECT conv, CAST(0 AS BIGINT) AS place, '' AS state, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'talk': ''}} AS best FROM counts
  UNION ALL
  SELECT p.conv, e.place, e.after,
         min({{'cost': p.best.cost + 5 * length(i.added) + e.cost, 'audit': p.best.audit || i.added || e.edit,
              'talk': p.best.talk || i.lines || e.line}})
  FROM parse p JOIN inserts i ON i.state = p.state JOIN edits e ON e.conv = p.conv AND e.place = p.place + 1 AND e.met = i.met
  GROUP BY p.conv, e.place, e.after
), repaired AS (
  SELECT conv, min({{'cost': best.cost + 5 * length(added), 'audit': best.audit || added, 'talk': best.talk || lines}}) AS best
  FROM parse JOIN counts USING (conv) JOIN inserts USING (state)
  WHERE place = n AND met IN ('', 'a') GROUP BY conv
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(substr(best.talk, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), '') AS conv FROM conversations)
LEFT JOIN counts USING (conv) LEFT JOIN repaired USING (conv)
"""

FIELD = "coalesce(CAST(strlen({0}) AS VARCHAR) || ':' || {0}, '-')"

MERKLE_MANIFEST = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce('s' || lang, 'n') AS lang,
         {" || ".join(FIELD.format(c) for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)"))} AS head,
         text, CASE WHEN {CRC32.format("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN translate(text, {LETTERS}) ELSE text END AS seen
  FROM documents
), hashed AS (
  SELECT doc_id, lang, sha256(head || {FIELD.format("text")}) AS leaf, sha256(head || {FIELD.format("seen")}) AS found FROM texts
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY lang) AS n
  FROM hashed
), nodes AS (
  SELECT lang, 0 AS level, place, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT lang, level + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE n > 1 GROUP BY lang, level, place // 8, n
), subroots AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1
), top_nodes AS (
  SELECT 0 AS level, place, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM top_nodes WHERE n > 1 GROUP BY level, place // 8, n
), runs AS (
  SELECT lang, level, place, digest, n FROM nodes WHERE n > 1
  UNION ALL
  SELECT NULL, level, place, digest, n FROM top_nodes WHERE n > 1
), steps AS (
  SELECT lang, level, place,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || '|' ||
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS step
  FROM runs WINDOW w AS (PARTITION BY lang, level, place // 8 ORDER BY place)
), inner_paths AS (
  SELECT l.lang, l.place, list(s.step ORDER BY s.level) AS steps
  FROM leaves l JOIN steps s ON s.lang = l.lang AND s.place = l.place >> (3 * s.level) GROUP BY l.lang, l.place
), outer_paths AS (
  SELECT r.lang, list(s.step ORDER BY s.level) AS steps
  FROM subroots r JOIN steps s ON s.lang IS NULL AND s.place = r.place >> (3 * s.level) GROUP BY r.lang
), proofs AS (
  SELECT l.*, subroot, list_concat(coalesce(i.steps, []), coalesce(o.steps, [])) AS path
  FROM leaves l JOIN subroots r USING (lang) LEFT JOIN inner_paths i ON i.lang = l.lang AND i.place = l.place
  LEFT JOIN outer_paths o ON o.lang = l.lang
), folded AS (
  SELECT *, list_reduce(list_prepend(found, path),
           lambda below, step: sha256(split_part(step, '|', 1) || below || split_part(step, '|', 2))) AS folded_root
  FROM proofs
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded, (SELECT digest AS root FROM top_nodes WHERE n = 1)
"""

ITEM_WORDS = rf"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), {LETTERS}),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

DECONTAMINATION = f"""
WITH d AS (
  SELECT doc_id, {ITEM_WORDS} AS w FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {ITEM_WORDS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT *, least(len(w), 10) AS n FROM b WHERE len(w) > 0))
), lengths AS (
  SELECT DISTINCT n FROM windows
), scanned AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths)
), hits AS (
  SELECT doc_id, n, i, item FROM scanned JOIN windows USING (n, words)
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_shingle_join": SHINGLE_JOIN,
    "op6_host_rules": HOST_RULES,
    "op8_pivot_search": TOP_K,
    "op11_conversation_repair": CONVERSATION_REPAIR,
    "op12_merkle_manifest": MERKLE_MANIFEST,
    "op13_decontamination": DECONTAMINATION,
}
