"""The queries as DuckDB SQL. Thresholds and word lists are written out here on their own."""

ORACLE_SQL = {
    "op4_quality_rules": r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), cut AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM doc
), places AS (
  SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM cut WHERE len(w) >= 3
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM places
), hit AS (
  SELECT DISTINCT r, unnest([i, i + 1, i + 2]) AS i FROM windows WHERE n > 1
), repeated AS (
  SELECT r, count(*) AS n FROM hit GROUP BY r
), measured AS (
  SELECT cut.*, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN (
           'the','and','of','to','a','in','is','that','was','it','for','on','with','as','this','by','be','are','at','from',
           'de','la','le','et','en','des','les','un','du','une','est','pour','que','qui','dans','au','par','pas','sur','avec',
           'der','die','und','von','den','zu','das','mit','sich','nicht','auf','ist','im','eine','ein','dem','für','er','sie','ich',
           'el','las','los','y','se','del','con','por','una','no','para','al','su','es','lo','como','más','o','pero','sus'))) AS n_stop_words
  FROM cut LEFT JOIN repeated ON cut.r = repeated.r
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 15 * n_words AND n_symbols / n_words <= 0.3
         AND n_stop_words / n_words >= 0.01 AND n_dup_lines / n_lines <= 0.3 AS kept,
       n_stop_words, n_lines
FROM judged""",
    "op5_dictionary_warc": r"""
WITH page AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), known AS (
  SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest FROM page
), grouped AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS response FROM known
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN response END AS refers_to
FROM grouped""",
    "op8_near_duplicates": r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM doc
), entry AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM shingled
), pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM entry a JOIN entry b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT reach.node, pair.b FROM reach JOIN pair ON reach.seen = pair.a
), label AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT shingled.doc_id, len(s) AS n_shingles, component_id, shingled.doc_id = component_id AS kept
FROM shingled JOIN label ON shingled.doc_id = label.node""",
    "op10_substring_dedup": r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), places AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM doc WHERE len(w) >= 35
), windows AS (SELECT r, i, count(*) OVER (PARTITION BY sha256(array_to_string(w[i:i + 34], ' '))) AS n FROM places
), hit AS (SELECT DISTINCT r, i + j AS i FROM windows, range(0, 35) AS t(j) WHERE n > 1
), removed AS (SELECT r, list(i) AS gone FROM hit GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_sort(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i))), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM doc LEFT JOIN removed ON doc.r = removed.r""",
    "op2_winnowing_decontamination": r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), item_place AS (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0
), item_window AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS x FROM item_place
), length AS (SELECT DISTINCT n FROM item_window
), place AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, length WHERE len(w) >= n
), doc_window AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS x FROM place
), found AS (SELECT r, i, n, item FROM doc_window JOIN item_window USING (n, x)
), hit AS (SELECT r, count(DISTINCT i + j) AS n_hit FROM found, range(0, 10) AS t(j) WHERE j < n GROUP BY r
), named AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM found GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit ON doc.r = hit.r LEFT JOIN named ON doc.r = named.r""",
    "op11_prefix_trie": r"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), original AS (
  SELECT c, list({'role': role, 'text': text} ORDER BY place) AS s FROM turns GROUP BY c
), crc AS (
  SELECT c, s, c - c % 20 AS donor,
         xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii((c::VARCHAR)[i])::BIGINT),
           lambda x, y: list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda p, q: CASE WHEN p % 2 = 1 THEN xor(p // 2, 3988292384) ELSE p // 2 END)), 4294967295) % 4 AS h
  FROM original
), rebuilt AS (
  SELECT a.c, list_concat(coalesce(b.s[1:a.h], []), coalesce(a.s[a.h + 1:], [])) AS s FROM crc a LEFT JOIN original b ON b.c = a.donor
), prefix AS (
  SELECT c, len(s) AS n, d, s[1:d] AS p FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)
), node AS (
  SELECT d, p, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CASE WHEN n = d THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256,
         CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(p[d].text, '[^\x20\x09-\x0D]+')) END AS words
  FROM prefix GROUP BY d, p
), parent AS (
  SELECT a.d, a.p, min(b.conv_id) AS parent_conv_id FROM node a JOIN node b ON b.d = a.d - 1 AND b.p = a.p[1:a.d - 1] GROUP BY a.d, a.p
), childless AS (
  SELECT d, p FROM node a WHERE NOT EXISTS (SELECT 1 FROM node b WHERE b.d = a.d + 1 AND b.p[1:a.d] = a.p)
), children AS (
  SELECT b.d - 1 AS d, b.p[1:b.d - 1] AS p, count(*) AS n FROM node b WHERE b.d > 0 GROUP BY ALL
), above AS (
  SELECT e AS d, p[1:e] AS p, (n_convs - 1) * words AS saved, leaf
  FROM (SELECT node.*, childless.d IS NOT NULL AS leaf, unnest(range(0, node.d + 1)) AS e FROM node LEFT JOIN childless ON node.d = childless.d AND node.p = childless.p)
), total AS (
  SELECT d, p, sum(saved) AS saved_tokens, count(*) FILTER (leaf) AS n_leaves FROM above GROUP BY d, p
)
SELECT node.conv_id, node.d AS depth, parent.parent_conv_id, node.n_convs, coalesce(children.n, 0) AS n_children, total.n_leaves,
       total.saved_tokens::BIGINT AS saved_tokens, node.ends_sha256
FROM node JOIN total ON node.d = total.d AND node.p = total.p
LEFT JOIN parent ON node.d = parent.d AND node.p = parent.p LEFT JOIN children ON node.d = children.d AND node.p = children.p""",
    "op13_hard_negatives": r"""
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank,
         s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5""",
}
