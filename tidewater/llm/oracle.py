"""DuckDB SQL with the same rows as the registered queries of this package."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""

ORACLE["op8_benchmark_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
grams AS (
  SELECT item_id, least(len(w), 10) AS size, list_slice(w, s, s + least(len(w), 10) - 1) AS g
  FROM (SELECT *, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS s FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM grams),
doc_grams AS (
  SELECT r, s, size, list_slice(w, s, s + size - 1) AS g
  FROM (SELECT r, w, size, unnest(generate_series(1, len(w) - size + 1)) AS s FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT r, s, doc_grams.size AS size, item_id FROM doc_grams JOIN (SELECT DISTINCT * FROM grams) USING (g)),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + size - 1)) AS p FROM hits) GROUP BY r),
hit_items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
              FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

ORACLE["op10_line_dedup"] = """
WITH RECURSIVE places AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
d AS (SELECT line, md5(line) AS h, length(line) AS n, min(doc_id) AS doc_id, count(*) AS n_copies FROM places WHERE line <> '' GROUP BY line),
pairs AS MATERIALIZED (
  SELECT a.h AS a, b.h AS b
  FROM (SELECT *, unnest([n, n + 1, n + 2]) AS other FROM d) AS a JOIN d AS b ON b.n = a.other
  WHERE (a.n < b.n OR a.h < b.h) AND levenshtein(a.line, b.line) <= least(a.n // 10, 2)),
links AS MATERIALIZED (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
classes AS (SELECT a AS h, min(least(a, b)) AS class_md5 FROM reach GROUP BY a),
degree AS (SELECT a AS h, count(*) AS n_links FROM links GROUP BY a)
SELECT h AS line_md5, doc_id, n_copies, coalesce(n_links, 0) AS n_links, coalesce(class_md5, h) AS class_md5
FROM d LEFT JOIN degree USING (h) LEFT JOIN classes USING (h)
"""

ORACLE["op3_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""

ORACLE["op7_chat_formatting"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, 4 + length(regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g')) + 2
               + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')) + 8 AS chars FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

ORACLE["op11_spelling_variants"] = """
WITH RECURSIVE steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS step),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
bytes AS (
  SELECT run, flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END)) AS b FROM runs),
hashed AS (
  SELECT run, length(run) AS chars,
         xor(list_reduce(b, lambda c, x: xor(c // 256, step[CAST(xor(c, CAST(x AS BIGINT)) % 256 AS INTEGER) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h
  FROM bytes, steps),
forms AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % chars AS INTEGER)) || substr(run, CAST(h % chars AS INTEGER) + 2) ELSE run END AS word FROM hashed),
w AS MATERIALIZED (
  SELECT word, count(*) AS n, length(word) AS chars,
         translate(word, 'ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖ×ØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõö÷øùúûüýþÿ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_{}~|') AS bytes
  FROM forms GROUP BY word HAVING count(*) >= 2 AND length(word) >= 7),
pairs AS MATERIALIZED (
  SELECT a.word AS a, b.word AS b, a.n AS a_n, b.n AS b_n
  FROM (SELECT *, unnest([chars, chars + 1]) AS other FROM w) AS a JOIN w AS b ON b.chars = a.other
  WHERE (a.chars < b.chars OR a.word < b.word) AND levenshtein(a.bytes, b.bytes) = 1),
near AS (SELECT a AS word, b AS near, b_n AS near_n FROM pairs UNION ALL SELECT b, a, a_n FROM pairs),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS near_n FROM near GROUP BY word),
first AS (SELECT near.word, n_near, best.near_n, min(near) AS near FROM near JOIN best ON near.word = best.word AND near.near_n = best.near_n GROUP BY ALL),
named AS MATERIALIZED (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
  FROM w LEFT JOIN first USING (word)),
way AS (
  SELECT word, word AS place, 0 AS hops FROM named
  UNION ALL SELECT way.word, named.form, hops + 1 FROM way JOIN named ON named.word = way.place WHERE named.form IS NOT NULL),
ends AS (SELECT word, arg_max(place, hops) AS root FROM way GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM named JOIN ends USING (word)
"""

ORACLE["op12_source_mixing"] = """
WITH d AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS size,
         (length(regexp_replace(coalesce(text, ''), '[^A-Za-z]+', '', 'g')) + 1) / (length(coalesce(text, '')) + 1) AS quality,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS digest FROM documents),
k AS (SELECT *, -ln((CAST('0x' || substr(digest, 1, 13) AS BIGINT) + 0.5) / 4503599627370496) / quality AS key FROM d),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS weight FROM s),
levels AS (
  SELECT *, 2 * source_size / weight AS ratio,
         (1.5 * CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(2 * source_size) OVER lower, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER lower, 0)) AS level
  FROM weighed WINDOW lower AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
one AS (SELECT arg_min(level, ratio) AS level FROM levels WHERE level <= ratio),
targets AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size, least(CAST(2 * source_size AS DOUBLE), weight * one.level) AS target FROM weighed, one),
words AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS total FROM targets),
placed AS (
  SELECT k.*, source_size, target, CASE WHEN source_size > 0 THEN total // source_size ELSE 0 END AS epochs, total,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN words ON k.source IS NOT DISTINCT FROM words.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(least(total - epochs * source_size - before, size), 0) AS BIGINT) AS taken FROM placed
"""

ORACLE["op13_ranked_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
held AS (SELECT r, doc_id, len(w) AS n, w AS words FROM d WHERE len(w) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM held),
items AS (
  SELECT item_id, term, count(*) AS repeats
  FROM (SELECT item_id, unnest(list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
tf AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM held) WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, docs),
scored AS (
  SELECT item_id, held.r, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM items JOIN tf USING (term) JOIN weights USING (term) JOIN held ON held.r = tf.r, total GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
