"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Sets are compared once per distinct set, by counting the shingles two of them share.
MINHASH = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array({LOWERED}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s
  FROM worded),
kinds AS (SELECT min(doc_id) AS k, len(s) AS n, s FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT k, n, unnest(s) AS g FROM kinds),
pairs AS (
  SELECT a.k AS a, b.k AS b FROM items a JOIN items b ON a.g = b.g AND a.k < b.k
  GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(k, r) AS (SELECT k, k FROM kinds UNION SELECT reach.k, links.b FROM reach JOIN links ON reach.r = links.a),
roots AS (SELECT k, min(r) AS root FROM reach GROUP BY k)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(root, sets.doc_id) AS component_id,
       coalesce(root, sets.doc_id) = sets.doc_id AS kept
FROM sets LEFT JOIN kinds ON sets.s = kinds.s LEFT JOIN roots ON roots.k = kinds.k
"""

#: crc32 by its table, byte by byte; near words by the word with one place left open, and by the word without it.
SPELLING = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) ORDER BY n) AS t
  FROM range(256) AS bytes(n)),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word FROM documents),
counted AS (SELECT doc_id, word, hex(encode(doc_id || ':' || word)) AS x, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT word, n, xor(list_reduce(list_transform(range(1, len(x), 2), lambda i: CAST('0x' || substr(x, CAST(i AS INT), 2) AS BIGINT)),
                                  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM counted, crc_table),
slipped AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(word, 1, h % length(word)) || substr(word, h % length(word) + 2) ELSE word END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped GROUP BY word HAVING length(word) >= 6 AND sum(n) >= 5),
holes AS (
  SELECT word, n, i, substr(word, 1, i - 1) || '?' || substr(word, i + 1) AS open, substr(word, 1, i - 1) || substr(word, i + 1) AS shorter
  FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
longer AS (SELECT DISTINCT h.word, h.n, s.word AS other, s.n AS other_n FROM holes h JOIN words s ON h.shorter = s.word),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.open = b.open AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT word, n, other, other_n FROM longer UNION ALL SELECT other, other_n, word, n FROM longer),
best AS (SELECT word, n, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n FROM near GROUP BY word, n),
forms AS (SELECT word, form, form_n FROM best WHERE form_n >= 5 * n),
ways(word, here, step) AS (
  SELECT word, word, 0 FROM words UNION ALL SELECT ways.word, forms.form, step + 1 FROM ways JOIN forms ON ways.here = forms.word),
roots AS (SELECT word, first(here ORDER BY step DESC) AS root FROM ways GROUP BY word)
SELECT words.word, forms.form, roots.root, words.n, coalesce(best.n_near, 0) AS n_near, forms.form_n
FROM words JOIN roots USING (word) LEFT JOIN best USING (word) LEFT JOIN forms USING (word)
"""

DIVERGENCE = rf"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({LOWERED}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found FROM documents),
kept AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(found)) AS term FROM docs) GROUP BY lang, term HAVING count(*) >= 3),
occurrences AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(found) AS term FROM docs) JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN occurrences o USING (lang, source, term)),
shares AS (
  SELECT lang, source, term, n, 1 + CAST(1000000000 AS HUGEINT) * (n + 1) // (sum(n) OVER (PARTITION BY lang, source) + v) AS p FROM cells JOIN sizes USING (lang)),
whole AS (
  SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 1) // (sum(n) OVER (PARTITION BY lang) + v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY lang, term) JOIN sizes USING (lang)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term)
    ON x.lang = a.lang AND x.source = a.source AND y.source = b.source
  GROUP BY ALL),
terms AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item, (p - q) * (p - q) // q AS value
  FROM shares s JOIN whole w ON s.lang = w.lang AND s.term = w.term WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
